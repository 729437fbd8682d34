"""The engine: SQL and DataFrames over a catalog's tables and views, for a user."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestack.operators import security
from lodestack.operators.security import Policies, Policy
from lodestack.operators.table import Table, create_as
from lodestack.plans.predicates import Parser, Unsupported, to_column
from lodestack.sources import names
from lodestack.sources.catalog import AlreadyExists, Catalog, CatalogError, NoSuchView, State, split_name
from lodestack.sources.specifiers import ALLOW_NON_ACID, IMPORT_DATA, PARTITIONS, split

__all__ = ["Engine", "Policies", "Policy"]

VERSION = "1"
SYSTEM_TABLES = ("system_schema.release", "information_schema.schemata", "information_schema.tables", "information_schema.columns")
_GROUPS = "<groups>"


def _json_form(column: Column, kind: T.DataType) -> Column:
    """A value with maps, at any depth, as lists of key and value (as JSON's objects have texts for keys)."""
    if isinstance(kind, T.MapType):
        entry = lambda e: F.struct(_json_form(e["key"], kind.keyType).alias("key"), _json_form(e["value"], kind.valueType).alias("value"))
        return F.transform(F.map_entries(column), entry)
    if isinstance(kind, T.ArrayType):
        return F.transform(column, lambda e: _json_form(e, kind.elementType)) if _has_map(kind) else column
    if isinstance(kind, T.StructType) and _has_map(kind):
        return F.when(column.isNotNull(), F.struct(*(_json_form(column[f.name], f.dataType).alias(f.name) for f in kind.fields)))
    return column


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    return isinstance(kind, T.MapType) or isinstance(kind, T.StructType) and any(_has_map(f.dataType) for f in kind.fields)


class Engine:
    """Queries run with the rights of `user`; `policies` say which rows and columns that user sees."""

    def __init__(self, spark: SparkSession, root: str, user: str = "", policies: Policies | None = None):
        self.spark, self.catalog, self.user, self.policies = spark, Catalog(spark, root), user, policies or Policies()

    def as_user(self, user: str) -> Engine:
        out = object.__new__(Engine)
        out.spark, out.catalog, out.user, out.policies = self.spark, self.catalog, user, self.policies
        return out

    # Transactions

    def begin(self) -> bool:
        return self.catalog.begin()

    def commit(self) -> bool:
        return self.catalog.commit()

    def rollback(self) -> bool:
        return self.catalog.rollback()

    # Reading

    def _policy(self, name: str) -> Policy:
        return self.policies.of("/".join(split_name(name)), self.user)

    def table(self, name: str, where: str | None = None, columns: Sequence[str] | None = None) -> DataFrame:
        """A table, a view or a partitions table, by name, as the user may see it."""
        if name.lower() in SYSTEM_TABLES:
            return self.system(name.lower())
        bare, specifier = split(name)
        if specifier == PARTITIONS:
            security.check_partitions(self._policy(bare))
            return Table(self.catalog, bare).partitions()
        if specifier:
            raise CatalogError(f"{specifier[0]} is no table to read")
        namespace, short = split_name(name)
        policy = self._policy(name)
        view = self.catalog.state().views.get(f"{namespace}/{short}")
        if view is not None:
            rows = self._view_rows(view)
            out = security.secured(rows, policy, None, name)
            out = out.where(where) if where else out
        else:
            # The user's condition prunes files, but is evaluated above filters and masks.
            rows = Table(self.catalog, name).scan(None if policy.masks or policy.row_filters else where)
            out = security.secured(rows, policy, None, name)
            if where and (policy.masks or policy.row_filters):
                out = out.where(where)
        if columns is not None:
            security.check_select(policy, columns, name)
            out = out.select(*columns)
        return out

    def sql(self, text: str) -> DataFrame:
        """Spark SQL over the engine's tables and views, which are named by three parts or more, and the system tables.

        Spark's parser finds the names, so texts, comments, columns and names of common table expressions stay as they
        are, and so do Spark's own tables and file paths.
        """
        return names.run(self.spark, text, self._own, self.table)

    @staticmethod
    def _own(parts: tuple[str, ...]) -> str | None:
        name = ".".join(parts)
        if name.lower() in SYSTEM_TABLES:
            return name.lower()
        return name if parts[0].lower() not in names.FORMATS and name.count(".") + name.count("/") > 1 else None

    def run(self, text: str) -> DataFrame:
        """Any statement: DDL, changes, transactions, SHOW, DESCRIBE, ANALYZE, or a query."""
        from lodestack.statements import Statements

        return Statements(self).run(text)

    def execute(self, text: str, groups: Sequence[str] = (), enforce_identity: bool = False) -> DataFrame:
        """A query's rows as one JSON column `records`, nulls included.

        Numbers, texts, lists and rows have their JSON forms, bytes are base64, maps lists of key and value.
        `<groups>` in the text becomes the caller's groups, as quoted texts; with enforce_identity the text must have
        it and there must be groups.
        """
        if enforce_identity and (_GROUPS not in text or not groups):
            raise PermissionError(f"the query must name {_GROUPS}, and the caller must have groups")
        quoted = ",".join("'" + g.replace("'", "''") + "'" for g in groups)
        rows = self.sql(text.replace(_GROUPS, quoted))
        # Bytes as base64, a row as an object, a map as a list of entries (its keys may be other than texts).
        return rows.select(F.to_json(F.struct(*(_json_form(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in rows.schema.fields)), {"ignoreNullFields": "false"}).alias("records"))

    def select(self, text: str) -> DataFrame:
        """The restricted language: `SELECT columns FROM table [WHERE ...] [ORDER BY columns] [LIMIT n]`.

        Conditions are comparisons of a column with a literal, IN, NOT IN, IS NULL and IS NOT NULL, under AND and OR;
        anything else raises Unsupported.  Columns come in the order of the SELECT.
        """
        p = Parser(text.rstrip().rstrip(";"))
        p.need("SELECT")
        columns = None if p.take("*") else [p.name()]
        while columns is not None and p.take(","):
            columns.append(p.name())
        p.need("FROM")
        name = p.name()
        while p.at < len(p.tokens) and p.tokens[p.at][1].startswith("."):
            name += p.tokens[p.at][1]
            p.at += 1
        where = p.condition() if p.take("WHERE") else None
        order: list = []
        if p.take("ORDER"):
            p.need("BY")
            while True:
                c = F.col(f"`{p.name()}`")
                order.append(c.desc() if p.take("DESC") else (p.take("ASC"), c.asc())[1])
                if not p.take(","):
                    break
        limit = p.literal() if p.take("LIMIT") else None
        if p.at < len(p.tokens):
            raise Unsupported(f"nothing expected at {p.tokens[p.at][1]}")
        policy = self._policy(name)
        if columns:
            security.check_select(policy, columns, name)
        plain = not policy.masks and not policy.row_filters
        rows = security.secured(Table(self.catalog, name).scan(where), policy) if plain else self.table(name)
        if where is not None and not plain:
            rows = rows.where(to_column(where))
        rows = rows.orderBy(*order) if order else rows
        rows = rows.select(*columns) if columns else rows
        return rows.limit(limit) if limit is not None else rows

    def batches(self, text: str) -> Iterator[Any]:
        """Rows of a query, fetched partition by partition."""
        return self.sql(text).toLocalIterator()

    def system(self, name: str) -> DataFrame:
        """System tables: the release, and what the catalog holds."""
        if name == "system_schema.release":
            return self.release()
        state = self.catalog.state()

        def columns_of(n: str) -> list[tuple[str, str]]:
            return list(zip(state.views[n]["columns"], state.views[n]["types"], strict=True)) if n in state.views else [(c, t) for c, t, _ in self.catalog.describe(n)]

        def policy_of(n: str) -> Policy | None:
            try:
                return self.policies.of(n, self.user)
            except PermissionError:  # a policy that can't be read hides the table
                return None

        if name == "information_schema.schemata":
            return self.spark.createDataFrame([(n.replace("/", "."),) for n in sorted(state.namespaces)], "schema_name string")
        entries = [(n, "BASE TABLE") for n in sorted(state.tables)] + [(n, "VIEW") for n in sorted(state.views)]
        each = [(n, k, policy_of(n), columns_of(n)) for n, k in entries]
        each = [e for e in each if e[2] is not None and not security.hides_all(e[2], [c for c, _ in e[3]])]
        if name == "information_schema.tables":
            return self.spark.createDataFrame([(n.rpartition("/")[0].replace("/", "."), n.rpartition("/")[2], k) for n, k, _, _ in each], "table_schema string, table_name string, table_type string")
        rows = []
        for n, _, policy, columns in each:
            shown = security.visible(policy, [c for c, _ in columns])
            rows += [(n.rpartition("/")[0].replace("/", "."), n.rpartition("/")[2], c, i + 1, t) for i, (c, t) in enumerate(columns) if c in shown]
        return self.spark.createDataFrame(rows, "table_schema string, table_name string, column_name string, ordinal_position int, data_type string")

    def release(self) -> DataFrame:
        """The system table of the release."""
        return self.spark.createDataFrame([(VERSION, "")], "version string, hash string")

    # Changes

    def insert(self, name: str, rows: DataFrame) -> int:
        """Add rows; into `t.import_data(c, ...)` each row names a file, and gives constants for the columns."""
        bare, specifier = split(name)
        if specifier and specifier[0] == IMPORT_DATA:
            from lodestack.sources.catalog import FILE_PATH

            security.check_insert(self._policy(bare), [f.name for f in self.catalog.manifest(bare)[2].fields])
            return Table(self.catalog, bare).import_table(rows.select(*specifier[1], FILE_PATH))
        if specifier:
            raise CatalogError(f"can't insert into {name}")
        security.check_insert(self._policy(name), rows.columns)
        return Table(self.catalog, name).append(rows)

    def create_table_as(self, name: str, rows: DataFrame, partitioning: Sequence[str] = (), sorted_by: Sequence[str] = ()) -> Table:
        return create_as(self.catalog, name, rows, partitioning, sorted_by)

    def delete(self, name: str, where: str | None = None) -> int:
        bare, specifier = split(name)
        if specifier and specifier[0] == ALLOW_NON_ACID and len(specifier) > 1 and specifier[1] == PARTITIONS[0]:
            security.check_drop(self._policy(bare))
            return Table(self.catalog, bare).drop_partitions(where or "true", allow_non_acid=True)
        if "/".join(split_name(bare)) in self.catalog.state().views:
            raise CatalogError("rows can't be deleted from a view")
        if specifier:
            raise CatalogError(f"can't delete from {name}")
        return Table(self.catalog, name).delete(security.delete_condition(self._policy(name), where))

    def update(self, name: str, assignments: Mapping[str, str], where: str | None = None) -> None:
        security.check_update(self._policy(name))
        if split(name)[1]:
            raise CatalogError(f"can't update {name}")
        Table(self.catalog, name).update(assignments, where)

    def merge(self, name: str, source: DataFrame, on: str, matched: Sequence = (), not_matched: Sequence = ()) -> None:
        security.check_update(self._policy(name))
        if split(name)[1]:
            raise CatalogError(f"can't merge into {name}")
        Table(self.catalog, name).merge(source, on, matched, not_matched)

    def drop_partition(self, name: str, where: str) -> int:
        """ALTER TABLE ... DROP PARTITION: the name must carry the specifier allow_non_acid."""
        bare, specifier = split(name)
        security.check_drop(self._policy(bare))
        return Table(self.catalog, bare).drop_partitions(where, allow_non_acid=bool(specifier) and specifier[0] == ALLOW_NON_ACID)

    # Views

    def _view_rows(self, view: dict) -> DataFrame:
        """A view's query has the rights of its owner, the user that made it; the policy on the view itself is the caller's."""
        rows = self.as_user(view["owner"]).sql(view["text"]) if "owner" in view else self.sql(view["text"])
        return rows.toDF(*view["columns"])

    def create_view(self, name: str, text: str, columns: Sequence[str] | None = None, comments: Mapping[str, str] | None = None, comment: str | None = None, replace: bool = False, if_not_exists: bool = False, properties: Mapping[str, str] | None = None) -> None:
        """A view over a query; its columns can be renamed (as many as the query has) and commented."""
        namespace, short = split_name(name)
        found = self.sql(text)
        shown = list(columns) if columns is not None else found.columns
        if len(shown) != len(found.columns):
            raise CatalogError(f"the view names {len(shown)} columns, the query has {len(found.columns)}")
        if len(set(shown)) < len(shown):
            raise CatalogError("two columns of the view have one name")
        unknown = set(comments or {}) - set(shown)
        if unknown:
            raise CatalogError(f"no column {unknown.pop()}")
        key = f"{namespace}/{short}"
        entry = {"text": text, "columns": shown, "types": [t for _, t in found.dtypes], "comments": dict(comments or {}), "comment": comment, "properties": dict(properties or {}), "owner": self.user}

        def edit(s: State) -> None:
            if namespace not in s.namespaces:
                raise CatalogError(f"no namespace {namespace}")
            if key in s.tables:
                raise AlreadyExists(f"{name} is a table")
            if key in s.views and not replace:
                if if_not_exists:
                    return
                raise AlreadyExists(f"{name} exists")
            s.views[key] = entry

        self.catalog.change(edit)

    def view(self, name: str) -> dict:
        found = self.catalog.state().views.get("/".join(split_name(name)))
        if found is None:
            raise NoSuchView(f"no view {name}")
        return found

    def alter_view(self, name: str, text: str) -> None:
        """Give a view a new query.  Comment and properties stay; if its columns differ from the old query's, their
        names and comments are the new query's."""
        old, new = self.view(name), self.sql(text)
        same = [t for _, t in new.dtypes] == old["types"] and new.columns == self.sql(old["text"]).columns
        entry = {**old, "text": text, "types": [t for _, t in new.dtypes]}
        if not same:
            entry |= {"columns": new.columns, "comments": {}}
        key = "/".join(split_name(name))
        self.catalog.change(lambda s: s.views.__setitem__(key, entry))

    def rename_view(self, old: str, new: str) -> None:
        (a, x), (b, y) = split_name(old), split_name(new)
        if a != b:
            raise CatalogError("renaming a view can't change its namespace")

        def edit(s: State) -> None:
            if f"{a}/{x}" not in s.views:
                raise NoSuchView(f"no view {old}")
            if f"{b}/{y}" in s.views or f"{b}/{y}" in s.tables:
                raise AlreadyExists(f"{new} exists")
            s.views[f"{b}/{y}"] = s.views.pop(f"{a}/{x}")

        self.catalog.change(edit)

    def drop_view(self, name: str, if_exists: bool = False) -> bool:
        key = "/".join(split_name(name))
        dropped = self.catalog.change(lambda s: s.views.pop(key, None) is not None)
        if not dropped and not if_exists:
            raise NoSuchView(f"no view {name}")
        return dropped

    def views(self, namespace: str) -> DataFrame:
        """Rows (namespace, viewName, isTemporary)."""
        key = Catalog._namespace(namespace)
        rows = [(key, n.rpartition("/")[2], False) for n in sorted(self.catalog.state().views) if n.rpartition("/")[0] == key]
        return self.spark.createDataFrame(rows, "namespace string, viewName string, isTemporary boolean")

    def get(self, name: str, row_id: int, columns: Sequence[str] | None = None) -> DataFrame:
        """A row by its id, if the user may see all of the table."""
        policy = self._policy(name)
        if policy != Policy():
            raise PermissionError("access denied: rows by id of a table with a policy")
        return Table(self.catalog, name).get(row_id, columns)

    def put(self, name: str, rows: DataFrame) -> DataFrame:
        """Add rows and return their ids."""
        t = Table(self.catalog, name)
        before = self.catalog.manifest(name)[2].next_row_id
        t.append(rows)
        return t.row_ids().where(F.col("_row_id") >= before)
