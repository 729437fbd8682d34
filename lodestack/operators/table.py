"""Scans and changes of tables: immutable files, rewritten file by file, swapped in by the catalog."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestack.functions.transforms import apply
from lodestack.plans import predicates as P
from lodestack.sources.catalog import FILE_PATH, ROW_ID, Catalog, CatalogError, Manifest
from lodestack.sources.filelist import LINE, DataFile, FileList, from_text, key_texts
from lodestack.sources.scratch import scratch

NON_ACID = "partitions are dropped without regard to rows that others are adding to them: allow_non_acid must say that this is meant"
_FILE = "_file"


class MergeError(ValueError):
    """More than one source row matches a target row."""


@dataclass(frozen=True)
class WhenMatched:
    """UPDATE (assignments: column to SQL over `t` and `s`, or "*" for all) or DELETE of matched target rows."""

    action: str
    assignments: Mapping[str, str] | str | None = None
    condition: str | None = None


@dataclass(frozen=True)
class WhenNotMatched:
    """INSERT of source rows without a match (values: column to SQL over `s`, or "*")."""

    values: Mapping[str, str] | str = "*"
    condition: str | None = None


class Table:
    """A table of a catalog.  Every change is one commit; scans hold to the manifest that they read."""

    def __init__(self, catalog: Catalog, name: str):
        self.catalog, self.name, self.spark = catalog, name, catalog.spark
        catalog.entry(name)

    # Scans

    def _kept_files(self, manifest: Manifest, where: P.Node | None) -> list[DataFile]:
        """Files whose partition keys don't rule the condition out."""
        ids = _row_ids(where)
        if ids is not None:
            return manifest.files.with_ids(ids)
        if where is None or not manifest.partitioning:
            return list(manifest.files)
        sources = [(t, manifest.field(t.column).kind) for t in manifest.partitioning]

        def possible(keys: list) -> bool:
            held: dict[str, list] = {}
            for (t, kind), key in zip(sources, keys, strict=True):
                held.setdefault(t.column, []).append(((t, kind), key))
            return P.possible(where, held)

        return manifest.files.chosen([f.dataType for f in manifest.key_fields()], possible)

    def _read(self, manifest: Manifest, files: Sequence[DataFile], hidden: bool = False) -> DataFrame:
        """Rows of files under the columns' present names; hidden: also the row id and the file."""
        logical = T.StructType([*manifest.schema().fields, *([T.StructField(ROW_ID, T.LongType()), T.StructField(_FILE, T.StringType())] if hidden else [])])
        if not files:
            return self.spark.createDataFrame([], logical)
        physical = T.StructType([*(T.StructField(f.physical, f.kind, True) for f in manifest.fields), *([T.StructField(ROW_ID, T.LongType())] if hidden else [])])
        folder = self.catalog.folder(self.name)
        rows = self.spark.read.schema(physical).parquet(*(f"{folder}/{f.path}" for f in files))
        chosen = [F.col(f.physical).alias(f.name) for f in manifest.fields]
        if hidden:
            chosen += [F.col(ROW_ID), _file_below(folder).alias(_FILE)]
        return rows.select(*chosen)

    def scan(self, where: str | P.Node | None = None, columns: Sequence[str] | None = None, hidden: bool = False, only_ordered: bool = False) -> DataFrame:
        """Rows that meet a condition.  Its parts on partition columns choose the files; Spark prunes columns and row
        groups below that.

        only_ordered: only the parts on sort columns reach the Parquet reader, where the others would cost more than
        they leave out; these are evaluated above it.
        """
        _, _, manifest = self.catalog.manifest(self.name)
        node = P.read(where) if isinstance(where, str) else where
        rows = self._read(manifest, self._kept_files(manifest, node), hidden)
        if node is not None and only_ordered:
            for part in P.conjuncts(node):
                met = P.to_column(part)
                rows = rows.where(met if P.single_column(part) in manifest.sorted_by else F.coalesce(met, F.lit(False)))
        elif node is not None:
            rows = rows.where(where if isinstance(where, str) else P.to_column(node))
        return rows.select(*columns) if columns else rows

    def files_for(self, where: str) -> int:
        """How many files a condition leaves to scan."""
        _, _, manifest = self.catalog.manifest(self.name)
        return len(self._kept_files(manifest, P.read(where)))

    def partitions(self, has_row_filter: bool = False) -> DataFrame:
        """The partitions table: a row for each partition, with its keys, est_row_count and est_byte_size."""
        if has_row_filter:
            raise PermissionError("access denied: the partitions table of a table with row filters")
        _, _, manifest = self.catalog.manifest(self.name)
        if not manifest.partitioning:
            raise CatalogError(f"{self.name} is not partitioned")
        fields = [T.StructField(t.key, f.dataType) for t, f in zip(manifest.partitioning, manifest.key_fields(), strict=True)]
        loose = [(x.path, x.bytes, x.rows, x.keys) for x in manifest.files.loose]
        each = self.spark.createDataFrame(loose, LINE)
        if manifest.files.parts:  # long lists are read by Spark
            each = each.unionByName(self.spark.read.schema(LINE).json([f"{self.catalog.root}/manifests/{p.name}" for p in manifest.files.parts]))
        rows = each.select(*(F.col("keys")[i].cast(f.dataType).alias(f.name) for i, f in enumerate(fields)), "rows", "bytes")
        return rows.groupBy(*(f.name for f in fields)).agg(F.sum("rows").alias("est_row_count"), F.sum("bytes").alias("est_byte_size"))

    def list_partitions(self, keys: Mapping[str, Any]) -> DataFrame:
        """Partitions whose keys equal the given ones; a null equals a null."""
        out = self.partitions()
        for name, value in keys.items():
            out = out.where(F.col(name).eqNullSafe(F.lit(value)))
        return out

    def unsupported_partition_metadata(self, *_: Any) -> None:
        raise NotImplementedError("partitions have no metadata of their own")

    create_partition = replace_partition_metadata = load_partition_metadata = unsupported_partition_metadata

    # Writing

    def _write(self, manifest: Manifest, rows: DataFrame, exact: bool = True) -> list[DataFile]:
        """Write rows (the table's columns and row ids) as new files.

        exact: rows are dealt by partition key first, so that a partition gets few files; a key of very many rows is
        split among tasks (by adaptive execution, at its advisory size).  Each task then writes its rows by key and sort
        key.
        """
        keys = [f.name for f in manifest.key_fields()]
        physical = rows.select(*(F.col(f"`{f.name}`").cast(f.kind).alias(f.physical) for f in manifest.fields), ROW_ID)
        for name, t in zip(keys, manifest.partitioning, strict=True):
            f = manifest.field(t.column)
            physical = physical.withColumn(name, apply(t, F.col(f.physical), f.kind))
        sort = [manifest.field(c).physical for c in manifest.sorted_by]
        if keys and exact:
            physical = physical.hint("rebalance", *(F.col(k) for k in keys))
        elif sort and not keys:
            physical = physical.repartitionByRange(*sort)
        if keys or sort:
            physical = physical.sortWithinPartitions(*keys, *sort)
        write, folder = uuid.uuid4().hex, self.catalog.folder(self.name)
        target = f"{folder}/{write}"
        (physical.write.partitionBy(*keys) if keys else physical.write).parquet(target)
        sizes = self.catalog.files.sizes(target)
        if not sizes:
            return []
        counts = self.spark.read.schema(T.StructType([T.StructField(ROW_ID, T.LongType())])).option("recursiveFileLookup", True).parquet(target).groupBy(_file_below(target).alias("f")).agg(F.count("*").alias("n"), F.min(ROW_ID).alias("low"), F.max(ROW_ID).alias("high")).collect()
        found = {r["f"]: r for r in counts}
        return [DataFile(f"{write}/{path}", size, r["n"], key_texts(path, len(keys)), r["low"], r["high"]) for path, size in sorted(sizes.items()) if (r := found.get(path))]

    def _numbered(self, manifest: Manifest, rows: DataFrame) -> DataFrame:
        """Rows with new row ids: unique, ascending in each task's rows, none ever used before."""
        return rows.withColumn(ROW_ID, F.monotonically_increasing_id() + F.lit(manifest.next_row_id))

    def _taken(self, manifest: Manifest, files: Sequence[DataFile]) -> int:
        """The first row id beyond those of new files."""
        return max([manifest.next_row_id, *(f.high + 1 for f in files)])

    def _shaped(self, manifest: Manifest, rows: DataFrame) -> DataFrame:
        """Rows with the table's columns: missing ones are null, unknown ones an error."""
        names = [f.name for f in manifest.fields]
        unknown = [c for c in rows.columns if c not in names]
        if unknown:
            raise CatalogError(f"no column {unknown[0]}")
        return rows.select(*(F.col(f"`{f.name}`").cast(f.kind).alias(f.name) if f.name in rows.columns else F.lit(None).cast(f.kind).alias(f.name) for f in manifest.fields))

    def append(self, rows: DataFrame, exact: bool = True) -> int:
        """Add rows (INSERT); columns that are missing become null.  Returns how many there are."""
        _, ident, manifest = self.catalog.manifest(self.name)
        files = self._write(manifest, self._numbered(manifest, self._shaped(manifest, rows)), exact)
        manifest.next_row_id = self._taken(manifest, files)
        manifest.files.add(files)
        self.catalog.replace_manifest(self.name, ident, manifest)
        return sum(f.rows for f in files)

    def _rewrite(self, manifest: Manifest, ident: str, touched: Sequence[DataFile], rows: DataFrame) -> None:
        files = self._write(manifest, rows)
        manifest.files.replace({f.path for f in touched}, files)
        self.catalog.replace_manifest(self.name, ident, manifest)

    def _touched(self, manifest: Manifest, condition: Column, node: P.Node | None) -> list[DataFile]:
        """Files that hold a row for which the condition is true; others are neither read again nor rewritten."""
        candidates = self._kept_files(manifest, node)
        hit = {r[0] for r in self._read(manifest, candidates, hidden=True).where(condition).select(_FILE).distinct().collect()}
        return [f for f in candidates if f.path in hit]

    def delete(self, where: str | None = None) -> int:
        """Delete the rows for which the condition is true (not null); returns how many."""
        _, ident, manifest = self.catalog.manifest(self.name)
        if where is None:
            gone = manifest.rows
            manifest.files = FileList()
            self.catalog.replace_manifest(self.name, ident, manifest)
            return gone
        touched = self._touched(manifest, F.expr(where), P.read(where))
        if not touched:
            return 0
        before = manifest.rows
        kept = self._read(manifest, touched, hidden=True).where(~F.coalesce(F.expr(where), F.lit(False))).drop(_FILE)
        self._rewrite(manifest, ident, touched, kept)
        return before - manifest.rows

    def delete_by_ids(self, ids: Sequence[int]) -> int:
        return self.delete(f"{ROW_ID} in ({', '.join(str(int(i)) for i in ids)})") if ids else 0

    def update(self, assignments: Mapping[str, str], where: str | None = None) -> None:
        """Set columns to SQL over the row, where the condition is true; row ids stay."""
        _, ident, manifest = self.catalog.manifest(self.name)
        if {ROW_ID, "row_id"} & set(assignments) - {f.name for f in manifest.fields} or ROW_ID in assignments:
            raise CatalogError("row ids can't be changed")
        for c in assignments:
            manifest.field(c)
            if c in manifest.sorted_by or any(t.column == c for t in manifest.partitioning):
                raise CatalogError(f"{c} is a sort or partition column and can't be updated")
        touched = list(manifest.files) if where is None else self._touched(manifest, F.expr(where), P.read(where))
        if not touched:
            return
        rows = self._read(manifest, touched, hidden=True).drop(_FILE)
        hit = F.coalesce(F.expr(where), F.lit(False)) if where else F.lit(True)
        new = [F.when(hit, F.expr(assignments[f.name]).cast(f.kind)).otherwise(F.col(f"`{f.name}`")).alias(f.name) if f.name in assignments else F.col(f"`{f.name}`") for f in manifest.fields]
        self._rewrite(manifest, ident, touched, rows.select(*new, ROW_ID))

    def merge(self, source: DataFrame, on: str, matched: Sequence[WhenMatched] = (), not_matched: Sequence[WhenNotMatched] = ()) -> None:
        """MERGE: `on` and the clauses are SQL over `t` (this table) and `s`.

        The first clause of a kind whose condition holds counts.  Only files with a match are rewritten; rows that are
        inserted get new files.  A target row with two matches raises MergeError.  The source is evaluated once: it is
        written to the shared folder, and all steps read that.
        """
        kept = scratch(self.spark, "source")
        names_of = [f"c{i}" for i in range(len(source.columns))]
        source.toDF(*names_of).write.parquet(kept)
        try:
            self._merge(self.spark.read.parquet(kept).toDF(*source.columns), on, matched, not_matched)
        finally:
            self.catalog.files.delete(kept)

    def _merge(self, source: DataFrame, on: str, matched: Sequence[WhenMatched], not_matched: Sequence[WhenNotMatched]) -> None:
        _, ident, manifest = self.catalog.manifest(self.name)
        for clause in matched:
            if clause.action not in ("update", "delete"):
                raise CatalogError(f"unknown action {clause.action}")
        names = [f.name for f in manifest.fields]
        target = self._read(manifest, manifest.files, hidden=True).alias("t")
        s = source.alias("s")
        found = target.join(s, F.expr(on)).groupBy(F.col(f"t.{_FILE}"), F.col(f"t.{ROW_ID}")).agg(F.count("*").alias("n")).groupBy(_FILE).agg(F.max("n").alias("n")).collect()
        if any(r["n"] > 1 for r in found) and matched:
            raise MergeError("a row of the target matches more than one row of the source")
        hit = {r[_FILE] for r in found}
        touched = [f for f in manifest.files if f.path in hit] if matched else []
        files: list[DataFile] = []
        if touched:
            rows = self._read(manifest, touched, hidden=True).drop(_FILE).alias("t").join(source.withColumn("__s", F.lit(True)).alias("s"), F.expr(on), "left")
            match = F.col("s.__s").isNotNull()
            which = F.lit(None).cast("int")
            for i in reversed(range(len(matched))):
                holds = match & (F.coalesce(F.expr(matched[i].condition), F.lit(False)) if matched[i].condition else F.lit(True))
                which = F.when(holds, F.lit(i)).otherwise(which)
            rows = rows.withColumn("__w", which)
            gone = [i for i, c in enumerate(matched) if c.action == "delete"]
            if gone:
                rows = rows.where(F.col("__w").isNull() | ~F.col("__w").isin(gone))
            new = []
            for f in manifest.fields:
                value = F.col(f"t.`{f.name}`")
                for i, c in enumerate(matched):
                    given = {n: f"s.`{n}`" for n in names if n in source.columns} if c.assignments == "*" else c.assignments or {}
                    if c.action == "update" and f.name in given:
                        value = F.when(F.col("__w") == i, F.expr(given[f.name]).cast(f.kind)).otherwise(value)
                new.append(value.alias(f.name))
            files += self._write(manifest, rows.select(*new, F.col(f"t.{ROW_ID}").alias(ROW_ID)))
        if not_matched:
            rest = s.join(target.select("t.*").alias("t"), F.expr(on), "left_anti")
            which = F.lit(None).cast("int")
            for i in reversed(range(len(not_matched))):
                c = not_matched[i].condition
                which = F.when(F.coalesce(F.expr(c), F.lit(False)) if c else F.lit(True), F.lit(i)).otherwise(which)
            rest = rest.withColumn("__w", which).where("__w is not null")
            new = []
            for f in manifest.fields:
                value = F.lit(None).cast(f.kind)
                for i, c in enumerate(not_matched):
                    given = {n: f"s.`{n}`" for n in names if n in source.columns} if c.values == "*" else c.values
                    if f.name in given:
                        value = F.when(F.col("__w") == i, F.expr(given[f.name]).cast(f.kind)).otherwise(value)
                new.append(value.alias(f.name))
            added = self._write(manifest, self._numbered(manifest, rest.select(*new)))
            manifest.next_row_id = self._taken(manifest, added)
            files += added
        manifest.files.replace({f.path for f in touched}, files)
        self.catalog.replace_manifest(self.name, ident, manifest)

    def drop_partitions(self, where: str, allow_non_acid: bool = False) -> int:
        """Drop whole partitions by a condition on key columns of the partitions table; returns how many."""
        if not allow_non_acid:
            raise CatalogError(NON_ACID)
        _, ident, manifest = self.catalog.manifest(self.name)
        if not manifest.partitioning:
            raise CatalogError(f"{self.name} is not partitioned")
        names = [t.key for t in manifest.partitioning]
        node = P.read(where)
        used = P.columns(node)
        if used is None or not used <= set(names):
            raise CatalogError(f"the condition must be on partition keys only: {', '.join(names)}")
        gone = {tuple(r[:-2]) for r in self.partitions().where(where).collect()}
        kinds = [f.dataType for f in manifest.key_fields()]
        manifest.files.replace({f.path for f in manifest.files if tuple(from_text(k, t) for k, t in zip(f.keys, kinds, strict=True)) in gone})
        self.catalog.replace_manifest(self.name, ident, manifest)
        return len(gone)

    def import_files(self, files: Sequence[tuple[str, Mapping[str, Any]]]) -> int:
        """Append the rows of Parquet files; each comes with constants for columns that it gives (as partition values
        of its folder).  Other columns come from the file and must be in it."""
        _, _, manifest = self.catalog.manifest(self.name)
        groups: dict[tuple, list[str]] = {}
        for path, constants in files:
            for c in constants:
                manifest.field(c)
            groups.setdefault(tuple(sorted(constants.items(), key=lambda x: x[0])), []).append(path)
        parts = []
        for constants, paths in groups.items():
            rows = self.spark.read.parquet(*paths)
            given = dict(constants)
            missing = [f.name for f in manifest.fields if f.name not in given and f.name not in rows.columns]
            if missing:
                raise CatalogError(f"{paths[0]} has no column {missing[0]}")
            parts.append(rows.select(*((F.lit(given[f.name]) if f.name in given else F.col(f"`{f.name}`")).cast(f.kind).alias(f.name) for f in manifest.fields)))
        if not parts:
            return 0
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return self.append(out)

    def import_table(self, listing: DataFrame) -> int:
        """Import by rows: a column `$parquet_file_path` names a file, all others are constants for it."""
        if FILE_PATH not in listing.columns:
            raise CatalogError(f"{FILE_PATH} is missing")
        rows = [r.asDict() for r in listing.collect()]
        return self.import_files([(r.pop(FILE_PATH), r) for r in rows])

    # Rows

    def get(self, row_id: int, columns: Sequence[str] | None = None) -> DataFrame:
        """The row of an id (none or one); without columns all of them and the id."""
        _, _, manifest = self.catalog.manifest(self.name)
        rows = self._read(manifest, manifest.files.with_ids([int(row_id)]), hidden=True).where(F.col(ROW_ID) == F.lit(int(row_id)))
        return rows.select(*columns) if columns else rows.drop(_FILE)

    def row_ids(self) -> DataFrame:
        _, _, manifest = self.catalog.manifest(self.name)
        return self._read(manifest, manifest.files, hidden=True).select(ROW_ID)


def create_as(catalog: Catalog, name: str, rows: DataFrame, partitioning: Sequence[str] = (), sorted_by: Sequence[str] = ()) -> Table:
    """CREATE TABLE AS SELECT; columns take nulls, whatever the query says."""
    catalog.create_table(name, rows.schema, list(partitioning), list(sorted_by))
    out = Table(catalog, name)
    out.append(rows)
    return out


def _row_ids(where: P.Node | None) -> list[int] | None:
    """The row ids that a condition asks for, or None if it doesn't name them."""
    for part in P.conjuncts(where) if where is not None else ():
        if isinstance(part, P.In) and part.column == ROW_ID and not part.negated:
            return [v for v in part.values if v is not None]
        if isinstance(part, P.Compare) and part.column == ROW_ID and part.operator == "=":
            return [part.value]
    return None


def _file_below(folder: str) -> Column:
    """The path of a row's file from a folder; Spark gives paths as URIs, so they are decoded."""
    decoded = F.url_decode(F.replace(F.input_file_name(), F.lit("+"), F.lit("%2B")))
    return F.element_at(F.split(decoded, f"/\\Q{folder.rpartition('/')[2]}\\E/", 2), 2)
