"""Tables by option: `spark.read.format("lodestack").option("root", ...).option("table", ...)`, and `df.write` likewise.

Each file of the table is a task's share; filters on partition columns leave out files before any is opened.  Scans in
Python are slower than `Engine.table`, which reads with Spark's own Parquet reader.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, WriterCommitMessage

from lodestack.operators.security import Policies, Policy
from lodestack.plans import predicates as P
from lodestack.sources.catalog import RETRIES, ROW_ID, Conflict, Manifest, NoSuchTable, split_name
from lodestack.sources.filelist import DataFile, FileList, key_text

_OPERATORS = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


def _files(root: str):
    from pyarrow import fs

    if "://" in root:
        return fs.FileSystem.from_uri(root)
    return fs.LocalFileSystem(), root.removeprefix("file:")


def load(root: str, table: str, at: tuple[str, str] | None = None) -> tuple[tuple[str, str], str, Manifest]:
    """What tells a table's version, its data folder and its manifest, read without a session.

    at: the version, as given before; else it is the latest.
    """
    files, base = _files(root.rstrip("/"))

    def read(path: str) -> dict:
        return json.loads(text(path))

    def text(path: str) -> str:
        with files.open_input_stream(path) as stream:
            return stream.read().decode()

    if at is None:
        at = latest(files, base, table, read)
    table_id, manifest = at
    return at, f"{base}/data/{table_id}", Manifest.of_json(read(f"{base}/manifests/{manifest}.json"), lambda part: text(f"{base}/manifests/{part}"))


def latest(files, base: str, table: str, read) -> tuple[str, str]:
    from pyarrow import fs

    states = [i.path for i in files.get_file_info(fs.FileSelector(f"{base}/states")) if re.fullmatch(r"\d{12}\.json", i.base_name)]
    key = "/".join(split_name(table))
    found = read(max(states))["tables"].get(key) if states else None
    if found is None:
        raise NoSuchTable(f"no table {table}")
    return found["id"], found["manifest"]


class TableSource(DataSource):
    #: Tables that the session's user may not read or write this way, as a policy holds for them.
    guarded: frozenset[str] = frozenset()

    @classmethod
    def name(cls) -> str:
        return "lodestack"

    def _table(self) -> str:
        if "/".join(split_name(self.options["table"])) in self.guarded:
            raise PermissionError(f"access denied: {self.options['table']} has a policy; read it by Engine.table")
        return self.options["table"]

    def schema(self) -> T.StructType:
        return load(self.options["root"], self._table())[2].schema()

    def reader(self, schema: T.StructType) -> TableReader:
        return TableReader(self.options["root"], self._table(), schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> TableWriter:
        if overwrite:
            raise ValueError('only mode("append") is possible')
        return TableWriter(self.options["root"], self._table(), schema)


@dataclass
class Written(WriterCommitMessage):
    files: list
    most: int


class TableWriter(DataSourceArrowWriter):
    """Appends rows: each task writes a file for each partition key, and one commit puts all of them into the table.

    Row ids are those that an append by the engine would give.  The commit makes the next state's file, which must be new:
    on local and mounted folders that is atomic.  Object stores and HDFS have no such call here: use `append`.
    """

    def __init__(self, root: str, table: str, schema: T.StructType):
        plain = re.sub(r"^file:(//(?=/))?", "", root.rstrip("/"))
        if "://" in plain:
            raise ValueError("writing by option needs a mounted folder; use lodestack.sources.datasource.append")
        self.root, self.table = plain, table
        _, self.folder, self.manifest = load(root, table)
        self.manifest.files = FileList()  # tasks don't need it, and the commit reads it anew
        known = [f.name for f in self.manifest.fields]
        unknown = [n for n in schema.names if n not in known]
        if unknown:
            raise ValueError(f"no column {unknown[0]}")
        self.write_id = uuid.uuid4().hex

    def write(self, iterator: Iterator) -> Written:
        import os

        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        from lodestack.functions.transforms import apply_value

        m, context = self.manifest, TaskContext.get()
        task = context.partitionId()
        target = to_arrow_schema(m.schema())
        physical = pa.schema([*(pa.field(f.physical, target.field(f.name).type) for f in m.fields), pa.field(ROW_ID, pa.int64())])
        # For each key: path, writer, and rows, lowest and highest row id so far.
        writers: dict[tuple, tuple[str, Any, list[int]]] = {}
        row = m.next_row_id + (task << 33)
        os.makedirs(f"{self.folder}/{self.write_id}", exist_ok=True)
        for batch in iterator:
            there = set(batch.schema.names)
            columns = [batch.column(f.name).cast(target.field(f.name).type) if f.name in there else pa.nulls(len(batch), target.field(f.name).type) for f in m.fields]
            rows = pa.Table.from_arrays([*columns, pa.array(range(row, row + len(batch)), pa.int64())], schema=physical)
            row += len(batch)
            groups: dict[tuple, list[int]] = {}
            sources = [(t, m.field(t.column)) for t in m.partitioning]
            values = [rows.column(f.physical).to_pylist() for _, f in sources]
            for i in range(len(batch)):
                key = tuple(key_text(apply_value(t, v[i], f.kind)) for (t, f), v in zip(sources, values, strict=True))
                groups.setdefault(key, []).append(i)
            for key, places in groups.items():
                if key not in writers:
                    path = f"{self.write_id}/part-{task:05d}-{len(writers):04d}-{uuid.uuid4().hex}.parquet"
                    writers[key] = (path, pq.ParquetWriter(f"{self.folder}/{path}", physical), [0, row, row])
                some = rows.take(places)
                if m.sorted_by:
                    some = some.sort_by([(m.field(c).physical, "ascending") for c in m.sorted_by])
                writers[key][1].write_table(some)
                found = writers[key][2]
                found[0] += len(places)
                found[1], found[2] = min(found[1], row - len(batch)), row - 1
        files = []
        for key, (path, writer, count) in writers.items():
            writer.close()
            files.append((path, os.path.getsize(f"{self.folder}/{path}"), count[0], list(key), *count[1:]))
        return Written(files, row - 1)

    def commit(self, messages: list) -> None:
        import os

        found = [m for m in messages if m is not None]
        files, most = [f for m in found for f in m.files], max((m.most for m in found), default=-1)
        if not files:
            return
        key = "/".join(split_name(self.table))
        for _ in range(RETRIES):
            states = sorted(n for n in os.listdir(f"{self.root}/states") if re.fullmatch(r"\d{12}\.json", n))
            with open(f"{self.root}/states/{states[-1]}") as stream:
                state = json.load(stream)
            entry = state["tables"].get(key)
            if entry is None or self.folder != f"{self.root}/data/{entry['id']}":
                raise NoSuchTable(f"no table {self.table}")
            with open(f"{self.root}/manifests/{entry['manifest']}.json") as stream:
                now = Manifest.of_json(json.load(stream), self._part)
            if [f.to_json() for f in now.fields] != [f.to_json() for f in self.manifest.fields] or now.next_row_id != self.manifest.next_row_id:
                raise Conflict(f"{self.table} was changed meanwhile")
            now.files.add(DataFile(*f) for f in files)
            now.files.store([f.dataType for f in now.key_fields()], self._put_part)
            now.next_row_id = max(now.next_row_id, most + 1)
            name = uuid.uuid4().hex
            with open(f"{self.root}/manifests/{name}.json", "x") as stream:
                json.dump(now.to_json(), stream, default=str)
            entry["manifest"], state["version"] = name, state["version"] + 1
            staged = f"{self.root}/states/.{uuid.uuid4().hex}"
            with open(staged, "x") as stream:
                json.dump(state, stream, default=str)
            try:
                os.link(staged, f"{self.root}/states/{state['version']:012d}.json")  # fails if it exists
                return
            except FileExistsError:
                continue
            finally:
                os.unlink(staged)
        raise Conflict("too many commits at once")

    def _part(self, name: str) -> str:
        with open(f"{self.root}/manifests/{name}") as stream:
            return stream.read()

    def _put_part(self, name: str, text: str) -> None:
        with open(f"{self.root}/manifests/{name}", "x") as stream:
            stream.write(text)

    def abort(self, messages: list) -> None:
        import shutil

        shutil.rmtree(f"{self.folder}/{self.write_id}", ignore_errors=True)


class TableReader(DataSourceReader):
    def __init__(self, root: str, table: str, schema: T.StructType):
        self.root, self.table, self.wanted = root, table, schema
        self.version, self.folder, manifest = load(root, table)
        self.physical = {f.name: f.physical for f in manifest.fields}
        self.nodes: list[P.Node] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        """Filters choose files; Spark evaluates them all the same."""
        for f in filters:
            node = self._node(f)
            if node is not None:
                self.nodes.append(node)
            yield f

    @staticmethod
    def _node(f: Filter) -> P.Node | None:
        if len(getattr(f, "attribute", ())) != 1:
            return None
        column = f.attribute[0]
        if type(f) in _OPERATORS:
            return P.Compare(column, _OPERATORS[type(f)], f.value)
        if isinstance(f, In):
            return P.In(column, tuple(f.value))
        return P.IsNull(column, isinstance(f, IsNotNull)) if isinstance(f, (IsNull, IsNotNull)) else None

    def partitions(self) -> list[InputPartition]:
        # Read again, so that the list of files doesn't travel with the reader.
        manifest = load(self.root, self.table, self.version)[2]
        types = [f.dataType for f in manifest.key_fields()]

        def possible(keys: list) -> bool:
            held: dict[str, list] = {}
            for t, key in zip(manifest.partitioning, keys, strict=True):
                held.setdefault(t.column, []).append(((t, manifest.field(t.column).kind), key))
            return all(P.possible(n, held) for n in self.nodes)

        kept = [f.path for f in manifest.files.chosen(types, possible)]
        return [InputPartition(p) for p in kept] or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator:
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import to_arrow_schema

        if partition.value is None:
            return
        files, _ = _files(self.root)
        physical = self.physical
        target = to_arrow_schema(self.wanted)
        source = pq.ParquetFile(files.open_input_file(f"{self.folder}/{partition.value}"))
        there = set(source.schema_arrow.names)
        names = [f.name for f in self.wanted.fields]
        for batch in source.iter_batches(columns=[physical[n] for n in names if physical[n] in there]):
            columns = [batch.column(physical[n]).cast(target.field(n).type) if physical[n] in there else pa.nulls(len(batch), target.field(n).type) for n in names]
            yield pa.RecordBatch.from_arrays(columns, schema=target)


def register(spark: SparkSession, policies: Policies | None = None, user: str = "") -> None:
    """Make the format known to the session.  Readers of files can't apply row filters and masks, so tables for which
    `policies` have one for `user` are refused; without policies this is an administrator's way in."""
    guarded = frozenset(name for (name, who), policy in (policies.known.items() if policies and policies.enabled else ()) if who == user and policy != Policy())
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(type("GuardedSource", (TableSource,), {"guarded": guarded}) if guarded else TableSource)


def append(rows: DataFrame, root: str, table: str) -> int:
    """The counterpart for writing: append rows to a table by root and name."""
    from lodestack.operators.table import Table
    from lodestack.sources.catalog import Catalog

    return Table(Catalog(rows.sparkSession, root), table).append(rows)
