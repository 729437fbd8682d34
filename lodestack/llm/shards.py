"""Size-tiered compaction of table shards under a versioned manifest.

Arrivals are appended as small immutable shards (folders of Parquet files).  Shards of similar size form a tier; a tier
of `fan_in` of them is merged into files of about the target size.  Each change is one new manifest, put in place by a
rename that fails if another writer was first; readers hold to the version that they opened.  Everything that touches
rows is a DataFrame operation.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Attempts at a commit, and seconds for which a folder that no version names is left alone.
RETRIES, GRACE = 20, 86_400.0


class Conflict(RuntimeError):
    """Another writer has committed this version."""


@dataclass(frozen=True)
class Shard:
    path: str
    bytes: int
    rows: int
    born: int


@dataclass(frozen=True)
class Manifest:
    version: int
    shards: tuple[Shard, ...]
    #: Shards that this version has dropped; their folders stay until `vacuum`.
    dropped: tuple[str, ...] = ()


def tiers(shards: list[Shard], least: int, ratio: float) -> dict[int, list[Shard]]:
    """Shards by tier: tier 0 below `least` bytes, each next one `ratio` times as large."""
    out: dict[int, list[Shard]] = {}
    for s in shards:
        tier = 0 if s.bytes < least else 1 + int(math.log(s.bytes / least, ratio) + 1e-9)
        out.setdefault(tier, []).append(s)
    return out


class ShardStore:
    """A table of immutable shards below `root`.

    target: bytes of a file; fan_in: shards of a tier that are merged; least, ratio: the tiers (see `tiers`).
    """

    def __init__(self, spark: SparkSession, root: str, target: int = 128 << 20, fan_in: int = 4, least: int = 1 << 20, ratio: float = 4.0):
        self.spark, self.root, self.target, self.fan_in, self.least, self.ratio = spark, root.rstrip("/"), target, fan_in, least, ratio
        jvm = spark.sparkContext._jvm
        self._jvm, self._conf = jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = jvm.org.apache.hadoop.fs.Path(self.root).getFileSystem(self._conf)
        self._fs.mkdirs(self._path(f"{self.root}/manifests"))

    def _path(self, text: str):
        return self._jvm.org.apache.hadoop.fs.Path(text)

    def _manifest_path(self, version: int) -> str:
        return f"{self.root}/manifests/{version:010d}.json"

    def versions(self) -> list[int]:
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(f"{self.root}/manifests"))]
        return sorted(int(n[:10]) for n in names if n.endswith(".json") and n[:10].isdigit())

    def manifest(self, version: int | None = None) -> Manifest:
        """A version, by default the latest; version 0 is the empty table."""
        if version is None:
            version = max(self.versions(), default=0)
        if version == 0:
            return Manifest(0, ())
        stream = self._fs.open(self._path(self._manifest_path(version)))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        found = json.loads(text)
        return Manifest(found["version"], tuple(Shard(**s) for s in found["shards"]), tuple(found["dropped"]))

    def commit(self, base: Manifest, shards: tuple[Shard, ...], dropped: tuple[str, ...] = ()) -> Manifest:
        """The next version after `base`, atomically; raises Conflict if it exists already."""
        new = Manifest(base.version + 1, shards, dropped)
        staged, final = self._path(f"{self.root}/manifests/.{uuid.uuid4().hex}"), self._path(self._manifest_path(new.version))
        stream = self._fs.create(staged, False)
        stream.write(bytearray(json.dumps(asdict(new)).encode()))
        stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(staged.toUri() if staged.toUri().getScheme() else self._fs.getUri(), self._conf)
        none = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(staged, final, none)
        except Exception as error:
            self._fs.delete(staged, False)
            if "FileAlreadyExists" in str(error):
                raise Conflict(f"version {new.version} exists") from error
            raise
        return new

    def _bytes(self, path: str) -> int:
        return sum(s.getLen() for s in self._fs.listStatus(self._path(path)) if s.getPath().getName().endswith(".parquet"))

    def _rows(self, paths: list[str]) -> dict[str, int]:
        """Rows of shards, counted from the files' footers."""
        names = {p: p.rsplit("/", 1)[-1] for p in paths}
        count = self.spark.read.parquet(*paths).groupBy(F.element_at(F.split(F.input_file_name(), "/"), -2).alias("shard")).count()
        found = {r["shard"]: r["count"] for r in count.collect()}
        return {p: found.get(n, 0) for p, n in names.items()}

    def _change(self, edit: Callable[[Manifest], tuple[tuple[Shard, ...], tuple[str, ...]] | None]) -> Manifest | None:
        """Commit what an edit makes of the latest version; if another writer is first, of the next one.  An edit that
        gives None gives up."""
        for _ in range(RETRIES):
            base = self.manifest()
            if (made := edit(base)) is None:
                return None
            try:
                return self.commit(base, *made)
            except Conflict:
                continue
        raise Conflict("too many commits at once")

    def append(self, frame: DataFrame) -> Manifest:
        """Add the rows as one new shard; an empty frame adds an empty shard (which holds the schema).  Other writers'
        commits meanwhile are no matter; if the rows can't be written or committed, nothing is left of them."""
        path = f"{self.root}/data/{uuid.uuid4().hex}"
        try:
            frame.write.parquet(path)
            size, rows = self._bytes(path), self._rows([path])[path]
            return self._change(lambda base: ((*base.shards, Shard(path, size, rows, base.version + 1)), ()))
        except Exception:
            self._fs.delete(self._path(path), True)
            raise

    def append_arrivals(self, frame: DataFrame, arrival: str) -> list[Manifest]:
        """Add rows as one shard for each value of a column (which is not kept), in its order: one job writes them
        all, then each is committed as a version of its own.  A null value is an arrival too."""
        batch = f"{self.root}/data/{uuid.uuid4().hex}"
        frame.write.partitionBy(arrival).parquet(batch)
        found = [s.getPath() for s in self._fs.listStatus(self._path(batch)) if s.isDirectory()]
        if not found:
            return [self.append(frame.drop(arrival))]
        moved = {}
        for source in sorted(found, key=lambda p: p.getName()):
            path = f"{self.root}/data/{uuid.uuid4().hex}"
            if not self._fs.rename(source, self._path(path)):
                raise OSError(f"can't rename {source}")
            moved[path] = None
        self._fs.delete(self._path(batch), True)
        rows, out = self._rows(list(moved)), []
        for path in moved:
            size = self._bytes(path)
            out.append(self._change(lambda base, path=path, size=size: ((*base.shards, Shard(path, size, rows[path], base.version + 1)), ())))
        return out

    def plan(self, manifest: Manifest) -> list[Shard]:
        """The next run to merge: the oldest `fan_in` or more shards of the lowest tier that has so many."""
        for _, found in sorted(tiers([s for s in manifest.shards], self.least, self.ratio).items()):
            if len(found) >= self.fan_in:
                return sorted(found, key=lambda s: s.born)[: self.fan_in]
        return []

    def merge(self, manifest: Manifest, run: list[Shard]) -> Manifest:
        """Merge a run into one shard of target-sized files.  Scans are packed, not shuffled."""
        total = sum(s.bytes for s in run)
        path = f"{self.root}/data/{uuid.uuid4().hex}"
        source = self.spark.read.parquet(*(s.path for s in run))
        count, rows = max(1, math.ceil(total / self.target)), sum(s.rows for s in run)
        # As many tasks as files are wanted, if the scan has them; where it has fewer, files are closed by their rows.
        source.coalesce(count).write.option("maxRecordsPerFile", max(1, math.ceil(1.2 * rows / count))).parquet(path)
        gone = {s.path for s in run}
        size = self._bytes(path)

        def replaced(base: Manifest) -> tuple[tuple[Shard, ...], tuple[str, ...]] | None:
            if not gone <= {s.path for s in base.shards}:
                return None  # another writer has merged some of them
            return (*(s for s in base.shards if s.path not in gone), Shard(path, size, rows, base.version + 1)), tuple(sorted(gone))

        new = self._change(replaced)
        if new is None:
            self._fs.delete(self._path(path), True)
        return new or self.manifest()

    def compact(self) -> Manifest:
        """Merge until no tier is full; each merge is a version.  Shards that others append meanwhile stay; a run that
        others have merged meanwhile is given up."""
        now = self.manifest()
        while run := self.plan(now):
            now = self.merge(now, run)
        return now

    def vacuum(self, keep: int = 1, grace: float = GRACE) -> list[str]:
        """Delete the folders that versions have dropped and none of the last `keep` versions names, and what no version
        has ever named for `grace` seconds: younger ones may be a writer's that hasn't committed yet.  Returns them.

        The manifests of older versions go too: these end to be readable.
        """
        before = time.time() - grace
        found = {s.getPath().getName(): s for s in self._fs.listStatus(self._path(f"{self.root}/data"))}
        versions = self.versions()
        each = {v: self.manifest(v) for v in versions}
        name = lambda path: path.rsplit("/", 1)[-1]
        live = {name(s.path) for v in versions[-keep:] for s in each[v].shards}
        named = {name(p) for m in each.values() for p in (*m.dropped, *(s.path for s in m.shards))}
        out = []
        for n, status in found.items():
            if n not in live and (n in named or status.getModificationTime() / 1000 < before):
                self._fs.delete(status.getPath(), True)
                out.append(status.getPath().toString())
        for v in versions[:-keep]:
            self._fs.delete(self._path(self._manifest_path(v)), False)
        return out

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, with the file's shard in the column `shard` (or, if the table has one, `_shard`, ...)."""
        found = self.manifest(version)
        if not found.shards:
            raise ValueError("the table has no shards yet")
        rows = self.spark.read.parquet(*(s.path for s in found.shards))
        return rows.withColumn(_free("shard", rows.columns), F.element_at(F.split(F.input_file_name(), "/"), -2))


def compacted(frame: DataFrame, root: str, key: str, arrivals: int = 12, **options) -> ShardStore:
    """Append the rows in `arrivals` parts by a hash of the key, compact, and delete what was merged.

    Null keys, repeated rows and further columns are kept as they are, whatever their names.  An empty table gives one
    empty shard.
    """
    store = ShardStore(frame.sparkSession, root, **options)
    arrival = _free("_arrival", frame.columns)
    store.append_arrivals(frame.withColumn(arrival, F.format_string("%05d", F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(arrivals)))), arrival)
    store.compact()
    store.vacuum()
    return store


def _free(name: str, taken: list[str]) -> str:
    """The name, behind as many underscores as tell it from all columns."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name = f"_{name}"
    return name
