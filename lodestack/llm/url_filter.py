"""URL verdicts by rules and by a cascade of Bloom filters over listed host keys."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestack.llm.bitmap import contains, of_bits
from lodestack.llm.html_text import host_of
from lodestack.llm.store import drop, materialise
from lodestack.llm.textvec import mix

#: Bits of a filter at most (32 MB); longer lists are dealt into several cascades by a hash of the keys.
MOST_BITS = 1 << 28
#: Levels of a cascade at most; each is some twenty times as rare as the one before.
MOST_LEVELS = 40


@dataclass(frozen=True)
class Rule:
    """`text` is a host, a slash and the beginning of a path; it holds for the host and all its subdomains."""

    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end; empty without `://`."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The text of the longest rule that fits, or null; of equal ones the first given."""
    out = F.lit(None).cast("string")
    for rule in sorted(reversed(list(rules)), key=lambda r: len(r.text)):
        fits = ((host == rule.host) | F.endswith(host, F.lit(f".{rule.host}"))) & F.startswith(path, F.lit(rule.path))
        out = F.when(fits, F.lit(rule.text)).otherwise(out)
    return out


def host_keys(host: Column) -> Column:
    """A host and its parent domains: a.b.c, b.c, c.  An empty host has no key."""
    parts = F.split(host, r"\.")
    every = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    return F.when(F.length(host) > 0, every).otherwise(F.array().cast("array<string>"))


@dataclass(frozen=True)
class Level:
    bits: int
    hashes: int
    bitmap: np.ndarray


@dataclass(frozen=True)
class Cascade:
    """Exact membership of every key of the universe it was built over: a key is listed if the number of levels
    that let it pass, before the first that doesn't, is odd."""

    levels: tuple[Level, ...]

    def listed(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether keys are listed, given their two 64-bit hashes."""
        passed = np.zeros(len(low), np.int64)
        open_ = np.arange(len(low))
        for k, level in enumerate(self.levels):
            hit = np.ones(len(open_), bool)
            for i in range(level.hashes):
                hit &= contains(level.bitmap, _bits(low[open_], high[open_], k, i, level.bits))
            open_ = open_[hit]
            passed[open_] += 1
            if not len(open_):
                break
        return passed % 2 == 1

    @property
    def size_bytes(self) -> int:
        return sum(x.bitmap.nbytes for x in self.levels)


def _bits(low: np.ndarray, high: np.ndarray, level: int, i: int, bits: int) -> np.ndarray:
    """Bit i of keys at a level, by double hashing; bits is a power of two."""
    x = low.view(np.uint64) ^ np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    return (mix(x + np.uint64(i) * (high.view(np.uint64) | np.uint64(1))) & np.uint64(bits - 1)).astype(np.int64)


def _level_bits(count: int, rate: float) -> tuple[int, int]:
    need = max(64, math.ceil(-count * math.log(rate) / math.log(2) ** 2))
    bits = 1 << (need - 1).bit_length()
    return bits, max(1, min(16, round(bits / max(count, 1) * math.log(2))))


def _fill(level: int, hashes: int, bits: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, high = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            every = np.unique(np.concatenate([_bits(low, high, level, i, bits) for i in range(hashes)]))
            yield pa.RecordBatch.from_arrays([pa.array(every)], ["bit"])

    return work


def _passing(level: int, filled: Level):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, high = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            hit = np.ones(len(low), bool)
            for i in range(filled.hashes):
                hit &= contains(filled.bitmap, _bits(low, high, level, i, filled.bits))
            yield batch.filter(pa.array(hit))

    return work


_KEY = "low long, high long, key string"


def _hashed(keys: DataFrame) -> DataFrame:
    return keys.select(F.xxhash64("key").alias("low"), F.xxhash64(F.lit("second"), "key").alias("high"), "key")


def _first_rate(n_listed: int, n_universe: int) -> float:
    return min(0.05, max(n_listed / max(n_universe, 1) / 1.5, 1e-6))


def cascades(universe: DataFrame, listed: DataFrame, most_bits: int = MOST_BITS) -> Iterator[tuple[int, int, Cascade]]:
    """(part, parts, cascade): cascades that together tell the listed keys of the universe.  There are as many parts as
    keep the filters within most_bits; a key belongs to the part that its first hash says."""
    inside = materialise(_hashed(universe.select("key").where("key is not null").distinct()), "universe")
    wanted = materialise(_hashed(listed.select("key").where("key is not null").distinct()), "listed")
    n_listed, n_universe = wanted.count(), inside.count()
    parts = 1
    while n_listed and _level_bits(math.ceil(1.1 * n_listed / parts), _first_rate(n_listed, n_universe))[0] > most_bits and parts < n_listed:
        parts *= 2
    for part in range(parts):
        mine = (lambda f, k=part: f.where(F.pmod("low", F.lit(parts)) == k)) if parts > 1 else (lambda f: f)
        yield part, parts, _build(mine(inside), mine(wanted))
    drop(inside, wanted)


def build(universe: DataFrame, listed: DataFrame) -> Cascade:
    """A cascade over the distinct keys of `universe` (column key) that tells those of `listed` (column key)."""
    return [c for _, _, c in cascades(universe, listed, 1 << 62)][0]


def _build(inside: DataFrame, wanted: DataFrame) -> Cascade:
    """Level 1 holds all listed keys; each later one the keys of the other kind that the level before lets pass by
    mistake, until there are none.  Filters are filled in Spark; only their words come to the driver."""
    n_listed, n_universe = wanted.count(), inside.count()
    levels: list[Level] = []
    encoded, other, count = wanted, None, n_listed
    rate = _first_rate(n_listed, n_universe)
    while count:
        k = len(levels)
        if k == MOST_LEVELS:
            raise RuntimeError("the cascade does not end: two keys of unlike kind share both hashes")
        bits, hashes = _level_bits(count, rate if k == 0 else 0.05)
        level = Level(bits, hashes, of_bits(encoded.select("low", "high").mapInArrow(_fill(k, hashes, bits), "bit long"), bits))
        levels.append(level)
        against = inside if k == 0 else other
        passing = against.mapInArrow(_passing(k, level), _KEY)
        if k == 0:
            passing = passing.join(wanted.select("key"), "key", "left_anti").select("low", "high", "key")
        passing = materialise(passing, "passing")
        read, encoded, other, count = other, passing, encoded, passing.count()
        drop(*(f for f in (read,) if f is not None and f is not wanted))
    drop(*(f for f in (encoded, other) if f is not None and f is not wanted))
    return Cascade(tuple(levels))


def _judged(cascade: Cascade, columns: int, part: int = 0, parts: int = 1):
    """The first listed key of each row, of the keys that belong to a part; where there are several parts, a column
    before the hashes has what other parts have found."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, high = batch.column(columns), batch.column(columns + 1)
            offsets = low.offsets.to_numpy() - low.offsets[0].as_py()
            lows, highs = low.flatten().to_numpy(), high.flatten().to_numpy()
            hit = np.zeros(len(lows), bool)
            mine = np.flatnonzero(lows % parts == part)
            hit[mine] = cascade.listed(lows[mine], highs[mine])
            first = np.full(len(batch), NONE, np.int32)
            owner = np.repeat(np.arange(len(batch)), np.diff(offsets))
            for at in np.flatnonzero(hit)[::-1]:
                first[owner[at]] = at - offsets[owner[at]]
            if parts > 1:
                first = np.minimum(first, batch.column(columns + 2).to_numpy())
                yield pa.RecordBatch.from_arrays([*batch.columns[: columns + 2], pa.array(first)], [*batch.schema.names[: columns + 2], "at"])
            else:
                yield pa.RecordBatch.from_arrays([*batch.columns[:columns], pa.array(first)], [*batch.schema.names[:columns], "at"])

    return work


#: In place of a key's position: no key is listed.
NONE = np.int32((1 << 31) - 1)


def judge(frame: DataFrame, rules: Sequence[Rule], listed: DataFrame, url: str = "url", key: str = "page_id", most_bits: int = MOST_BITS) -> DataFrame:
    """The verdict on every url: of the longest rule that fits it, else block if its host or a parent domain is listed.

    Returns key, host, path, rule, verdict and listed_key (the longest listed key of the host, whatever the rule).
    Null urls and such without `://` have an empty host and path, fit no rule that names a host and are allowed;
    repeated rows stay; other columns are not read; an empty table or list is no error.  listed: a table with a
    column `key` of host names; nulls and repetitions in it are ignored.  A list beyond most_bits is worked off in parts.
    """
    kinds = dict(frame.dtypes)
    text = F.col(f"`{url}`").cast("string")
    rows = frame.select(F.col(f"`{key}`").alias("__key"), host_of(text).alias("host"), path_of(text).alias("path"))
    keys = rows.select("host").distinct().select(F.explode(host_keys(F.col("host"))).alias("key"))
    every = host_keys(F.col("host"))
    hashed = rows.select("__key", "host", "path", rule_for(F.col("host"), F.col("path"), rules).alias("rule"), F.transform(every, lambda x: F.xxhash64(x)).alias("low"), F.transform(every, lambda x: F.xxhash64(F.lit("second"), x)).alias("high"))
    schema = f"__key {kinds[key]}, host string, path string, rule string"
    found = None
    for part, parts, cascade in cascades(keys, listed, most_bits):
        if parts == 1:
            found = hashed.mapInArrow(_judged(cascade, 4), f"{schema}, at int")
            continue
        # One part's filters at a time are in memory; each part's findings are written for the next.
        before = hashed.withColumn("at", F.lit(int(NONE))) if found is None else found
        found, old = materialise(before.mapInArrow(_judged(cascade, 4, part, parts), f"{schema}, low array<long>, high array<long>, at int"), "judged"), found
        if old is not None:
            drop(old)
    verdicts = {r.text: r.verdict for r in rules}
    by_rule = F.lit(None).cast("string")
    for rule_text, verdict in verdicts.items():
        by_rule = F.when(F.col("rule") == rule_text, F.lit(verdict)).otherwise(by_rule)
    key_of = F.when(F.col("at") != int(NONE), F.element_at(host_keys(F.col("host")), F.col("at") + 1))
    return found.select(F.col("__key").alias(key), "host", "path", "rule", F.coalesce(by_rule, F.when(F.col("at") != int(NONE), "block").otherwise("allow")).alias("verdict"), key_of.alias("listed_key"))


def host_list(spark: SparkSession, hosts: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(h,) for h in hosts], "key string")
