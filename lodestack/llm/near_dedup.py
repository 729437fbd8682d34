"""Near-duplicates by SuperMinHash signatures, banding, exact verification and union-find grouping."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestack.llm import textvec as tv
from lodestack.llm.bitmap import bit_column, contains, of_column
from lodestack.llm.components import connected_components
from lodestack.llm.store import drop, materialise, trimmed

WIDTH = 5
BANDS, ROWS = 20, 5
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 85
#: Shingles, and bytes of text, worked on at once.
MOST_SHINGLES, MOST_BYTES = 1 << 15, 1 << 18
#: 64-bit words of a parity sketch.
SKETCH = 16


def shingle_sets(data: np.ndarray, offs: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct shingles as sorted 64-bit hashes, and where each text's begin."""
    starts, ends, first = tv.words(data, offs)
    every, begin = tv.windows(tv.hashes(data, starts, ends), first, width, whole=True)
    owner = np.repeat(np.arange(len(offs) - 1), np.diff(begin))
    order = np.lexsort((every, owner))
    every = every[order]
    new = np.ones(len(every), bool)
    new[1:] = (every[1:] != every[:-1]) | (owner[1:] != owner[:-1])
    begin = np.concatenate([[0], np.cumsum(new)])[begin]
    return every[new], begin


def superminhash(sets: np.ndarray, begin: np.ndarray, size: int) -> np.ndarray:
    """A signature of `size` slots for each set; the chance that a slot agrees is the sets' Jaccard similarity.

    Each element walks through the slots by its own random permutation, which a Fisher-Yates shuffle deals out step
    by step; at step j it offers j plus a random fraction to the slot that it comes to (64-bit fixed point).  A set
    is done as soon as all its slots hold less than the next step, as no later offer can be lower.
    """
    texts = len(begin) - 1
    out = np.full(texts * size, np.iinfo(np.uint64).max, np.uint64)
    owner = np.repeat(np.arange(texts), np.diff(begin))
    values, places = sets, np.broadcast_to(np.arange(size, dtype=np.uint8 if size <= 256 else np.uint16), (len(sets), size)).copy()
    for step in range(size):
        drawn = tv.mix(values ^ tv.mix(np.array([step + 1], np.uint64)))
        other = step + ((drawn & tv.U64(0xFFFFFFFF)) * tv.U64(size - step) >> tv.U64(32)).astype(np.int64)
        rows = np.arange(len(values))
        place = places[rows, other]
        places[rows, other] = places[:, step]
        offer = (drawn >> tv.U64(32)) | tv.U64(step << 32)
        np.minimum.at(out, owner * size + place, offer)
        open_ = (out.reshape(texts, size).max(axis=1) >= tv.U64((step + 1) << 32))[owner]
        if not open_.all():
            values, owner, places = values[open_], owner[open_], places[open_]
        if not len(values):
            break
    return out.reshape(texts, size)


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key for each band of each signature."""
    out = np.zeros((len(signatures), bands), np.uint64)
    parts = signatures[:, : bands * rows].reshape(len(signatures), bands, rows)
    for k in range(rows):
        out = tv.mix(out * tv.U64(0x100000001B3) + parts[:, :, k])
    return out


def fingerprints(sets: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """128 bits for each set, as two sums of mixed elements."""
    out = np.zeros((len(begin) - 1, 2), np.uint64)
    for k, salt in enumerate((0x51ED270B35B4A1C7, 0xA24BAED4963EE407)):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(tv.mix(sets ^ tv.U64(salt)))])
        out[:, k] = total[begin[1:]] - total[begin[:-1]]
    return out


def parities(sets: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """A sketch of each set: elements are dealt over 64 * SKETCH places, and a bit says whether a place got an odd number.

    Two sketches differ in at most as many bits as the sets have elements that the other one lacks.
    """
    out = np.zeros((len(begin) - 1, SKETCH), np.uint64)
    mixed = tv.mix(sets ^ tv.U64(0x2545F4914F6CDD1D))
    owner = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    np.bitwise_xor.at(out, (owner, (mixed >> tv.U64(6)).astype(np.int64) % SKETCH), tv.U64(1) << (mixed & tv.U64(63)))
    return out


def _summaries(bands: int, rows: int, width: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offs in tv.slices(batch.column(1), MOST_BYTES):
                sets, begin = shingle_sets(data, offs, width)
                n = np.diff(begin)
                keys, marks = np.zeros((b - a, bands), np.uint64), fingerprints(sets, begin)
                at = 0
                while at < b - a:  # few enough shingles at once; a longer text stands alone
                    stop = max(at + 1, int(np.searchsorted(begin, begin[at] + MOST_SHINGLES, "right")) - 1)
                    stop = min(stop, b - a)
                    keys[at:stop] = band_keys(superminhash(sets[begin[at] : begin[stop]], begin[at : stop + 1] - begin[at], bands * rows), bands, rows)
                    at = stop
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array(n, pa.int64()),
                        pa.array(marks[:, 0].astype(np.int64)),
                        pa.array(marks[:, 1].astype(np.int64)),
                        pa.ListArray.from_arrays(np.arange(0, (b - a) * bands + 1, bands, dtype=np.int32), keys.astype(np.int64).ravel()),
                    ],
                    ["doc_id", "n", "mark1", "mark2", "keys"],
                )

    return work


_PARITIES = [f"p{k}" for k in range(SKETCH)]


def _packed_sets(bitmap: np.ndarray, width: int):
    """Sets, and their sketches, of those texts whose id may be in the bitmap."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen = np.flatnonzero(contains(bitmap, batch.column(2).to_numpy(zero_copy_only=False)))
            if not len(chosen):
                continue
            picked = batch.take(pa.array(chosen))
            for a, b, data, offs in tv.slices(picked.column(1), MOST_BYTES):
                sets, begin = shingle_sets(data, offs, width)
                packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer((begin * 8).astype(np.int64)), pa.py_buffer(sets)])
                sketch = parities(sets, begin).view(np.int64)
                yield pa.RecordBatch.from_arrays([picked.column(0).slice(a, b - a), packed.cast(pa.binary()), *(pa.array(sketch[:, k]) for k in range(SKETCH))], ["node", "packed", *_PARITIES])

    return work


def _verified(percent: int):
    """Of rows (a, b, x, y) with packed sets x and y, those that are links."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                one, two = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = np.concatenate([one, two])
                both.sort(kind="stable")
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                keep.append(100 * shared >= percent * (len(both) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return work


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that hold on the full sets."""
    x = sets.select(F.col("node").alias("a"), F.col("packed").alias("x"))
    y = sets.select(F.col("node").alias("b"), F.col("packed").alias("y"))
    return pairs.select("a", "b").join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(trimmed(_verified(percent)), "a long, b long")


def near_duplicates(frame: DataFrame, text: str = "text", key: str = "doc_id", width: int = WIDTH, bands: int = BANDS, rows: int = ROWS, percent: int = PERCENT) -> DataFrame:
    """Group documents whose word-shingle sets have a Jaccard similarity of percent/100 or more, transitively.

    Returns (key, n_shingles, component_id, kept) for every row.  Words are lower-cased in A-Z; a text of fewer than
    `width` words has all of them as one shingle; without words (or null) the set is empty and links with nothing.
    Rows with equal keys count as one document whose texts are linked; a row with a null key links with nothing, has
    a null component and is kept.  An empty table gives an empty result; other columns are not read.

    Steps: (1) one pass makes set sizes, fingerprints and band keys; equal sets are one node.  (2) In each bucket of
    a band all nodes are held against one of them, which shares the most buckets, never all pairs.  (3) What full
    sets confirm is joined by union-find.  (4) Buckets still holding more than one component go through exact filters: two
    sets can only be similar enough if they share one of their rarest shingles and if sketches of 1024 bits don't differ
    too much (which keeps pages of one template, that share most shingles but not enough, from meeting in pairs); the
    pairs found are verified too.  Intermediate tables go when they have been read.  A pair of similarity 0.85 shares no bucket with a chance of about 8e-6 (20 bands of 5).
    """
    source = frame.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    summaries = materialise(source.mapInArrow(trimmed(_summaries(bands, rows, width)), "doc_id long, n long, mark1 long, mark2 long, keys array<long>"), "summaries")
    # Written, so that the last join deals both its sides anew and a fingerprint of very many rows can be split.
    nodes = materialise(summaries.where("doc_id is not null and n > 0").groupBy("mark1", "mark2", "n").agg(F.min("doc_id").alias("node"), F.first("keys").alias("keys")), "nodes")
    dealt = nodes.select("node", "n", F.posexplode("keys").alias("band", "bucket"))
    buckets = dealt.groupBy("band", "bucket").agg(F.count("*").alias("size")).where("size > 1")
    shared = materialise(dealt.join(buckets, ["band", "bucket"]), "buckets")
    support = shared.groupBy("node").agg(F.sum("size").alias("support"))
    heads = shared.join(support, "node").groupBy("band", "bucket").agg(F.max_by(F.struct("node", "n"), F.struct("support", -F.col("node"))).alias("head"))
    near = shared.join(heads, ["band", "bucket"]).where(f"node <> head.node and 100 * least(n, head.n) >= {percent} * greatest(n, head.n)")
    tried = materialise(near.select(F.least("node", "head.node").alias("a"), F.greatest("node", "head.node").alias("b")).distinct(), "pairs")
    bitmap = of_column(shared.select("node"), "node")
    sets = materialise(source.withColumn("bit", bit_column("doc_id", len(bitmap) * 64)).mapInArrow(trimmed(_packed_sets(bitmap, width)), f"node long, packed binary, {', '.join(f'{p} long' for p in _PARITIES)}").where("node is not null"), "sets")
    links = materialise(_links(tried, sets, percent), "links")
    first = connected_components(links)

    # Buckets of more than one component.
    labelled = shared.join(first, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = labelled.groupBy("band", "bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("band", "bucket")
    open_ = materialise(labelled.join(mixed, ["band", "bucket"], "left_semi").select("node", "n", "component").distinct(), "open")
    drop(shared, first)
    more = _prefix_pairs(open_, sets, tried, percent)
    extra = materialise(_links(more, sets, percent), "links")
    drop(tried, open_, more, sets)
    labels = connected_components(links.unionByName(extra))
    drop(links, extra)

    grouped = nodes.select("mark1", "mark2", "n", "node").join(labels, "node", "left").select("mark1", "mark2", "n", F.coalesce("component", "node").alias("component_id"))
    out = summaries.select("doc_id", "n", "mark1", "mark2").join(grouped, ["mark1", "mark2", "n"], "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return out.select(F.col("doc_id").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        each = [np.frombuffer(v.as_buffer(), np.int64) for v in batch.column(3)]
        counts = [len(v) for v in each]
        at = 0
        while at < len(each):
            stop, size = at, 0
            while stop < len(each) and (stop == at or size + counts[stop] <= MOST_SHINGLES):
                size += counts[stop]
                stop += 1
            many = np.repeat(np.arange(at, stop), counts[at:stop])
            taken = batch.select([0, 1, 2]).take(pa.array(many))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(np.concatenate(each[at:stop]))], ["node", "n", "component", "token"])
            at = stop


def _prefix_pairs(open_: DataFrame, sets: DataFrame, tried: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of open nodes of unlike components, not among those tried, that exact filters don't rule out.

    Shingles that one open node alone has come first in the order, then rare ones.  With I shared of x and y
    shingles, 100 I >= percent (x + y - I), so I is at least A = percent (x + y) / (100 + percent) and the first
    shared shingle stands among the first x - A + 1 and y - A + 1.  For the smaller set of a pair (y <= x) that is less
    than for the larger one, so each node has a longer list of places as the larger and a shorter one as the smaller;
    nodes meet by shingle and by steps of size, of which the smaller can be at most one below.  Before a pair leaves that
    join, the sketches must leave it possible: x + y - 2 I elements are in one set only, so as many bits may differ.
    """
    held = open_.join(sets.select("node", "packed"), "node").select("node", "n", "component", "packed").mapInArrow(trimmed(_unpacked), "node long, n long, component long, token long")
    tokens = materialise(held, "tokens")
    common = tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    found = materialise(tokens.join(common, "token"), "tokens")
    drop(tokens)
    # A node with more shingles of its own than a partner of any size allows has no place left in its prefix.
    kept = found.groupBy("node").agg(F.count("*").alias("c"), F.first("n").alias("m")).where(f"(m - c) * 100 <= (100 - {percent}) * m").select("node", "c")
    order = Window.partitionBy("node").orderBy("df", "token")
    ranked = found.join(kept, "node").withColumn("place", F.row_number().over(order) - 1 + F.col("n") - F.col("c")).where(f"place * 100 <= (100 - {percent}) * n")
    ranked = ranked.join(sets.select("node", *_PARITIES), "node").withColumn("step", F.floor(F.log(F.col("n")) / -math.log(percent / 100)))
    ranked = materialise(ranked.select("node", "n", "component", "token", "place", "step", *_PARITIES), "prefixes")
    drop(found)
    x = ranked.withColumn("step", F.explode(F.array(F.col("step"), F.col("step") - 1))).alias("x")
    y = ranked.where(f"place <= n - ceil(2 * n * {percent} / (100.0 + {percent}) - 1e-9)").alias("y")
    least = F.ceil((F.col("x.n") + F.col("y.n")) * percent / (100.0 + percent) - 1e-9)
    larger = (F.col("x.n") > F.col("y.n")) | (F.col("x.n") == F.col("y.n")) & (F.col("x.node") > F.col("y.node"))
    apart = reduce(lambda a, b: a + b, (F.bit_count(F.col(f"x.{p}").bitwiseXOR(F.col(f"y.{p}"))) for p in _PARITIES))
    hit = (F.col("x.token") == F.col("y.token")) & (F.col("x.step") == F.col("y.step")) & larger & (F.col("x.component") != F.col("y.component")) & (F.col("x.place") <= F.col("x.n") - least) & (F.col("y.place") <= F.col("y.n") - least) & (apart <= F.col("x.n") + F.col("y.n") - 2 * least)
    pairs = x.join(y, hit).select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()
    out = materialise(pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
    drop(ranked)
    return out
