"""Connected components of a table of links: union-find inside partitions, then star contraction in Spark."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestack.llm.store import drop, materialise


def _contract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Union-find with path halving over one partition's links: returns links of each node to its root."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (p := parent[x]) != x:
            parent[x] = x = parent[p]
        return x

    for batch in batches:
        for a, b in zip(batch.a.tolist(), batch.b.tolist(), strict=True):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            if (x := find(a)) != (y := find(b)):
                parent[max(x, y)] = min(x, y)
    pairs = [(x, r) for x in parent if (r := find(x)) != x]
    yield pd.DataFrame(pairs, columns=["a", "b"], dtype="int64")


def _star(links: DataFrame) -> DataFrame:
    """One large-star and one small-star step over links (a, b) with a > b."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
    low = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = low.groupBy("a").agg(F.min("b").alias("m"))
    moved = low.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """The component (its smallest node) of every node in links (a long, b long).

    Links may repeat, stand in either direction and join a node with itself; rows with a null are left out.
    Returns (node, component), written, for all nodes but those that are linked with themselves only.
    """
    clean = links.where("a is not null and b is not null and a <> b").select(F.col("a").cast("long"), F.col("b").cast("long"))
    now = materialise(clean.mapInPandas(_contract, "a long, b long").distinct(), "links")
    mark = None
    for _ in range(most_rounds):
        now, before = materialise(_star(now), "links"), now
        drop(before)
        new = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == mark:
            break
        mark = new
    else:
        raise RuntimeError("components did not settle")
    both = now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")))
    out = materialise(both.distinct(), "labels")
    drop(now)
    return out
