"""Joins that Spark's planner doesn't choose by itself: by ranges, on hot keys, and behind a runtime filter."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestack.plans.predicates import And, Compare, In


#: A range touches at most this many bins of its level, and each level's bins are as many times as wide as the last's.
BINS = 16


def range_join(points: DataFrame, ranges: DataFrame, value: str, low: str, high: str, width: float) -> DataFrame:
    """Rows of points and ranges with low <= value < high.

    Values are cut into bins; a range goes to each bin that it touches, a point to one, and the bins join by equality, so
    no nested loop is needed.  Bins are `width` wide, which should be about the length of common ranges; ranges of more
    than BINS bins go to bins of a higher level, each level's being BINS times as wide, so that no range is copied more
    than BINS + 2 times.  A point goes to a bin of each level that there are ranges of (a range of a million widths is on
    level 4).  A range also goes to the bin of its end, so that rounding of very large values loses nothing.  Rows with
    a null bound or value join nothing.
    """
    length = (F.col(high).cast("double") - F.col(low).cast("double")) / width
    level = F.greatest(F.lit(0), F.ceil(F.log(F.greatest(length, F.lit(1.0))) / math.log(BINS) - 1).cast("int"))
    placed_ranges = ranges.where(f"`{low}` < `{high}`").withColumn("__level", level)
    levels = sorted(r[0] for r in placed_ranges.select("__level").distinct().collect())
    wide = F.lit(float(width)) * F.pow(F.lit(float(BINS)), F.col("__level"))
    first, last = F.floor(F.col(low) / wide), F.floor(F.col(high) / wide)
    binned = placed_ranges.withColumn("__bin", F.explode(F.sequence(first, F.greatest(first, last))))
    placed = points.withColumn("__level", F.explode(F.array(*(F.lit(k) for k in levels)))) if levels else points.withColumn("__level", F.lit(0))
    placed = placed.withColumn("__bin", F.floor(F.col(value) / wide))
    return placed.join(binned, ["__level", "__bin"]).where((F.col(value) >= F.col(low)) & (F.col(value) < F.col(high))).drop("__bin", "__level")


def salted_join(hot: DataFrame, other: DataFrame, keys: Sequence[str], how: str = "inner", salts: int = 16) -> DataFrame:
    """An inner or left join of a side with hot keys: its rows are dealt over `salts` parts of each key, and the other
    side is copied to all of them.  For data where adaptive skew handling can't help (hot keys on an aggregated side)."""
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"not for {how} joins: rows of the copied side would count {salts} times")
    dealt = hot.withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
    copied = other.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return dealt.join(copied, [*keys, "__salt"], how).drop("__salt")


def filtered_join(large: DataFrame, small: DataFrame, left_key: str, right_key: str, most_values: int = 10_000) -> DataFrame:
    """An inner equi-join that first asks the small side for its keys and pushes them into the large side's scan.

    Up to `most_values` distinct keys go as an IN list or, if there are more than 15 and they are whole numbers, as
    their range too (which Parquet statistics can use); beyond that only the range goes; an empty small side gives an
    empty scan.  The join itself stays, so the filter only has to be a superset.
    """
    keys = small.select(F.col(right_key).alias("k")).where("k is not null").distinct().limit(most_values + 1).collect()
    if not keys:
        return large.where(F.lit(False)).join(small, F.col(left_key) == F.col(right_key))
    if len(keys) <= most_values:
        values = [r.k for r in keys]
        low, high = min(values), max(values)
        kept = large.where(F.col(left_key).between(low, high))
        if len(values) <= 1000:
            kept = kept.where(F.col(left_key).isin(values))
    else:
        low, high = small.agg(F.min(right_key), F.max(right_key)).first()
        kept = large.where(F.col(left_key).between(low, high))
    return kept.join(small, F.col(left_key) == F.col(right_key))


def table_join(table, other: DataFrame, column: str, key: str, columns: Sequence[str] | None = None, most_values: int = 10_000) -> DataFrame:
    """An inner equi-join of one of the engine's tables with a smaller side, whose keys choose the table's files.

    Up to `most_values` distinct keys of the other side become a condition on the column, which the scan carries over to
    partition keys (of transforms too), and pushes to the Parquet reader; beyond that, the range of its keys does.
    """
    keys = [r[0] for r in other.select(F.col(f"`{key}`")).where(f"`{key}` is not null").distinct().limit(most_values + 1).collect()]
    if len(keys) <= most_values:
        where = In(column, tuple(keys))
    else:
        low, high = other.agg(F.min(f"`{key}`"), F.max(f"`{key}`")).first()
        where = And((Compare(column, ">=", low), Compare(column, "<=", high)))
    rows = table.scan(where, columns)
    return rows.join(other, rows[column] == other[key])
