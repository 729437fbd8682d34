"""Bitmaps of hashed keys, filled in Spark: of a fixed size, whatever the number of keys."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a bitmap; 2 MB travel to the driver and the executors.  Beyond some ten million keys it lets all rows pass.
BITS = 1 << 24


def bit_column(key: str, bits: int = BITS) -> Column:
    """The bit of a key; nulls have one too."""
    return F.pmod(F.xxhash64(F.col(key)), F.lit(bits))


def of_bits(bits: DataFrame, size: int) -> np.ndarray:
    """The bitmap of a column `bit` (long, below `size`): 64-bit words combined before they are shuffled."""
    words = bits.groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("value"))
    out = np.zeros((size + 63) // 64, np.int64)
    for batch in words.toArrow().to_batches():
        out[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    return out.view(np.uint64)


def of_column(frame: DataFrame, key: str, bits: int = BITS) -> np.ndarray:
    return of_bits(frame.select(bit_column(key, bits).alias("bit")), bits)


def contains(bitmap: np.ndarray, bits: np.ndarray) -> np.ndarray:
    bits = bits.astype(np.int64)
    return (bitmap[bits >> 6] >> (bits & 63).astype(np.uint64)) & np.uint64(1) != 0
