"""The partition transforms as SQL functions of a session."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestack.functions.transforms import murmur3

#: Name, parameters, type and body of the functions that SQL can say.
SQL_FUNCTIONS = (
    ("ls_years", "x TIMESTAMP_NTZ", "INT", "year(x) - 1970"),
    ("ls_months", "x TIMESTAMP_NTZ", "INT", "(year(x) - 1970) * 12 + month(x) - 1"),
    ("ls_days", "x TIMESTAMP_NTZ", "INT", "unix_date(cast(x AS DATE))"),
    ("ls_hours", "x TIMESTAMP_NTZ", "INT", "cast(floor(unix_micros(cast(x AS TIMESTAMP)) / 3600000000) AS INT)"),
    ("ls_truncate", "w INT, x BIGINT", "BIGINT", "x - pmod(x, w)"),
    ("ls_truncate_text", "w INT, x STRING", "STRING", "substring(x, 1, w)"),
)


#: murmur3 of eight bytes, step by step: `a * c` and rotation in 32 bits, a block, and the end; then the bucket.
_MASK = 0xFFFFFFFF
BUCKET_FUNCTIONS = (
    ("ls_m3_times", "a BIGINT, c BIGINT", "BIGINT", f"((a & 65535) * c + shiftleft((shiftrightunsigned(a, 16) * c) & 65535, 16)) & {_MASK}"),
    ("ls_m3_turn", "a BIGINT, n INT", "BIGINT", "shiftleft(a & (shiftleft(1L, 32 - n) - 1), n) | shiftrightunsigned(a, 32 - n)"),
    ("ls_m3_mixed", "a BIGINT", "BIGINT", f"(ls_m3_turn(a, 13) * 5 + {0xE6546B64}) & {_MASK}"),
    ("ls_m3_block", "h BIGINT, w BIGINT", "BIGINT", f"ls_m3_mixed(h ^ ls_m3_times(ls_m3_turn(ls_m3_times(w, {0xCC9E2D51}), 15), {0x1B873593}))"),
    ("ls_m3_folded", "a BIGINT, n INT", "BIGINT", "a ^ shiftrightunsigned(a, n)"),
    ("ls_m3_end", "a BIGINT", "BIGINT", f"ls_m3_folded(ls_m3_times(ls_m3_folded(ls_m3_times(ls_m3_folded(a, 16), {0x85EBCA6B}), 13), {0xC2B2AE35}), 16)"),
    ("ls_bucket", "n INT, x BIGINT", "INT", f"cast((ls_m3_end(ls_m3_block(ls_m3_block(0L, x & {_MASK}), shiftrightunsigned(x, 32)) ^ 8L) & {0x7FFFFFFF}) % n AS INT)"),
)


def _bucket_text(n: pd.Series, values: pd.Series) -> pd.Series:
    """Texts (as UTF-8); a batch's distinct texts are hashed once."""
    codes, distinct = pd.factorize(values)
    hashed = np.array([murmur3(v.encode()) & 0x7FFFFFFF for v in distinct] or [0], np.int64)
    return pd.Series(hashed[codes] % n.to_numpy(np.int64)).astype("Int32").mask(codes < 0)


def register(spark: SparkSession) -> list[str]:
    """Register the functions for this session; returns their names.

    ls_bucket takes whole numbers, ls_bucket_text texts; both take the number of buckets first.  All but ls_bucket_text
    are SQL themselves, which Spark takes into the query's plan.
    """
    for name, parameters, kind, body in (*SQL_FUNCTIONS, *BUCKET_FUNCTIONS):
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {body}")
    spark.udf.register("ls_bucket_text", F.pandas_udf(_bucket_text, T.IntegerType()))
    return [*(f[0] for f in SQL_FUNCTIONS), "ls_bucket", "ls_bucket_text"]
