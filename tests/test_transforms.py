import datetime as dt
import struct
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestack.functions.transforms import Transform, apply, apply_value, carry, murmur3, parse


@pytest.mark.parametrize(("value", "unsigned", "bucket"), [(34, 2017239379, 3), (0, 1669671676, 12), (-1, 1651860712, 8), (1234567890123, 1740798302, 14)])
def test_hash_of_long(spark, value, unsigned, bucket):
    assert murmur3(struct.pack("<q", value)) & 0xFFFFFFFF == unsigned
    row = spark.createDataFrame([(value,)], "v long").select(apply(Transform("v", "bucket", 16), F.col("v"), T.LongType())).first()
    assert row[0] == bucket


CASES = [
    (T.IntegerType(), "int", [0, 1, -1, 17, -2147483648, 2147483647, None]),
    (T.LongType(), "long", [0, -7, 9223372036854775807, -9223372036854775808, None]),
    (T.StringType(), "string", ["", "a", "abcd", "abcde", "żółw", "梦🙂x", None]),
    (T.BinaryType(), "binary", [b"", b"\x00\xff\x10", None]),
    (T.DateType(), "date", [dt.date(1969, 12, 31), dt.date(1970, 1, 1), dt.date(2024, 2, 29), dt.date(1900, 3, 1), None]),
    (T.TimestampNTZType(), "timestamp_ntz", [dt.datetime(1969, 12, 31, 23, 30), dt.datetime(1970, 1, 1), dt.datetime(2017, 11, 16, 22, 31, 8, 123456), None]),
    (T.DecimalType(9, 2), "decimal(9,2)", [Decimal("14.20"), Decimal("-14.20"), Decimal("0.00"), Decimal("-0.01"), None]),
]


@pytest.mark.parametrize(("kind", "name", "values"), CASES, ids=[c[1] for c in CASES])
def test_spark_agrees_with_python(spark, kind, name, values):
    transforms = [Transform("v"), Transform("v", "bucket", 7)]
    if not isinstance(kind, (T.DateType, T.TimestampNTZType)):
        transforms.append(Transform("v", "truncate", 3))
    if isinstance(kind, (T.DateType, T.TimestampNTZType)):
        transforms += [Transform("v", k) for k in ("year", "month", "day")]
    if isinstance(kind, T.TimestampNTZType):
        transforms.append(Transform("v", "hour"))
    rows = spark.createDataFrame([(v,) for v in values], f"v {name}")
    for t in transforms:
        if t.kind == "truncate" and any(v is not None and isinstance(v, int) and v < -2147483640 for v in values):
            rows_, kept = rows.where("v is null or v > -2147483640"), [v for v in values if v is None or v > -2147483640]
        else:
            rows_, kept = rows, values
        got = [r[0] for r in rows_.select(apply(t, F.col("v"), kind)).collect()]
        want = [apply_value(t, v, kind) for v in kept]
        assert [bytes(g) if isinstance(g, bytearray) else g for g in got] == want, str(t)


def test_known_values():
    assert apply_value(Transform("v", "truncate", 10), -7, T.IntegerType()) == -10
    assert apply_value(Transform("v", "hour"), dt.datetime(1969, 12, 31, 23, 30), T.TimestampNTZType()) == -1
    assert apply_value(Transform("v", "month"), dt.date(1969, 12, 1), T.DateType()) == -1
    assert apply_value(Transform("v", "truncate", 2), "🙂ab", T.StringType()) == "🙂a"


def test_parse():
    assert parse("a") == Transform("a")
    assert parse("bucket(4, c2)") == parse("bucket(c2, 4)") == Transform("c2", "bucket", 4)
    assert parse("years(d)") == Transform("d", "year")
    for bad in ("bucket(a)", "year(a, 3)", "median(a)", "bucket(0, a)", "f(a"):
        with pytest.raises(ValueError):
            parse(bad)


def test_carry_widens():
    t = Transform("v", "truncate", 10)
    assert carry(t, "<", 20, T.IntegerType()) == ("<=", 10) and carry(t, "<", 21, T.IntegerType()) == ("<=", 20) and carry(t, ">", 29, T.IntegerType()) == (">=", 30) and carry(t, ">", 25, T.IntegerType()) == (">=", 20)
    assert carry(t, "<>", 20, T.IntegerType()) is None
    assert carry(Transform("v", "bucket", 4), "<", 20, T.IntegerType()) is None
    assert carry(Transform("v", "bucket", 4), "is null", None, T.IntegerType()) == ("is null", None)


def test_types_that_do_not_fit(spark):
    for t, kind in [(Transform("v", "hour"), T.DateType()), (Transform("v", "year"), T.IntegerType()), (Transform("v", "bucket", 3), T.DoubleType()), (Transform("v", "truncate", 3), T.DateType())]:
        with pytest.raises(TypeError):
            apply(t, F.lit(None).cast(kind), kind)
