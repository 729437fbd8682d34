"""Partition transforms as Spark expressions, and predicates on columns carried over to their partition keys.

identity, year, month, day, hour (units since 1970, UTC, rounded down), bucket (a Murmur3 hash, seed 0) and truncate.
All are null for null.
"""

from __future__ import annotations

import datetime as dt
import math
import re
import struct
from dataclasses import dataclass
from decimal import Decimal
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("identity", "year", "month", "day", "hour", "bucket", "truncate")
#: Partition columns of a table at most.
MOST = 4

_MASK = 0xFFFFFFFF
_C1, _C2 = 0xCC9E2D51, 0x1B873593


@dataclass(frozen=True)
class Transform:
    """A transform of a column; `argument` is the number of buckets or the width."""

    column: str
    kind: str = "identity"
    argument: int | None = None

    def __post_init__(self) -> None:
        if self.kind not in KINDS:
            raise ValueError(f"unknown transform {self.kind}")
        if (self.kind in ("bucket", "truncate")) != (self.argument is not None) or self.argument is not None and self.argument <= 0:
            raise ValueError(f"{self.kind} takes {'a positive number' if self.kind in ('bucket', 'truncate') else 'no number'}")

    def __str__(self) -> str:
        return self.column if self.kind == "identity" else f"{self.kind}({self.column})" if self.argument is None else f"{self.kind}({self.column}, {self.argument})"

    @property
    def key(self) -> str:
        """The name of its key column."""
        return self.column if self.kind == "identity" else f"{self.column}_{self.kind}"


_TEXT = re.compile(r"\s*(?:(?P<kind>[a-z]+)s?\s*\(\s*(?:(?P<first>[^,()\s]+)\s*)(?:,\s*(?P<second>[^,()\s]+)\s*)?\)|(?P<plain>[^,()\s]+))\s*", re.I)


def parse(text: str) -> Transform:
    """`a`, `year(a)`, `days(a)`, `bucket(4, a)`, `bucket(a, 4)`, `truncate(a, 3)`."""
    m = _TEXT.fullmatch(text)
    if not m:
        raise ValueError(f"no transform: {text!r}")
    if m["plain"]:
        return Transform(m["plain"])
    kind = m["kind"].lower()
    kind = kind[:-1] if kind in ("years", "months", "days", "hours") else kind
    first, second = m["first"], m["second"]
    if second is None:
        return Transform(first, kind)
    return Transform(second, kind, int(first)) if first.isdigit() else Transform(first, kind, int(second))


# Murmur3 (x86, 32 bits, seed 0), as Python and as a Spark expression


def murmur3(data: bytes) -> int:
    """The hash of bytes, as a signed integer."""
    h = 0
    whole = len(data) // 4 * 4
    for (k,) in struct.iter_unpack("<I", data[:whole]):
        h ^= _scramble(k)
        h = ((h << 13 | h >> 19) & _MASK) * 5 + 0xE6546B64 & _MASK
    if len(data) > whole:
        h ^= _scramble(int.from_bytes(data[whole:], "little"))
    h ^= len(data)
    for shift, by in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        h = (h ^ h >> shift) * by & _MASK
    h ^= h >> 16
    return h - (1 << 32) if h >> 31 else h


def _scramble(k: int) -> int:
    k = k * _C1 & _MASK
    return (k << 15 | k >> 17) * _C2 & _MASK


def _let(value: Column, body) -> Column:
    """body(value), with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _times(a: Column, c: int) -> Column:
    """The low 32 bits of a product, without overflow of 64 bits."""
    return ((a.bitwiseAND(F.lit(65535)) * F.lit(c)) + F.shiftleft((F.shiftrightunsigned(a, 16) * F.lit(c)).bitwiseAND(F.lit(65535)), 16)).bitwiseAND(F.lit(_MASK))


def _turn(a: Column, n: int) -> Column:
    return F.shiftleft(a.bitwiseAND(F.lit((1 << 32 - n) - 1)), n).bitwiseOR(F.shiftrightunsigned(a, 32 - n))


def hash_long(column: Column) -> Column:
    """murmur3 of a whole number's eight little-endian bytes, as an unsigned number, inside Spark."""
    wide = column.cast("long")

    def scrambled(word: Column) -> Column:
        return _let(_times(word, _C1), lambda k: _times(_turn(k, 15), _C2))

    def round_(h: Column, word: Column) -> Column:
        return _let(h.bitwiseXOR(scrambled(word)), lambda x: (_turn(x, 13) * F.lit(5) + F.lit(0xE6546B64)).bitwiseAND(F.lit(_MASK)))

    low = wide.bitwiseAND(F.lit(_MASK))
    high = F.shiftrightunsigned(wide, 32)
    h = _let(round_(F.lit(0).cast("long"), low), lambda a: round_(a, high))
    h = _let(h.bitwiseXOR(F.lit(8).cast("long")), lambda a: a.bitwiseXOR(F.shiftrightunsigned(a, 16)))
    h = _let(_let(h, lambda a: _times(a, 0x85EBCA6B)), lambda a: a.bitwiseXOR(F.shiftrightunsigned(a, 13)))
    return _let(_let(h, lambda a: _times(a, 0xC2B2AE35)), lambda a: a.bitwiseXOR(F.shiftrightunsigned(a, 16)))


def _hash_each(values: pd.Series) -> pd.Series:
    """Bytes of any length; distinct values are hashed once for each batch."""
    known = {v: murmur3(v) for v in set(values.dropna().map(bytes))}
    return values.map(lambda v: None if v is None else known[bytes(v)]).astype("Int32")


def _hash_numerals(values: pd.Series) -> pd.Series:
    known = {v: murmur3(_decimal_bytes(Decimal(v), 0)) for v in set(values.dropna())}
    return values.map(lambda v: None if v is None else known[v]).astype("Int32")


def _vectorised(function, column: Column) -> Column:
    return F.pandas_udf(function, T.IntegerType())(column).cast("long")


def _decimal_bytes(value: Decimal, scale: int) -> bytes:
    unscaled = int(value.scaleb(scale))
    return unscaled.to_bytes(max(1, (unscaled + (unscaled < 0)).bit_length() // 8 + 1), "big", signed=True)


def hash_value(value: Any, kind: T.DataType) -> int:
    """The hash of a Python value of a Spark type."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return murmur3(struct.pack("<q", value))
    if isinstance(kind, T.DateType):
        return murmur3(struct.pack("<q", (value - dt.date(1970, 1, 1)).days))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return murmur3(struct.pack("<q", micros(value)))
    if isinstance(kind, T.DecimalType):
        return murmur3(_decimal_bytes(value, kind.scale))
    if isinstance(kind, (T.StringType, T.CharType, T.VarcharType)):
        return murmur3(value.encode())
    if isinstance(kind, T.BinaryType):
        return murmur3(bytes(value))
    raise TypeError(f"no bucket of {kind.simpleString()}")


def micros(value: dt.datetime) -> int:
    if value.tzinfo is None:
        value = value.replace(tzinfo=dt.timezone.utc)
    delta = value - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
    return (delta.days * 86400 + delta.seconds) * 1_000_000 + delta.microseconds


def _micros_column(column: Column) -> Column:
    return F.unix_micros(column.cast("timestamp"))


def bucket(column: Column, kind: T.DataType, buckets: int) -> Column:
    """`(hash & 0x7fffffff) % buckets` as int."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        hashed = hash_long(column)
    elif isinstance(kind, T.DateType):
        hashed = hash_long(F.unix_date(column))
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        hashed = hash_long(_micros_column(column))
    elif isinstance(kind, T.DecimalType):
        unscaled = (column * F.lit(10 ** kind.scale).cast("decimal(38,0)")) if kind.scale else column
        hashed = _vectorised(_hash_numerals, unscaled.cast("decimal(38,0)").cast("string"))
    elif isinstance(kind, (T.StringType, T.CharType, T.VarcharType)):
        hashed = _vectorised(_hash_each, F.encode(column, "UTF-8"))
    elif isinstance(kind, T.BinaryType):
        hashed = _vectorised(_hash_each, column)
    else:
        raise TypeError(f"no bucket of {kind.simpleString()}")
    return F.pmod(hashed.bitwiseAND(F.lit(0x7FFFFFFF)), F.lit(buckets)).cast("int")


def truncate(column: Column, kind: T.DataType, width: int) -> Column:
    """Whole numbers and decimals go down to a multiple of the width (of the last digit); texts and bytes keep their first."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        wide = column.cast("long")
        return (wide - F.pmod(wide, F.lit(width))).cast(kind)
    if isinstance(kind, T.DecimalType):
        step = F.lit(Decimal(width).scaleb(-kind.scale)).cast(kind)
        return (column - F.pmod(column, step)).cast(kind)
    if isinstance(kind, (T.StringType, T.CharType, T.VarcharType, T.BinaryType)):
        return F.substring(column, 1, width)
    raise TypeError(f"no truncation of {kind.simpleString()}")


def apply(transform: Transform, column: Column, kind: T.DataType) -> Column:
    """The key of a column under a transform."""
    k = transform.kind
    if k == "identity":
        return column
    if k == "bucket":
        return bucket(column, kind, transform.argument)
    if k == "truncate":
        return truncate(column, kind, transform.argument)
    timed = isinstance(kind, (T.TimestampType, T.TimestampNTZType))
    if not timed and not isinstance(kind, T.DateType) or k == "hour" and not timed:
        raise TypeError(f"no {k} of {kind.simpleString()}")
    if k == "year":
        return F.year(column) - 1970
    if k == "month":
        return (F.year(column) - 1970) * 12 + F.month(column) - 1
    if k == "day":
        return F.unix_date(column.cast("date"))
    return F.floor(_micros_column(column) / F.lit(3_600_000_000)).cast("int")


def apply_value(transform: Transform, value: Any, kind: T.DataType) -> Any:
    """The key of a Python value."""
    k = transform.kind
    if value is None or k == "identity":
        return value
    if k == "bucket":
        return (hash_value(value, kind) & 0x7FFFFFFF) % transform.argument
    if k == "truncate":
        if isinstance(kind, T.DecimalType):
            unscaled = int(value.scaleb(kind.scale))
            return Decimal(unscaled - unscaled % transform.argument).scaleb(-kind.scale)
        return value[: transform.argument] if isinstance(value, (str, bytes)) else value - value % transform.argument
    if k == "year":
        return value.year - 1970
    if k == "month":
        return (value.year - 1970) * 12 + value.month - 1
    if k == "day":
        day = value.date() if isinstance(value, dt.datetime) else value
        return (day - dt.date(1970, 1, 1)).days
    return math.floor(micros(value) / 3_600_000_000)


def key_type(transform: Transform, kind: T.DataType) -> T.DataType:
    return kind if transform.kind in ("identity", "truncate") else T.IntegerType()


def carry(transform: Transform, operator: str, value: Any, kind: T.DataType) -> tuple[str, Any] | None:
    """A condition `column operator value` carried over to the key: (operator, key value), or None if there is none.

    The result holds wherever the condition does (it may hold for more), so the condition itself must stay.
    """
    if operator in ("is null", "is not null"):
        return operator, None
    if transform.kind == "identity":
        return operator, value
    if operator == "=" or operator == "<=>" and value is not None:
        return operator, apply_value(transform, value, kind)
    if transform.kind == "bucket" or operator not in ("<", "<=", ">", ">="):
        return None
    if operator in ("<", ">"):
        value = _next_to(value, kind, -1 if operator == "<" else 1)
    key = apply_value(transform, value, kind)
    return ("<=" if operator[0] == "<" else ">="), key


def _next_to(value: Any, kind: T.DataType, step: int) -> Any:
    """The closest value of a discrete type below (-1) or above (1); the value itself where that can't be told."""
    try:
        if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)) and type(value) is int:
            return value + step
        if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)) and isinstance(value, dt.datetime):
            return value + dt.timedelta(microseconds=step)
        if isinstance(kind, T.DateType) and isinstance(value, dt.date):
            return value + dt.timedelta(days=step)
        if isinstance(kind, T.DecimalType) and isinstance(value, (int, Decimal)) and Decimal(value).scaleb(kind.scale) % 1 == 0:
            return Decimal(value) + Decimal(step).scaleb(-kind.scale)
    except OverflowError:
        pass
    return value
