"""Specifiers after a table's name: `t.partitions`, `t import_data(a, b)`, `t allow_non_acid`, `t$partitions allow_non_acid`."""

from __future__ import annotations

import re

IMPORT_DATA, ALLOW_NON_ACID = "import_data", "allow_non_acid"
PARTITIONS = ("partitions",)
_SPECIFIER = re.compile(rf"\s+(?:\w+\.)?(?:(?P<import>{IMPORT_DATA})\s*\((?P<columns>[^)]*)\)|(?P<acid>{ALLOW_NON_ACID}))\s*$", re.I)


def split(name: str) -> tuple[str, tuple | None]:
    """The bare name and what follows: None, PARTITIONS, (IMPORT_DATA, columns) or (ALLOW_NON_ACID[, "partitions"])."""
    name = name.strip()
    quoted = re.fullmatch(r"((?:[^`]*\.)?)`([^`]+)`", name)
    name = f"{quoted[1]}{quoted[2]}" if quoted else name
    m = _SPECIFIER.search(name)
    bare = name[: m.start()] if m else name
    parts = bare.endswith((".partitions", "$partitions"))
    bare = bare[: -len(".partitions")] if parts else bare.rstrip()
    if not m:
        return bare, PARTITIONS if parts else None
    if m["acid"]:
        return bare, (ALLOW_NON_ACID, *PARTITIONS) if parts else (ALLOW_NON_ACID,)
    columns = tuple(c.strip() for c in m["columns"].split(",") if c.strip())
    if not columns or len(set(columns)) < len(columns):
        raise ValueError(f"columns of {IMPORT_DATA} are missing or occur twice")
    return bare, (IMPORT_DATA, columns)
