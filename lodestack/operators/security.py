"""Row filters, column masks and column permissions of a user on a table or view."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Policy:
    """row_filters and masks are SQL over the table's columns; an empty `allowed` allows all that isn't denied."""

    row_filters: Sequence[str] = ()
    allowed: frozenset[str] = frozenset()
    denied: frozenset[str] = frozenset()
    masks: Mapping[str, str] = field(default_factory=dict)

    def for_user(self, user: str) -> Policy:
        """With `current_user()` replaced by the user's name."""
        quoted = "'" + user.replace("'", "''") + "'"
        put = lambda sql: re.sub(r"\bcurrent_user\s*\(\s*\)|\bcurrent_user\b", lambda _: quoted, sql, flags=re.I)
        return Policy(tuple(map(put, self.row_filters)), self.allowed, self.denied, {k: put(v) for k, v in self.masks.items()})


class Policies:
    """Policies by (table or view, user).  A lookup that fails denies: no policy is not the same as an unknown one."""

    def __init__(self, known: Mapping[tuple[str, str], Policy] | None = None, enabled: bool = True):
        self.known, self.enabled = dict(known or {}), enabled

    def set(self, name: str, user: str, policy: Policy) -> None:
        self.known[name, user] = policy

    def of(self, name: str, user: str | None) -> Policy:
        if not self.enabled:
            return Policy()
        try:
            return self.known.get((name, user or ""), Policy()).for_user(user or "")
        except Exception as error:
            raise PermissionError(f"access denied: the policy of {name} can't be read") from error


def check_select(policy: Policy, columns: Sequence[str], name: str = "the table") -> None:
    for c in columns:
        if c in policy.denied or policy.allowed and c not in policy.allowed and c not in policy.masks:
            raise PermissionError(f"access denied: column {c} of {name}")


def visible(policy: Policy, columns: Sequence[str]) -> list[str]:
    """The columns that `*` stands for; raises if there are none."""
    out = [c for c in columns if c not in policy.denied and (not policy.allowed or c in policy.allowed or c in policy.masks)]
    if not out:
        raise PermissionError("access denied: no column is left")
    return out


def hides_all(policy: Policy, columns: Sequence[str]) -> bool:
    """Whether a user sees no column of a table, so that not even its name is shown."""
    try:
        visible(policy, columns)
    except PermissionError:
        return True
    return False


def secured(rows: DataFrame, policy: Policy, columns: Sequence[str] | None = None, name: str = "the table") -> DataFrame:
    """Rows that pass all filters (on unmasked values), then masks in place of columns."""
    chosen = list(columns) if columns is not None else visible(policy, rows.columns)
    check_select(policy, chosen, name)
    for text in policy.row_filters:
        rows = rows.where(text)
    kinds = dict(rows.dtypes)
    return rows.select(*((F.expr(policy.masks[c]).cast(kinds[c]) if c in policy.masks else F.col(f"`{c}`")).alias(c) for c in chosen))


def delete_condition(policy: Policy, where: str | None) -> str | None:
    """The condition of a DELETE: with masks it is denied; row filters are added, as hidden rows can't be deleted."""
    if policy.masks:
        raise PermissionError("access denied: DELETE on a table with column masks")
    parts = [*([where] if where else []), *policy.row_filters]
    return " AND ".join(f"({p})" for p in parts) if parts else None


def check_update(policy: Policy) -> None:
    if policy.masks or policy.row_filters:
        raise PermissionError("access denied: UPDATE on a table with row filters or column masks")


def check_drop(policy: Policy) -> None:
    """Whole partitions go with rows that filters may hide, and by keys that masks may hide."""
    if policy.masks or policy.row_filters or policy.denied or policy.allowed:
        raise PermissionError("access denied: dropping partitions of a table with row filters, masks or hidden columns")


def check_insert(policy: Policy, columns: Sequence[str]) -> None:
    """Rows can be added, but not to columns that the user may not see."""
    for c in columns:
        if c in policy.denied or policy.allowed and c not in policy.allowed:
            raise PermissionError(f"access denied: INSERT into column {c}")


def check_partitions(policy: Policy) -> None:
    if policy.row_filters:
        raise PermissionError("access denied: the partitions table of a table with row filters")
