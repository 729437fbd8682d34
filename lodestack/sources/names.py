"""Names of the engine's tables in Spark SQL: found by Spark's own parser, and put in place by position.

The parser tells which parts of a text are relations, and which are literals, comments, columns, functions or names of
common table expressions.  A relation that is the engine's own is replaced by a temporary view under the table's name as
its alias; columns that are qualified by the table's full name are qualified by the alias instead.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

#: Texts, quoted names and comments: what stands in these is no name.
ATOM = re.compile(r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.|\"\")*\"|`[^`]*`|--[^\n]*|/\*.*?\*/", re.S)
_DOLLAR = re.compile(r"(?<![\w`])([A-Za-z_]\w*\$\w+)")
FORMATS = ("parquet", "csv", "json", "orc", "text", "avro")


@dataclass(frozen=True)
class Found:
    """A relation or a qualified column: its parts, its place, and where an alias can stand (None if it has one)."""

    parts: tuple[str, ...]
    start: int
    stop: int
    alias_at: int | None = None


def _items(seq) -> Iterator:
    for k in range(seq.size()):
        yield seq.apply(k)


def _place(node) -> tuple[int, int] | None:
    start, stop = node.origin().startIndex(), node.origin().stopIndex()
    return (start.get(), stop.get() + 1) if start.isDefined() and stop.isDefined() else None


def _walk(plan, parent, relations: list[Found], columns: list[Found]) -> None:
    kind = plan.getClass().getSimpleName()
    if kind == "UnresolvedRelation" and (place := _place(plan)):
        above = parent.getClass().getSimpleName() if parent is not None else ""
        at = None if above == "SubqueryAlias" else place[1]
        if above == "Sample":
            sampled = _place(parent)
            at = sampled[1] if sampled else None
        relations.append(Found(tuple(_items(plan.multipartIdentifier())), *place, at))
    for e in _items(plan.expressions()):
        _columns(e, columns)
    for child in _items(plan.children()):
        _walk(child, plan, relations, columns)
    for inner in _items(plan.innerChildren()):
        _walk(inner, None, relations, columns)


def _columns(expression, columns: list[Found]) -> None:
    kind = expression.getClass().getSimpleName()
    if kind in ("UnresolvedAttribute", "UnresolvedStar") and (place := _place(expression)):
        if kind == "UnresolvedAttribute":
            parts = tuple(_items(expression.nameParts()))
        else:
            parts = tuple(_items(expression.target().get())) if expression.target().isDefined() else ()
        if len(parts) > 1:
            columns.append(Found(parts, *place))
    for child in _items(expression.children()):
        _columns(child, columns)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def with_dollars_quoted(text: str) -> str:
    """Names such as t$partitions, which Spark's parser doesn't know, in backquotes."""
    out, at = [], 0
    for m in ATOM.finditer(text):
        out += [_DOLLAR.sub(r"`\1`", text[at : m.start()]), m[0]]
        at = m.end()
    return "".join([*out, _DOLLAR.sub(r"`\1`", text[at:])])


def run(spark: SparkSession, text: str, own: Callable[[tuple[str, ...]], str | None], frame: Callable[[str], DataFrame]) -> DataFrame:
    """The rows of a query; own: the name of the engine's table that a relation's parts stand for, or None."""
    text = with_dollars_quoted(text)
    relations: list[Found] = []
    columns: list[Found] = []
    _walk(spark._jsparkSession.sessionState().sqlParser().parsePlan(text), None, relations, columns)
    named = [(r, name) for r in dict.fromkeys(relations) if (name := own(r.parts)) is not None]
    if not named:
        return spark.sql(text)
    plain = [r.parts for r, _ in named if r.alias_at is not None]
    low = lambda parts: tuple(p.lower() for p in parts)
    full = [c for c in columns if any(_prefix(low(c.parts), low(p)) > 1 for p in plain)]
    # Tables of one name from several namespaces go by their full names if columns tell them apart by these.
    several = {low(p)[-1] for p in plain if full and len({low(q) for q in plain if low(q)[-1] == low(p)[-1]}) > 1}

    def alias(parts: tuple[str, ...]) -> str:
        return ".".join(parts) if parts[-1].lower() in several else parts[-1]

    edits: list[tuple[int, int, str]] = []
    keys = {name: f"t{k}" for k, name in enumerate(dict.fromkeys(name for _, name in named))}
    for r, name in named:
        key = keys[name]
        if r.alias_at is None or re.search(r"\bTABLE\s*$", text[: r.start], re.I):
            edits.append((r.start, r.stop, f"{{{key}}}"))
        elif r.alias_at == r.stop:
            edits.append((r.start, r.stop, f"{{{key}}} AS {_escaped(quoted(alias(r.parts)))}"))
        else:
            edits += [(r.start, r.stop, f"{{{key}}}"), (r.alias_at, r.alias_at, f" AS {_escaped(quoted(alias(r.parts)))}")]
    for c in dict.fromkeys(full):
        parts, length = max(((p, _prefix(low(c.parts), low(p))) for p in plain), key=lambda x: x[1])
        star = text[c.start : c.stop].rstrip().endswith("*")
        rest = [quoted(alias(parts)), *map(quoted, c.parts[length:]), *(["*"] if star else [])]
        edits.append((c.start, c.stop, _escaped(".".join(rest))))
    out, at = [], 0
    for start, stop, new in sorted(edits):
        out += [_escaped(text[at:start]), new]
        at = stop
    out.append(_escaped(text[at:]))
    return spark.sql("".join(out), **{key: frame(name) for name, key in keys.items()})


def _escaped(text: str) -> str:
    return text.replace("{", "{{").replace("}", "}}")


def _prefix(column: tuple[str, ...], table: tuple[str, ...]) -> int:
    """How many parts of a column's name, two at least, are the end of a table's name; 0 if they aren't."""
    for n in range(min(len(table), len(column)), 1, -1):
        if column[:n] == table[-n:]:
            return n
    return 0
