"""Personal data by fixed patterns, and identifiers that bootstrapped contexts discover."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestack.llm import textvec as tv
from lodestack.llm.store import drop, materialise, small_side, trimmed

#: In the order in which spans that start together are listed; the method adds the last, and more of the others.
KINDS = ("email", "ip", "card", "phone", "secret")
BASE = 4

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only begin where a run of digits does, and takes whole runs: so possessive, and linear in the text.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile("[^0-9]")
#: Seeds of the kind `secret`: hexadecimal keys of 32, 40 or 64 places with letters and digits in them.
_KEY = re.compile(r"(?<![A-Za-z0-9])(?=[0-9]*[a-f])(?=[a-f]*[0-9])(?:[0-9a-f]{64}|[0-9a-f]{40}|[0-9a-f]{32})(?![A-Za-z0-9])")
#: Tokens shaped like identifiers: six or more such characters with a digit among them.
_SHAPED = re.compile(r"[A-Za-z0-9_+/=@][A-Za-z0-9_+/=.@-]{4,}[A-Za-z0-9_+/=]")
#: Identifiers written in groups: digits, with or without capitals before them, or four capitals; one space between.
_SPACED = re.compile(r"(?<![A-Za-z0-9])[A-Z]{0,4}+[0-9]{2,}+(?: (?:[A-Z]{0,4}+[0-9]++|[A-Z]{4})(?![A-Za-z0-9]))+")
#: Numbers with a part in parentheses, and groups of hexadecimal places between colons.
_BRACKETED = re.compile(r"(?<![A-Za-z0-9+])\([0-9]{2,5}\)[ .-]?[0-9]{2,8}(?:[ .-][0-9]{2,8}){0,4}(?![A-Za-z0-9])")
_COLONS = re.compile(r"(?<![A-Za-z0-9:])[0-9A-Fa-f]{0,4}+(?::[0-9A-Fa-f]{0,4}+){3,7}(?![A-Za-z0-9:])")
#: Addresses with their marks spelled out in brackets.
_SPOKEN_AT = re.compile(r" ?[\[({] ?at ?[\])}] ?", re.I)
_SPOKEN_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:(?:\.| ?[\[({] ?dot ?[\])}] ?)[A-Za-z0-9-]++)+", re.I)
_ITEM = re.compile(r"[^\W\d_]+|\d+|[^\w\s]|_")
#: Characters of context looked at on either side.
CONTEXT = 48


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of `[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+`, found from each @ outwards."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            last = m.end()
        at = text.find("@", max(at + 1, last))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all base entities, by start and kind."""
    out = [(a, 0, b) for a, b in emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def shaped(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, kind or -1, end) of seeds of secrets and of other identifier-shaped tokens off the taken spans.

    All keys of a token are seeds, and what is left of it on either side may be shaped like an identifier too.  Other
    shapes: groups with single spaces, numbers with a part in parentheses, groups between colons, and addresses whose
    marks are spelled out in brackets, as name [at] site (dot) org.
    """
    out = []
    busy = sorted((a, b) for a, _, b in taken)

    def free(a: int, b: int, k: int) -> bool:
        while k < len(busy) and busy[k][1] <= a:
            k += 1
        return k == len(busy) or busy[k][0] >= b

    k = 0
    for m in _SHAPED.finditer(text):
        a, b = m.span()
        while k < len(busy) and busy[k][1] <= a:
            k += 1
        if not any(c.isdigit() for c in m[0]):
            continue
        at = a
        for key in _KEY.finditer(m[0]):
            start, end = a + key.start(), a + key.end()
            if free(start, end, k):
                out.append((start, 4, end))
            out += [(x.start(), -1, x.end()) for x in _SHAPED.finditer(text, at, start) if any(c.isdigit() for c in x[0]) and free(*x.span(), k)]
            at = end
        if at == a:
            if free(a, b, k):
                out.append((a, -1, b))
        else:
            out += [(x.start(), -1, x.end()) for x in _SHAPED.finditer(text, at, b) if any(c.isdigit() for c in x[0]) and free(*x.span(), k)]
    k = 0
    for m in _SPACED.finditer(text):
        a, b = m.span()
        while k < len(busy) and busy[k][1] <= a:
            k += 1
        if b - a - m[0].count(" ") >= 6 and free(a, b, k):
            out.append((a, -1, b))
    for pattern in (_BRACKETED, _COLONS) if "(" in text or ":" in text else ():
        k = 0
        for m in pattern.finditer(text):
            a, b = m.span()
            while k < len(busy) and busy[k][1] <= a:
                k += 1
            if any(c.isdigit() for c in m[0]) and free(a, b, k):
                out.append((a, -1, b))
    last = k = 0
    for m in _SPOKEN_AT.finditer(text):
        start = m.start()
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start() and (domain := _SPOKEN_DOMAIN.match(text, m.end())):
            last = domain.end()
            while k < len(busy) and busy[k][1] <= start:
                k += 1
            if free(start, last, k):
                out.append((start, -1, last))
    return out


def patterns(text: str, start: int, end: int) -> list[str]:
    """Lexical patterns around a span: its last three, two and one items on the left, and one on either side.

    Items are words (lower case), runs of digits (as 0) and single marks.
    """
    low = text[max(0, start - CONTEXT) : start].lower()
    left = ["0" if x[0].isdigit() else x for x in _ITEM.findall(low)]
    if start > CONTEXT and left and low[0].isalnum():
        left = left[1:]  # it may be cut
    nxt = _ITEM.search(text, end, end + CONTEXT)
    right = "" if not nxt else "0" if nxt[0][0].isdigit() else nxt[0].lower()
    out = [f"{n}<{' '.join(left[-n:])}" for n in (3, 2, 1) if len(left) >= n]
    return [*out, f"b<{left[-1] if left else ''}>{right}"]


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


_SPAN = pa.struct([("s", pa.int64()), ("k", pa.int32()), ("e", pa.int64())])
_MENTION = pa.struct([("s", pa.int64()), ("k", pa.int32()), ("e", pa.int64()), ("value", pa.string()), ("patterns", pa.list_(pa.string()))])
_INTEREST = np.zeros(256, bool)
_INTEREST[[*range(48, 58), *b"@[({"]] = True
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    context = TaskContext.get()
    row = (context.partitionId() if context else 0) << 36
    for batch in batches:
        column = batch.column(1)
        for a, b, data, offs in tv.slices(column, 1 << 22):
            total = np.zeros(len(data) + 1, np.int64)
            np.cumsum(_INTEREST[data], out=total[1:])
            any_ = total[offs[1:]] > total[offs[:-1]]
            n = b - a
            counted = np.zeros((BASE, n), np.int64)
            shas, base, mentions = [EMPTY_SHA] * n, [()] * n, [()] * n
            for i in np.flatnonzero(any_).tolist():
                text = data[offs[i] : offs[i + 1]].tobytes().decode()
                found = base_spans(text)
                for _, k, _ in found:
                    counted[k, i] += 1
                shas[i] = hashlib.sha256(joined(found).encode()).hexdigest()
                base[i] = [{"s": s, "k": k, "e": e} for s, k, e in found]
                mentions[i] = [{"s": s, "k": k, "e": e, "value": hashlib.sha256(text[s:e].encode()).hexdigest()[:32], "patterns": patterns(text, s, e)} for s, k, e in [*found, *shaped(text, found)]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(row, row + n)), batch.column(0).slice(a, n), batch.column(2).slice(a, n), *(pa.array(c) for c in counted), pa.array(shas), pa.array(base, pa.list_(_SPAN)), pa.array(mentions, pa.list_(_MENTION))],
                ["row", "key", "text_mark", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "base", "mentions"],
            )
            row += n


def score(mentions: DataFrame, rounds: int = 3, support: int = 8, confidence: float = 0.8) -> DataFrame:
    """High-confidence patterns for each kind, from an iterated pattern-instance graph.

    mentions: (value string, kind int or -1, patterns array).  Values of a known kind are seeds.  In each round a
    pattern's confidence for a kind is the mean of its distinct values' scores for that kind, and counts only if
    values worth `support` seeds stand behind it; a value that is no seed then scores one minus the product of
    (1 - confidence) over its trusted patterns.  Returns (pattern, kind, confidence) of at least `confidence`.
    """
    edges = materialise(mentions.select("value", "kind", F.explode("patterns").alias("pattern")).groupBy("value", "pattern").agg(F.max("kind").alias("kind")), "edges")
    total = edges.groupBy("pattern").agg(F.count("*").alias("total")).where(f"total >= {support}")
    graph = materialise(edges.join(total, "pattern"), "graph")
    drop(edges)
    scores = graph.where("kind >= 0").select("value", "kind", F.lit(1.0).alias("score")).distinct()
    trusted = last = None
    for _ in range(rounds):
        known = graph.drop("kind").join(scores, "value")
        trusted = known.groupBy("pattern", "kind").agg(F.sum("score").alias("mass"), F.first("total").alias("total")).where(f"mass >= {support} and mass >= {confidence} * total")
        before, trusted = last, materialise(trusted.select("pattern", "kind", (F.col("mass") / F.col("total")).alias("confidence")), "patterns")
        drop(*([before] if before is not None else []))
        last = trusted
        found = graph.where("kind < 0").drop("kind").join(trusted, "pattern").groupBy("value", "kind")
        found = found.agg((1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-6)))))).alias("score"))
        scores = graph.where("kind >= 0").select("value", "kind", F.lit(1.0).alias("score")).distinct().unionByName(found)
    drop(graph)
    return trusted


def find(frame: DataFrame, text: str = "text", key: str = "doc_id", rounds: int = 3, support: int = 8, confidence: float = 0.8) -> DataFrame:
    """Spans of personal data in every whole text.

    Returns key, n_email, n_ip, n_card, n_phone (of the base patterns), base_sha256, spans (all of them as
    kind:start:end in code points, by start, then kind), spans_list (array of struct s, k, e; k indexes KINDS) and
    text_mark (a hash of the text).
    What is shaped like an identifier (see `shaped`) and stands in a context of high confidence is added with that context's kind, unless
    they overlap a base span.  Null and empty texts have no spans; repeated rows and equal or null keys stay rows of
    their own; an empty table gives an empty result; other columns are not read.
    """
    kind = dict(frame.dtypes)[key]
    schema = f"row long, key {kind}, text_mark long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base array<struct<s:long,k:int,e:long>>, mentions array<struct<s:long,k:int,e:long,value:string,patterns:array<string>>>"
    scanned = materialise(frame.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"), F.xxhash64(F.col(f"`{text}`").cast("string")).alias("mark")).mapInArrow(trimmed(_scan), schema), "scanned")
    each = scanned.where(F.size("mentions") > 0).select("row", F.explode("mentions").alias("m"))
    trusted = score(each.select(F.col("m.value").alias("value"), F.col("m.k").alias("kind"), F.col("m.patterns").alias("patterns")), rounds, support, confidence)
    seeds = each.where("m.k >= 4").select("row", "m.s", "m.k", "m.e")
    unseen = each.where("m.k < 0").select("row", "m.s", "m.e", F.explode("m.patterns").alias("pattern")).join(trusted, "pattern")
    best = unseen.groupBy("row", "s", "e").agg(F.max_by("kind", F.struct("confidence", -F.col("kind"))).alias("k")).select("row", "s", "k", "e")
    added = seeds.unionByName(best).groupBy("row").agg(F.collect_list(F.struct("s", "k", "e")).alias("added"))
    everything = F.array_sort(F.concat("base", F.coalesce("added", F.array().cast("array<struct<s:long,k:int,e:long>>"))))
    out = scanned.drop("mentions").join(added, "row", "left").withColumn("spans_list", everything)
    names = F.array(*map(F.lit, KINDS))

    def shown(x: Column) -> Column:
        return F.concat_ws(":", F.element_at(names, x.k + 1), x.s.cast("string"), x.e.cast("string"))

    return out.select(F.col("key").alias(key), "n_email", "n_ip", "n_card", "n_phone", "base_sha256", F.array_join(F.transform("spans_list", shown), ",").alias("spans"), "spans_list", "text_mark")


def _replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(0).to_pylist()
        out = []
        for text, spans in zip(texts, batch.column(1).to_pylist(), strict=True):
            at, parts = 0, []
            for span in spans or ():
                if span["s"] >= at:
                    parts += [text[at : span["s"]], f"<{KINDS[span['k']].upper()}>"]
                    at = span["e"]
                elif span["e"] > at:
                    at = span["e"]
            out.append(text if not spans else "".join([*parts, text[at:]]))
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), *batch.columns[2:]], ["text", *batch.schema.names[2:]])


def redact(frame: DataFrame, spans: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows with every span of theirs (from `find`) replaced by its kind, as <EMAIL>.

    Rows find their spans by key and text, so repeated rows and equal or null keys are no matter; null texts stay null.
    """
    names = [f"__c{i}" for i in range(len(frame.columns))]
    renamed = frame.toDF(*names)
    of = dict(zip(frame.columns, names, strict=True))
    held = spans.where(F.size("spans_list") > 0).select(F.col(f"`{key}`").alias("__key"), F.col("text_mark").alias("__mark"), "spans_list").dropDuplicates(["__key", "__mark"])
    held = small_side(held, "spans")
    others = [n for n in names if n != of[text]]
    same_row = F.col(of[key]).eqNullSafe(F.col("__key")) & (F.xxhash64(F.col(of[text])) == F.col("__mark"))
    rows = renamed.join(held, same_row, "left").select(F.col(of[text]).alias("text"), "spans_list", *others)
    kinds = dict(rows.dtypes)
    changed = rows.where("spans_list is not null").mapInArrow(trimmed(_replace), ", ".join(f"{c} {kinds[c]}" for c in ("text", *others)))
    same = rows.where("spans_list is null").drop("spans_list")
    return changed.unionByName(same).select(*(F.col("text" if n == of[text] else n).alias(c) for c, n in of.items()))
