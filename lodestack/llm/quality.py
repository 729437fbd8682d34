"""Quality rules whose cutoffs are chosen with a guaranteed bound on falsely rejected good documents."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestack.llm import textvec as tv
from lodestack.llm.store import drop, materialise, small_side, trimmed

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_MARKED = np.zeros(256, bool)
_MARKED[list(b"!?")] = True
WINDOW = 8
#: Strata whose counts come to the driver; more are judged in Spark.
MOST_STRATA = 200
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marked")


def _sums(flags: np.ndarray, offs: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offs[1:]] - total[offs[:-1]]


def counts(data: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    """What the rules count, for each text."""
    starts, ends, first = tv.words(data, offs)
    n_words = np.diff(first)
    space = tv.SPACE[data]
    out = {"n_words": n_words, "word_chars": _sums(~space & ((data & 0xC0) != 0x80), offs), "n_symbols": _sums(_SYMBOL[data], offs)}
    for name, flags in (("n_upper", _UPPER), ("n_marked", _MARKED)):
        out[name] = _sums(flags[data], offs)

    # Lines with a word, equal to an earlier one.
    a, b, line_first = tv.spans(data != 0x0A, offs)
    worded = np.zeros(len(data) + 1, np.int64)
    np.cumsum(~space, out=worded[1:])
    full = worded[b] > worded[a]
    begin = np.concatenate([[0], np.cumsum(full)])[line_first]
    a, b = a[full], b[full]
    text_of = np.repeat(np.arange(len(offs) - 1), np.diff(begin))
    keys = tv.per_text(tv.hashes(data, a, b, lower=False), begin)
    order = np.argsort(keys, kind="stable")
    again = np.zeros(len(keys), bool)
    again[order[1:]] = keys[order][1:] == keys[order][:-1]
    out["n_dup_lines"] = np.bincount(text_of[again], minlength=len(offs) - 1)
    out["n_lines"] = np.diff(begin)

    # Words in windows that the text holds more than once.
    runs, run_first = tv.windows(tv.hashes(data, starts, ends, lower=False), first, WINDOW, whole=False)
    twice = np.flatnonzero(tv.repeated(tv.per_text(runs, run_first)))
    owner = np.searchsorted(run_first, twice, "right") - 1
    at = twice - run_first[owner] + first[owner]
    cover = np.zeros(len(starts) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.subtract.at(cover, at + WINDOW, 1)
    out["n_repeat_words"] = _sums(np.cumsum(cover[:-1]) > 0, first)
    return out


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, data, offs in tv.slices(batch.column(batch.num_columns - 1), 1 << 21):
            found = counts(data, offs)
            kept = [batch.column(k).slice(a, b - a) for k in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, *(pa.array(found[n].astype(np.int64)) for n in COUNTS)], [*batch.schema.names[:-1], *COUNTS])


def with_counts(frame: DataFrame, keep: Sequence[str], text: str = "text") -> DataFrame:
    """The kept columns and the counts of each row's whole text; null and empty texts have zeros."""
    kinds = dict(frame.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), *(f"{n} long" for n in COUNTS)])
    return frame.select(*(F.col(f"`{c}`") for c in keep), F.col(f"`{text}`").cast("string").alias("__counted")).mapInArrow(trimmed(_count_batches), schema)


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


@dataclass(frozen=True)
class Rule:
    """Rejects documents whose measure exceeds a cutoff.

    measure: SQL over the counts; cutoffs: candidates from lenient to strict, fixed before any label is seen.
    """

    name: str
    measure: str
    cutoffs: tuple[float, ...]


def _down(high: float, low: float, steps: int = 24) -> tuple[float, ...]:
    return tuple(round(high * (low / high) ** (k / (steps - 1)), 6) for k in range(steps))


RULES = (
    Rule("symbols", "n_symbols / greatest(n_words, 1)", _down(6.0, 0.02)),
    Rule("dup_lines", "n_dup_lines / greatest(n_lines, 1)", _down(0.95, 0.05)),
    Rule("repeats", "n_repeat_words / greatest(n_words, 1)", _down(0.3, 0.01)),
    Rule("upper", "n_upper / greatest(word_chars, 1)", _down(0.95, 0.05)),
    Rule("marked", "n_marked / greatest(n_words, 1)", _down(3.0, 0.02)),
    Rule("long_words", "word_chars / greatest(n_words, 1)", _down(40.0, 8.0)),
)


def log_binomial_tail(k: int, n: int, p: float) -> float:
    """log P(X <= k) for X binomial (n, p), summed exactly in logarithms."""
    if k >= n:
        return 0.0
    terms = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    most = max(terms)
    return most + math.log(sum(math.exp(t - most) for t in terms))


def certified(rejected: Sequence[int], good: int, risk: float, error: float) -> int:
    """How many steps, from the first, are certified, by how many good documents each rejects.

    Fixed-sequence testing: the hypothesis "this step rejects more than `risk` of the good documents" is dismissed
    while its exact binomial p-value is at most `error`; the first that isn't ends the sequence, so no further
    correction for the number of steps is needed.
    """
    for i, k in enumerate(rejected):
        if log_binomial_tail(k, good, risk) > math.log(error):
            return i
    return len(rejected)


@dataclass(frozen=True)
class Threshold:
    """A certified cutoff.  good, rejected, log_p: of the stratum's certification, of all its cutoffs together."""

    stratum: str
    rule: str
    cutoff: float
    good: int
    rejected: int
    log_p: float


#: Bad documents that a step must add, on the tuning half, for each good one that it loses.
WORTH = 5


def tuned_path(good: Sequence[Sequence[int]], bad: Sequence[Sequence[int]]) -> list[tuple[int, int]]:
    """Steps (rule, cutoff) from lenient to strict, by how many good and bad documents each rule's cutoffs reject.

    Each step takes one rule to a stricter cutoff: the one that adds most bad documents for the good ones that it loses,
    of equals the most lenient of the first rule.  The path ends where no step adds WORTH bad documents for each good one.
    """
    at, path = [-1] * len(good), []
    while True:
        best = None
        for r, (g, b) in enumerate(zip(good, bad, strict=True)):
            now = at[r]
            for i in range(now + 1, len(g)):
                more = b[i] - (b[now] if now >= 0 else 0)
                lost = g[i] - (g[now] if now >= 0 else 0)
                if more > 0 and more >= WORTH * lost and (best is None or more / (lost + 0.5) > best[0]):
                    best = more / (lost + 0.5), r, i
        if best is None:
            return path
        path.append(best[1:])
        at[best[1]] = best[2]


def choose_thresholds(labelled: DataFrame, rules: Sequence[Rule] = RULES, risk: float = 0.05, error: float = 0.05, most_strata: int | None = None, split: Column | None = None) -> list[Threshold] | DataFrame:
    """Cutoffs for each stratum from labelled documents (columns stratum, quality and the counts).

    The labelled documents are split in two by `split` (a long; without it by their order).  On the tuning half, good
    (quality 1) and bad ones (quality 0) say in which order cutoffs are worth tightening (see `tuned_path`).  On the
    holdout half, good ones test the steps of that path in order: the hypothesis "all cutoffs up to here together reject
    more than `risk` of the good documents" is dismissed while its exact binomial p-value is small enough; the first step
    that fails ends the path.  As the path is fixed before the holdout is seen, that needs no correction for its length;
    `error` is shared by all strata (Bonferroni): with a probability of 1 - error every stratum keeps its bound.

    Work in Spark gives a row for each stratum.  Of up to `most_strata` strata (MOST_STRATA) the cutoffs come to the
    driver; for more the result is a table (stratum, rule, cutoff, good, rejected, log_p), written.
    """
    halves = F.pmod(split if split is not None else F.monotonically_increasing_id(), F.lit(2))
    known = labelled.withColumn("__half", halves).withColumn("__measures", F.array(*(F.expr(r.measure).cast("double") for r in rules)))
    known = materialise(known.select("stratum", "quality", "__half", "__measures"), "labelled")
    over = [F.count_if((F.col("quality") == q) & (F.col("__measures")[k] > c)).alias(f"n{k}_{i}_{q}") for k, r in enumerate(rules) for i, c in enumerate(r.cutoffs) for q in (0, 1)]
    tuning = known.where("__half = 0").groupBy("stratum").agg(*over)
    strata = max(1, known.where("__half = 1 and quality = 1").select("stratum").distinct().count())

    def paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, steps = [], []
            for row in batch.to_pylist():
                counts = [[[row[f"n{k}_{i}_{q}"] for i in range(len(r.cutoffs))] for k, r in enumerate(rules)] for q in (0, 1)]
                names.append(row["stratum"])
                steps.append([{"rule": k, "cutoff": rules[k].cutoffs[i]} for k, i in tuned_path(counts[1], counts[0])])
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(steps, pa.list_(pa.struct([("rule", pa.int32()), ("cutoff", pa.float64())])))], ["stratum", "steps"])

    path = small_side(tuning.mapInArrow(paths, "stratum string, steps array<struct<rule:int,cutoff:double>>"), "paths")
    held = known.where("__half = 1 and quality = 1").join(path, "stratum")
    # The first step that rejects a document; 0: none does.
    first = F.array_position(F.transform("steps", lambda s: F.col("__measures")[s["rule"]] > s["cutoff"]), F.lit(True))
    each = held.groupBy("stratum", first.alias("step")).agg(F.count("*").alias("n"), F.first("steps").alias("steps"))
    tested = each.groupBy("stratum").agg(F.sum("n").alias("good"), F.first("steps").alias("steps"), F.collect_list(F.struct("step", "n")).alias("found"))

    def certify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(t.stratum, t.rule, t.cutoff, t.good, t.rejected, t.log_p) for row in batch.to_pylist() for t in _certified_cutoffs(row, rules, risk, error / strata)]
            kinds = (pa.string(), pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.float64())
            columns = list(zip(*out, strict=True)) if out else [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], ["stratum", "rule", "cutoff", "good", "rejected", "log_p"])

    out = materialise(tested.mapInArrow(certify, "stratum string, rule string, cutoff double, good long, rejected long, log_p double"), "thresholds")
    drop(known, path)
    if strata > (MOST_STRATA if most_strata is None else most_strata):
        return out
    order = {r.name: k for k, r in enumerate(rules)}
    chosen = sorted((Threshold(*row) for row in out.collect()), key=lambda t: (t.stratum, order[t.rule]))
    drop(out)
    return chosen


def _certified_cutoffs(row: dict, rules: Sequence[Rule], risk: float, error: float) -> list[Threshold]:
    """A stratum's cutoffs: the strictest of each rule on the certified part of its path."""
    new = {x["step"]: x["n"] for x in row["found"]}
    rejected = list(accumulate(new.get(k, 0) for k in range(1, len(row["steps"]) + 1)))
    passed = certified(rejected, row["good"], risk, error)
    cutoffs = {s["rule"]: s["cutoff"] for s in row["steps"][:passed]}
    if not passed:
        return []
    log_p = log_binomial_tail(rejected[passed - 1], row["good"], risk)
    return [Threshold(row["stratum"], rules[k].name, c, row["good"], rejected[passed - 1], log_p) for k, c in sorted(cutoffs.items())]


def with_verdict(rows: DataFrame, thresholds: list[Threshold] | DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows with the rules that each breaks, in the column `broken`."""
    if not isinstance(thresholds, DataFrame):
        return rows.withColumn("broken", verdict(thresholds, rules))
    each = small_side(thresholds.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("__cutoffs")), "cutoffs")
    joined = rows.join(each, "stratum", "left")
    broken = F.array_compact(F.array(*(F.when(F.expr(r.measure) > F.col("__cutoffs")[r.name], F.lit(r.name)) for r in rules)))
    return joined.withColumn("broken", broken).drop("__cutoffs")


def verdict(thresholds: Sequence[Threshold], rules: Sequence[Rule] = RULES) -> Column:
    """Which rules a row (with `stratum` and the counts) breaks, as an array of names."""
    measures = {r.name: r.measure for r in rules}
    broken = [F.when((F.col("stratum") == t.stratum) & (F.expr(measures[t.rule]) > t.cutoff), F.lit(t.rule)) for t in thresholds]
    return F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")


def _stratified(frame: DataFrame, stratum: str) -> DataFrame:
    value = F.coalesce(F.col(f"`{stratum}`").cast("string"), F.lit("")) if stratum in frame.columns else F.lit("")
    return frame.withColumn("__stratum", value)


def _thresholds(counted: DataFrame, labels: DataFrame, key: str, rules: Sequence[Rule], risk: float, error: float) -> list[Threshold] | DataFrame:
    """counted: __key, stratum and the counts of every document."""
    known = labels.where("quality in (0, 1)").select(F.col(f"`{key}`").alias("__key"), "quality")
    return choose_thresholds(counted.where(~base_failed()).join(known, "__key"), rules, risk, error, split=F.xxhash64("__key"))


def keep_good(frame: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", stratum: str = "lang", risk: float = 0.05, error: float = 0.05, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows, with all their columns, that `judge` keeps.  Texts are counted twice, and not shuffled."""
    keyed = _stratified(frame, stratum).withColumn("__key", F.col(f"`{key}`"))
    counted = materialise(with_counts(keyed, ["__key", "__stratum"], text).withColumnRenamed("__stratum", "stratum"), "counts")
    chosen = _thresholds(counted, labels, key, rules, risk, error)
    named = [f"__c{i}" for i in range(len(frame.columns))]
    again = _stratified(frame, stratum).select("__stratum", F.col(f"`{text}`").alias("__text"), *(F.col(f"`{c}`").alias(n) for c, n in zip(frame.columns, named, strict=True)))
    whole = with_counts(again, [*named, "__stratum"], "__text").withColumnRenamed("__stratum", "stratum")
    drop(counted)
    return with_verdict(whole.where(~base_failed()), chosen, rules).where(F.size("broken") == 0).select(*(F.col(n).alias(c) for c, n in zip(frame.columns, named, strict=True)))


def judge(frame: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", stratum: str = "lang", risk: float = 0.05, error: float = 0.05, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Judge every document: the base rules, then cutoffs certified on the labelled documents of its stratum.

    Returns key, the stratum, the counts, base_failed, broken (array of rules) and kept.  Null texts count as empty
    and fail the base rule; a null stratum is a stratum of its own (""); rows with equal keys are judged apart, and
    count once for each label of theirs; labels that are null or neither 0 nor 1 are left out, a document with
    contradicting labels counts for each.  Without labels, or with too few to certify a cutoff, only the base rules
    reject.  An empty table gives an empty result.
    """
    keyed = _stratified(frame, stratum).withColumn("__key", F.col(f"`{key}`"))
    counted = materialise(with_counts(keyed, ["__key", "__stratum"], text).withColumnRenamed("__stratum", "stratum"), "counts")
    chosen = _thresholds(counted, labels, key, rules, risk, error)
    broken = with_verdict(counted.withColumn("base_failed", base_failed()), chosen, rules)
    return broken.select(F.col("__key").alias(key), "stratum", *COUNTS, "base_failed", "broken", (~F.col("base_failed") & (F.size("broken") == 0)).alias("kept"))
