import random
import re
from collections import Counter
from math import comb

import numpy as np
import pytest

from lodestack.llm import quality
from lodestack.llm.quality import RULES, certified, choose_thresholds, judge, keep_good, log_binomial_tail

from .conftest import multiset


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    cover = {i for k in range(len(words) - 7) if runs[tuple(words[k : k + 8])] > 1 for i in range(k, k + 8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(cover)


@pytest.mark.parametrize("table", ["odd", "documents"])
def test_counts(request, spark, table):
    frame = request.getfixturevalue(table)
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, None, None), (None, 1, 1), (3, 7, 0)], "doc_id long, quality int, toxic int")
    got = judge(frame, labels).collect()
    want = []
    for r in frame.collect():
        b = brute(r.text)
        failed = b[0] < 20 or 100 * b[4] > 30 * b[0]
        want.append((r.doc_id, *b, failed, not failed))
    assert multiset((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in got) == multiset(want)


def test_keep_good_keeps_columns(spark, odd):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    got = keep_good(odd, labels)
    assert got.columns == odd.columns
    kept = multiset((r.doc_id, r.text) for r in odd.collect() if brute(r.text)[0] >= 20 and 100 * brute(r.text)[4] <= 30 * brute(r.text)[0])
    assert multiset((r.doc_id, r.text) for r in got.collect()) == kept


def test_empty(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert judge(empty, labels).count() == 0 and keep_good(empty, labels).count() == 0


def test_binomial_tail_is_exact():
    for n, p in ((10, 0.3), (57, 0.01)):
        for k in range(n + 1):
            want = sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
            assert pow(2.718281828459045, log_binomial_tail(k, n, p)) == pytest.approx(want, rel=1e-9)


def test_fixed_sequence_stops_at_the_first_failure():
    assert certified([0, 0, 50, 0], 1000, 0.01, 0.01) == 2
    assert certified([0], 10, 0.01, 0.01) == 0


def test_thresholds_find_bad_and_keep_good(spark):
    """Good documents have a symbol ratio of 0 (one in a thousand 0.3), bad ones of 0.5 to 3."""
    rows = [("en", 1, 100, 500, 30 if i % 1000 == 0 else 0, 0, 0, 10, 1, 0) for i in range(5000)]
    rows += [("en", 0, 100, 500, 50 + i % 250, 0, 0, 10, 1, 0) for i in range(500)]
    rows += [("xx", 1, 100, 500, 0, 0, 0, 10, 1, 0)] * 20 + [("xx", 0, 100, 500, 99, 0, 0, 10, 1, 0)] * 20
    frame = spark.createDataFrame(rows, "stratum string, quality int, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_upper long, n_marked long")
    chosen = choose_thresholds(frame, RULES, 0.05, 0.05)
    assert [(t.stratum, t.rule) for t in chosen] == [("en", "symbols")] and chosen[0].cutoff < 0.5 and chosen[0].rejected <= 5
    many = choose_thresholds(frame, RULES, 0.05, 0.05, most_strata=1)
    assert [tuple(r) for r in many.collect()] == [(t.stratum, t.rule, t.cutoff, t.good, t.rejected, t.log_p) for t in chosen]


def test_many_strata_are_judged_alike(spark, monkeypatch):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    rows, labels = [], []
    for i in range(2400):
        good = i % 4 > 0
        words = [word() for _ in range(30)] + ([] if good else ["###"] * 12)
        rows.append((i, " ".join(words), "abcdef"[i % 6] if i % 5 else None))
        labels.append((i, int(good)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    few = multiset(map(tuple, judge(docs, known, risk=0.3).collect()))
    kept = multiset(map(tuple, keep_good(docs, known, risk=0.3).collect()))
    assert any("symbols" in r for r in few) and len(kept) < len(rows)
    monkeypatch.setattr(quality, "MOST_STRATA", 2)
    assert multiset(map(tuple, judge(docs, known, risk=0.3).select(*judge(docs, known).columns).collect())) == few
    assert multiset(map(tuple, keep_good(docs, known, risk=0.3).collect())) == kept


def test_the_bound_holds_on_average(spark):
    """With true false-rejection rates just above the risk, a cutoff is certified at most as often as `error` says."""
    rng = random.Random(1)
    wrong = sum(certified([sum(rng.random() < 0.03 for _ in range(400))], 400, 0.03, 0.05) for _ in range(400))
    assert wrong / 400 <= 0.08


def test_paths_tighten_what_is_worth_it():
    """Cutoff 1 of the first rule catches ten for nothing, cutoff 3 of the second 21 for four; no others are worth it."""
    good, bad = [[0, 0, 1, 5], [0, 3, 4, 4]], [[5, 10, 12, 30], [0, 1, 20, 21]]
    assert quality.tuned_path(good, bad) == [(0, 1), (1, 3)]
    assert quality.tuned_path([[0, 0]], [[0, 0]]) == [] and quality.tuned_path([], []) == []


def test_the_bound_holds_for_all_rules_together():
    """Good documents have two uniform measures, so cutoffs a and b reject 1 - ab of them; bad ones lie higher.  However
    the tuning half bends the path, at most `error` of the runs certify cutoffs that reject more than the risk."""
    rng = np.random.default_rng(5)
    cutoffs, risk, error, runs, wrong, used = np.linspace(0.995, 0.8, 14), 0.05, 0.1, 300, 0, 0
    for _ in range(runs):
        good, bad, held = rng.random((300, 2)), rng.random((300, 2)) ** 0.12, rng.random((300, 2))
        counts = [[[int((x[:, r] > c).sum()) for c in cutoffs] for r in range(2)] for x in (good, bad)]
        path = quality.tuned_path(*counts)
        at, rejected, limits = [1.0, 1.0], [], []
        for r, i in path:
            at[r] = cutoffs[i]
            limits.append(1 - at[0] * at[1])
            rejected.append(int(((held[:, 0] > at[0]) | (held[:, 1] > at[1])).sum()))
        passed = certified(rejected, 300, risk, error)
        used += passed > 0
        wrong += passed > 0 and limits[passed - 1] > risk
    assert used > runs / 2 and wrong / runs <= error + 0.03


def test_small_strata_certify_nothing_and_larger_ones_do(spark):
    """With a risk of 5 % and two strata some 72 good documents of the holdout half are enough, 40 are not."""
    rows = [(s, 1, 100, 500, 0, 0, 0, 10, 1, 0) for s, n in (("a", 240), ("b", 60)) for _ in range(n)]
    rows += [(s, 0, 100, 500, 90, 0, 0, 10, 1, 0) for s in "ab" for _ in range(40)]
    frame = spark.createDataFrame(rows, "stratum string, quality int, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_upper long, n_marked long")
    assert [(t.stratum, t.rule) for t in choose_thresholds(frame.coalesce(1))] == [("a", "symbols")]


def brute_measures(text):
    """The rules' measures, by plain Python."""
    text = text or ""
    n, chars, symbols, dup, repeats = brute(text)
    lines = sum(1 for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line))
    upper, marked = len(re.findall("[A-Z]", text)), len(re.findall("[!?]", text))
    return {"symbols": symbols / max(n, 1), "dup_lines": dup / max(lines, 1), "repeats": repeats / max(n, 1), "upper": upper / max(chars, 1), "marked": marked / max(n, 1), "long_words": chars / max(n, 1)}


def test_learnt_verdicts_on_real_documents(spark, monkeypatch):
    """At this size the English documents certify cutoffs: the verdicts follow from these, catch most of the bad documents
    that the base rules leave, and hardly a good one."""
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    chosen = []
    plain = quality.choose_thresholds
    monkeypatch.setattr(quality, "choose_thresholds", lambda *a, **k: chosen.extend(found := plain(*a, **k)) or found)
    got = {r.doc_id: r for r in judge(docs, labels).collect()}
    assert chosen and {t.stratum for t in chosen} <= {"en", "de", "es", "fr"}
    known = {r.doc_id: r.quality for r in labels.collect()}
    caught = {0: [0, 0], 1: [0, 0]}
    for r in docs.collect():
        measures = brute_measures(r.text)
        broken = [t.rule for t in chosen if t.stratum == r.lang and measures[t.rule] > t.cutoff]
        found = got[r.doc_id]
        assert sorted(found.broken) == sorted(broken) and found.kept == (not found.base_failed and not broken), r.doc_id
        if not found.base_failed and known.get(r.doc_id) in caught and r.lang == "en":
            caught[known[r.doc_id]][0] += bool(broken)
            caught[known[r.doc_id]][1] += 1
    assert caught[0][0] > caught[0][1] / 2 and caught[1][0] <= caught[1][1] * 0.05
