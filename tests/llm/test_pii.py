import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lodestack.llm import pii

from .conftest import multiset

PATTERNS = (
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def brute(text):
    out = []
    for k, pattern in enumerate(PATTERNS):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if k == 1 and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if k == 2 and not (12 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if k == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


@settings(max_examples=1500, deadline=None)
@given(st.text(st.sampled_from(list("ab.@-+ 0123459()%_é\n,:")), max_size=60))
def test_base_spans_equal_the_patterns(text):
    assert pii.base_spans(text) == brute(text)


def test_known_entities():
    text = "é me@x.co, 4111 1111 1111 1111 and 1.2.3.4.5.6.7.8 or 256.1.1.1 call +1 (017) 555-7713."
    assert [(k, text[a:b]) for a, k, b in pii.base_spans(text)] == [(0, "me@x.co"), (2, "4111 1111 1111 1111"), (1, "1.2.3.4"), (1, "5.6.7.8"), (3, "+1 (017) 555-7713")]


def test_long_runs_are_linear():
    for text in ("a" * 300_000 + "@", "1" * 300_000, "1." * 150_000, "+1" * 150_000, "@a" * 100_000, "a@" + "b" * 300_000, "+1" + " 2" * 100_000 + "x"):
        pii.base_spans(text)
        pii.shaped(text, [])


@pytest.mark.parametrize("table", ["odd", "documents"])
def test_find(request, table):
    frame = request.getfixturevalue(table)
    want = []
    for r in frame.collect():
        spans = brute(r.text or "")
        counts = [sum(k == i for _, k, _ in spans) for i in range(4)]
        want.append((r.doc_id, *counts, hashlib.sha256(pii.joined(spans).encode()).hexdigest()))
    got = pii.find(frame).collect()
    assert multiset((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got) == multiset(want)
    texts = {(r.doc_id, r.text) for r in frame.collect()}
    for r in got:
        shown = [x for x in r.spans.split(",") if x]
        assert shown == sorted(shown, key=lambda x: (int(x.split(":")[1]), pii.KINDS.index(x.split(":")[0])))
        assert len(shown) == len(r.spans_list)
        for kind, a, b in (x.split(":") for x in shown if x.startswith("secret")):
            assert kind == "secret" and any(re.fullmatch("[0-9a-f]{32,64}", (t or "")[int(a) : int(b)]) for i, t in texts if i == r.doc_id)


def test_empty(empty):
    assert pii.find(empty).count() == 0


def planted(spark, share_bad=0.0):
    """Member numbers, which no base pattern takes, stand where phones do: after `reach me at`."""
    rng = random.Random(4)
    rows, hidden = [], {}
    for i in range(120):
        filler = " ".join(rng.choice(["some", "other", "word", "here"]) for _ in range(20))
        number = f"+1 (0{rng.randrange(10, 99)}) 555-{rng.randrange(1000, 9999)}"
        rows.append((i, f"{filler} reach me at {number} {filler} version 2.{i}.17b {filler}"))
    for i in range(120, 140):
        ident = f"ZX-{rng.randrange(10**6, 10**7)}q"
        bad = rng.random() < share_bad
        text = f"{'before we reach me at' if not bad else 'order'} {ident} thanks"
        rows.append((i, text))
        if not bad:
            hidden[i] = (text.index(ident), text.index(ident) + len(ident))
    rows.append((999, "build id ZX-1234567q is clean"))
    return spark.createDataFrame(rows, "doc_id long, text string"), hidden


def test_contexts_discover_unseen_identifiers(spark):
    frame, hidden = planted(spark)
    got = {r.doc_id: [tuple(x) for x in r.spans_list] for r in pii.find(frame).collect()}
    for i, (a, b) in hidden.items():
        assert (a, 3, b) in got[i], i
    assert got[999] == []
    assert all(len(got[i]) == 1 for i in range(120))  # versions in the same texts are left alone


def test_a_weak_context_discovers_nothing(spark):
    rows = [(i, f"code +1 (017) 555-{1000 + i} x") for i in range(20)] + [(100 + i, f"code AB{i:06d}z x") for i in range(20)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert all(not r.spans_list for r in pii.find(frame).where("doc_id >= 100").collect())


def test_redact(spark, odd):
    rows = [(1, "mail é me@x.co now", "a"), (2, None, "b"), (3, "", "c"), (4, "clean", None), (5, "key = deadbeefdeadbeefdeadbeefdeadbee0 +1 (017) 555-7713", "d")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, spans_list string")
    frame = frame.union(frame.where("doc_id = 1")).union(spark.createDataFrame([(1, "x@y.zz", "e"), (None, "q x@y.zz", "f")], frame.schema))
    got = sorted(map(tuple, pii.redact(frame, pii.find(frame)).collect()), key=str)
    assert got == [(1, "<EMAIL>", "e"), (1, "mail é <EMAIL> now", "a"), (1, "mail é <EMAIL> now", "a"), (2, None, "b"), (3, "", "c"), (4, "clean", None), (5, "key = <SECRET> <PHONE>", "d"), (None, "q <EMAIL>", "f")]


@pytest.mark.parametrize("between", ["..", "/", "=", "@", "_x:", "+"])
def test_all_keys_of_a_token(spark, between):
    one, two = "0a" * 20, "b1" * 16
    text = f"diff {one}{between}{two} end"
    assert [text[a:b] for a, k, b in pii.shaped(text, []) if k == 4] == [one, two]
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert pii.redact(frame, pii.find(frame)).first().text == f"diff <SECRET>{between}<SECRET> end"


def test_parts_beside_keys_are_candidates():
    text = f"user-4711x/{'0a' * 20}/{'b1' * 16}/ref2024z, 1.2.3.4/{'c2' * 16}"
    got = [(k, text[a:b]) for a, k, b in pii.shaped(text, pii.base_spans(text))]
    assert [v for k, v in got if k == 4] == ["0a" * 20, "b1" * 16, "c2" * 16]
    assert [v for k, v in got if k < 0] == ["user-4711x/", "/ref2024z"]


def test_contexts_discover_spaced_groups(spark):
    rng = random.Random(8)
    rows = [(i, f"some words reach me at +1 (0{rng.randrange(10, 99)}) 555-{1000 + i} and more") for i in range(60)]
    hidden = ["123 45 6789", "DE89 3704 0044 0532 0130 00", "GB29 NWBK 6016 1331 9268 19", "ZX-1234567q"]
    rows += [(100 + i, f"before we reach me at {v} thanks") for i, v in enumerate(hidden)]
    rows.append((999, "rooms 123 45 6789 are free"))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: [tuple(x) for x in r.spans_list] for r in pii.find(frame).where("doc_id >= 100").collect()}
    for i, v in enumerate(hidden):
        assert (len("before we reach me at "), 3, len("before we reach me at ") + len(v)) in got[100 + i], v
    assert got[999] == []


def test_spaced_groups_are_linear():
    for text in ("12 " * 100_000, "AB12 CD" * 50_000, "12 ABCDE " * 50_000, ("0a" * 16 + "/") * 5_000):
        pii.shaped(text, pii.base_spans(text))


UNSEEN = {
    "email": ("write to", lambda rng, i: f"p{i}.{rng.randrange(99)}@mail{i % 9}.example.org", ["bo.li [at] site (dot) org", "ANN(AT)Home.example", "x_y+z { at } a-b [dot] co [dot] uk"]),
    "ip": ("seen from host", lambda rng, i: ".".join(str(rng.randrange(256)) for _ in range(4)), ["fe80:0:0:12ab::7", "10-20-30-40", "2001:db8:85a3:0:0:8a2e:370:7334"]),
    "card": ("paid by card", lambda rng, i: with_check_digit(f"4{rng.randrange(10**14):014d}"), ["4111-1111-1111-1112", "4000 1234 5678 9011", "5500000000000005x"]),
    "phone": ("please call", lambda rng, i: f"+1 (0{rng.randrange(10, 99)}) 555-{1000 + i}", ["(017) 555-7713", "0175557713", "(0049) 30-1234 567"]),
}


def with_check_digit(body):
    return next(body + c for c in "0123456789" if pii.luhn(body + c))


def test_contexts_of_each_base_kind_discover_other_spellings(spark):
    """Found: all of 12 unseen identifiers; left alone: the same ones elsewhere, and numbers of the same texts."""
    rng = random.Random(6)
    rows, want = [], {}
    for context, seed, unseen in UNSEEN.values():
        for i in range(40):
            rows.append((len(rows), f"room {rng.randrange(10**5, 10**6)} is free so {context} {seed(rng, i)} until {rng.randrange(1990, 2030)}-05-17 or later"))
    for kind, (context, _, unseen) in UNSEEN.items():
        for v in unseen:
            text = f"now {context} {v} thanks"
            want[len(rows)] = {f"{kind}:{text.index(v)}:{text.index(v) + len(v)}"}
            rows.append((len(rows), text))
            rows.append((len(rows), f"the plain model {v} is out"))
    got = {r.doc_id: {x for x in r.spans.split(",") if x} for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, spans in want.items():
        assert spans <= got[i], (rows[i], got[i])
        assert all(x.split(":")[0] == next(iter(spans)).split(":")[0] for x in got[i])
    assert all(len(got[i]) == 1 for i in range(160))
    assert all(not got[i + 1] for i in want)


def brute_scores(mentions, rounds, support, confidence):
    """Patterns of high confidence, step by step over plain dictionaries."""
    edges = {}
    for value, kind, patterns in mentions:
        for p in patterns:
            edges[value, p] = max(kind, edges.get((value, p), -1))
    values_of = {}
    for (value, p), kind in edges.items():
        values_of.setdefault(p, {})[value] = kind
    values_of = {p: v for p, v in values_of.items() if len(v) >= support}
    seeds = {(v, k): 1.0 for vs in values_of.values() for v, k in vs.items() if k >= 0}
    scores, trusted = dict(seeds), {}
    for _ in range(rounds):
        trusted = {}
        for p, vs in values_of.items():
            for kind in {k for _, k in scores}:
                mass = sum(scores.get((v, kind), 0) for v in vs)
                if mass >= support and mass >= confidence * len(vs):
                    trusted[p, kind] = mass / len(vs)
        miss = {}
        for (p, kind), c in trusted.items():
            for v, k in values_of[p].items():
                if k < 0:
                    miss[v, kind] = miss.get((v, kind), 1.0) * max(1 - c, 1e-6)
        scores = {**seeds}
        for key, m in miss.items():
            scores[key] = scores.get(key, 0) + 1 - m
    return trusted


@pytest.mark.parametrize("seed", range(3))
def test_graph_scores_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    mentions = []
    for i in range(400):
        group = rng.randrange(4)
        kind = group if rng.random() < (0.95, 0.85, 0.5, 0.9)[group] else -1
        mentions.append((f"v{i % 350}", kind, [f"p{group}", f"q{rng.randrange(12)}", f"r{group}{rng.randrange(3)}"]))
    kinds = {}
    mentions = [(v, kinds.setdefault(v, k), p) for v, k, p in mentions]  # a value is of one kind
    got = pii.score(spark.createDataFrame(mentions, "value string, kind int, patterns array<string>"), 3, 8, 0.8)
    want = brute_scores(mentions, 3, 8, 0.8)
    assert {(r.pattern, r.kind): pytest.approx(r.confidence, rel=1e-9) for r in got.collect()} == want and want


def brute_spans(texts, rounds=3, support=8, confidence=0.8):
    """All spans of each text, with the graph of patterns and values in plain dictionaries."""
    found = [(t, pii.base_spans(t)) for t in texts]
    every = [[(s, k, e, t[s:e], pii.patterns(t, s, e)) for s, k, e in [*base, *pii.shaped(t, base)]] for t, base in found]
    trusted = brute_scores([(v, k, p) for m in every for _, k, _, v, p in m], rounds, support, confidence)
    out = []
    for mentions in every:
        spans = []
        for s, k, e, _, patterns in mentions:
            if k < 0:
                best = max(((c, -kind) for p in patterns for (q, kind), c in trusted.items() if q == p), default=None)
                if best is None:
                    continue
                k = -best[1]
            spans.append((s, k, e))
        out.append(pii.joined(sorted(spans)))
    return out


@pytest.mark.parametrize("table", ["documents", "odd", "contexts"])
def test_all_spans_against_brute_force(request, spark, table):
    if table == "contexts":
        rng = random.Random(3)
        rows = [(i, f"a key = {rng.randrange(16**40):040x} and reach me at +1 (0{rng.randrange(10, 99)}) 555-{1000 + i} ok") for i in range(30)]
        rows += [(100 + i, f"a key = {rng.randrange(10**9)}Z{i} and reach me at X{rng.randrange(10**7)}-{i} ok, code 12 34 {rng.randrange(100, 999)}") for i in range(10)]
        frame = spark.createDataFrame(rows, "doc_id long, text string")
    else:
        frame = request.getfixturevalue(table)
    rows = [(r.doc_id, r.text or "") for r in frame.collect()]
    want = multiset((i, s) for (i, _), s in zip(rows, brute_spans([t for _, t in rows]), strict=True))
    assert multiset((r.doc_id, r.spans) for r in pii.find(frame).collect()) == want
