import random
import re
from itertools import combinations

import numpy as np
import pytest

from lodestack.llm import near_dedup
from lodestack.llm import textvec as tv
from lodestack.llm.components import connected_components
from lodestack.llm.near_dedup import near_duplicates, superminhash

from .conftest import multiset


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """(doc_id, n_shingles, component_id, kept) with rows of one id as one document."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, x), (b, y) in combinations([s for s in sets if s[0] is not None and s[1]], 2):
        both = len(x & y)
        if 100 * both >= 85 * (len(x) + len(y) - both):
            p, q = find(a), find(b)
            parent[max(p, q)] = min(p, q)
    return [(i, len(s), None if i is None else find(i) if s else i, True if i is None else (find(i) if s else i) == i) for i, s in sets]


def check(frame):
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    assert multiset(tuple(r) for r in near_duplicates(frame).collect()) == multiset(brute(rows))


def test_odd_rows(odd):
    check(odd)


def test_documents(documents):
    check(documents)


def test_empty(empty):
    assert near_duplicates(empty).count() == 0


@pytest.mark.parametrize("base", [True, False])
def test_group_of_edited_copies(spark, base):
    """Copies of one text with one to eight words changed; without the base the links are among the copies."""
    rng = random.Random(3)
    text = [f"w{rng.randrange(10**6)}" for _ in range(150)]
    rows = [(0, " ".join(text))] if base else []
    for i in range(1, 250):
        copy = list(text)
        for _ in range(rng.randint(1, 8)):
            copy[rng.randrange(150)] = f"e{rng.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    shared = [f"e{k}" for k in range(3)]
    for i in range(250, 300):  # edits in common: linked with each other, far from the base
        copy = list(text)
        for k in range(6):
            copy[10 + 20 * k] = shared[0] + str(k)
        if i % 2:
            copy[149] = f"z{i}"
        rows.append((i, " ".join(copy)))
    check(spark.createDataFrame(rows, "doc_id long, text string"))


def test_threshold_is_exact(spark):
    """Sets of 37 shingles with 34 and 33 in common: 34/40 is a link, 33/41 is none."""
    words = [f"a{k}" for k in range(41)]
    rows = [(1, " ".join(words)), (2, " ".join([*words[3:], "x1", "x2", "x3"])), (3, " ".join([f"y{k}" for k in range(41)])), (4, " ".join([*(f"y{k}" for k in range(4, 41)), "q1", "q2", "q3", "q4"]))]
    check(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.component_id for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == {1: 1, 2: 1, 3: 3, 4: 4}


def test_superminhash_estimates_similarity():
    rng = np.random.default_rng(1)
    for share in (0.2, 0.5, 0.85):
        errors = []
        for _ in range(40):
            a = rng.integers(1, 1 << 63, 400, dtype=np.uint64)
            cut = int(400 * 2 * share / (1 + share))
            b = np.concatenate([a[:cut], rng.integers(1, 1 << 63, 400 - cut, dtype=np.uint64)])
            s = superminhash(np.concatenate([a, b]), np.array([0, 400, 800]), 100)
            errors.append((s[0] == s[1]).mean() - cut / (800 - cut))
        assert abs(np.mean(errors)) < 0.03 and np.std(errors) < np.sqrt(share * (1 - share) / 100) * 1.2


def test_superminhash_of_small_sets():
    s = superminhash(np.array([7, 7, 9], np.uint64), np.array([0, 1, 3, 3]), 16)
    assert (s[2] == np.iinfo(np.uint64).max).all() and (s[0] < np.iinfo(np.uint64).max).all()
    again = superminhash(np.array([7], np.uint64), np.array([0, 1]), 16)
    assert (s[0] == again[0]).all()


def test_word_hashes_depend_on_the_bytes_alone():
    data = np.frombuffer(b"abc ABC x abc" + b" y" * 200_000 + b" abc", np.uint8)
    starts, ends, first = tv.words(data, np.array([0, len(data)]))
    h = tv.hashes(data, starts, ends)
    assert h[0] == h[1] == h[3] == h[-1] != h[2] and first.tolist() == [0, len(h)]
    assert tv.hashes(data, starts, ends, lower=False)[0] != tv.hashes(data, starts, ends, lower=False)[1]


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(150)] + [(k, k + 1) for k in range(400, 460)] + [(500, k) for k in range(501, 900)] + [(7, 7), (None, 3)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            p, q = find(a), find(b)
            parent[max(p, q)] = min(p, q)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long").repartition(5)).collect()}
    assert got == {x: find(x) for x in list(parent)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def template_pages(count=160, blocks=14, chosen=11, words=40):
    """Pages that share most blocks of one template, no two of them similar enough by chance alone."""
    rng = random.Random(11)
    text = [" ".join(f"b{k}w{rng.randrange(10**6)}" for _ in range(words)) for k in range(blocks)]
    return [(i, " ".join([*(text[k] for k in sorted(rng.sample(range(blocks), chosen))), f"page {i} of its own"])) for i in range(count)]


def test_pages_of_a_template_do_not_meet_in_pairs(spark, monkeypatch):
    pages = template_pages()
    counts = []
    plain = near_dedup.materialise

    def counted(frame, name):
        out = plain(frame, name)
        if name == "pairs":
            counts.append(out.count())
        return out

    monkeypatch.setattr(near_dedup, "materialise", counted)
    got = [tuple(r) for r in near_duplicates(spark.createDataFrame(pages, "doc_id long, text string")).collect()]
    assert multiset(got) == multiset(brute(pages))
    assert len(counts) == 2  # those tried with a head of their bucket, and those that the filters leave
    assert counts[1] < len(pages) * (len(pages) - 1) / 2 / 20


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(2)
    some = rng.integers(1, 1 << 62, 900, dtype=np.uint64)
    for k in (0, 1, 40, 300, 800):
        a, b = np.sort(some[k:]), np.sort(some[: len(some) - k // 2])
        x, y = near_dedup.parities(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        apart = int(np.bitwise_count(x ^ y).sum())
        assert apart <= k + k // 2 and (apart > 0) == (k > 0)
