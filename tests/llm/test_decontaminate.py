import random
import re
from collections import Counter

import numpy as np
import pytest

from lodestack.llm.decontaminate import Settings, _masks, common_subsequence, contaminated


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        diagonal = 0
        for j, y in enumerate(b):
            above = row[j + 1]
            row[j + 1] = diagonal + 1 if x == y else max(above, row[j])
            diagonal = above
    return row[-1]


def test_bit_parallel_subsequence():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ([rng.randint(0, 5) for _ in range(rng.randint(1, 90))] for _ in range(2))
        assert common_subsequence(_masks(np.array(a)), len(a), np.array(b)) == lcs(a, b)


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(9)
    vocabulary = [f"{a}{b}{c}" for a in ("th", "er", "on", "re") for b in ("an", "ti", "és", "ou", "in") for c in ("d", "st", "al", "é", "ing", "x")]
    common = ["the", "of", "and", "to", "a", "in"]

    def prose(n):
        return [rng.choice(common) if rng.random() < 0.4 else rng.choice(vocabulary) + str(rng.randrange(40)) for _ in range(n)]

    items = [prose(rng.randint(15, 60)) for _ in range(30)]
    docs, truth = [], set()
    for d in range(400):
        body = prose(rng.randint(0, 600))
        if d % 4 == 0:
            i = rng.randrange(30)
            passage = list(items[i])
            if d % 8 == 0:  # a paraphrase: every seventh word another, some left out or put in
                passage = [rng.choice(vocabulary) if k % 7 == 3 else w for k, w in enumerate(passage) if k % 11 != 5]
                passage.insert(4, "really")
            at = rng.randint(0, len(body))
            body[at:at] = [w.upper() for w in passage] if d % 12 == 0 else passage
            truth.add((d, i))
        docs.append((d, " ".join(body)))
    documents = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    return documents, spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string"), truth


def test_planted_passages(planted):
    documents, benchmark, truth = planted
    got = {(r.doc_id, r.item_id) for r in contaminated(documents, benchmark).collect()}
    assert truth <= got and len(got - truth) == 0


def test_answers_are_checked(spark, planted):
    """A document with the question but not its end is no leak."""
    _, benchmark, _ = planted
    item = benchmark.where("item_id = 3").first().text.split()
    cut = item[: int(len(item) * 0.68)]
    docs = spark.createDataFrame([(1, " ".join(cut + ["zz"] * 80)), (2, " ".join(item))], "doc_id long, text string")
    assert [r.doc_id for r in contaminated(docs, benchmark, settings=Settings(overlap=0.5)).where("item_id = 3").collect()] == [2]


def plain_words(text):
    return re.findall(r"(?:[0-9a-z]|[^\x00-\x7f])+", (text or "").lower())


def test_real_documents(spark, folder, documents):
    """Exactly the pairs that a window of the document passes the checks for: all of those of windows of twice the item's
    length, and none that no window of the widest kind that is looked at passes."""
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    got = {(r.doc_id, r.item_id) for r in contaminated(documents, benchmark).collect()}
    items = {r.item_id: plain_words(r.text) for r in benchmark.collect()}
    numbers = {w: k for k, w in enumerate(sorted({w for ws in items.values() for w in ws}), 1)}
    items = {i: [numbers[w] for w in ws] for i, ws in items.items()}
    masks = {i: _masks(np.array(ws)) for i, ws in items.items()}
    least, most = set(), set()
    for d in documents.collect():
        words = [numbers.get(w, 0) for w in plain_words(d.text)]
        for i, item in items.items():
            shared = sum((Counter(words) & Counter(item)).values())
            if shared / len(item) >= 0.6 and common_subsequence(masks[i], len(item), np.array(words)) / len(item) >= 0.6:
                if accepted(item, words, 2 * len(item)):
                    least.add((d.doc_id, i))
                if accepted(item, words, 4 * len(item) + 100):
                    most.add((d.doc_id, i))
    assert least and least <= got <= most
    exact = {(d.doc_id, i) for d in documents.collect() for i, t in [(r.item_id, " ".join(r.text.lower().split())) for r in benchmark.collect()] if t in " ".join((d.text or "").lower().split())}
    assert exact <= got and len(got - exact) <= len(got) / 20


def test_very_long_items(spark):
    """Items of more words than the largest passage of the search."""
    rng = random.Random(12)
    word = lambda: f"{rng.choice(['ka', 'lo', 'mi', 'ne'])}{rng.randrange(900)}"
    items = [[word() for _ in range(n)] for n in (513, 700, 1500)]
    docs, truth = [], set()
    for k in range(24):
        i, every = k % 3, (0, 9, 4, 2)[k // 3 % 4]
        copy = [f"other{rng.randrange(999)}" if every and j % every == 0 else w for j, w in enumerate(items[i])]
        docs.append((k, " ".join([word() for _ in range(rng.randrange(400))] + copy + [word() for _ in range(rng.randrange(400))])))
        if every != 2:  # half of the words are too few
            truth.add((k, i))
    docs.append((99, " ".join(items[2][:800])))
    got = contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == truth


def test_odd_rows(spark, odd, empty):
    text = odd.where("doc_id = 9").first().text
    benchmark = spark.createDataFrame([(1, text), (1, text), (2, None), (3, ""), (4, "..."), (None, "word")], "item_id long, text string")
    got = contaminated(odd, benchmark).collect()
    assert sorted(r.doc_id for r in got if r.item_id == 1) == [9, 9, 30, 30]
    assert contaminated(empty, benchmark).count() == 0
    assert contaminated(odd, benchmark.where("item_id = 2")).count() == 0
    assert contaminated(odd, spark.createDataFrame([], "item_id long, text string")).count() == 0


def search(words_of, space, docs, df=None):
    """Pairs (document, item) that the search finds with a given space; words are places, documents lists of them."""
    import pyarrow as pa

    from lodestack.llm import decontaminate as d

    df = np.ones(len(space)) if df is None else df
    run = d._search(np.uint32, [np.array(w, np.int32) for w in words_of], space, df, Settings())
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(docs))), pa.array(range(len(docs))), pa.array([np.array(w, np.uint32).tobytes() for w in docs], pa.binary())], ["row", "key", "words"])
    return {(r["row"], r["item"]) for out in run(iter([batch])) for r in out.to_pylist()}


@pytest.mark.parametrize(("length", "weighted"), [(40, 4), (56, 4), (59, 6)])
def test_all_windows_of_a_run_are_checked(length, weighted):
    """Only the first words of the item weigh, so that all windows that hold them are as similar."""
    rng = np.random.default_rng(length)
    space = np.zeros((length + 1, 8), np.float32)
    space[1 : weighted + 1] = rng.standard_normal((weighted, 8))
    item = list(range(1, length + 1))
    docs = [[0] * int(rng.integers(60, 200)) + item + [0] * int(rng.integers(60, 200)) for _ in range(200)]
    assert search([item], space, docs) == {(k, 0) for k in range(200)}


def accepted(item, words, width):
    """Whether a window of so many words passes the overlap and answer checks."""
    tail = min(len(item), max(3, int(np.ceil(0.3 * len(item)))))
    whole, answer = _masks(np.array(item)), _masks(np.array(item[-tail:]))
    parts = (np.array(words[k : k + width]) for k in range(max(1, len(words) - width + 1)))
    return any(common_subsequence(whole, len(item), p) / len(item) >= 0.6 and common_subsequence(answer, tail, p) / tail >= 0.5 for p in parts)


def altered_copies(rng, size, items, every):
    """Documents of random words, each with a copy of an item in which every so-manieth word is another."""
    docs = []
    for k in range(300):
        item = list(items[k % len(items)])
        item[::every] = rng.integers(1, size, len(item[::every])).tolist()
        before, after = (rng.integers(1, size, int(rng.integers(0, 80))).tolist() for _ in range(2))
        docs.append(before + item + after)
    return docs


@pytest.mark.parametrize("every", [3, 5, 100])
def test_search_equals_brute_force(every):
    """Words of very different weights in a random space: whatever their cosine, all passages that pass are found."""
    rng = np.random.default_rng(every)
    size = 600
    df = 1 + 3000 / np.arange(1, size + 1)
    space = (rng.standard_normal((size, 96)) * rng.exponential(size=(size, 1))).astype(np.float32)
    space[0] = space[1:20] = 0
    items = [rng.choice(np.arange(1, size), n, p=df[1:] / df[1:].sum()).tolist() for n in rng.integers(9, 60, 30)]
    docs = altered_copies(rng, size, items, every)
    got = search(items, space, docs, df)
    want = {(k, k % 30) for k, words in enumerate(docs) if accepted(items[k % 30], words, 2 * len(items[k % 30]))}
    assert len(want) > 250 and want <= got
    for k, i in got - want:  # surroundings may be somewhat wider
        assert accepted(items[i], docs[k], 4 * len(items[i]) + 40)


def test_hot_copies_decide_nothing(spark):
    """Copies of one document hold most words of all items, which so weigh nothing; the few other words are replaced."""
    rng = random.Random(3)
    items = [[f"w{i}x{k}" for k in range(34)] for i in range(20)]
    hot = [w for item in items for w in item[2:]]
    rng.shuffle(hot)
    docs = [(1000 + k, " ".join(hot)) for k in range(80)]
    docs += [(2000 + i, " ".join(item[:2])) for i, item in enumerate(items)]
    for k in range(60):
        passage = [f"other{j}" if j < 2 or j % 3 == 0 else w for j, w in enumerate(items[k % 20])]
        docs.append((k, " ".join(f"p{rng.randrange(500)}" for _ in range(rng.randrange(90))) + " " + " ".join([*passage, "end", "of", "it"])))
    documents = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in contaminated(documents, benchmark).where("doc_id < 1000").collect()}
    assert got == {(k, k % 20) for k in range(60)}


@pytest.mark.parametrize("bound", [("MOST_ITEMS", 7), ("MOST_VOCABULARY", 150)])
def test_large_benchmarks_are_worked_off_in_blocks(planted, monkeypatch, bound):
    from lodestack.llm import decontaminate as d

    documents, benchmark, truth = planted
    monkeypatch.setattr(d, *bound)
    blocks = list(d.Items.blocks(benchmark, "text", "item_id"))
    assert len(blocks) > 2 and sorted(i for b in blocks for i in b.ids) == list(range(30))
    chosen = benchmark.where("item_id < 18")
    got = [(r.doc_id, r.item_id) for r in contaminated(documents, chosen).collect()]
    assert sorted(got) == sorted((k, i) for k, i in truth if i < 18)
