import duckdb
import pytest

import corpus_pipeline
from lodestack.llm import registry
from lodestack.llm.store import BATCHES, materialise, shared_root

from .conftest import multiset
from .test_near_dedup import brute as near
from .test_quality import brute as quality


def test_stages_against_brute_force(spark, folder, documents):
    """At this size no cutoff can be certified, so only the base rules reject."""
    docs = documents
    rows = {r.doc_id: r.text for r in docs.collect()}
    kept = {i: t for i, t in rows.items() if (q := quality(t))[0] >= 20 and 100 * q[4] <= 30 * q[0]}
    docs = materialise(corpus_pipeline.quality(spark, docs, folder), "stage")
    assert {r.doc_id: r.text for r in docs.collect()} == kept and docs.columns == documents.columns
    kept = {i: kept[i] for i, _, _, keep in near(kept.items()) if keep}
    docs = materialise(corpus_pipeline.near_dedup(spark, docs, folder), "stage")
    assert {r.doc_id: r.text for r in docs.collect()} == kept and docs.columns == documents.columns
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    leaks = {i for i, t in kept.items() if any(x in " ".join(t.lower().split()) for x in items)}
    docs = materialise(corpus_pipeline.decontaminate(spark, docs, folder), "stage")
    left = {r.doc_id: r.text for r in docs.collect()}
    assert not leaks & set(left) and set(left) == set(kept) - leaks and docs.columns == documents.columns
    clean = materialise(corpus_pipeline.personal_data(spark, docs, folder), "stage")
    assert clean.columns == documents.columns and clean.count() == len(left)
    changed = [r for r in clean.collect() if r.text != left[r.doc_id]]
    assert changed and all("<" in r.text and r.n_chars == len(r.text) for r in changed)
    out = corpus_pipeline.tokens(spark, clean, folder)
    assert out.count() == len(left) and set(out.columns) >= {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}


def test_stages_on_odd_rows(spark, folder, odd):
    """Null and repeated ids, null, empty and very long texts, and further columns with clashing names."""
    item = spark.read.parquet(f"{folder}/benchmark.parquet").first().text
    more = [(None, f"{item} and more words follow here", "en"), (8, f"see {item}", "en"), (None, "one two mail me@x.co", None), (8, None, None)]
    extra = spark.createDataFrame([r + ("s", 1, 1, 2, 3, "k", 4, "q", True, "z", 0) for r in more], odd.schema)
    docs = odd.unionByName(extra)
    rows = [(r.doc_id, r.text) for r in docs.collect()]

    def done(frame):
        out = materialise(frame, "stage")
        return out, multiset((r.doc_id, r.text) for r in out.collect())

    good = [(i, t) for i, t in rows if (q := quality(t))[0] >= 20 and 100 * q[4] <= 30 * q[0]]
    out, got = done(corpus_pipeline.quality(spark, docs, folder))
    assert got == multiset(good) and out.columns == docs.columns
    kept = {(i, k) for i, _, _, k in near(rows)}
    out, got = done(corpus_pipeline.near_dedup(spark, docs, folder))
    assert got == multiset((i, t) for i, t in rows if i is None or (i, True) in kept) and out.columns == docs.columns
    out, got = done(corpus_pipeline.decontaminate(spark, docs, folder))
    assert got == multiset((i, t) for i, t in rows if item not in (t or "")) and out.columns == docs.columns
    out, got = done(corpus_pipeline.personal_data(spark, docs, folder))
    assert out.columns == docs.columns and len(got) == len(rows)
    assert multiset([(None, "one two mail <EMAIL>")])[0] in got and sum(t is None for _, t in rows) == sum("None)" in g for g in got)
    assert corpus_pipeline.tokens(spark, docs, folder).count() == len(rows)


def test_stages_on_nothing(spark, folder, empty):
    before = {k: spark.conf.get(k) for k in BATCHES}
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, folder)
        assert out.count() == 0 and (stage is corpus_pipeline.tokens or out.columns == empty.columns)
    for k, v in before.items():
        spark.conf.set(k, v)


def test_run(spark, folder):
    before = {k: spark.conf.get(k) for k in BATCHES}
    out = corpus_pipeline.run(spark, folder)
    assert {k: spark.conf.get(k) for k in BATCHES} == before
    assert out.count() > 0 and len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("stage", [stage for _, stage in corpus_pipeline.STAGES])
def test_stages_give_heap_back(spark, folder, empty, stage):
    """Each stage collects garbage before its jobs, and again before the caller's, if it had any."""

    def full():
        beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
        return sum(b.getCollectionCount() for b in beans if "Old" in b.getName() or "MarkSweep" in b.getName())

    before, settings = full(), {k: spark.conf.get(k) for k in BATCHES}
    stage(spark, empty, folder)
    for k, v in settings.items():
        spark.conf.set(k, v)
    assert full() - before >= (1 if stage is corpus_pipeline.tokens else 2)


def test_shared_root(spark):
    assert shared_root(spark)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_registered(spark, folder, name):
    got = registry.QUERIES[name](spark, folder)
    rows = got.collect()
    if name in registry.ORACLES:
        duck = duckdb.connect()
        for t in ("documents", "pages"):
            duck.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
        want = duck.execute(registry.ORACLES[name])
        columns = [d[0] for d in want.description]
        assert sorted(columns) == sorted(got.columns)
        assert sorted(repr(tuple(r[c] for c in columns)) for r in rows) == sorted(map(repr, want.fetchall()))
    else:
        assert rows
    assert {f"op{n}" for n in range(1, 11)} == {n.split("_")[0] for n in registry.QUERIES}
