"""A corpus pipeline: quality rules, near-duplicates, benchmark passages, personal data, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestack.llm.decontaminate import contaminated
from lodestack.llm.near_dedup import near_duplicates
from lodestack.llm.pii import find, redact
from lodestack.llm.quality import keep_good
from lodestack.llm.registry import table, tokenizer_path
from lodestack.llm.sentencepiece_codec import encode_decode
from lodestack.llm.store import BATCHES, delete, fresh_path, give_back, small_side

#: Several stages decide by rules that are learnt, or hash, so SQL can't express them; tests hold them against brute force.
ORACLE_SQL = None


#: Runs that a worker of the last stage remembers: fewer than `encode_decode` has by itself, as executors keep some of
#: what earlier stages have touched.
REMEMBERED = 100_000


def _prepared(spark: SparkSession) -> None:
    """Small batches for the job that writes what a stage returns.  They stay set for a caller of single stages, as that
    job is the caller's; `run` puts the session's own settings back.  Executors start with what they need, not with the
    heap that the stage before has left."""
    for k, v in BATCHES.items():
        spark.conf.set(k, v)
    give_back(spark)


def _finished(frame: DataFrame) -> DataFrame:
    """What a stage returns, after jobs of its own: the heap that these have left goes before the caller's job."""
    give_back(frame.sparkSession)
    return frame


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the certified cutoffs of their language.

    Null and empty texts fail the base rules and go; repeated rows are judged apart; a table without rows stays so.
    """
    _prepared(spark)
    return _finished(keep_good(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id.

    Rows of one id are one document: they stay or go together.  Rows without an id, and texts without words, stay.
    """
    _prepared(spark)
    gone = small_side(near_duplicates(docs).where("not kept").select("doc_id"), "gone")
    return _finished(docs.join(gone, "doc_id", "left_anti").select(docs.columns))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark.

    Rows are told by id and text, so rows of one id, or without one, are judged apart; null and empty texts stay.
    """
    _prepared(spark)
    keyed = docs.select(F.struct("doc_id", F.xxhash64("text").alias("mark")).alias("row"), "text")
    found = contaminated(keyed, table(spark, sf_dir, "benchmark"), key="row").select("row.doc_id", "row.mark").distinct()
    gone = small_side(found.toDF("__doc_id", "__mark"), "gone")
    same = docs.doc_id.eqNullSafe(gone["__doc_id"]) & (F.xxhash64(docs.text) == gone["__mark"])
    return _finished(docs.join(gone, same, "left_anti").select(docs.columns))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; n_chars follows the text, and stays where that is null."""
    _prepared(spark)
    return _finished(redact(docs, find(docs)).withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of what they decode to, for each row; null texts have no ids."""
    _prepared(spark)
    return encode_decode(docs, tokenizer_path("piece_bpe_32k.model"), remembered=REMEMBERED, forget=True, at_once=1 << 20)


STAGES = [("quality rules", quality), ("near-dedup", near_dedup), ("decontamination", decontaminate), ("PII", personal_data), ("SentencePiece", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to `documents`; each one's rows are written to the shared folder and read again.

    What a stage has read is deleted once its own rows are written, and the session's settings are as before.
    """
    docs = table(spark, sf_dir, "documents")
    folder = fresh_path(spark, "pipeline")
    before = {k: spark.conf.get(k) for k in BATCHES}
    try:
        for k, (_, stage) in enumerate(STAGES):
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
            if k:
                delete(spark, f"{folder}/{k - 1}")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    return docs
