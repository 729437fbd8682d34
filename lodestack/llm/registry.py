"""The registered queries of this subpackage, one for each operator, and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_sentencepiece")
def op1_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    from lodestack.llm.sentencepiece_codec import encode_decode

    return encode_decode(table(spark, folder, "documents"), tokenizer_path("piece_bpe_32k.model"))


@query("op4_near_dedup")
def op4_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from lodestack.llm.near_dedup import near_duplicates

    return near_duplicates(table(spark, folder, "documents"))


@query("op7_quality_rules")
def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    from lodestack.llm.quality import judge

    return judge(table(spark, folder, "documents"), table(spark, folder, "labels")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.array_join("broken", ",").alias("broken"))


@query("op10_pii")
def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    from lodestack.llm.pii import find

    return find(table(spark, folder, "documents")).drop("spans_list", "text_mark")


@query("op9_decontaminate")
def op9_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    from lodestack.llm.decontaminate import contaminated

    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op3_token_records")
def op3_token_records(spark: SparkSession, folder: str) -> DataFrame:
    from lodestack.llm.records import round_trip

    return round_trip(table(spark, folder, "documents"), tokenizer_path("word_bpe_49k.json"), end_id=1)


@query("op6_html_text")
def op6_html_text(spark: SparkSession, folder: str) -> DataFrame:
    from lodestack.llm.html_text import extract

    return extract(table(spark, folder, "pages"))


#: The rules of the contract.
URL_RULES = (("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/"))
#: Hosts that are blocked unless a rule says otherwise.
LISTED_HOSTS = tuple(f"{name}.example.{end}" for name in ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm") for end in ("com", "net", "org"))
_URL_SQL = f"""
with p as (
  select page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path from pages),
rules(verdict, rule) as (values {', '.join(f"('{v}', '{r}')" for v, r in URL_RULES)}),
listed(k) as (values {', '.join(f"('{h}')" for h in LISTED_HOSTS)}),
fit as (
  select p.host, p.path, max_by(rules.rule, length(rules.rule)) as rule from (select distinct host, path from p) p join rules
  on (p.host = split_part(rules.rule, '/', 1) or ends_with(p.host, '.' || split_part(rules.rule, '/', 1)))
  and starts_with(p.path, substr(rules.rule, strpos(rules.rule, '/'))) group by all),
hit as (
  select h.host, max_by(k, length(k)) as listed_key from (select distinct host from p) h join listed on h.host = k or ends_with(h.host, '.' || k) group by all)
select p.page_id, p.host, p.path, fit.rule, coalesce(rules.verdict, case when hit.listed_key is null then 'allow' else 'block' end) as verdict, hit.listed_key
from p left join fit on p.host = fit.host and p.path = fit.path left join rules on rules.rule = fit.rule left join hit on hit.host = p.host"""


@query("op2_url_filter", _URL_SQL)
def op2_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    from lodestack.llm.url_filter import Rule, host_list, judge

    return judge(table(spark, folder, "pages"), [Rule(*r) for r in URL_RULES], host_list(spark, LISTED_HOSTS))


@query("op5_warc_derivatives")
def op5_warc_derivatives(spark: SparkSession, folder: str) -> DataFrame:
    from lodestack.llm.warc import derivatives

    return derivatives(table(spark, folder, "pages"))


@query("op8_sharding", "select doc_id, lang, source, n_chars, md5(text) as text_md5, cast(octet_length(encode(text)) as bigint) as n_bytes from documents")
def op8_sharding(spark: SparkSession, folder: str) -> DataFrame:
    from lodestack.llm.shards import compacted
    from lodestack.llm.store import fresh_path

    store = compacted(table(spark, folder, "documents"), fresh_path(spark, "shards"), "doc_id", target=64 << 20)
    return store.read().select("doc_id", "lang", "source", "n_chars", F.md5(F.encode("text", "UTF-8")).alias("text_md5"), F.octet_length("text").cast("long").alias("n_bytes"))
