"""The operators on the given tables: one query per operator, with its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from parcelsight.llm import bpe, counts, exact, forest, langid, lm, manifest, mixing, near, phrases, search, secrets, urls
from parcelsight.llm.common import read


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.chosen(read(spark, sf_dir, "documents"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source is the owner; its repositories are its languages."""
    docs = read(spark, sf_dir, "documents")
    found = secrets.scan(docs, F.col("source"), F.concat_ws("/", "source", "lang"))
    found = found.withColumn("spans", secrets.joined())
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_live", "n_example")


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scored(read(spark, sf_dir, "documents"))


def op4_phrase_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.with_next(read(spark, sf_dir, "documents"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = langid.predict(docs.select("doc_id", "text"), langid.train(docs))
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


#: The rules of the contract (host, path, verdict); fixed values.
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = urls.judged(read(spark, sf_dir, "pages").select("page_id", "url"), urls.rules_of(spark, URL_RULES))
    return found.select("page_id", "host", "path", "rule", "verdict")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(read(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = counts.token_counts(read(spark, sf_dir, "documents"))
    return found.withColumn("over_limit", F.col("n_tokens") > counts.LIMIT)


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.classes(read(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size", "kept")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact.decisions(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op11_embedding_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.linked(read(spark, sf_dir, "embeddings"))


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(read(spark, sf_dir, "documents"), manifest.tampered())


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.ranked(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_secrets": op2_secrets,
    "op3_lm_score": op3_lm_score,
    "op4_phrase_fingerprint": op4_phrase_fingerprint,
    "op5_language": op5_language,
    "op6_url_filter": op6_url_filter,
    "op7_bpe": op7_bpe,
    "op8_token_counts": op8_token_counts,
    "op9_near_dedup": op9_near_dedup,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_embedding_forest": op11_embedding_forest,
    "op12_manifest": op12_manifest,
    "op13_search": op13_search,
}

ORACLE: dict[str, str] = {
    "op1_mixing": mixing.sql(),
    "op6_url_filter": r"""
with parts as (
  select page_id,
         coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') as path
  from pages
), found as (
  select *, '.' || host as dotted from parts
), ruled as (
  select page_id, host, path,
         case when ends_with(dotted, '.example.net') and starts_with(path, '/en/') then 'example.net/en/'
              when ends_with(dotted, '.example.com') and starts_with(path, '/de/') then 'example.com/de/'
              when ends_with(dotted, '.org') and starts_with(path, '/fr/') then 'org/fr/'
              when ends_with(dotted, '.net') and starts_with(path, '/') then 'net/' end as rule
  from found
)
select page_id, host, path, rule,
       case when rule in ('net/', 'example.com/de/') then 'block' else 'allow' end as verdict
from ruled
""",
    "op10_exact_dedup": r"""
with keyed as (
  select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as body
  from documents
)
select doc_id,
       min(doc_id) over same as keep_id,
       count(*) over same as group_size,
       row_number() over (partition by body order by doc_id) = 1 as kept,
       sha256(body) as text_sha256
from keyed
window same as (partition by body)
""",
    "op11_embedding_forest": forest.sql(),
    "op12_manifest": manifest.sql(),
    "op13_search": search.sql(),
}
