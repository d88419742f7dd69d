"""One query per corpus operator, applied to its whole table."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm import (
    ann,
    bpe,
    extraction,
    packing,
    periodicity,
    pii,
    quality,
    simhash,
    toxicity,
    url_filter,
    vector_dedup,
    warc,
    whitening,
)
from stratamart.llm.common import importable, table

Query = Callable[[SparkSession, str], DataFrame]


URL_RULES = [
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
]


def op1_main_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return extraction.main_text(pages, extraction.train(pages))


def op2_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode_digest(table(spark, folder, "documents"), public_tokenizers.path(bpe.RANKS))


def op3_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, folder, "pages"), URL_RULES)


def op4_ann(spark: SparkSession, folder: str) -> DataFrame:
    return ann.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return quality.score(documents, quality.train(documents))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return toxicity.score(documents, toxicity.train(documents, table(spark, folder, "labels")))


def op8_vector_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return vector_dedup.near_duplicate_vectors(table(spark, folder, "embeddings"))


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), public_tokenizers.path(packing.VOCABULARY))


def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.pii_digest(table(spark, folder, "documents"))


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.by_component(whitening.whiten(table(spark, folder, "embeddings")))


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    documents = periodicity.with_periodic_tails(table(spark, folder, "documents"))
    return periodicity.run_digest(periodicity.periodic_runs(documents))


def op13_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archived(table(spark, folder, "pages"))


OPERATORS = (
    op1_main_text,
    op2_byte_bpe,
    op3_url_filter,
    op4_ann,
    op5_simhash,
    op6_quality,
    op7_toxicity,
    op8_vector_dedup,
    op9_packing,
    op10_pii,
    op11_whitening,
    op12_periodic_runs,
    op13_warc,
)


def _registered(run: Query) -> Query:
    @wraps(run)
    def call(spark: SparkSession, folder: str) -> DataFrame:
        importable(spark)
        return run(spark, folder)

    return call


QUERIES: dict[str, Query] = {f.__name__: _registered(f) for f in OPERATORS}
_RULES = " union all ".join(
    f"select '{r.action}' as action, '{r.host}' as rule_host, '{r.path}' as rule_path" for r in URL_RULES
)
SQL: dict[str, str] = {
    "op3_url_filter": rf"""
    with rules as ({_RULES}),
    parts as (
      select page_id,
        translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') as path
      from pages),
    keys as (select distinct host, path from parts),
    fitting as (
      select k.host, k.path, arg_max(r.rule_host || r.rule_path, length(r.rule_host || r.rule_path)) as rule,
        arg_max(r.action, length(r.rule_host || r.rule_path)) as action
      from keys k join rules r
        on (k.host = r.rule_host or ends_with(k.host, '.' || r.rule_host)) and starts_with(k.path, r.rule_path)
      group by all)
    select p.page_id, p.host, p.path, f.rule, coalesce(f.action, 'allow') as verdict
    from parts p left join fitting f on p.host = f.host and p.path = f.path
    """,
    "op8_vector_dedup": """
    with recursive usable as (
      select vec_id, label, embedding::double[] as vector from embeddings
      where label is not null and len(embedding) > 0
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        and len(list_filter(embedding, lambda x: x <> 0)) > 0),
    links as (
      select a.vec_id as a, b.vec_id as b from usable a join usable b
      on a.label = b.label and a.vec_id <> b.vec_id and len(a.vector) = len(b.vector)
      where list_cosine_similarity(a.vector, b.vector) >= 0.98),
    reach as (
      select vec_id as a, vec_id as b from embeddings
      union select r.a, l.b from reach r join links l on r.b = l.a),
    components as (select a, min(b) as component_id from reach group by a),
    counts as (select a, count(*) as n from links group by a)
    select e.vec_id, coalesce(n, 0)::bigint as n_links, component_id, e.vec_id = component_id as kept
    from embeddings e join components c on e.vec_id = c.a left join counts k on e.vec_id = k.a
    """,
    "op13_warc": """
    with payloads as (
      select page_id, strlen(coalesce(html, ''))::bigint as payload_bytes, sha256(coalesce(html, '')) as payload_digest
      from pages),
    shared as (
      select payload_digest, min(page_id) as least from payloads where payload_bytes >= 100
      group by payload_digest having count(*) > 1)
    select page_id, payload_bytes, payload_digest,
      case when page_id <> least then 'revisit' else 'response' end as record_type,
      case when page_id <> least then least end as refers_to
    from payloads left join shared using (payload_digest)
    """,
}
