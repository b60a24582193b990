"""The registered queries of the training-data operators: ``opN_<name>`` and ``pipeline``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from nimbus.llm import (alignment, decontaminate, hnsw, html_text, language_id, near_dup, packing, quantised_dup, secrets,
                        token_counts, toxicity, url_filter, whitening)
from nimbus.llm.common import table, work_folder


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"))
            .select("page_id", "host", "path", "rule", "verdict", "template", "purity"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.learn(docs, labels, ~toxicity.fold())
    return (toxicity.score(docs, model).withColumn("held_out", toxicity.fold())
            .select("doc_id", "held_out", "score", "predicted"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.learn(docs, ~language_id.fold())
    return (language_id.predict(docs, model).withColumn("held_out", language_id.fold())
            .select("doc_id", "held_out", "lang_pred", "score"))


def op4_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.nearest(table(spark, sf_dir, "embeddings"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of a first run go to the cache, and the result comes from a second run that finds them there."""
    docs, cache = table(spark, sf_dir, "documents"), f"{work_folder(spark, 'token-cache')}/counts"
    token_counts.count_tokens(docs, cache=cache)
    return token_counts.count_tokens(docs, cache=cache)


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.find(docs, secrets.learn(secrets.weak_findings(docs)))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (alignment.count_links(table(spark, sf_dir, "documents"))
            .select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"))


def op12_vector_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quantised_dup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_url_filter, op2_toxicity, op3_language_id, op4_nearest_vectors, op5_near_duplicates, op6_decontamination,
    op7_packing, op8_token_counts, op9_secrets, op10_html_text, op11_token_alignment, op12_vector_duplicates, op13_whitening)}

#: All pairs of a label, and the transitive closure of the links.
VECTOR_DUPLICATES = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a
  JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
    AND list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (
  SELECT vec_id AS x, vec_id AS y FROM v
  UNION
  SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
least AS (SELECT x, min(y) AS component FROM reach GROUP BY x),
number AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(component, e.vec_id)::BIGINT AS component_id,
       coalesce(e.vec_id = coalesce(component, e.vec_id), true) AS kept
FROM embeddings e LEFT JOIN least ON least.x = e.vec_id LEFT JOIN number ON number.x = e.vec_id
"""

#: The other operators are learned, sketched, tokenized or parsed: none has a SQL form over whole tables. tests/llm hold
#: each against a brute-force version or held-out accuracy.
SQL: dict[str, str] = {"op12_vector_duplicates": VECTOR_DUPLICATES}
