"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from nimbus.llm import decontaminate, near_dup, packing, secrets, toxicity
from nimbus.llm.common import cut, ship, table, work_folder


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored toxic go. The model learns from the labels of the documents at hand, its held-out fold left out."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), ~toxicity.fold())
    return toxicity.drop_toxic(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    ship(spark)
    return near_dup.drop_near_duplicates(docs)


def contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    ship(spark)
    return secrets.redact(docs, secrets.learn(secrets.weak_findings(docs)))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    ship(spark)
    return packing.pack(docs)


STAGES = [("toxicity", toxic), ("near_duplicates", near_duplicates), ("decontamination", contaminated),
          ("secrets", redacted), ("packing", packed)]

#: Tokens, classifiers and sketches have no SQL form: tests/llm compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, docs = work_folder(spark, "pipeline"), table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = cut(stage(spark, docs, sf_dir), root, f"{k}-{name}")
    return docs
