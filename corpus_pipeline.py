"""A corpus pipeline: five stages over ``documents``, each one decision acted on.

Toxic documents go, one document of each group of near duplicates stays, documents that
hold benchmark passages go, secrets are blotted out, and the rest is mixed to target
weights. Each stage's result is written and read again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parcelyard.llm import decontaminate, mixing, near_dup, secret_scan, toxicity
from parcelyard.llm.workspace import Workspace


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, _table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def blot_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", blot_secrets),
    ("mixing", mix_sources),
]

# A trained classifier and hashed minima have no SQL; tests/llm checks every stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document that is left after the other stages.

    A null or empty text is not toxic, no duplicate of anything, clean and without secrets; it
    stays, with nothing taken of it. A row without doc_id stays in every stage unless toxic or
    contaminated. Of rows that share a doc_id and have words one stays. Columns beside those of
    documents pass through all stages but the last. An empty table gives an empty result.
    """
    work = Workspace(spark, "pipeline")
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = work.write(stage(spark, docs, sf_dir), name)
    return docs
