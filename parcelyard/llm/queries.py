"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from parcelyard.llm import (
    chat,
    decontaminate,
    extraction,
    language_model,
    licenses,
    metric_join,
    mixing,
    near_dup,
    periodic,
    pii,
    ranked,
    secret_scan,
    toxicity,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.report(_table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(_table(spark, sf_dir, "documents"))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts are made of control strings."""
    text = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame(
        [(-7, 0, "user", text), (-7, 1, "assistant", text)],
        "conv_id long, turn long, role string, text string",
    )
    whole = _table(spark, sf_dir, "conversations").select(*planted.columns).unionByName(planted)
    return chat.digest(chat.format_conversations(whole))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find(_table(spark, sf_dir, "documents"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace_pii(_table(spark, sf_dir, "documents"))


def op7_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_join.near_vectors(_table(spark, sf_dir, "embeddings"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )


def op9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.main_text(_table(spark, sf_dir, "pages"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(_table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of all documents, of which every tenth has one written into it."""
    documents = periodic.with_planted_runs(_table(spark, sf_dir, "documents"))
    return periodic.report(documents).drop("n_words")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_licenses": op1_licenses,
    "op2_toxicity": op2_toxicity,
    "op3_near_dup": op3_near_dup,
    "op4_chat": op4_chat,
    "op5_secrets": op5_secrets,
    "op6_pii": op6_pii,
    "op7_near_vectors": op7_near_vectors,
    "op8_decontaminate": op8_decontaminate,
    "op9_mix": op9_mix,
    "op10_main_text": op10_main_text,
    "op11_ranked_search": op11_ranked_search,
    "op12_language_model": op12_language_model,
    "op13_periodic_runs": op13_periodic_runs,
}
