"""Queries of the training-data operators over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm import dialogues, topk

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfwise.llm.mixing import mix_sources

    return mix_sources(_table(spark, sf_dir, "documents"))


def op3_shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfwise.llm.sharding import shard_documents

    return shard_documents(_table(spark, sf_dir, "documents"))


def op4_scan_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfwise.llm.licences import scan_licences

    return scan_licences(_table(spark, sf_dir, "documents"))


def op5_rotate_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfwise.llm.dialogues import rotate_perspectives

    return rotate_perspectives(_table(spark, sf_dir, "conversations"))


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfwise.llm.topk import top_k

    return top_k(_table(spark, sf_dir, "embeddings"))


def op1_encode_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfwise.llm.pieces import encode_documents

    return encode_documents(_table(spark, sf_dir, "documents"))


def op9_fingerprint_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfwise.llm.phrases import fingerprint_documents

    return fingerprint_documents(_table(spark, sf_dir, "documents"))


def op10_toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfwise.llm.toxicity import toxicity_scores

    return toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_remove_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfwise.llm.repeats import remove_repeats

    return remove_repeats(_table(spark, sf_dir, "documents"))


def op7_join_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfwise.llm.chosen_path import join_near

    return join_near(_table(spark, sf_dir, "documents")).drop("sid")


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfwise.llm.quality import quality_rules

    return quality_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_group_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfwise.llm.spelling import group_spellings

    return group_spellings(_table(spark, sf_dir, "documents"))


def op13_detect_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfwise.llm.runs import detect_runs

    return detect_runs(_table(spark, sf_dir, "documents"), planted=True)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_encode_documents, op2_mix_sources, op3_shard_documents, op4_scan_licences, op5_rotate_perspectives,
        op6_top_k, op7_join_near, op8_remove_repeats, op9_fingerprint_documents, op10_toxicity_scores,
        op11_quality_rules, op12_group_spellings, op13_detect_runs,
    )
}
COMPARISON_SQL: dict[str, str] = {
    "op5_rotate_perspectives": dialogues.COMPARISON,
    "op6_top_k": topk.COMPARISON,
}
