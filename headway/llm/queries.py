"""Queries and SQL of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from headway.llm import (
    audit,
    chat,
    decontaminate,
    kneser,
    minhash,
    packing,
    pages,
    repeats,
    shards,
    simhash,
    topk,
    wavelet,
    whitening,
)


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_chat_prefix_targets(spark: SparkSession, sf: str) -> DataFrame:
    return chat.digest(chat.with_control_case(spark, _table(spark, sf, "conversations")))


def op2_simhash_pigeonring(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.digest(_table(spark, sf, "documents"))


def op3_boosted_extraction(spark: SparkSession, sf: str) -> DataFrame:
    return pages.extract(_table(spark, sf, "pages"))


def op4_mixture_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(_table(spark, sf, "documents"))


def op5_byte_shards(spark: SparkSession, sf: str) -> DataFrame:
    return shards.digest(_table(spark, sf, "documents"))


def op6_latent_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.digest(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


def op7_impact_topk(spark: SparkSession, sf: str) -> DataFrame:
    return topk.digest(_table(spark, sf, "embeddings"))


def op8_wavelet_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return wavelet.digest(_table(spark, sf, "documents"))


def op9_repeated_passages(spark: SparkSession, sf: str) -> DataFrame:
    return repeats.digest(_table(spark, sf, "documents"))


def op10_kneser_quality(spark: SparkSession, sf: str) -> DataFrame:
    return kneser.digest(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def op11_blockmatrix_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whitening.digest(_table(spark, sf, "embeddings"))


def op12_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    return audit.digest(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def op13_minhash_bayesian(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.digest(_table(spark, sf, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_chat_prefix_targets,
        op2_simhash_pigeonring,
        op3_boosted_extraction,
        op4_mixture_packing,
        op5_byte_shards,
        op6_latent_decontamination,
        op7_impact_topk,
        op8_wavelet_tokens,
        op9_repeated_passages,
        op10_kneser_quality,
        op11_blockmatrix_whitening,
        op12_filter_audit,
        op13_minhash_bayesian,
    )
}

ORACLES: dict[str, str] = {
    "op1_chat_prefix_targets": chat.ORACLE_SQL,
    "op7_impact_topk": topk.ORACLE_SQL,
    "op12_filter_audit": audit.ORACLE_SQL,
}
