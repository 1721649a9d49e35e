"""The registered queries: each applies an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starflat.llm import (
    alignment,
    decontaminate,
    extraction,
    licenses,
    negatives,
    packing,
    secrets,
    sharding,
    simhash,
    substrings,
    topk,
    toxicity,
    urls,
)
from starflat.llm.common import read
from starflat.llm.oracles import LLM_ORACLES

Query = Callable[[SparkSession, str], DataFrame]


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(read(spark, sf_dir, "documents")))


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), vocabulary())


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read(spark, sf_dir, "embeddings"))


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document that loses sentences, with those and where they occurred first."""
    rows = substrings.numbered_rows(read(spark, sf_dir, "documents"))
    return substrings.removals(rows).select(
        "doc_id",
        "n_sentences",
        F.size("removed").alias("n_removed"),
        substrings.ranges(F.col("removed")).alias("removed"),
        "first_doc_ids",
    )


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


def op9_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(read(spark, sf_dir, "pages"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
    return alignment.digest(*alignment.align(read(spark, sf_dir, "documents"), *files))


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose id is divisible by 7 get the next label of ten first."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(read(spark, sf_dir, "embeddings").withColumn("label", moved))


def op13_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(read(spark, sf_dir, "pages"))


LLM_QUERIES: dict[str, Query] = {
    "op1_secrets": op1_secrets,
    "op2_packing": op2_packing,
    "op3_simhash": op3_simhash,
    "op4_topk": op4_topk,
    "op5_substrings": op5_substrings,
    "op6_sharding": op6_sharding,
    "op7_decontamination": op7_decontamination,
    "op8_licenses": op8_licenses,
    "op9_extraction": op9_extraction,
    "op10_toxicity": op10_toxicity,
    "op11_alignment": op11_alignment,
    "op12_negatives": op12_negatives,
    "op13_urls": op13_urls,
}

__all__ = ["LLM_ORACLES", "LLM_QUERIES"]
