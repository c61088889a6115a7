"""The registered queries of this subpackage: operators over the whole tables, in digest form."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallymart.llm import (
    decontamination,
    embedding_dedup,
    language,
    ngram_join,
    packing,
    quality_model,
    quality_rules,
    sharding,
    spelling,
    token_counts,
    token_files,
    toxicity,
    whitening,
)
from tallymart.llm.frames import Shelf, read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    joined = ngram_join.ngram_join(read_table(spark, folder, "documents"))
    return joined.select("doc_id", "n_shingles", "component_id")


def op2_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shards(read_table(spark, folder, "documents"))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(
        read_table(spark, folder, "documents"), read_table(spark, folder, "labels")
    )


def op4_token_files(spark: SparkSession, folder: str) -> DataFrame:
    files = f"{Shelf(spark, 'token_files').folder}/files"
    token_files.write_token_files(read_table(spark, folder, "documents"), files)
    return token_files.read_token_files(spark, files, with_ids=False)


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality_model.quality(
        read_table(spark, folder, "documents"), read_table(spark, folder, "labels")
    )


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.quality_rules(read_table(spark, folder, "documents"))


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contamination(
        read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark")
    )


def op8_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.languages(read_table(spark, folder, "documents"))


def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(read_table(spark, folder, "documents"))


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read_table(spark, folder, "documents"))


def op11_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling(read_table(spark, folder, "documents"))


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(read_table(spark, folder, "embeddings"))


def op13_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.embedding_dedup(read_table(spark, folder, "embeddings"))


def queries() -> dict[str, Query]:
    return {
        "op1_ngram_join": op1_ngram_join,
        "op2_sharding": op2_sharding,
        "op3_toxicity": op3_toxicity,
        "op4_token_files": op4_token_files,
        "op5_quality": op5_quality,
        "op6_quality_rules": op6_quality_rules,
        "op7_decontamination": op7_decontamination,
        "op8_language": op8_language,
        "op9_token_counts": op9_token_counts,
        "op10_packing": op10_packing,
        "op11_spelling": op11_spelling,
        "op12_whitening": op12_whitening,
        "op13_embedding_dedup": op13_embedding_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_ngram_join": ngram_join.ORACLE,
        "op7_decontamination": decontamination.ORACLE,
    }
