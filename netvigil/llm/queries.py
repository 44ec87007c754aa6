"""The numbered operators and the pipeline as queries over the given tables, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netvigil.llm import (
    archive, decontaminate, divergence, jaccard, language, lines, materialise, packing, pages, pii, resampling, topk, unigram,
)
from netvigil.llm.common import small_batches


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return small_batches(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.main_text(_table(spark, sf_dir, "pages"))


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(_table(spark, sf_dir, "documents"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_table(spark, sf_dir, "documents"))


def op4_unigram(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = unigram.encode_documents(_table(spark, sf_dir, "documents"))
    return encoded.withColumn("decoded_sha256", F.sha2("decoded", 256)).drop("decoded")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminations(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialise.training_order(_table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_counts(_table(spark, sf_dir, "documents"))


def op8_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_products(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(_table(spark, sf_dir, "documents"))


def op10_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive.round_trip(_table(spark, sf_dir, "pages"))


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resampled(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergences(_table(spark, sf_dir, "documents"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.packed(_table(spark, sf_dir, "documents"), public_tokenizers.path(packing.VOCABULARY))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query for query in (
        op1_main_text, op2_personal_data, op3_language, op4_unigram, op5_decontaminate, op6_training_order,
        op7_line_dedup, op8_top_products, op9_jaccard_join, op10_archive, op11_resampling,
        op12_divergence, op13_packing,
    )
}

ORACLES: dict[str, str] = {
    "op7_line_dedup": lines.LINE_SQL, "op8_top_products": topk.TOP_SQL, "op10_archive": archive.ARCHIVE_SQL,
    "op11_resampling": resampling.RESAMPLING_SQL, "op12_divergence": divergence.DIVERGENCE_SQL,
}
