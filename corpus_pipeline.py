"""A corpus pipeline: documents with a language, without boilerplate lines, near duplicates and test items, as token ids.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept; all but the last return
the columns of documents, further ones included, whatever their names. An empty table stays empty in all stages; texts of any
length are read whole. Null texts go in the first stage; run on their own, the others keep rows with null or empty texts,
and rows without doc_id are no duplicates of others. Of repeated rows near_duplicates keeps one; elsewhere they stay or go together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netvigil.llm import decontaminate, jaccard, language, lines, unigram
from netvigil.llm.common import small_batches
from netvigil.session import new_path


def _bounded(docs: DataFrame) -> DataFrame:
    """The documents, in a session that hands them to Python in batches of bounded size."""
    small_batches(docs.sparkSession)
    return docs


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose text has no language (null or without a letter); a missing ``lang`` becomes the predicted one."""
    return language.keep_identified(_bounded(docs))


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that are boilerplate of their source from the texts; n_chars, where it is a number, follows."""
    kept = lines.drop_boilerplate(_bounded(docs))
    kind = dict(kept.dtypes).get("n_chars")
    return kept.withColumn("n_chars", F.length("text").cast(kind)) if kind in ("int", "bigint") else kept


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each group linked by shingle similarity."""
    return jaccard.keep_one(_bounded(docs))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a test item of the table ``benchmark``."""
    return decontaminate.decontaminate(_bounded(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether they decode to it."""
    return unigram.encode_documents(_bounded(docs), keep_text=False).drop("decoded")


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_boilerplate_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("unigram_encoding", encode),
]

#: The language machines and the Viterbi path have no SQL; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
