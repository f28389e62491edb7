"""The training-data pipeline over ``documents``.

Language identification (texts it rejects go), line deduplication, SimHash
near-deduplication (the smallest document of each group stays), benchmark
decontamination (documents that contain an item go), SentencePiece encoding
and decoding.  Each stage takes (spark, docs, sf_dir) and works on every row
of its input; all but the last return the columns of ``documents``.

The defined results for nulls, empty and long texts, repeated rows, empty
tables and extra columns are those of the operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siniestro.llm import decontamination, language_id, line_dedup, pieces, simhash
from siniestro.session import materialize, ready_for_python


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready_for_python(spark)
    return language_id.keep_known(docs, language_id.learn(docs))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``n_chars`` is counted again for documents that lose lines."""
    out = line_dedup.drop_lines(docs)
    count = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", count).select(*(F.col(f"`{c}`") for c in docs.columns))


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready_for_python(spark)
    return simhash.keep_one(docs, simhash.SHINGLE, simhash.MAX_BITS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready_for_python(spark)
    return decontamination.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready_for_python(spark)
    return pieces.round_trip(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", dedup_near),
    ("benchmark_decontamination", decontaminate),
    ("sentencepiece", tokenise),
]

ORACLE_SQL = None
"""A trained classifier and connected components have no SQL; tests/llm holds every stage against a plain one."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each one's rows are written as Parquet and read again by the next."""
    ready_for_python(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
