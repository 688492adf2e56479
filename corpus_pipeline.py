"""From `documents` to a training order in five stages, each over all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from revlens.llm import decontaminate, line_dedup, mixing, quality, simhash
from revlens.session import staged


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label classifier rejects go; so do null texts and texts without words."""
    return quality.without_rejected(docs)


def fresh_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Long lines of five documents or more stay in one of them; `n_chars` follows the new text, null for a null one.

    Rows without id lose nothing; an empty table gives no rows.
    """
    kept = line_dedup.dedup_lines(docs).select("row.*")
    return kept.withColumn("n_chars", F.length("text").cast(kept.schema["n_chars"].dataType))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of documents whose SimHash fingerprints link, with op8's shingles and bits, the smallest id stays."""
    return simhash.one_of_each(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold at least half of a benchmark text go; rows without id and null texts stay."""
    return decontaminate.without_leaks(docs, decontaminate.leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def training_order(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per reading of a document, by position in the run; sources' demand rises, falls or is constant by rank.

    Null and empty texts have no words and are never read; an empty table gives no rows.
    """
    return mixing.training_rows(docs, mixing.mix(docs, schedule=mixing.rotating_schedules))


STAGES = [
    ("quality", good_quality),
    ("line_dedup", fresh_lines),
    ("near_dedup", one_of_each),
    ("decontamination", no_benchmark),
    ("mixing", training_order),
]

ORACLE_SQL = None  # a fitted classifier comes first


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each one's result is a written table that the next reads."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
