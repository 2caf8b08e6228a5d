"""The corpus pipeline: reject poor and toxic documents, drop repeated lines and near-duplicates, pack the rest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from candlemill.llm import linededup, packing, quality, simhash, toxicity
from candlemill.llm.common import stored
from candlemill.llm.queries import added_tokens, ranks, shared_folder

ALIKE = 0.8  # Jaccard likeness of the five-word shingles from which the near-duplicate stage links two documents


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality.accepted(docs)


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted to be toxic; the examples are those of ``labels`` that are still there."""
    return toxicity.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents, without lines that repeat an earlier one; n_chars follows the text."""
    return linededup.deduped(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that fingerprints or a likeness of ``ALIKE`` link."""
    return simhash.keep_one(docs, alike=ALIKE)


def best_fit(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 tokens; one row per piece."""
    return packing.best_fit(docs, *ranks(), added=added_tokens())


STAGES = [("quality", quality_rules), ("toxicity", toxic_documents), ("line_dedup", line_dedup), ("simhash", near_duplicates), ("packing", best_fit)]

# fingerprints, nearest examples and tokens are beyond SQL; tests hold the result against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each one's result is a written table that the next one reads."""
    shared_folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
