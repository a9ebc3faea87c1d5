"""The corpus pipeline: documents -> token ids, in stages that are each written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fraudspark.llm import decontaminate, jaccard, pieces_codec, quality, queries, secrets
from fraudspark.llm.tables import documents, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.quality_filter(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the least doc_id."""
    return jaccard.one_of_each_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are cut out of the texts; every document stays."""
    return secrets.redact(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the text that they decode to."""
    return pieces_codec.encode(docs, queries.piece_codec())


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("jaccard_join", jaccard_join),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("sentencepiece", sentencepiece),
]

#: Some stages (encoding, tests of randomness) can't be expressed in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
