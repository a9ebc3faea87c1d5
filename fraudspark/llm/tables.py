"""Written intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from fraudspark.session import ensure_checkpoint_dir, ship_package

__all__ = ["arrow_rows", "documents", "folder", "ship_package", "written"]

ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def folder(spark: SparkSession, name: str) -> str:
    """A new path under spark.checkpoint.dir."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}/{name}"


@contextmanager
def arrow_rows(spark: SparkSession, rows: int | None) -> Iterator[None]:
    """Jobs inside send at most `rows` rows at a time to Python: wide rows take less memory on both sides."""
    before = spark.conf.get(ARROW_ROWS, None)
    if rows is not None:
        spark.conf.set(ARROW_ROWS, str(rows))
    try:
        yield
    finally:
        if rows is not None:
            spark.conf.unset(ARROW_ROWS) if before is None else spark.conf.set(ARROW_ROWS, before)


def written(df: DataFrame, name: str, batch_rows: int | None = None) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: cuts lineage, survives lost executors.

    batch_rows: rows that go to Python at a time, where they are wide.
    """
    path = folder(df.sparkSession, name)
    with arrow_rows(df.sparkSession, batch_rows):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
