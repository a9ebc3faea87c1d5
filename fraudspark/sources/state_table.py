"""A written per-customer state table with versions.

Customers are dealt to a fixed number of buckets by a hash. A version is a
manifest: for each bucket the folder that holds it and the version that wrote
it. An upsert writes the buckets of its customers to a new folder and then the
manifest, which is what makes them visible: a write that is killed before
leaves the old version as it was, and readers of the old version keep their
files. A version number can be written once, so of two upserts from the same
version one fails and can be tried again.

A lookup of some customers reads the folders of their buckets only, and in
these Parquet's Bloom filters and statistics on customer_id skip files and row
groups.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudspark.operators.state import state_upsert

BUCKET, KEY = "bucket", "customer_id"


class StateTableError(ValueError):
    """The state table cannot be written or read as asked."""


class StateTable:
    """The table at `path`, made with `create`; n_buckets is fixed then."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _manifests(self) -> DataFrame | None:
        try:
            return self.spark.read.schema("bucket int, folder string, written_by bigint, n_buckets int, version bigint") \
                .parquet(f"{self.path}/manifest")
        except AnalysisException:  # no version yet
            return None

    def manifest(self, version: int | None = None) -> list:
        """Rows (bucket, folder, written_by, n_buckets, version) of a version, the newest by default: one a bucket."""
        every = self._manifests()
        if version is None and every is not None:
            version = every.agg(F.max("version")).first()[0]
        rows = [] if version is None or every is None else every.filter(F.col("version") == version).collect()
        if not rows:
            raise StateTableError(f"no state table at {self.path}" + ("" if version is None else f", version {version}"))
        return sorted(rows, key=lambda r: r["bucket"])

    @staticmethod
    def _bucket(n_buckets: int) -> Column:
        return F.pmod(F.xxhash64(F.col(KEY).cast("string")), F.lit(n_buckets)).cast("int")

    def _write(self, state: DataFrame, buckets: Sequence[int], kept: Sequence, n_buckets: int, version: int) -> int:
        """Write the buckets of `state` as a folder, then the manifest of the version."""
        folder = f"data/v{version}-{uuid.uuid4().hex[:8]}"
        (state.withColumn(BUCKET, self._bucket(n_buckets)).repartition(BUCKET).sortWithinPartitions(BUCKET, KEY)
         .write.partitionBy(BUCKET)
         .option(f"parquet.bloom.filter.enabled#{KEY}", "true")
         .option(f"parquet.bloom.filter.expected.ndv#{KEY}", "1000000")
         .parquet(f"{self.path}/{folder}"))
        rows = [(b, f"{folder}/{BUCKET}={b}", version, n_buckets) for b in buckets]
        rows += [(r["bucket"], r["folder"], r["written_by"], n_buckets) for r in kept if r["bucket"] not in set(buckets)]
        try:
            (self.spark.createDataFrame(rows, "bucket int, folder string, written_by bigint, n_buckets int").coalesce(1)
             .write.mode("errorifexists").parquet(f"{self.path}/manifest/version={version}"))
        except AnalysisException as exc:
            raise StateTableError(f"version {version} was written by another upsert: read again and repeat") from exc
        return version

    def create(self, state: DataFrame, n_buckets: int = 64) -> int:
        """The first version; state has one row a customer."""
        if self._manifests() is not None:
            raise StateTableError(f"{self.path} holds a state table already")
        present = state.select(self._bucket(n_buckets).alias("b")).distinct().collect()  # at most n_buckets
        return self._write(state, sorted(r["b"] for r in present), [], n_buckets, 1)

    def read(self, version: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        """The state of a version (the newest by default), of some buckets or of all."""
        rows = self.manifest(version)
        paths = [f"{self.path}/{r['folder']}" for r in rows if buckets is None or r["bucket"] in set(buckets)]
        whole = self.spark.read.parquet(*(paths or [f"{self.path}/{rows[0]['folder']}"]))
        return whole if paths else whole.limit(0)

    def upsert(self, incoming: DataFrame) -> int:
        """A version in which the newer of the kept and the incoming row of each customer counts; the number of it.

        Only the buckets of incoming customers are read and written.
        """
        rows = self.manifest()
        n_buckets, version = rows[0]["n_buckets"], rows[0]["version"]
        touched = sorted(r["b"] for r in incoming.select(self._bucket(n_buckets).alias("b")).distinct().collect())
        if not touched:
            return version
        old = self.read(version, touched)
        return self._write(state_upsert(old, incoming.select(*old.columns)), touched, rows, n_buckets, version + 1)

    def lookup(self, ids: Sequence, version: int | None = None) -> DataFrame:
        """The rows of some customers (a short list); unknown ones have none."""
        rows = self.manifest(version)
        wanted = self.spark.createDataFrame([(i,) for i in ids], f"{KEY} {self.read(version).schema[KEY].dataType.simpleString()}")
        buckets = sorted(r["b"] for r in wanted.select(self._bucket(rows[0]["n_buckets"]).alias("b")).distinct().collect())
        return self.read(version, buckets).filter(F.col(KEY).isin(list(ids)))
