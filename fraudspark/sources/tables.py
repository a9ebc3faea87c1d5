"""Tables and sinks: partitioned Parquet tables, appends, the training-set
read, profile persistence, the run log.

Tables are day-partitioned on `event_date` (derived from event time) and
clustered by sorting each file by (customer_id, event_time), which gives the
Parquet row groups tight min/max ranges for customer and time filters.
Reads filter BOTH `event_time` (pushed into the Parquet scan) and
`event_date` (partition pruning: the partition column differs from the
event-time column, so Spark cannot infer the pruning by itself).
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudspark import schema as S

PARTITION = "event_date"


class TableError(ValueError):
    """A table operation was called with invalid arguments."""


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder."""
    from fraudspark.session import ensure_checkpoint_dir

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


#: Holds a line that the declared schema does not fit (null for a good one).
BAD_LINE = "_bad_line"


def scan_transactions(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType = S.RAW_SCHEMA, *,
                      header: bool = True) -> DataFrame:
    """Read raw transactions with the declared schema (never inferred).

    Lines of a CSV file that don't fit (a value that is not of its type, too
    few or too many fields) don't fail the scan: they are rows with the line in
    `_bad_line` (see `scanned`). A Parquet file's columns have types of their
    own; those that can't be read as declared fail the scan.
    """
    if fmt != "csv":
        return spark.read.schema(schema).format(fmt).load(path)
    declared = T.StructType([*[T.StructField(f.name, f.dataType, True) for f in schema.fields],
                             T.StructField(BAD_LINE, T.StringType(), True)])
    # every field is parsed whichever columns are asked for, else a bad one would not be seen
    return (spark.read.schema(declared).option("columnPruning", False).option("header", header).option("enforceSchema", True)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_LINE)
            .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]").csv(path))


def scanned(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected lines with `n_fields` that could be read and `reasons`); together they are all lines.

    A good row still has to keep the contract (`validate.quarantine`).
    """
    if BAD_LINE not in rows.columns:
        return rows, rows.limit(0).select(F.lit("").alias("line"), F.lit(0).alias("n_fields"), F.array(F.lit("")).alias("reasons"))
    reasons = F.array(F.lit("line:not_of_the_schema"))
    read = F.size(F.filter(F.array(*[F.col(c).cast("string") for c in rows.columns if c != BAD_LINE]), lambda x: x.isNotNull()))
    return (rows.filter(F.col(BAD_LINE).isNull()).drop(BAD_LINE),
            rows.filter(F.col(BAD_LINE).isNotNull()).select(F.col(BAD_LINE).alias("line"), read.alias("n_fields"),
                                                            reasons.alias("reasons")))


def floor_timestamps(df: DataFrame, ns_columns: tuple[str, ...] = ()) -> DataFrame:
    """Timestamps at the store's microsecond resolution.

    Spark timestamps are already microseconds (no-op); integer nanosecond
    columns (since 1970 UTC) are floored to microseconds in integer arithmetic."""
    from fraudspark.functions.expr import ntz_from_micros

    out = df
    for c in ns_columns:
        out = out.withColumn(c, ntz_from_micros(F.expr(f"(`{c}` - pmod(`{c}`, 1000L)) div 1000L")))
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            out = out.withColumn(f.name, F.date_trunc("microsecond", F.col(f.name)))
    return out


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, location: str,
                 partition_col: str = PARTITION) -> None:
    """CREATE TABLE IF NOT EXISTS ... USING parquet PARTITIONED BY (event_date)."""
    cols = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}"
        + (f" COMMENT '{f.metadata.get('comment', '')}'" if f.metadata.get("comment") else "")
        for f in schema.fields
    )
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({cols}, `{partition_col}` date) USING parquet "
        f"PARTITIONED BY ({partition_col}) LOCATION '{location}'"
    )


def _clustered(df: DataFrame) -> DataFrame:
    """Add the partition column and cluster rows inside each output file.

    Range partitioning on (day, customer, time) -- sampled, balanced -- so a
    hot day or a hot customer is spread over many writer tasks, each file
    holding a narrow (customer, time) range."""
    out = df.withColumn(PARTITION, F.to_date(F.col(S.EVENT_TIME)))
    return out.repartitionByRange(PARTITION, "customer_id", S.EVENT_TIME).sortWithinPartitions(
        PARTITION, "customer_id", S.EVENT_TIME)


def append(df: DataFrame, path: str, name: str = "append") -> int:
    """Append partitioned by event_date; returns the rows written, counted by
    an Observation during the write itself (no second pass)."""
    obs = Observation(name)
    observed = _clustered(df).observe(obs, F.count(F.lit(1)).alias("rows"))
    observed.write.mode("append").partitionBy(PARTITION).parquet(path)
    return int(obs.get["rows"])


def append_raw(df: DataFrame, path: str) -> int:
    S.require_columns(df.columns, [f.name for f in S.RAW_SCHEMA.fields if not f.nullable], "raw frame")
    return append(df.select(*[f.name for f in S.RAW_SCHEMA.fields if f.name in df.columns]), path, "append_raw")


def append_features(df: DataFrame, path: str) -> int:
    """Project to the 5 keys + 13 features in declared order, reject missing columns."""
    S.require_columns(df.columns, S.FEATURE_TABLE_KEYS + S.FEATURES, "feature frame")
    return append(df.select(*S.FEATURE_TABLE_KEYS, *S.FEATURES), path, "append_features")


def _parse_bound(name: str, value) -> _dt.datetime:
    if isinstance(value, _dt.datetime):
        return value
    if isinstance(value, _dt.date):
        return _dt.datetime(value.year, value.month, value.day)
    try:
        return _dt.datetime.fromisoformat(str(value))
    except ValueError as exc:
        raise TableError(f"{name} must be a timestamp; got {value!r}") from exc


def training_set(spark: SparkSession, path: str, start, end) -> DataFrame:
    """Labelled feature rows with start <= event_time < end."""
    return feature_rows(spark, path, start, end, labelled=True)


def feature_rows(spark: SparkSession, path: str, start, end, *, labelled: bool = False) -> DataFrame:
    """Feature rows with start <= event_time < end (bound parameters); labelled: those with a label only.

    Bounds are validated before planning; the query filters both the
    partition column (pruning) and event_time (Parquet pushdown)."""
    lo, hi = _parse_bound("start", start), _parse_bound("end", end)
    if lo >= hi:
        raise TableError(f"empty date range: {lo} >= {hi}")
    cols = ", ".join(S.FEATURE_TABLE_KEYS + S.FEATURES)
    # bounds travel as ISO text and become TIMESTAMP_NTZ in SQL, so the
    # session time zone cannot shift them (event_time is a UTC wall clock)
    return spark.sql(
        f"""SELECT {cols} FROM parquet.`{path}`
            WHERE event_time >= CAST(:start AS TIMESTAMP_NTZ) AND event_time < CAST(:end AS TIMESTAMP_NTZ)
              AND {PARTITION} >= CAST(CAST(:start AS TIMESTAMP_NTZ) AS DATE)
              AND {PARTITION} <= CAST(CAST(:end AS TIMESTAMP_NTZ) AS DATE)
              {f"AND {S.LABEL} IS NOT NULL" if labelled else ""}""",
        args={"start": lo.isoformat(sep=" "), "end": hi.isoformat(sep=" ")},
    )


def load_features(spark: SparkSession, *, raw: DataFrame | None = None, table: str | None = None,
                  start=None, end=None) -> DataFrame:
    """One entry point, two sources: raw frame -> computed features, or feature
    table -> date-bounded read. Both give the feature-table columns."""
    from fraudspark.operators.features import build_features

    if raw is not None:
        return build_features(raw).select(*S.FEATURE_TABLE_KEYS, *S.FEATURES)
    missing = [n for n, v in (("table", table), ("start", start), ("end", end)) if v is None]
    if missing:
        raise TableError(f"reading the feature table needs: {', '.join(missing)} (or pass raw=)")
    return training_set(spark, table, start, end)


# ------------------------------------------------------------------ small artefacts
def save_profile(profile: DataFrame, path: str) -> None:
    profile.coalesce(1).write.mode("overwrite").parquet(path)  # a few dozen rows


def load_profile(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def run_log(evaluation: DataFrame, run_id: str, params: dict | None = None,
            importance: DataFrame | None = None) -> DataFrame:
    """Long table (run, variant, kind, name, value): metrics unpivoted from the
    evaluation table, params as strings, importances as `shap_importance__<f>`."""
    metric_cols = [c for c in evaluation.columns if c != "variant"]
    metrics = evaluation.select("variant", *[F.col(c).cast("double") for c in metric_cols]).unpivot(
        "variant", metric_cols, "name", "num").select(
        F.lit(run_id).alias("run"), "variant", F.lit("metric").alias("kind"), "name",
        F.col("num").cast("string").alias("value"), F.col("num").alias("num"))
    out = metrics
    if params:
        rows = [(run_id, v, "param", k, str(val), None) for v in ("*",) for k, val in sorted(params.items())]
        out = out.unionByName(evaluation.sparkSession.createDataFrame(
            rows, "run string, variant string, kind string, name string, value string, num double"))
    if importance is not None:
        imp = importance.select(
            F.lit(run_id).alias("run"), "variant", F.lit("metric").alias("kind"),
            F.concat(F.lit(S.FEATURE_PREFIX_IMPORTANCE), F.col("feature")).alias("name"),
            F.col("importance").cast("string").alias("value"), F.col("importance").cast("double").alias("num"))
        out = out.unionByName(imp)
    return out


def append_run(log: DataFrame, path: str) -> int:
    """Append one run's rows, partitioned by run; a run that the log holds already is rejected. Rows written."""
    runs = [r[0] for r in log.select("run").distinct().limit(2).collect()]
    if len(runs) != 1:
        raise TableError(f"rows of one run are appended at a time; these have {len(runs)}")
    try:
        known = not log.sparkSession.read.parquet(path).filter(F.col("run") == runs[0]).isEmpty()
    except AnalysisException:  # nothing logged yet
        known = False
    if known:
        raise TableError(f"{runs[0]} is in the log already")
    obs = Observation("append_run")
    log.coalesce(1).observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("append").partitionBy("run").parquet(path)
    return int(obs.get["rows"])


def audit_rows(scored: DataFrame, variant_col: str = "variant") -> DataFrame:
    """Prediction-log projection (all ten columns, declared order)."""
    S.require_columns(scored.columns, [f.name for f in S.PREDICTION_LOG_SCHEMA.fields if not f.nullable],
                      "scored frame")
    cols = [f.name for f in S.PREDICTION_LOG_SCHEMA.fields]
    out = scored if "latency_ms" in scored.columns else scored.withColumn("latency_ms", F.lit(None).cast("double"))
    return out.select(*cols)


def check_same_ids(scored: DataFrame, events: DataFrame) -> None:
    """Raises TableError unless the scored rows are those of the events: as many of each transaction_id (one job)."""
    def side(df: DataFrame, sign: int) -> DataFrame:
        return df.select(F.col("transaction_id").cast("string").alias("id"), F.lit(sign).alias("n"))

    off = side(events, 1).unionByName(side(scored, -1)).groupBy("id").agg(F.sum("n").alias("n")).agg(
        F.coalesce(F.sum(F.greatest("n", F.lit(0))), F.lit(0)).alias("missing"),
        F.coalesce(F.sum(F.greatest(-F.col("n"), F.lit(0))), F.lit(0)).alias("extra")).first()
    if off["missing"] or off["extra"]:
        raise TableError(f"{off['missing']} events have no scored row and {off['extra']} scored rows have no event")


def audit_append(scored: DataFrame, path: str, events: DataFrame | None = None) -> int:
    """Append prediction-log rows partitioned by date and variant. A failed
    write is reported and returns 0 (the scoring path must not fail); rows
    that don't match the given events are rejected before it."""
    rows = audit_rows(scored)
    if events is not None:
        check_same_ids(rows, events)
    try:
        obs = Observation("audit_append")
        # observe above the range exchange: its sampling job must not count rows
        rows = rows.withColumn(PARTITION, F.to_date(S.EVENT_TIME)).repartitionByRange(
            PARTITION, "variant", "customer_id").sortWithinPartitions(PARTITION, "variant", "customer_id")
        rows = rows.observe(obs, F.count(F.lit(1)).alias("rows"))
        rows.write.mode("append").partitionBy(PARTITION, "variant").parquet(path)
        return int(obs.get["rows"])
    except Exception as exc:  # noqa: BLE001 -- logged, never fatal
        import logging

        logging.getLogger(__name__).error("audit append failed: %s", exc)
        return 0
