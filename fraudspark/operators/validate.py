"""Ingestion contract checks and the per-event quarantine.

All data checks of `validate_raw_transactions` run as ONE aggregation job
(one scan, partial aggregation, one row back to the driver). Column presence
and types are checked from `df.schema` without touching data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudspark import schema as S

REQUIRED = [f.name for f in S.RAW_SCHEMA.fields if not f.nullable]


def _null_expr(df: DataFrame, name: str) -> Column:
    c = F.col(name)
    dtype = df.schema[name].dataType
    cond = c.isNull()
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        cond = cond | F.isnan(c)  # pandas isna() treats NaN as missing
    return F.count_if(cond)


def validation_summary(df: DataFrame) -> DataFrame:
    """One row: null count per required column, negative amounts, bad labels.

    `invalid_labels` = sorted distinct non-null labels outside {0, 1}.
    """
    present = [c for c in REQUIRED if c in df.columns]
    aggs = [_null_expr(df, c).cast("bigint").alias(f"null_{c}") for c in present]
    if S.AMOUNT in df.columns and isinstance(df.schema[S.AMOUNT].dataType, T.NumericType):
        aggs.append(F.count_if(F.col(S.AMOUNT) < 0).cast("bigint").alias("n_negative_amount"))
    if S.LABEL in df.columns:
        bad = F.collect_set(
            F.when(~F.col(S.LABEL).cast("bigint").isin(0, 1), F.col(S.LABEL).cast("bigint"))
        )
        aggs.append(F.array_sort(bad).alias("invalid_labels"))
    return df.agg(*aggs)


def _shape_problems(df: DataFrame) -> list[str]:
    """What the schema alone tells: absent columns, columns of another kind."""
    kinds = {S.EVENT_TIME: ((T.TimestampType, T.TimestampNTZType), "a point in time"), S.AMOUNT: (T.NumericType, "numeric")}
    absent = [f"no column {c}" for c in REQUIRED if c not in df.columns]
    return absent + [f"{c} is {df.schema[c].dataType.simpleString()}, not {wanted}" for c, (kind, wanted) in kinds.items()
                     if c in df.columns and not isinstance(df.schema[c].dataType, kind)]


def _row_problems(counts: dict) -> list[str]:
    """What the counted rows tell, a text for each rule that some row breaks."""
    found = [f"{c} is null in {counts[f'null_{c}']} rows" for c in REQUIRED if counts.get(f"null_{c}")]
    if counts.get("n_negative_amount"):
        found.append(f"{S.AMOUNT} is below zero in {counts['n_negative_amount']} rows")
    labels = counts.get("invalid_labels")
    return found + ([f"{S.LABEL} takes values beside 0 and 1: {', '.join(map(str, labels))}"] if labels else [])


def validate_raw_transactions(df: DataFrame, *, hot_customer_rows: int | None = None) -> list:
    """Raise `SchemaValidationError` with everything that breaks the contract.

    Columns and their types are looked at first, without a job; then all rules
    on rows in one job. With `hot_customer_rows`, the same job also returns the
    ids of customers with more rows than that (at most N / hot_customer_rows).
    """
    hot: list = []
    problems = _shape_problems(df)
    if not problems:
        counts, hot = _summary_and_hot(df, hot_customer_rows) if hot_customer_rows is not None else (
            validation_summary(df).first().asDict(), [])
        problems = _row_problems(counts)
    if problems:
        raise S.SchemaValidationError("the transactions break the contract: " + "; ".join(problems))
    return hot


def _summary_and_hot(df: DataFrame, hot_customer_rows: int) -> tuple[dict, list]:
    """Validation counts and hot customers in one job: per-customer partial
    counts (codegen'd hash aggregate, one shuffle of partial aggregates), then
    a one-row total. The distinct bad labels are only listed (second job) when
    there are any, i.e. on the error path."""
    present = [c for c in REQUIRED if c in df.columns]
    has_amount = S.AMOUNT in df.columns and isinstance(df.schema[S.AMOUNT].dataType, T.NumericType)
    has_label = S.LABEL in df.columns
    per_aggs = [F.count(F.lit(1)).alias("_rows")]
    per_aggs += [_null_expr(df, c).cast("bigint").alias(f"null_{c}") for c in present]
    if has_amount:
        per_aggs.append(F.count_if(F.col(S.AMOUNT) < 0).cast("bigint").alias("n_negative_amount"))
    if has_label:
        per_aggs.append(F.count_if(~F.col(S.LABEL).cast("bigint").isin(0, 1)).cast("bigint").alias("_n_bad"))
    per = df.groupBy("customer_id").agg(*per_aggs)
    final = [F.sum(f"null_{c}").cast("bigint").alias(f"null_{c}") for c in present]
    if has_amount:
        final.append(F.sum("n_negative_amount").cast("bigint").alias("n_negative_amount"))
    if has_label:
        final.append(F.sum("_n_bad").cast("bigint").alias("_n_bad"))
    final.append(F.collect_list(F.when(F.col("_rows") > hot_customer_rows, F.col("customer_id"))).alias("_hot"))
    row = per.agg(*final).first().asDict()
    if row.pop("_n_bad", 0):
        row["invalid_labels"] = validation_summary(df).first()["invalid_labels"]
    return row, list(row.pop("_hot") or [])


# ---------------------------------------------------------------------------
# Per-event contract (one event at the edge): split into good and rejected
# ---------------------------------------------------------------------------
_TEXT_FIELDS = ["transaction_id", "customer_id", "merchant_id", "merchant_category"]
_COUNTRY_FIELDS = ["country", "customer_home_country"]
ALLOWED_FIELDS = [f.name for f in S.RAW_SCHEMA.fields if f.name != S.LABEL]


def quarantine_reasons(df: DataFrame) -> Column:
    """array<string> of every rule the row breaks (empty when valid)."""
    checks = []
    for c in _TEXT_FIELDS:
        checks.append(F.when(F.col(c).isNull() | (F.length(F.col(c).cast("string")) < 1), F.lit(f"{c}:empty")))
    checks.append(F.when(F.col(S.EVENT_TIME).isNull(), F.lit(f"{S.EVENT_TIME}:missing")))
    amt = F.col(S.AMOUNT)
    checks.append(
        F.when(amt.isNull() | (amt < 0) | (amt > F.lit(S.MAX_AMOUNT)), F.lit("amount:out_of_range"))
    )
    for c in _COUNTRY_FIELDS:
        checks.append(
            F.when(F.col(c).isNull() | (F.length(F.col(c)) != S.COUNTRY_CODE_LENGTH), F.lit(f"{c}:not_2_letters"))
        )
    checks.append(F.when(F.col("card_present").isNull(), F.lit("card_present:missing")))
    return F.filter(F.array(*checks), lambda x: x.isNotNull())


def quarantine(df: DataFrame) -> DataFrame:
    """Tag each row with `reasons` and `is_valid` (no data leaves the cluster)."""
    reasons = quarantine_reasons(df)
    if "_unknown_fields" in df.columns:
        reasons = F.concat(
            reasons,
            F.transform(F.col("_unknown_fields"), lambda k: F.concat(F.lit("unknown_field:"), k)),
        )
    if "_parse_errors" in df.columns:
        reasons = F.concat(F.col("_parse_errors"), reasons)
    out = df.withColumn("reasons", reasons)
    return out.withColumn("is_valid", F.size("reasons") == 0)


def split_quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    tagged = quarantine(df)
    good = tagged.filter("is_valid").drop("reasons", "is_valid")  # good + rejected = all rows
    rejected = tagged.filter(~F.col("is_valid"))
    return good, rejected


def parse_events_json(raw: DataFrame, column: str = "payload") -> DataFrame:
    """Parse JSON event payloads; record fields outside the contract.

    Unknown fields are forbidden by the contract: they are listed in
    `_unknown_fields` so `quarantine` rejects the row instead of ignoring them.
    No payload fails the job: one that is no JSON object, and each field whose
    text is not of the field's type, is listed in `_parse_errors` and is null.
    """
    from fraudspark.functions.expr import to_naive_utc

    fields = [f for f in S.RAW_SCHEMA.fields if f.name != S.LABEL]
    text_schema = T.StructType([T.StructField(f.name, T.StringType(), True) for f in fields])
    allowed = F.array(*[F.lit(n) for n in ALLOWED_FIELDS])
    keys = F.json_object_keys(F.col(column))
    parsed = raw.select(
        F.from_json(F.col(column), text_schema).alias("_p"),
        F.coalesce(F.array_except(keys, allowed), F.array().cast("array<string>")).alias("_unknown_fields"),
        keys.isNull().alias("_not_json"),
    )
    typed = {
        S.EVENT_TIME: (to_naive_utc(F.col(f"_p.{S.EVENT_TIME}")), "not_a_timestamp"),
        S.AMOUNT: (F.col(f"_p.{S.AMOUNT}").try_cast("double"), "not_a_number"),
        "card_present": (F.col("_p.card_present").try_cast("boolean"), "not_a_boolean"),
    }
    wrong = [F.when(F.col("_not_json"), F.lit("payload:not_json"))]
    wrong += [F.when(F.col(f"_p.{n}").isNotNull() & value.isNull(), F.lit(f"{n}:{why}"))
              for n, (value, why) in typed.items()]
    return parsed.select(
        *[F.col(f"_p.{n}").alias(n) for n in _TEXT_FIELDS],
        typed[S.EVENT_TIME][0].alias(S.EVENT_TIME),
        F.col(f"_p.{S.AMOUNT}").try_cast(S.MONEY).alias(S.AMOUNT),
        *[F.col(f"_p.{n}").alias(n) for n in _COUNTRY_FIELDS],
        typed["card_present"][0].alias("card_present"),
        "_unknown_fields",
        F.filter(F.array(*wrong), lambda x: x.isNotNull()).alias("_parse_errors"),
    )
