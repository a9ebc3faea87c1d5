"""Stateful stream scoring.

source -> contract filter -> watermark + dedup on transaction_id ->
groupBy(customer_id).applyInPandasWithState (the customer state: newest 100
events, exact prior sum/count, truncated flag) -> the 13 features per event ->
foreachBatch: score, explain, append the prediction log.

Inside a micro-batch a customer's events are folded in (event time,
transaction id) order. State is keyed by customer, so the shuffle spreads
customers over tasks; per-event Python is limited to the small fold below.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from fraudspark import schema as S
from fraudspark.functions.expr import epoch_micros

H_US = S.ONE_HOUR_SECONDS * 1_000_000
D_US = S.ONE_DAY_SECONDS * 1_000_000

STATE_SCHEMA = T.StructType([
    T.StructField("recent_us", T.ArrayType(T.LongType())),
    T.StructField("recent_cents", T.ArrayType(T.LongType())),
    T.StructField("prior_cents", T.LongType()),
    T.StructField("prior_count", T.LongType()),
    T.StructField("truncated", T.BooleanType()),
])

STREAM_KEYS = ["transaction_id", "customer_id", S.EVENT_TIME, S.AMOUNT, S.LABEL]
ROW_FEATURES = ["amount_log", "hour_of_day", "day_of_week", "is_night", "is_weekend", "is_foreign", "card_not_present"]
STATE_FEATURES = ["seconds_since_prev_txn", "txn_count_1h", "txn_count_24h", "amount_sum_24h",
                  "customer_amount_mean_prior", "amount_vs_customer_mean"]


def output_schema(input_schema: T.StructType) -> T.StructType:
    """Input columns passed through + the state features + new_customer."""
    extra = [
        T.StructField("seconds_since_prev_txn", T.DoubleType()),
        T.StructField("txn_count_1h", T.LongType()),
        T.StructField("txn_count_24h", T.LongType()),
        T.StructField("amount_sum_24h", T.DoubleType()),
        T.StructField("customer_amount_mean_prior", T.DoubleType()),
        T.StructField("amount_vs_customer_mean", T.DoubleType()),
        T.StructField("new_customer", T.BooleanType()),
    ]
    return T.StructType(list(input_schema.fields) + extra)


FoldState = tuple[list[int], list[int], int, int, bool]
NEW_CUSTOMER: FoldState = ([], [], 0, 0, False)


def fold_events(batch: pd.DataFrame, state: FoldState, max_events: int = S.MAX_RECENT_EVENTS) -> tuple[list, FoldState]:
    """Features of each event of a batch sorted by (_us, transaction_id), from the events strictly before its instant,
    and the state with the batch folded in. Money stays exact: integer cents. The kept events stay sorted by time, so
    an event finds its windows by bisection."""
    return folded(batch["_us"].tolist(), batch["_cents"].tolist(), state, max_events)


def folded(times: list[int], cents: list[int], state: FoldState, max_events: int = S.MAX_RECENT_EVENTS) -> tuple[list, FoldState]:
    """`fold_events` of the events at these times, of these amounts."""
    rec_us, rec_amt, psum, pcnt, trunc = state
    order = sorted(range(len(rec_us)), key=rec_us.__getitem__)
    us, am = [rec_us[i] for i in order], [rec_amt[i] for i in order]
    out, at = [], 0
    while at < len(times):  # every event of an instant sees the state before it
        now, end = int(times[at]), at + 1
        while end < len(times) and times[end] == now:
            end += 1
        new = [int(c) for c in cents[at:end]]
        at = end
        past = bisect_left(us, now)
        in1, in24 = past - bisect_right(us, now - H_US), past - bisect_right(us, now - D_US)
        prev = (now - us[past - 1]) / 1e6 if past else S.NO_PRIOR_TRANSACTION
        # an event that comes late must not see kept events at its instant or after it
        count, total = pcnt - (len(us) - past), psum - sum(am[past:])
        in24_sum = sum(am[past - in24:past])
        for c in new:
            amt = c / 100
            mean = (total / 100) / count if count > 0 else amt
            ratio = amt / mean if mean > 0 else 1.0
            out.append((prev, in1 + 1, in24 + 1, (in24_sum + c) / 100, mean, ratio, count == 0))
        after = bisect_right(us, now)
        us[after:after], am[after:after] = [now] * len(new), new
        psum, pcnt = psum + sum(new), pcnt + len(new)
        if len(us) > max_events:
            del us[:-max_events], am[:-max_events]
            trunc = True
    return out, (us, am, psum, pcnt, trunc)


def fold_customer(key, pdfs: Iterator[pd.DataFrame], state, max_events: int = S.MAX_RECENT_EVENTS):
    """State function: features of each new event, then the events folded into the state."""
    batch = pd.concat(list(pdfs), ignore_index=True).sort_values(["_us", "transaction_id"], kind="mergesort")
    out, now = fold_events(batch, state.get if state.exists else NEW_CUSTOMER, max_events)
    state.update(now)
    feats = pd.DataFrame(out, columns=[*STATE_FEATURES, "new_customer"], index=batch.index)
    yield pd.concat([batch, feats], axis=1)


def stream_features(events: DataFrame, *, watermark: str = "1 day", contract: bool = True) -> DataFrame:
    """Streaming features: one output row per accepted event (append mode).

    `contract` applies the per-event quarantine first (invalid events are
    dropped here; `quarantine` gives them with reasons for a side table)."""
    from fraudspark.operators.features import add_row_features
    from fraudspark.operators.validate import quarantine
    from fraudspark.session import ship_package

    ship_package(events.sparkSession)
    good = quarantine(events).filter("is_valid").drop("reasons", "is_valid") if contract else events
    # watermarks need TIMESTAMP (an instant): derive it from the UTC wall clock
    timed = good.withColumn("_wm", F.timestamp_micros(epoch_micros(S.EVENT_TIME)))
    deduped = timed.withWatermark("_wm", watermark).dropDuplicatesWithinWatermark(["transaction_id"])
    keyed = add_row_features(deduped.drop("_wm")).withColumn("_us", epoch_micros(S.EVENT_TIME)).withColumn(
        "_cents", (F.col(S.AMOUNT) * 100).cast("bigint"))
    return keyed.groupBy("customer_id").applyInPandasWithState(
        fold_customer, output_schema(keyed.schema), STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout
    ).drop("_us", "_cents")


def run_stream(events_stream: DataFrame, sink_path: str, checkpoint: str, *, contract: bool = True,
               on_batch=None, available_now: bool = True):
    """Run the feature stream to a Parquet sink through foreachBatch, a folder for each batch_id; `on_batch`
    (df, batch_id) -> df can score and explain each micro-batch first."""
    feats = stream_features(events_stream, contract=contract)

    def handle(batch_df: DataFrame, batch_id: int) -> None:
        # the stateful plan runs once however often on_batch reads the batch; a retried batch replaces its folder
        batch_df.persist()
        try:
            out = on_batch(batch_df, batch_id) if on_batch is not None else batch_df
            out.write.mode("overwrite").parquet(f"{sink_path.rstrip('/')}/batch_id={batch_id}")
        finally:
            batch_df.unpersist()

    w = feats.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    q = w.start()
    q.awaitTermination()
    return q


def unscored(events: DataFrame, scored: DataFrame, *, contract: bool = True) -> DataFrame:
    """Side table of a stream: its input events that have no scored row, with `reasons`.

    An event that breaks the contract has the rules it breaks; a good one that
    came behind the watermark is 'late'. Together with the scored rows (and
    repeats of their ids, which the stream drops) these are all events."""
    from fraudspark.operators.validate import quarantine

    tagged = quarantine(events) if contract else events.withColumns(
        {"reasons": F.array().cast("array<string>"), "is_valid": F.lit(True)})
    late = tagged.filter("is_valid").join(scored.select("transaction_id"), "transaction_id", "left_anti")
    late = late.withColumn("reasons", F.array(F.lit("late")))
    return tagged.filter("NOT is_valid").unionByName(late).drop("is_valid")


def late_events(tx: DataFrame, lateness_us: int, *, arrival: str = "transaction_id",
                n_ranges: int | None = None) -> DataFrame:
    """Events (in arrival order) older than the newest earlier arrival of the
    same customer by more than `lateness_us`: rows to route to a side table
    instead of folding them into the state. Adds `late_by_us`.

    A two-level running maximum: rows are dealt by ranges of (customer,
    arrival), a small table of each customer's part of a range gives what came
    before it, then the maximum runs inside the part. No customer is one task,
    and the result does not depend on `n_ranges`."""
    from pyspark.sql import Window

    from fraudspark.operators.ordering import RANGE, dealt_by_range

    d = dealt_by_range(tx.withColumn("_us", epoch_micros(S.EVENT_TIME)), ["customer_id", arrival], n_ranges)
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    tops = d.groupBy("customer_id", RANGE).agg(F.max("_us").alias("_top"))
    earlier = tops.select("customer_id", RANGE, F.max("_top").over(
        before.partitionBy("customer_id").orderBy(RANGE)).alias("_earlier"))
    run = d.withColumn("_inside", F.max("_us").over(before.partitionBy("customer_id", RANGE).orderBy(arrival)))
    marked = run.join(earlier, ["customer_id", RANGE], "left").withColumn(
        "newest_us", F.greatest("_inside", "_earlier"))  # skips nulls
    late = marked.filter(F.col("_us") < F.col("newest_us") - F.lit(lateness_us))
    return late.select(*tx.columns, (F.col("newest_us") - F.col("_us")).alias("late_by_us"))
