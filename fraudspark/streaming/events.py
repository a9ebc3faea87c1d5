"""Event stream with a side output and a saved state (transformWithState).

Every input event leaves the stream once, with a `status`:
  accepted   it has its features and is folded into its customer's state
  late       it is older, by more than the allowed lateness, than the newest
             event that earlier micro-batches folded in for its customer
  duplicate  its id was accepted for the customer within the lateness before
  rejected   it breaks the contract; `reasons` says how
So accepted + late + duplicate + rejected rows are the input, without reading
a sink again. Only accepted events change the state.

A stream can start from a state: that of a batch fold over history
(`state_of_fold`), or one that an earlier stream left in its checkpoint
(`saved_state`). Rejected events are keyed apart from customers and spread
over some keys, so many of them (or of a null customer) are not one task.

A customer's micro-batch goes to Python and back as a frame of its own, at a
cost for each column. So the columns that the fold does not read travel as one
text, and features of the event alone are added behind the fold.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from fraudspark import schema as S
from fraudspark.functions.expr import epoch_micros
from fraudspark.streaming.scoring import NEW_CUSTOMER, STATE_FEATURES, STATE_SCHEMA, folded, output_schema

#: The customer state: the newest events, sums over all, and the newest event time folded in.
SAVED_SCHEMA = T.StructType([*STATE_SCHEMA.fields, T.StructField("newest_us", T.LongType())])
# (names that begin with an underscore don't reach the processor)
KEY, MICROS, CENTS, PACKED, REJECT_KEYS = "fold_key", "fold_us", "fold_cents", "fold_packed", 64
#: Types whose values come back from their texts unchanged.
_AS_TEXT = (T.IntegralType, T.DecimalType, T.DoubleType, T.FloatType, T.BooleanType, T.TimestampNTZType, T.DateType)
_TEXTS = T.ArrayType(T.StringType())
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def customer_key(customer: Column) -> Column:
    return F.concat(F.lit("c"), customer.cast("string"))


class CustomerEvents(StatefulProcessor):
    """State of one customer: the fold, and the ids accepted within the lateness."""

    def __init__(self, lateness_us: int, columns: list[str], max_events: int = S.MAX_RECENT_EVENTS) -> None:
        self.lateness_us, self.columns, self.max_events = lateness_us, columns, max_events
        self.begun = None  # the key whose state to start from was written last, and that state

    def init(self, handle) -> None:
        self.customer = handle.getValueState("customer", SAVED_SCHEMA)
        self.seen = handle.getValueState("seen", "transaction_id array<string>, event_us array<bigint>")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        r = initialState.iloc[0]
        known = ([int(x) for x in r["recent_us"]], [int(x) for x in r["recent_cents"]],
                 int(r["prior_cents"]), int(r["prior_count"]), bool(r["truncated"]), int(r["newest_us"]))
        self.customer.update(known)
        self.begun = (tuple(key), known)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts = [r for r in rows if len(r)]
        if not parts:  # a customer of the state to start from, without an event yet
            return
        batch = parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)
        us = batch[MICROS].to_numpy()
        order = np.argsort(us, kind="stable")
        if (us[order][1:] == us[order][:-1]).any():  # those of an instant go by their ids
            order = batch.reset_index(drop=True).sort_values([MICROS, "transaction_id"], kind="mergesort").index.to_numpy()
        if key[0].startswith("r"):
            yield self._out(batch, order, ["rejected"] * len(order), [])
            return
        known = self.begun[1] if self.begun and self.begun[0] == tuple(key) else self.customer.get()
        self.begun = None
        state, newest = (NEW_CUSTOMER, None) if known is None else (tuple(known[:5]), known[5])
        times, ids = us[order].tolist(), batch["transaction_id"].astype(str).to_numpy()[order].tolist()
        first = newest - self.lateness_us if newest is not None else times[0]
        seen = dict(zip(*(self.seen.get() or ([], [])), strict=True))  # read and written whole, once a micro-batch
        status, met = [], set()
        for t, i in zip(times, ids, strict=True):
            status.append("late" if t < first else "duplicate" if i in met or i in seen else "accepted")
            met.add(i)
        good = [k for k, s in enumerate(status) if s == "accepted"]
        if not good:
            yield self._out(batch, order, status, [])
            return
        cents, times = batch[CENTS].to_numpy()[order[good]].tolist(), [times[k] for k in good]
        found, state = folded(times, cents, state, self.max_events)
        newest = max(times[-1], newest if newest is not None else -2**62)
        self.customer.update((*state, newest))
        seen |= zip((ids[k] for k in good), times, strict=True)
        seen = {i: us for i, us in seen.items() if us >= newest - self.lateness_us}
        self.seen.update((list(seen), list(seen.values())))
        yield self._out(batch, order, status, found)

    def _out(self, batch: pd.DataFrame, order: np.ndarray, status: list[str], found: list[tuple]) -> pd.DataFrame:
        """The rows in order, with their status; found are the features of those accepted, others have none."""
        made, rows = {"status": status}, iter(found)
        features = [*STATE_FEATURES, "new_customer"]
        none = (None,) * len(features)
        every = found if len(found) == len(status) else [next(rows) if s == "accepted" else none for s in status]
        for name, values in zip(features, zip(*every, strict=True), strict=True):
            made[name] = list(values) if len(found) == len(status) else pd.Series(values, dtype=object)
        return pd.DataFrame({c: made[c] if c in made else batch[c].to_numpy()[order] for c in self.columns})

    def close(self) -> None:
        pass


def event_rows(events: DataFrame, *, lateness_us: int = S.ONE_HOUR_SECONDS * 1_000_000, contract: bool = True,
               state: DataFrame | None = None) -> DataFrame:
    """One row an event: its columns, the features, `status` and `reasons`. `state`: the customers' state to start from."""
    from fraudspark.operators.features import add_row_features
    from fraudspark.operators.validate import quarantine
    from fraudspark.session import ship_package

    ship_package(events.sparkSession)
    tagged = quarantine(events) if contract else events.withColumns(
        {"reasons": F.array().cast("array<string>"), "is_valid": F.lit(True)})
    spread = F.pmod(F.xxhash64(F.col("transaction_id").cast("string")), F.lit(REJECT_KEYS)).cast("string")
    names = [c for c in tagged.columns if c not in ("is_valid", "transaction_id")]
    texts = [f for f in tagged.schema.fields if f.name in names and _is_text(f.dataType)]
    others = [c for c in names if c not in [f.name for f in texts]]
    keyed = tagged.select(
        F.when(F.col("is_valid"), customer_key(F.col("customer_id"))).otherwise(F.concat(F.lit("r"), spread)).alias(KEY),
        F.coalesce(epoch_micros(S.EVENT_TIME), F.lit(0)).alias(MICROS),
        F.coalesce((F.col(S.AMOUNT) * 100).cast("bigint"), F.lit(0)).alias(CENTS),
        F.to_json(F.array(*[_text(f) for f in texts])).alias(PACKED), "transaction_id", *others)
    passed = keyed.select("transaction_id", PACKED, *others)
    schema = T.StructType([*output_schema(passed.schema).fields, T.StructField("status", T.StringType())])
    initial = None if state is None else state.withColumn(KEY, customer_key(F.col("customer_id"))).groupBy(KEY)
    out = keyed.groupBy(KEY).transformWithStateInPandas(
        CustomerEvents(lateness_us, schema.names), schema, "Append", "None", initial)
    values = F.from_json(PACKED, _TEXTS)
    out = out.withColumn(PACKED, values).withColumns({f.name: _value(F.col(PACKED)[i], f) for i, f in enumerate(texts)})
    new = [*STATE_FEATURES, "new_customer", "status"]
    base = add_row_features(out.select(*[c for c in tagged.columns if c != "is_valid"], *new))
    return base.select(*[c for c in base.columns if c not in new], *new)


def _is_text(kind: T.DataType) -> bool:
    return isinstance(kind, _AS_TEXT) or kind in (T.StringType(), _TEXTS, T.ArrayType(T.StringType(), False))


def _text(column: T.StructField) -> Column:
    return F.to_json(column.name) if isinstance(column.dataType, T.ArrayType) else F.col(column.name).cast("string")


def _value(text: Column, column: T.StructField) -> Column:
    """The value of `_text`."""
    return F.from_json(text, _TEXTS) if isinstance(column.dataType, T.ArrayType) else text.cast(column.dataType)


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, which transformWithState takes."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


def run_events(events: DataFrame, sink: str, checkpoint: str, *, lateness_us: int = S.ONE_HOUR_SECONDS * 1_000_000,
               contract: bool = True, state: DataFrame | None = None) -> None:
    """Run the stream over what is there, into Parquet: a folder for each micro-batch, which a retry replaces."""
    rows = event_rows(events, lateness_us=lateness_us, contract=contract, state=state)

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink.rstrip('/')}/batch_id={batch_id}")

    with rocksdb_state(events.sparkSession):
        (rows.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start().awaitTermination())


def saved_state(spark: SparkSession, checkpoint: str, customer_type: str = "bigint") -> DataFrame:
    """The customers' state that a stream left, to start another from."""
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "customer").load()
    return state.filter(F.col(f"key.{KEY}").startswith("c")).select(
        F.substring(F.col(f"key.{KEY}"), 2, 1 << 20).cast(customer_type).alias("customer_id"), "value.*")


def state_of_fold(fold: DataFrame) -> DataFrame:
    """The state to start from after a batch fold (operators/state.state_fold) over history."""
    return fold.select(
        "customer_id", F.transform("recent", lambda e: e["us"]).alias("recent_us"),
        F.transform("recent", lambda e: (e["amount"] * 100).cast("bigint")).alias("recent_cents"),
        (F.col("prior_sum") * 100).cast("bigint").alias("prior_cents"), F.col("prior_count").cast("bigint").alias("prior_count"),
        "truncated", F.array_max(F.transform("recent", lambda e: e["us"])).alias("newest_us"))
