"""The event stream: every event leaves it once, and a stream can go on from a saved state."""

import datetime as dt
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import RAW_DDL
from fraudspark import schema as S
from fraudspark.operators import state as ST
from fraudspark.sources.tables import scratch_path
from fraudspark.streaming import events as EV
from fraudspark.streaming import scoring as SC

START = dt.datetime(2024, 1, 1)
FEATURES = ["txn_count_1h", "txn_count_24h", "amount_sum_24h", "seconds_since_prev_txn", "customer_amount_mean_prior"]


def event(i, customer, minutes, amount="10.00", country="GB"):
    return (f"t{i}", customer, START + dt.timedelta(minutes=minutes), Decimal(amount), "m", "grocery", country, "GB", True, 0)


def run(spark, parts, **kw):
    """Stream the parts, a micro-batch each, and give the rows and the checkpoint."""
    path, sink, ck = (scratch_path(spark, n) for n in ("arrivals", "sink", "ckpt"))
    for rows in parts:
        spark.createDataFrame(rows, RAW_DDL).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 1).parquet(path)
    EV.run_events(stream, sink, ck, **kw)
    return spark.read.parquet(sink), ck


def by_id(rows):
    return {r["transaction_id"]: tuple(round(r[f], 9) for f in FEATURES) for r in rows.filter("status = 'accepted'").collect()}


@pytest.fixture(scope="module")
def history():
    return [event(i, f"c{i % 3}", 7 * i, f"{i % 11 + 1}.25") for i in range(120)]


def test_every_event_leaves_the_stream_once(spark, history):
    first = [*history[:60], event("bad", "c1", 1, country="GBR"), event("null", None, 2), event("neg", "c2", 3, "-1.00"), history[5]]
    second = [*history[60:], event("late", "c0", 0), event("new", "c9", 0), history[59], event("edge", "c2", 7 * 59 - 60)]
    rows, _ = run(spark, [first, second])
    got = {}
    for r in rows.select("transaction_id", "status", "reasons").collect():
        got.setdefault(r["transaction_id"], []).append((r["status"], len(r["reasons"])))
    assert sum(map(len, got.values())) == len(first) + len(second)
    assert got["tlate"] == [("late", 0)] and got["tnew"] == got["tedge"] == [("accepted", 0)]
    assert sorted(got["t5"]) == sorted(got["t59"]) == [("accepted", 0), ("duplicate", 0)]
    assert all(got[i] == [("rejected", 1)] for i in ("tbad", "tnull", "tneg"))
    assert all(got[r[0]] == [("accepted", 0)] for r in history if r[0] not in ("t5", "t59"))


def test_a_stream_goes_on_from_a_saved_state(spark, history):
    whole, _ = run(spark, [history[:70], history[70:]])
    first, checkpoint = run(spark, [history[:70]])
    saved = EV.saved_state(spark, checkpoint, "string")
    assert saved.count() == 3 and saved.agg(F.sum("prior_count")).first()[0] == 70
    # the state is a table like any other: written, read and given to a new stream
    path = scratch_path(spark, "saved")
    saved.write.parquet(path)
    second, _ = run(spark, [history[70:]], state=spark.read.parquet(path))
    assert by_id(first) | by_id(second) == by_id(whole) and len(by_id(second)) == 50


def test_a_stream_goes_on_from_a_batch_fold(spark, history):
    df = spark.createDataFrame(history, RAW_DDL)
    cut = START + dt.timedelta(minutes=7 * 70)
    state = EV.state_of_fold(ST.state_fold(df, as_of=cut))
    rows, _ = run(spark, [history[70:], [event("late", "c1", 1)]], state=state)
    whole, _ = run(spark, [history])
    got, want = by_id(rows), by_id(whole)
    assert got == {k: v for k, v in want.items() if int(k[1:]) >= 70}
    assert rows.filter("status = 'late'").count() == 1
    served = {r["transaction_id"]: r["txn_count_24h"] for r in ST.serving_features_batch(df).collect()}
    assert all(served[k] == v[1] for k, v in want.items())


def test_state_is_bounded(spark):
    rows = [event(i, "c", i) for i in range(S.MAX_RECENT_EVENTS + 40)]
    _, ck = run(spark, [rows])
    r = EV.saved_state(spark, ck, "string").first()
    assert len(r["recent_us"]) == S.MAX_RECENT_EVENTS and r["truncated"] and r["prior_count"] == len(rows)
    seen = spark.read.format("statestore").option("path", ck).option("stateVarName", "seen").load()
    assert 0 < seen.count() <= 61  # ids of the last hour


class Value:
    """A value of the state that counts how often it is asked for or written."""

    calls, held = 0, None

    def exists(self):
        Value.calls += 1
        return self.held is not None

    def get(self):
        Value.calls += 1
        return self.held

    def update(self, value):
        Value.calls += 1
        self.held = value


class Handle:
    def getValueState(self, name, schema):
        return Value()


def test_the_state_is_read_and_written_once_a_batch():
    made = EV.CustomerEvents(3600 * 1_000_000, ["transaction_id", EV.MICROS, EV.CENTS, "status"])
    made.init(Handle())
    for n, again in ((300, 0), (400, 1)):
        ids = [0, *range(n)] if again else list(range(n))
        batch = pd.DataFrame({"transaction_id": ids, EV.MICROS: [i * 1_000_000 for i in ids], EV.CENTS: [i + 1 for i in ids]})
        Value.calls = 0
        out = pd.concat(made.handleInputRows(("c1",), iter([batch]), None))
        assert len(out) == len(ids) and Value.calls <= 6
        assert (out["status"] == "duplicate").sum() == (301 if again else 0)
    assert made.customer.get()[3] == 400 and len(made.seen.get()[0]) == 400
    later = pd.DataFrame({"transaction_id": [400], EV.MICROS: [3800 * 1_000_000], EV.CENTS: [1]})
    list(made.handleInputRows(("c1",), iter([later]), None))
    assert len(made.seen.get()[0]) == 201  # ids of the last hour


def test_a_customers_batch_takes_four_calls_and_one_frame(spark):
    made = EV.CustomerEvents(3600 * 1_000_000, ["transaction_id", "status", *EV.STATE_FEATURES, "new_customer"])
    made.init(Handle())
    start = pd.DataFrame([{"recent_us": [5], "recent_cents": [100], "prior_cents": 100, "prior_count": 1, "truncated": False,
                           "newest_us": 7200 * 1_000_000}])
    made.handleInitialState(("c1",), start, None)
    batch = pd.DataFrame({"transaction_id": ["b", "a", "late", "a"], EV.MICROS: [8000 * 1_000_000] * 2 + [9, 8001 * 1_000_000],
                          EV.CENTS: [1, 2, 3, 4]})
    Value.calls = 0
    (out,) = made.handleInputRows(("c1",), iter([batch]), None)
    assert Value.calls <= 4
    assert list(zip(out["transaction_id"], out["status"])) == [
        ("late", "late"), ("a", "accepted"), ("b", "accepted"), ("a", "duplicate")]
    assert out["txn_count_1h"].tolist() == [None, 1, 1, None] and made.customer.get()[3] == 3


def test_values_pass_the_stream_unchanged(spark):
    """Columns that the fold does not read go to the workers as one, and come back as they were."""
    more = ", weight double, part float, day date, small smallint, tags array<string>, pair struct<a:int,b:string>"
    rows = [(*event(i, f"c{i % 2}", i), w, w, d, n, t, p) for i, (w, d, n, t, p) in enumerate([
        (0.1, dt.date(1890, 2, 3), 3, ["a,\"b", None], (1, "x")), (None, None, None, None, None),
        (-1e300, dt.date(2024, 2, 29), -5, [], (None, "\n\u00e9")), (1 / 3, dt.date(9999, 1, 1), 0, [""], (2, None))])]
    rows[1] = (*rows[1][:1], "c\"\\1", rows[1][2].replace(microsecond=123456), Decimal("123456789012345.67"), None, *rows[1][5:])
    frame, (path, sink, ck) = spark.createDataFrame(rows, RAW_DDL + more), (scratch_path(spark, n) for n in ("a", "s", "c"))
    frame.write.parquet(path)
    stream = spark.readStream.schema(frame.schema).parquet(path)
    made = EV.event_rows(stream, contract=False)
    sent = made._jdf.queryExecution().analyzed().toString().split("TransformWithState")[1].split("Project")[1]
    assert "merchant_category#" not in sent.split("\n")[0] and EV.PACKED in sent
    EV.run_events(stream, sink, ck, contract=False)
    back = spark.read.parquet(sink)
    assert [(f.name, f.dataType) for f in back.select(*frame.columns).schema] == [(f.name, f.dataType) for f in frame.schema]
    assert back.select(*frame.columns).orderBy("transaction_id").collect() == frame.orderBy("transaction_id").collect()
    assert {tuple(r["reasons"]) for r in back.collect()} == {()} and back.columns[:10] == frame.columns[:10]


def test_a_fold_equals_the_plain_rule_for_late_and_equal_times():
    day = 24 * 3600 * 1_000_000
    us = sorted([0, 5, 5, 5, day - 1, day, day + 5, day + 5, 2 * day, *range(day + 7, day + 900, 31)])
    batch = pd.DataFrame({"_us": us, "_cents": [i % 13 + 1 for i in range(len(us))]})
    known = ([day + 9, 3, day + 9, 2 * day + 1], [100, 200, 300, 400], 5000, 40, False)
    rows, (times, cents, total, count, cut) = SC.fold_events(batch, known, 10_000)
    for i, (at, own) in enumerate(zip(us, batch["_cents"], strict=True)):
        before = [*zip(known[0], known[1]), *zip(us[:i], batch["_cents"])]
        near = [(t, c) for t, c in before if 0 < at - t < day]
        later = [c for t, c in zip(known[0], known[1]) if t >= at]
        n = known[3] + sum(t < at for t in us[:i]) - len(later)
        assert rows[i][1] == 1 + sum(at - t < day // 24 for t, _ in near) and rows[i][2] == 1 + len(near)
        assert rows[i][3] == (sum(c for _, c in near) + own) / 100
        spent = known[2] + sum(c for t, c in zip(us[:i], batch["_cents"]) if t < at) - sum(later)
        assert abs(rows[i][4] - spent / 100 / n) < 1e-9
    assert times == sorted([*known[0], *us]) and (count, total, cut) == (40 + len(us), 5000 + batch["_cents"].sum(), False)
