import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import tx_rows
from fraudspark import schema as S
from fraudspark.operators import drift as DR
from fraudspark.operators import state as ST
from fraudspark.plans import jobs as JB


def frame(spark, n=3000, shift=0.0, scale=1.0, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=n) * scale + shift
    rows = [(float(a), bool(i % 7 == 0), 1, int(i % 24)) for i, a in enumerate(x)]
    return spark.createDataFrame(rows, "x double, is_night boolean, txn_count_1h bigint, hour_of_day bigint")


FEATS = ["x", "is_night", "hour_of_day"]


def test_self_drift_is_stable(spark):
    ref = frame(spark)
    prof = DR.build_reference(ref, FEATS)
    d = DR.detect_drift(prof, ref)
    rep = DR.drift_report(d).first()
    assert not rep["drifted"] and rep["worst_psi"] < 0.02
    kinds = {r["feature"]: r["kind"] for r in prof.select("feature", "kind").distinct().collect()}
    assert kinds == {"x": "numeric", "is_night": "categorical", "hour_of_day": "numeric"}


def test_shift_is_flagged_and_any_not_mean(spark):
    prof = DR.build_reference(frame(spark), FEATS)
    d = DR.detect_drift(prof, frame(spark, shift=3.0, seed=1))
    sev = {r["feature"]: r["severity"] for r in d.collect()}
    assert sev["x"] == "significant" and sev["is_night"] == "none"
    assert DR.drift_report(d).first()["drifted"]


def test_constant_numeric_is_categorical_and_constant_profile_raises(spark):
    prof = DR.build_reference(frame(spark), ["txn_count_1h"])
    assert prof.first()["kind"] == "categorical"
    const = spark.createDataFrame([(float(i % 3 == 0) * 0 + 1.0 + i * 0,) for i in range(50)], "v double")
    assert DR.build_reference(const, ["v"]).first()["kind"] == "categorical"


def test_unseen_category_is_drift(spark):
    ref = spark.createDataFrame([("a",)] * 900 + [("b",)] * 100, "c string")
    cur = spark.createDataFrame([("z",)] * 500, "c string")
    d = DR.detect_drift(DR.build_reference(ref, ["c"]), cur).first()
    assert d["severity"] == "significant" and math.isfinite(d["psi"]) and d["unseen_count"] == 500


def test_severity_bands(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 0.09, 0.10, 0.2, 0.25, 1.5)], "p double")
    assert [r[0] for r in df.select(DR.severity(F.col("p"))).collect()] == [
        "none", "none", "moderate", "moderate", "significant", "significant"]


def test_numeric_edges_equal_numpy(spark):
    ref = frame(spark, n=2000)
    prof = DR.build_reference(ref, ["x"]).orderBy("bin_no").collect()
    xs = np.array([r[0] for r in ref.select("x").collect()])
    edges = np.unique(np.quantile(xs, np.linspace(0, 1, 11)))
    edges[0], edges[-1] = -np.inf, np.inf
    assert np.allclose([r["lo"] for r in prof] + [prof[-1]["hi"]], edges, atol=1e-12)
    counts, _ = np.histogram(xs, bins=edges)
    assert [r["ref_count"] for r in prof] == counts.tolist()


def test_drift_check_dry_run(spark):
    prof = DR.build_reference(frame(spark), FEATS)
    cur = frame(spark, shift=3.0, seed=1)
    assert JB.drift_check(prof, cur).first()["retrain_requested"]
    assert not JB.drift_check(prof, cur, dry_run=True).first()["retrain_requested"]


# ---------------------------------------------------------------- state
def test_window_edge_is_half_open(spark):
    rows = [("p", "c", "2024-01-01 10:00:00", 10, "GB", "GB", True, 0),
            ("q", "c", "2024-01-01 10:00:01", 20, "GB", "GB", True, 0),
            ("now", "c", "2024-01-01 11:00:00", 5, "GB", "GB", True, 0)]
    f = ST.serving_features_batch(tx_rows(spark, rows))
    r = {x["transaction_id"]: x for x in f.collect()}["now"]
    assert r["txn_count_1h"] == 2  # 3600 s back excluded, 3599 s included, + itself
    assert r["amount_sum_24h"] == 35.0


def test_capped_state(spark):
    rows = [(f"d{i}", "c", f"2024-01-01 00:00:00", i, "GB", "GB", True, 0) for i in range(1)]
    import datetime as dt
    from decimal import Decimal

    base = dt.datetime(2023, 1, 1)
    data = [(f"d{i:03d}", "c", base + dt.timedelta(days=i), Decimal(i)) for i in range(200)]
    h = spark.createDataFrame(data, "transaction_id string, customer_id string, event_time timestamp_ntz, amount decimal(18,2)")
    st = ST.state_fold(h, max_events=10, salts=4).first()
    assert st["prior_count"] == 200 and len(st["recent"]) == 10 and st["truncated"]
    assert st["prior_amount_mean"] == 99.5
    assert [int(e["amount"]) for e in st["recent"]] == list(range(190, 200))
    del rows


def test_as_of_excludes_the_instant(spark):
    rows = [("a", "c1", "2024-01-01 09:00:00", 10, "GB", "GB", True, 0),
            ("b", "c1", "2024-01-01 10:00:00", 20, "GB", "GB", True, 0)]
    a = {r["transaction_id"]: r for r in ST.asof_state(tx_rows(spark, rows)).collect()}
    assert a["b"]["prior_count"] == 1 and a["b"]["prior_amount_mean"] == 10.0
    assert a["a"]["prior_count"] == 0


def test_latest_state_and_upsert(spark):
    from fraudspark.operators.features import build_features

    rows = [("a", "c1", "2024-01-01 09:00:00", 10, "GB", "GB", True, 0),
            ("b", "c1", "2024-01-01 10:00:00", 20, "GB", "GB", True, 0),
            ("c", "c2", "2024-01-01 11:00:00", 5, "GB", "GB", True, 0)]
    f = build_features(tx_rows(spark, rows))
    latest = {r["customer_id"]: r for r in ST.latest_customer_state(f).collect()}
    assert latest["c1"]["transaction_id"] == "b" and latest["c1"]["txn_count_24h"] == 2
    old = ST.latest_customer_state(f.filter("transaction_id = 'b'"))
    late = ST.latest_customer_state(f.filter("transaction_id = 'a'"))  # older backfill
    up = ST.state_upsert(old, late).first()
    assert up["transaction_id"] == "b"
    ids = spark.createDataFrame([("c1",), ("nobody",)], "customer_id string")
    lk = {r["customer_id"]: r for r in ST.state_lookup(ids, ST.latest_customer_state(f)).collect()}
    assert lk["nobody"]["txn_count_24h"] is None


def test_state_features_from_explicit_state(spark):
    hist = tx_rows(spark, [("a", "c1", "2024-01-01 09:00:00", 10, "GB", "GB", True, 0),
                           ("b", "c1", "2024-01-01 10:00:00", 20, "GB", "GB", True, 0)])
    st = ST.state_fold(hist)
    ev = tx_rows(spark, [("n", "c1", "2024-01-01 10:30:00", 30, "GB", "GB", True, 0),
                         ("m", "new", "2024-01-01 10:30:00", 7, "GB", "GB", True, 0)])
    f = {r["transaction_id"]: r for r in ST.state_features(ev, st).collect()}
    assert f["n"]["txn_count_1h"] == 2 and f["n"]["seconds_since_prev_txn"] == 1800.0
    assert f["n"]["customer_amount_mean_prior"] == 15.0 and f["n"]["amount_sum_24h"] == 60.0
    assert f["m"]["customer_amount_mean_prior"] == 7.0 and f["m"]["seconds_since_prev_txn"] == S.NO_PRIOR_TRANSACTION


def test_skew_check_is_clean_on_tie_free_data(spark):
    from conftest import SF_SMALL
    from fraudspark.operators.features import build_features
    from fraudspark.sources.adapter import load_transactions

    tx = load_transactions(spark, SF_SMALL)
    sk = ST.skew_check(build_features(tx), ST.serving_features_batch(tx))
    assert sk.agg(F.sum("n_mismatch")).first()[0] == 0
    assert sk.agg(F.min("n_compared")).first()[0] == tx.count()


def test_hot_customer_serving_plan_equals_plain_plan(spark):
    from conftest import SF_SMALL
    from fraudspark.sources.adapter import load_transactions

    tx = load_transactions(spark, SF_SMALL)
    plain = ST.serving_features_batch(tx, hot_customer_rows=None).select("transaction_id", *S.FEATURES)
    hot = ST.serving_features_batch(tx, hot_customer_rows=0, n_ranges=7).select(
        "transaction_id", *S.FEATURES)
    j = plain.alias("p").join(hot.alias("h"), "transaction_id")
    assert j.count() == plain.count() == hot.count()
    for c in S.FEATURES:
        bad = j.filter(~(F.abs(F.col(f"p.{c}").cast("double") - F.col(f"h.{c}").cast("double")) <= 1e-9))
        assert bad.count() == 0, c


def test_hot_plan_applies_the_cap(spark):
    import datetime as dt
    from decimal import Decimal

    base = dt.datetime(2024, 1, 1)
    rows = [(f"x{i:03d}", "c", base + dt.timedelta(minutes=i), Decimal(i % 7 + 1), "m", "g", "GB", "GB", True, 0)
            for i in range(150)]
    from conftest import RAW_DDL

    tx = spark.createDataFrame(rows, RAW_DDL)
    cap = 20
    plain = {r["transaction_id"]: r for r in
             ST.serving_features_batch(tx, max_events=cap, hot_customer_rows=None).collect()}
    hot = {r["transaction_id"]: r for r in
           ST.serving_features_batch(tx, max_events=cap, hot_customer_rows=0, n_ranges=7).collect()}
    assert plain["x149"]["txn_count_24h"] == cap + 1
    for t in plain:
        for c in ("txn_count_1h", "txn_count_24h", "amount_sum_24h", "customer_amount_mean_prior",
                  "seconds_since_prev_txn"):
            assert abs(plain[t][c] - hot[t][c]) < 1e-9, (t, c)


def test_approx_profile_is_close_to_exact(spark):
    ref = frame(spark, n=4000)
    exact = {(r["feature"], r["bin_no"]): r for r in DR.build_reference(ref, ["x"]).collect()}
    approx = {(r["feature"], r["bin_no"]): r for r in DR.build_reference(ref, ["x"], quantiles="approx").collect()}
    assert set(exact) == set(approx)
    for k in exact:
        assert abs(exact[k]["ref_prop"] - approx[k]["ref_prop"]) < 0.01
    with pytest.raises(ValueError):
        DR.build_reference(ref, ["x"], quantiles="fast")
