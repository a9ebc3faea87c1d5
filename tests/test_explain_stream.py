import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from fraudspark import schema as S
from fraudspark.operators import explain as EX
from fraudspark.operators import features as FE
from fraudspark.operators import model as MO
from fraudspark.operators import split as SP
from fraudspark.operators import state as ST
from fraudspark.operators import trees as TR
from fraudspark.session import ensure_checkpoint_dir


def imp(spark, d):
    return spark.createDataFrame(list(d.items()), "feature string, importance double")


def shift(spark, a, b):
    return EX.importance_shift(imp(spark, a), imp(spark, b)).first()[0]


def test_importance_shift_fixtures(spark):
    assert abs(shift(spark, {"a": .5, "b": .5}, {"a": .75, "b": .25}) - .25) < 1e-12
    assert abs(shift(spark, {"a": 1.0}, {"a": 1.0, "b": 1.0}) - .5) < 1e-12
    assert abs(shift(spark, {"a": 1.0}, {"b": 1.0}) - 1.0) < 1e-12
    assert shift(spark, {"a": 1.0, "b": 2.0}, {"a": 1.0, "b": 2.0}) == 0.0
    with pytest.raises(EX.ExplainerError):
        shift(spark, {"a": 0.0}, {"a": 1.0})


def test_top_contributions_and_margin(spark):
    row = [("t", -2.0, [0.5, -3.0, 1.0])]
    df = spark.createDataFrame(row, "transaction_id string, base_value double, shap array<double>")
    names = ["a", "b", "c"]
    df = df.withColumn("attributions", F.transform("shap", lambda s, i: F.struct(
        F.element_at(F.array(*[F.lit(n) for n in names]), i + 1).alias("feature"), F.lit(0.0).alias("value"),
        s.alias("shap_value"), EX.direction(s).alias("direction"))))
    r = df.select(EX.top_contributions(k=2).alias("top"), EX.margin_of().alias("m")).first()
    assert [a["feature"] for a in r["top"]] == ["b", "c"]
    assert r["m"] == -3.5
    assert [a["direction"] for a in df.first()["attributions"]] == ["toward_fraud", "toward_genuine", "toward_fraud"]


def test_leaf_table_matches_brute_force_shapley():
    import itertools
    import math

    z = np.array([0.3, 0.6, 0.5])
    v = 2.0
    table = TR.leaf_table(v, z)
    m = len(z)
    for p in range(2 ** m):
        o = [(p >> j) & 1 for j in range(m)]

        def val(S):
            return v * np.prod([o[j] if j in S else z[j] for j in range(m)])

        for i in range(m):
            phi = 0.0
            others = [j for j in range(m) if j != i]
            for k in range(m):
                for Sset in itertools.combinations(others, k):
                    w = math.factorial(k) * math.factorial(m - k - 1) / math.factorial(m)
                    phi += w * (val(set(Sset) | {i}) - val(set(Sset)))
            assert abs(table[p, i] - phi) < 1e-12


def test_tree_shap_is_additive_and_feature_order_is_enforced(spark):
    from fraudspark.sources.adapter import load_transactions

    sp = SP.temporal_split(FE.build_features(load_transactions(spark, SF_SMALL)))
    m = MO.fit_variant(sp.filter("split = 'train'"), "B", scale_pos_weight=SP.scale_pos_weight_value(sp),
                       n_estimators=8)
    test = sp.filter("split = 'test'")
    sc = MO.score(m, test)
    attr = EX.attributions(test, m, ensure_checkpoint_dir(spark))
    err = EX.additivity_check(sc.join(attr, "transaction_id"))
    assert err < S.ADDITIVITY_TOLERANCE
    p = sc.agg(F.min("fraud_probability"), F.max("fraud_probability")).first()
    assert 0.0 <= p[0] <= p[1] <= 1.0
    with pytest.raises(S.SchemaValidationError):
        MO.feature_matrix(test.drop("amount_log"))
    with pytest.raises(MO.UnknownVariantError):
        MO.estimator_for("C")
    with pytest.raises(ValueError):
        MO.flag(sc, 1.5)
    nobody = MO.flag(sc, MO.Threshold(p[0] / 2, block_none=True))
    assert nobody.filter("is_flagged").count() == 0 and MO.flag(sc, p[0] / 2).filter("NOT is_flagged").count() == 0


def test_score_job_and_the_shift_of_explanations(spark):
    from fraudspark.plans import jobs as JB
    from fraudspark.sources import tables as TB
    from fraudspark.sources.adapter import load_transactions

    folder = ensure_checkpoint_dir(spark)
    path, out = TB.scratch_path(spark, "shift-features"), TB.scratch_path(spark, "shift-model")
    TB.append_features(FE.build_features(load_transactions(spark, SF_SMALL)), path)
    feats = TB.feature_rows(spark, path, "2024-01-01", "2024-02-01")
    sp = SP.temporal_split(feats)
    train = sp.filter("split = 'train'")
    m = MO.fit_variant(train, "A", scale_pos_weight=SP.scale_pos_weight_value(sp), n_estimators=3)
    # every row is scored once, whatever its id
    same = feats.limit(40).withColumn("transaction_id", F.pmod("transaction_id", F.lit(3)))
    scored = JB.score_job(same.withColumn("new_customer", F.lit(True)), m, "A", 0.5, folder=folder)
    assert scored.count() == 40 and scored.filter("new_customer AND size(shap) = 13").count() == 40
    assert EX.additivity_check(scored) < S.ADDITIVITY_TOLERANCE

    from fraudspark.operators import drift as DR

    TB.save_profile(DR.build_reference(train), out + "/profile")
    imp = EX.global_importance(EX.attributed(train, m, folder)).withColumn("variant", F.lit("A"))
    imp.write.parquet(out + "/importance")
    m.write().overwrite().save(out + "/model_A")

    def check(**kw):
        return JB.drift_check_job(spark, out + "/profile", path, "2024-01-20", "2024-02-01", **kw).first()

    r = check(model_path=out + "/model_A", importance_path=out + "/importance")
    assert 0 <= r["importance_shift"] <= 1
    assert r["n_current_rows"] == TB.feature_rows(spark, path, "2024-01-20", "2024-02-01").count()
    for broken in ({}, {"model_path": out + "/none", "importance_path": out + "/importance"},
                   {"model_path": out + "/model_A", "importance_path": out + "/none"},
                   {"model_path": out + "/model_A", "importance_path": out + "/importance", "variant": "B"}):
        b = check(**broken)
        assert b["importance_shift"] is None and b["drifted"] == r["drifted"]


def test_scored_late_and_rejected_events_are_all_events(spark):
    from conftest import tx_rows
    from fraudspark.streaming import scoring as SC

    folder = tempfile.mkdtemp(prefix="stream-side-", dir="/tmp")
    batches = [[(f"a{i}", f"c{i % 3}", f"2024-01-10 {i:02d}:00:00", i + 1, "GB", "GB", True, 0) for i in range(20)],
               [(f"b{i}", f"c{i % 3}", f"2024-01-12 {i:02d}:00:00", i + 1, "GB", "GB", True, 0) for i in range(20)],
               [("c0", "c1", "2024-01-01 00:00:00", 5, "GB", "GB", True, 0),   # behind the watermark
                ("c1", "c1", "2024-01-12 21:00:00", 5, "GBR", "GB", True, 0),  # breaks the contract
                ("c2", "c1", "2024-01-12 22:00:00", 5, "GB", "GB", True, 0),
                ("b3", "c0", "2024-01-12 03:00:00", 4, "GB", "GB", True, 0)]]  # repeats an event
    for i, rows in enumerate(batches):
        tx_rows(spark, rows).coalesce(1).write.parquet(f"{folder}/part-{i}")
        for f in os.listdir(f"{folder}/part-{i}"):
            if f.endswith(".parquet"):
                os.makedirs(f"{folder}/all", exist_ok=True)
                os.link(f"{folder}/part-{i}/{f}", f"{folder}/all/{i}.parquet")
    schema = tx_rows(spark, batches[0]).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/all")
    SC.run_stream(stream, f"{folder}/sink", f"{folder}/ck")
    scored, events = spark.read.parquet(f"{folder}/sink"), spark.read.schema(schema).parquet(f"{folder}/all")
    side = {r["transaction_id"]: r["reasons"] for r in SC.unscored(events, scored).collect()}
    assert side == {"c0": ["late"], "c1": ["country:not_2_letters"]}
    ids = [r[0] for r in scored.select("transaction_id").collect()]
    assert len(ids) == len(set(ids))
    assert set(ids) | set(side) == {r[0] for r in events.select("transaction_id").collect()}


def test_stream_equals_batch(spark):
    from fraudspark.sources.adapter import load_transactions
    from fraudspark.streaming import scoring as SC

    tx = load_transactions(spark, SF_SMALL)
    src = tempfile.mkdtemp(prefix="stream-src-", dir="/tmp")
    (tx.withColumn("_part", F.floor(F.dayofmonth("event_time") / 8)).repartition(1, "_part")
     .write.partitionBy("_part").parquet(src + "/p"))
    flat = tempfile.mkdtemp(prefix="stream-flat-", dir="/tmp")
    files = sorted(os.path.join(r, f) for r, _, fs in os.walk(src) for f in fs if f.endswith(".parquet"))
    for i, f in enumerate(files):
        os.link(f, os.path.join(flat, f"part-{i:03d}.parquet"))
    stream = spark.readStream.schema(tx.schema).option("maxFilesPerTrigger", 1).parquet(flat)
    out = tempfile.mkdtemp(prefix="stream-out-", dir="/tmp")
    q = SC.run_stream(stream, out + "/o", out + "/ck", contract=False)
    assert len(q.recentProgress) >= 2
    got = spark.read.parquet(out + "/o")
    batch = ST.serving_features_batch(tx)
    a = got.select("transaction_id", *S.FEATURES)
    b = batch.select("transaction_id", *S.FEATURES)
    assert a.count() == tx.count()
    assert a.exceptAll(b).count() == 0


def test_entry_contract():
    import __spark_entry__ as E

    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(qs) >= 80


def test_late_events_do_not_depend_on_the_ranges(spark):
    import datetime as dt
    from decimal import Decimal

    from conftest import RAW_DDL
    from fraudspark.streaming import scoring as SC

    base = dt.datetime(2024, 1, 1)
    # arrival order = id (text); every 10th event arrives 3 hours late
    rows = [(f"{i:03d}", "1" if i < 300 else "2", base + dt.timedelta(minutes=i - (180 if i % 10 == 0 else 0)),
             Decimal(1), "m", "g", "GB", "GB", True, 0) for i in range(400)]
    tx = spark.createDataFrame(rows, RAW_DDL)
    newest, expected = {}, {}
    for tid, customer, t, *_ in rows:
        if customer in newest and newest[customer] - t > dt.timedelta(hours=1):
            expected[tid] = (newest[customer] - t) // dt.timedelta(microseconds=1)
        newest[customer] = max(t, newest.get(customer, t))
    assert len(expected) == 38  # 010 ... 390 except the first arrival of each customer
    for n in (1, 8, 60):
        late = SC.late_events(tx, 3600 * 10**6, n_ranges=n)
        assert {r["transaction_id"]: r["late_by_us"] for r in late.collect()} == expected


def test_fold_ties_and_late_events_see_only_what_is_before_them():
    from fraudspark.streaming import scoring as SC

    import pandas as pd

    class State:
        exists, get = False, None

        def update(self, value):
            self.exists, self.get = True, value

    def fold(state, rows):
        batch = pd.DataFrame(rows, columns=["transaction_id", "_us", "_cents"])
        (out,) = SC.fold_customer(("c",), iter([batch]), state)
        return [(r.txn_count_24h, r.amount_sum_24h, r.customer_amount_mean_prior) for r in out.itertuples()]

    hour = 3600 * 10**6
    state = State()
    assert fold(state, [("a", 10 * hour, 2000), ("b", 10 * hour, 3000), ("c", 10 * hour, 4000)]) == [
        (1, 20.0, 20.0), (1, 30.0, 30.0), (1, 40.0, 40.0)]
    # 09:30 comes after 10:00: nothing was before it
    assert fold(state, [("d", int(9.5 * hour), 500)]) == [(1, 5.0, 5.0)]
    assert fold(state, [("e", 11 * hour, 100)]) == [(5, 96.0, 23.75)]


@pytest.mark.parametrize("name", ["fit_variant", "train_job"])
def test_model_queries_fit_the_whole_ensemble(spark, monkeypatch, name):
    from fraudspark.plans import catalog

    class Seen(Exception):
        pass

    def fit(train, variant, *, scale_pos_weight, n_estimators=None):
        raise Seen(MO.estimator_for(variant, n_estimators).getStages()[-1].getMaxIter())

    monkeypatch.setattr(MO, "fit_variant", fit)
    monkeypatch.setattr(catalog, "_MODEL_CACHE", {})
    with pytest.raises(Seen) as seen:
        catalog.QUERIES[name](spark, SF_SMALL)
    assert seen.value.args == (300,) == (MO.SHARED["n_estimators"],)


def test_variants_are_fitted_side_by_side(spark, monkeypatch):
    import threading

    both = threading.Barrier(len(MO.VARIANTS), timeout=20)

    def fit(train, variant, *, scale_pos_weight, n_estimators=None):
        both.wait()
        return variant, train.count(), scale_pos_weight, n_estimators

    monkeypatch.setattr(MO, "fit_variant", fit)
    got = MO.fit_variants(spark.range(3), scale_pos_weight=2.0, n_estimators=4)
    assert list(got) == list(MO.VARIANTS) and got == {v: (v, 3, 2.0, 4) for v in MO.VARIANTS}


@pytest.mark.parametrize("sample_rows", [None, 100])
def test_shift_of_explanations_takes_all_current_rows(spark, monkeypatch, sample_rows):
    from fraudspark.plans import jobs as JB

    class Seen(Exception):
        pass

    def attributed(rows, model, folder):
        raise Seen(rows.count())

    monkeypatch.setattr(EX, "attributed", attributed)
    with pytest.raises(Seen) as seen:
        JB.explanation_shift(None, spark.range(3000).withColumnRenamed("id", "transaction_id"), None, folder="",
                             **({} if sample_rows is None else {"sample_rows": sample_rows}))
    assert seen.value.args == (sample_rows or 3000,)
