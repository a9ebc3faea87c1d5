import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from fraudspark.operators import features as FE
from fraudspark.operators import metrics as ME
from fraudspark.operators import split as SP
from fraudspark.operators.ordering import exact_quantiles, global_rank
from fraudspark.sources.adapter import load_transactions


def scored(spark, y, s, amounts=None, variant="A"):
    amounts = amounts or [0] * len(y)
    rows = [(i, variant, float(si), int(yi), Decimal(str(a))) for i, (yi, si, a) in enumerate(zip(y, s, amounts))]
    return spark.createDataFrame(rows, "transaction_id bigint, variant string, score double, label bigint, amount decimal(18,2)")


def thr(spark, t, variant="A"):
    return spark.createDataFrame([(variant, float(t))], "variant string, threshold double")


def cost(spark, y, pred, amounts=None, fp=5.0, fn=100.0):
    cm = ME.CostModel(false_positive_cost=fp, false_negative_cost=fn)
    rows = [(int(a), int(b), Decimal(str(c))) for a, b, c in zip(y, pred, amounts or [0] * len(y))]
    df = spark.createDataFrame(rows, "label bigint, pred bigint, amount decimal(18,2)")
    return ME.business_cost(df, cm, use_amounts=amounts is not None).first()[0]


def test_business_cost_fixtures(spark):
    assert cost(spark, [0, 1, 0, 1], [0, 1, 0, 1], [1, 1, 1, 1]) == 0
    assert cost(spark, [0, 1], [0, 0], [10, 500]) == 500
    assert cost(spark, [0, 1], [1, 1], [0, 0], fp=7) == 7
    assert cost(spark, [1, 1, 0], [0, 0, 1], None, fp=2, fn=100) == 202
    assert cost(spark, [0, 0, 0, 1], [1, 1, 1, 1], [1, 1, 1, 1]) == 15
    with pytest.raises(ValueError):
        ME.CostModel(false_positive_cost=-1)


def test_optimal_threshold_picks_highest_zero_cost(spark):
    s = scored(spark, [0, 0, 1, 1], [.1, .2, .8, .9], [10, 10, 1000, 1000])
    r = ME.optimal_threshold(s).first()
    assert r["cost"] == 0 and r["threshold"] == 0.8


def test_worthless_fraud_flags_nothing(spark):
    s = scored(spark, [0, 0, 1], [.2, .3, .9], [0, 0, 0])
    r = ME.optimal_threshold(s, ME.CostModel(false_positive_cost=10, false_negative_cost=0)).first()
    assert r["block_none"] and r["threshold"] > 0.9


def test_evaluate_fixture_and_cost_per_1000(spark):
    e = ME.evaluate(scored(spark, [1, 1, 0, 0], [.9, .1, .8, .2], [1, 1, 1, 1]), thr(spark, .5)).first()
    assert (e["true_positives"], e["false_negatives"], e["false_positives"]) == (1, 1, 1)
    e2 = ME.evaluate(scored(spark, [0, 1], [.9, .1], [10, 90]), thr(spark, .5)).first()
    assert e2["cost_per_1000"] == 47500


def test_curves_match_brute_force(spark):
    import random

    rnd = random.Random(3)
    y = [rnd.random() < .3 for _ in range(300)]
    s = [round(rnd.random(), 2) for _ in range(300)]  # many ties
    c = ME.curve_metrics(scored(spark, [int(v) for v in y], s)).first()
    pos = [si for si, yi in zip(s, y) if yi]
    neg = [si for si, yi in zip(s, y) if not yi]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert abs(c["roc_auc"] - auc) < 1e-12
    # step-wise average precision
    ap = 0.0
    for t in sorted(set(s), reverse=True):
        tp = sum(1 for si, yi in zip(s, y) if yi and si >= t)
        fp = sum(1 for si, yi in zip(s, y) if not yi and si >= t)
        new = sum(1 for si, yi in zip(s, y) if yi and si == t)
        ap += new / len(pos) * tp / (tp + fp)
    assert abs(c["pr_auc"] - ap) < 1e-12


def test_single_class_gives_nan(spark):
    c = ME.curve_metrics(scored(spark, [0, 0, 0], [.1, .2, .3])).first()
    assert math.isnan(c["roc_auc"]) and math.isnan(c["pr_auc"])


def paired(spark, n, invert=False):
    rows = []
    for i in range(n):
        y = 1 if i % 10 == 0 else 0
        a = 0.9 if y else 0.1
        b = (0.1 if y else 0.9) if invert else a
        rows.append((i, y, Decimal("100.00"), a, b))
    return spark.createDataFrame(rows, "transaction_id bigint, label bigint, amount decimal(18,2), score_A double, score_B double")


def test_bootstrap_same_scores_is_zero(spark):
    r = ME.bootstrap_cost_difference(paired(spark, 200), {"A": .5, "B": .5}).first()
    assert (r["point"], r["lower"], r["upper"]) == (0.0, 0.0, 0.0)


def test_bootstrap_inverted_is_positive_difference_and_deterministic(spark):
    # A is perfect, B inverted -> A - B < 0 in cost
    p = paired(spark, 200, invert=True)
    r1 = ME.bootstrap_cost_difference(p, {"A": .5, "B": .5}).first()
    r2 = ME.bootstrap_cost_difference(p, {"A": .5, "B": .5}).first()
    assert r1 == r2
    assert r1["point"] < 0 and r1["upper"] < 0 and r1["lower"] <= r1["point"] <= r1["upper"]
    wide = ME.bootstrap_cost_difference(p, {"A": .5, "B": .5}, confidence=0.99).first()
    assert wide["lower"] <= r1["lower"] and wide["upper"] >= r1["upper"]
    v = ME.ab_verdict(ME.bootstrap_cost_difference(p, {"A": .5, "B": .5})).first()
    assert v["significant"] and v["winner"] == "A"


def test_global_rank_is_a_permutation(spark):
    df = spark.range(5000).withColumn("k", (F.col("id") * 7919) % 5000)
    for buckets in (1, 16, 200, None):  # the result does not depend on the number of ranges
        r = global_rank(df, ["k", "id"], n_buckets=buckets)
        got = sorted((row["k"], row["rank"]) for row in r.collect())
        assert [rk for _, rk in got] == list(range(1, 5001))


def test_exact_quantiles_equal_numpy(spark):
    import numpy as np

    vals = [float(x) for x in np.random.default_rng(1).normal(size=2001).round(3)]
    df = spark.createDataFrame([("f", v) for v in vals], "g string, v double")
    probs = list(np.linspace(0, 1, 11))
    for buckets in (1, 8, 200, None):
        q = sorted((r["q_index"], r["quantile"])
                   for r in exact_quantiles(df, "g", "v", probs, n_buckets=buckets).collect())
        assert np.allclose([x for _, x in q], np.quantile(np.array(vals), probs), rtol=0, atol=1e-12)


def test_temporal_split_sizes_order_and_guards(spark):
    f = FE.build_features(load_transactions(spark, SF_SMALL))
    sp = SP.temporal_split(f)
    n = sp.count()
    sizes = {r["split"]: r["n_rows"] for r in SP.split_stats(sp).collect()}
    assert sizes == dict(zip(("train", "validation", "test"), SP.split_sizes(n, .2, .25)))
    edge = SP.temporal_rank(sp).groupBy("split").agg(F.min("time_rank").alias("lo"), F.max("time_rank").alias("hi")).collect()
    e = {r["split"]: (r["lo"], r["hi"]) for r in edge}
    assert e["train"][1] + 1 == e["validation"][0] and e["validation"][1] + 1 == e["test"][0]
    t = sp.groupBy("split").agg(F.min("event_time").alias("a"), F.max("event_time").alias("b")).collect()
    t = {r["split"]: (r["a"], r["b"]) for r in t}
    assert t["train"][1] <= t["validation"][0] and t["validation"][1] <= t["test"][0]
    assert "is_fraud" not in [c for c in f.columns if c in ("amount_log",)]
    with pytest.raises(SP.DatasetError):
        SP.temporal_split(f, test_fraction=1.5)
    with pytest.raises(SP.DatasetError, match="at least 10"):
        SP.temporal_split(f.limit(5))
    assert SP.split_sizes(10, 0.25, 0.25) == (6, 2, 2)  # round half to even: 2.5 -> 2


def test_global_rank_with_a_hot_leading_value(spark):
    # 40% of rows share one leading value: the tuple bounds still split them
    df = spark.range(6000).withColumn("k", F.when(F.col("id") % 5 < 2, F.lit(7)).otherwise(F.col("id") % 97))
    df = df.withColumn("c", (F.col("id") * 31) % 1000)
    r = global_rank(df, ["k", "c", "id"], n_buckets=16)
    got = [row["id"] for row in r.orderBy("rank").collect()]
    want = [row["id"] for row in df.orderBy("k", "c", "id").collect()]
    assert got == want
    ranges = df.repartitionByRange(16, "k", "c", "id").groupBy(F.spark_partition_id()).count()
    assert max(row[1] for row in ranges.collect()) < 6000 * 0.2  # no range holds the hot value's 40%


def test_bootstrap_interval_does_not_depend_on_rows_per_block(spark):
    """A mean difference far from zero: few large blocks against about one row a block."""
    df = spark.range(20000).select(
        F.col("id").alias("transaction_id"), (F.col("id") % 4 == 0).cast("int").alias("label"),
        (F.lit(5.0) + F.col("id") % 7).alias("amount"), F.lit(0.9).alias("score_A"), F.lit(0.1).alias("score_B"))
    width = []
    for blocks in (200, 1 << 16):
        r = ME.bootstrap_cost_difference(df, {"A": .5, "B": .5}, n_blocks=blocks, n_resamples=400).first()
        assert r["lower"] < r["point"] < r["upper"]
        width.append(r["upper"] - r["lower"])
    assert 0.8 < width[0] / width[1] < 1.25
