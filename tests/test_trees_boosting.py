"""Node-table ensembles against enumeration, leaf-wise boosting against a plain numpy version."""

import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fraudspark import schema as S
from fraudspark.operators import boosting as B
from fraudspark.operators import model as MO
from fraudspark.operators import trees as TR
from fraudspark.plans import catalog


def random_nodes(rng, trees=5, features=4, depth=4):
    rows = []
    for t in range(trees):
        nodes = [[0, 64.0]]
        i = 0
        while i < len(nodes):
            level, cover = nodes[i][:2]
            if level < depth and cover > 2 and rng.random() < 0.8:
                part = float(rng.integers(1, int(cover)))
                nodes[i] += [int(rng.integers(features)), float(rng.normal()), len(nodes), len(nodes) + 1]
                nodes += [[level + 1, part], [level + 1, cover - part]]
            i += 1
        for n, x in enumerate(nodes):
            rows.append((t, n, *(x[2:] if len(x) > 2 else (-1, 0.0, -1, -1)), float(rng.normal()), x[1]))
    return pd.DataFrame(rows, columns=TR.NODE_SCHEMA.names)


def expected(nodes, tree, x, known):
    """Value of one tree where only the features in `known` are known."""
    byid = {r.node: r for r in nodes[nodes.tree == tree].itertuples()}

    def walk(r):
        if r.feature < 0:
            return r.value
        a, b = byid[r.left], byid[r.right]
        if r.feature in known:
            return walk(a if x[r.feature] <= r.threshold else b)
        return (a.cover * walk(a) + b.cover * walk(b)) / r.cover

    return walk(byid[0])


def test_attributions_are_shapley_values_of_the_trees():
    rng = np.random.default_rng(4)
    nodes = random_nodes(rng)
    e = TR.Ensemble(nodes, bias=0.5)
    x = rng.normal(size=(7, 4))
    phi, margin = e.attributions(x), e.margins(x)
    for i, row in enumerate(x):
        def total(known):
            return sum(expected(nodes, t, row, known) for t in range(5))

        assert abs(margin[i] - 0.5 - total({0, 1, 2, 3})) < 1e-12
        assert abs(e.base_value - 0.5 - total(set())) < 1e-12
        for f in range(4):
            want = sum(math.factorial(k) * math.factorial(3 - k) / 24 * (total({*s, f}) - total(set(s)))
                       for k in range(4) for s in itertools.combinations([g for g in range(4) if g != f], k))
            assert abs(phi[i, f] - want) < 1e-9


def full_nodes(rng, trees, depth, features):
    rows, n = [], 2 ** depth - 1
    for t in range(trees):
        cover = [1000.0]
        for i in range(2 * n + 1):
            if i < n:
                left = cover[i] * rng.uniform(0.2, 0.8)
                cover += [left, cover[i] - left]
                rows.append((t, i, int(rng.integers(features)), float(rng.normal()), 2 * i + 1, 2 * i + 2, 0.0, cover[i]))
            else:
                rows.append((t, i, -1, 0.0, -1, -1, float(rng.normal()), cover[i]))
    return pd.DataFrame(rows, columns=TR.NODE_SCHEMA.names)


@pytest.mark.parametrize("depth", [6, 10])
def test_attributions_of_full_trees_look_up_a_line_for_many_leaves(depth):
    """A tree of the variants' depth has 64 leaves in at most 16 tables; leaves that are too deep keep their own."""
    rng = np.random.default_rng(11)
    e = TR.Ensemble(full_nodes(rng, 2, depth, 5))
    trees = e.paths()[0]
    assert all(len(t.blocks) <= 16 and len(t.leaves) == (0 if depth == 6 else 1024) for t in trees)
    x = rng.normal(size=(5, 7))
    x[0, 0], x[1, 1], x[2, 2] = np.nan, np.inf, e.threshold[e.feature == 2][0]
    phi = e.attributions(x)
    assert np.allclose(phi.sum(axis=1) + e.base_value, e.margins(x), atol=1e-9) and not phi[:, 5:].any()
    for i, row in enumerate(x[:2] if depth == 10 else x):
        def total(known):
            return sum(expected(e.nodes, t, row, known) for t in range(2))

        values = {s: total(set(s)) for k in range(6) for s in itertools.combinations(range(5), k)}
        for f in range(5):
            want = sum(math.factorial(len(s)) * math.factorial(4 - len(s)) / 120
                       * (values[tuple(sorted((*s, f)))] - values[s]) for s in values if f not in s)
            assert abs(phi[i, f] - want) < 1e-9


def test_missing_values_go_right_and_bad_tables_are_rejected():
    nodes = pd.DataFrame([(0, 0, 0, 1.0, 1, 2, 0.0, 4.0), (0, 1, -1, 0.0, -1, -1, -1.0, 1.0),
                          (0, 2, -1, 0.0, -1, -1, 1.0, 3.0)], columns=TR.NODE_SCHEMA.names)
    e = TR.Ensemble(nodes)
    assert e.margins(np.array([[0.5], [1.0], [2.0], [np.nan]])).tolist() == [-1, -1, 1, 1]
    assert e.base_value == 0.5
    with pytest.raises(TR.EnsembleError):
        TR.Ensemble(nodes.drop(columns="cover"))
    with pytest.raises(TR.EnsembleError):
        TR.Ensemble(nodes.iloc[[0, 2]])
    with pytest.raises(TR.EnsembleError):
        TR.Ensemble(nodes.assign(left=0))


def test_evaluated_keeps_rows_and_saved_models_come_back(spark):
    from fraudspark.sources.tables import scratch_path

    e = catalog.fixed_ensemble("A")
    rows = spark.range(9).select((F.col("id") % 2).alias("transaction_id"), F.lit("x").alias("margin"),
                                 *[(F.col("id") * (i + 1)).cast("double").alias(c) for i, c in enumerate(S.FEATURES)])
    out = TR.evaluated(rows.repartition(3), e, margin="margin", probability="p", shap=True)
    assert out.columns == ["transaction_id", *S.FEATURES, "margin", "p", "base_value", "shap"]
    got = out.toPandas()
    assert len(got) == 9
    x = got[S.FEATURES].to_numpy()
    assert np.allclose(got["margin"], e.margins(x)) and np.allclose(got["p"], 1 / (1 + np.exp(-got["margin"])))
    assert np.allclose(got["base_value"] + [sum(s) for s in got["shap"]], got["margin"], atol=1e-12)
    assert TR.evaluated(rows.limit(0), e, margin="m").count() == 0
    path = scratch_path(spark, "ensemble")
    MO.save_model(spark, e, path)
    back = MO.load_model(spark, path)
    assert back.bias == e.bias and back.nodes.equals(e.nodes)


# boosting


def plain_fit(x, label, weight, key, plan):
    """Leaf-wise boosting on arrays, one leaf at a time: every split of every leaf is looked at anew."""
    edges = [np.unique(np.percentile(c, np.arange(1, plan.max_bins) / plan.max_bins * 100, method="inverted_cdf"))
             for c in x.T]
    bins = np.stack([np.searchsorted(e, c) for e, c in zip(edges, x.T)], axis=1)
    share = (label * weight).sum() / weight.sum()
    bias = float(np.log(share / (1 - share)))
    margin, rows = np.full(len(x), bias), []
    for tree in range(plan.n_trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = np.rint(weight * (p - label) * B.SCALE), np.rint(weight * p * (1 - p) * B.SCALE)
        on, used = B.sampled(key, tree, plan), B.columns_of(tree, x.shape[1], plan)

        def best(members):
            found = (0.0, 0, 0)
            for f in used:
                for cut in range(max(len(e) for e in edges) + 1):
                    left = members & (bins[:, f] <= cut)
                    right = members & ~left
                    if min(left.sum(), right.sum()) < plan.min_rows or \
                            min(h[left].sum(), h[right].sum()) < plan.min_hessian * B.SCALE:
                        continue
                    gain = sum(s * g[m].sum() ** 2 / max(h[m].sum(), 1) for s, m in ((1, left), (1, right), (-1, members)))
                    if gain / B.SCALE > found[0] + 1e-9 * found[0]:
                        found = (gain / B.SCALE, f, cut)
            return found

        nodes = [{"m": on, "every": np.ones(len(x), bool), "depth": 0}]
        leaves = 1
        for n in nodes:
            n["split"] = best(n["m"])
        while leaves < plan.max_leaves:
            open_ = [(-n["split"][0], i) for i, n in enumerate(nodes) if "left" not in n and n["split"][0] > 0]
            if not open_:
                break
            n = nodes[min(open_)[1]]
            _, f, cut = n["split"]
            n["left"] = len(nodes)
            for side in (bins[:, f] <= cut, bins[:, f] > cut):
                child = {"m": n["m"] & side, "every": n["every"] & side, "depth": n["depth"] + 1}
                child["split"] = best(child["m"]) if child["depth"] < plan.max_depth else (0.0, 0, 0)
                nodes.append(child)
            leaves += 1
        for i, n in enumerate(nodes):
            value = -plan.learning_rate * g[n["m"]].sum() / max(h[n["m"]].sum(), 1)
            if "left" in n:
                _, f, cut = n["split"]
                at = edges[f][cut] if cut < len(edges[f]) else np.inf
                rows.append((tree, i, f, at, n["left"], n["left"] + 1, 0.0, n["m"].sum()))
            else:
                rows.append((tree, i, -1, 0.0, -1, -1, value, n["m"].sum()))
                margin = margin + np.where(n["every"], value, 0.0)
    return pd.DataFrame(rows, columns=TR.NODE_SCHEMA.names), bias


@pytest.fixture(scope="module")
def training(spark):
    rng = np.random.default_rng(8)
    x = np.stack([rng.normal(size=700), rng.integers(0, 5, 700), rng.exponential(size=700)], axis=1).round(3)
    label = (x[:, 0] + 0.6 * (x[:, 1] == 3) + 0.3 * x[:, 2] + 0.5 * rng.normal(size=700) > 1.2).astype(float)
    weight = np.where(label == 1, 2.5, 1.0)
    df = pd.DataFrame(x, columns=["a", "b", "c"]).assign(transaction_id=np.arange(700), label=label, weight=weight)
    return df, spark.createDataFrame(df)


@pytest.mark.parametrize("more", [{}, {"rows_per_task": 50, "fan_in": 3, "write_every": 2}, {"max_depth": 2}])
def test_leaf_wise_trees_equal_the_plain_version(spark, training, more):
    df, frame = training
    plan = B.Growth(n_trees=5, learning_rate=0.3, max_leaves=7, min_rows=10, max_bins=16, **more)
    got = B.fit(frame.repartition(4), ["a", "b", "c"], plan)
    key = np.array([r[0] for r in frame.orderBy("transaction_id").select(
        F.xxhash64(F.col("transaction_id").cast("string"))).collect()])
    want, bias = plain_fit(df[["a", "b", "c"]].to_numpy(), df["label"].to_numpy(), df["weight"].to_numpy(), key, plan)
    assert abs(got.bias - bias) < 1e-12
    exact = ["tree", "node", "feature", "left", "right", "cover"]
    assert got.nodes[exact].astype(float).to_numpy().tolist() == want[exact].astype(float).to_numpy().tolist()
    assert np.allclose(got.nodes[["threshold", "value"]], want[["threshold", "value"]], atol=1e-9)
    leaves = got.nodes[got.nodes.feature < 0].groupby("tree").size()
    assert leaves.max() <= (4 if more.get("max_depth") == 2 else 7) and leaves.max() > 2


def test_trees_do_not_depend_on_how_rows_are_dealt(spark, training):
    _, frame = training
    plans = [B.Growth(n_trees=3, max_leaves=9, min_rows=5, rows_per_task=n) for n in (40, 10**6)]
    a, b = (B.fit(frame.repartition(k), ["a", "b", "c"], p) for k, p in zip((1, 7), plans))
    assert a.nodes.equals(b.nodes)


def test_subtrees_grow_in_tasks_of_their_own(spark, training, monkeypatch):
    """Small samples: one job for the root's histogram and one for all below it, and the same trees as level by level."""
    jobs, sums, below = [], B._histograms, B._subtrees
    monkeypatch.setattr(B, "_histograms", lambda *a: jobs.append("level") or sums(*a))
    monkeypatch.setattr(B, "_subtrees", lambda *a: jobs.append("subtrees") or below(*a))
    plan = {"n_trees": 3, "max_leaves": 12, "min_rows": 5, "least_rows": 100, "colsample": 0.67}

    def fitted(**more):
        jobs.clear()
        return B.fit(training[1], ["a", "b", "c"], B.Growth(**plan, **more)).nodes

    moved = fitted()
    assert jobs == ["level", "subtrees"] * 3
    by_level = fitted(rows_moved=100)
    assert jobs.count("subtrees") == 0 and jobs.count("level") > 9
    later = fitted(rows_per_subtree=350)
    assert jobs.count("level") > 3 and 0 < jobs.count("subtrees") <= 3
    assert moved.equals(by_level) and moved.equals(later) and (moved.groupby("tree").size() > 15).all()


def test_a_fit_uses_every_core(spark, training, monkeypatch):
    tasks, sums = [], B._histograms

    def seen(data, n_parts, *rest):
        tasks.append((n_parts, data.getNumPartitions()))
        return sums(data, n_parts, *rest)

    monkeypatch.setattr(B, "_histograms", seen)
    B.fit(training[1], ["a", "b", "c"], B.Growth(n_trees=2, max_leaves=3, min_rows=5, least_rows=100))
    want = min(spark.sparkContext.defaultParallelism, 7)
    assert set(tasks) == {(want, want)}


@pytest.mark.parametrize("skew", [0.02, 0.5, 0.98])
def test_only_the_smaller_child_of_a_split_is_summed(skew):
    rng = np.random.default_rng(3)
    bins = np.where(rng.random((3000, 3)) < skew, rng.integers(0, 4, (3000, 3)), rng.integers(4, 8, (3000, 3))).astype(np.uint8)
    sums = tuple(np.rint(v * B.SCALE) for v in (rng.normal(size=3000) + bins[:, 0] + (bins[:, 1] > 4), np.ones(3000)))
    used, plan, summed = np.arange(3), B.Growth(min_rows=5, max_depth=4), []

    def hists(nodes, asked):
        at = B.Splits.of(nodes).descend(bins)
        parent = {c: n for n in nodes if n.left >= 0 for c in (n.left, n.right)}
        summed.extend((sum(at == c), parent[c].total[2]) for c in asked)
        return B.histogram(bins, B._slots(nodes, asked)[at], len(asked), sums, 8, used)

    nodes = B.split_all(B.histogram(bins, np.zeros(3000, int), 1, sums, 8, used)[0], used, plan, hists)
    assert len(summed) > 3 and all(2 * rows <= of for rows, of in summed)
    at = B.Splits.of(nodes).descend(bins)
    assert all(n.total.tolist() == [s[at == i].sum() for s in (*sums, np.ones(3000))]
               for i, n in enumerate(nodes) if n.left < 0)


def test_rows_reach_their_block_as_a_few_columns_of_bytes(spark, training):
    df, frame = training
    rows = B.binned(frame, ["a", "b", "c"], [np.array([0.0, 1.0])] * 3, "transaction_id").toArrow()
    packed = [r for b in B._packed(iter(rows.to_batches(100))) for r in b.to_pylist()]
    assert len(packed) <= 14
    (block,) = B._blocks((tuple(r.values()) for r in packed), 3, 0.5)
    assert block.key.tolist() == rows["key"].to_pylist() and block.label.tolist() == df["label"].tolist()
    assert block.weight.tolist() == df["weight"].tolist() and block.margin.tolist() == [0.5] * 700
    assert block.bins.tolist() == [list(r) for r in rows["bins"].to_pylist()]
    assert not list(B._blocks(iter([]), 3, 0.5))


def test_small_samples_take_few_tasks(spark, training, monkeypatch):
    """A task's rows are summed sooner than a task starts, so it gets up to 100 000 of them."""
    tasks, sums = [], B._histograms
    monkeypatch.setattr(B, "_histograms", lambda data, n_parts, *rest: tasks.append(n_parts) or sums(data, n_parts, *rest))
    many = training[1].crossJoin(spark.range(20)).withColumn("transaction_id", F.col("id") * 1000 + F.col("transaction_id"))
    B.fit(many, ["a", "b", "c"], B.Growth(n_trees=1, max_leaves=3))
    assert set(tasks) == {1}


def test_fit_needs_both_classes(spark, training):
    _, frame = training
    for rows in (frame.filter("label = 1"), frame.limit(0)):
        with pytest.raises(ValueError):
            B.fit(rows, ["a", "b", "c"], B.Growth(n_trees=1))


def test_a_level_reads_the_sample_alone_and_sums_small_features_together():
    rng = np.random.default_rng(5)
    n, sizes = 5000, [7, 200, 2, 24, 255, 3]
    bins = np.stack([rng.integers(0, s, n) for s in sizes], axis=1).astype(np.uint8)
    groups = B.together(sizes)
    assert groups == [(2, 5, 0, 3)] and not B.together([255, 100])
    rows = B.Rows(rng.integers(-2**62, 2**62, n), rng.integers(0, 2, n).astype(float), np.full(n, 2.5), bins,
                  rng.normal(size=n), B.coded(bins, sizes))
    plan, used = B.Growth(), np.array([0, 1, 2, 3, 5])
    sample = rows.for_tree(3, plan)
    on = B.sampled(rows.key, 3, plan)
    assert 0 < on.sum() < n and (sample.bins == bins[on]).all() and not hasattr(sample, "key")
    want = B.gradients(rows.margin[on], rows.label[on], rows.weight[on])
    assert all((s == w).all() and s.dtype == np.int32 for s, w in zip(sample.sums, want, strict=True))
    slot = rng.integers(-1, 3, len(sample.bins))
    for k in (0, 2):  # with rows enough for codes, and without
        some = sample if not k else sample.of(np.arange(400))
        at = slot[:len(some.bins)]
        got = some.histogram(at, 3, 256, used)
        for f in range(len(sizes)):
            for s, w in enumerate((*some.sums, np.ones(len(at)))):
                cell = np.zeros((3, 256))
                np.add.at(cell, (at[at >= 0], some.bins[at >= 0, f]), w[at >= 0])
                assert (got[:, f, :, s] == (cell if f in used else 0)).all()
    heavy = B.Rows(rows.key, rows.label, np.full(n, 500.0), bins, rows.margin).for_tree(3, plan)
    assert heavy.sums[0].dtype == np.float64  # too great for four bytes


def test_blocks_take_several_trees_at_once(spark, training):
    """The values of the trees since a block was held come in one after the other, whatever hold_every is."""
    plans = [B.Growth(n_trees=7, max_leaves=5, min_rows=5, hold_every=h, write_every=w) for h, w in ((1, 1), (3, 4), (50, 50))]
    one, *others = (B.fit(training[1], ["a", "b", "c"], p).nodes for p in plans)
    assert all(one.equals(o) for o in others)
