"""Radix selection against sorting."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fraudspark.operators import selection as SE


@pytest.fixture(scope="module")
def values(spark):
    rng = np.random.default_rng(3)
    n = 3000
    columns = {
        "normal": rng.normal(size=n), "tiny": rng.normal(size=n) * 1e-300, "huge": rng.normal(size=n) * 1e300,
        "hot": np.where(rng.random(n) < 0.4, 7.25, rng.normal(size=n)), "small": rng.integers(-2, 3, n).astype(float),
        "zeros": np.where(rng.random(n) < 0.5, 0.0, -0.0), "one": np.full(n, 3.5),
    }
    rows = [tuple(float(c[i]) for c in columns.values()) for i in range(n)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns))
    gaps = df.withColumn("gaps", F.when(F.col("normal") > 0, F.col("normal"))).withColumn("none", F.lit(None).cast("double"))
    columns["gaps"] = columns["normal"][columns["normal"] > 0]
    return columns, gaps.repartition(7)


def test_codes_keep_the_order_of_doubles():
    x = np.array([-np.inf, -1e300, -1.5, -5e-324, -0.0, 0.0, 5e-324, 1.0, 1.0000000000000002, np.inf])
    code = SE.codes_of(x)
    assert (np.diff(code.astype(object)) >= 0).all() and code[4] == code[5] and len(np.unique(code)) == 9
    assert [SE.value_of(int(c)) for c in code] == [0.0 if v == 0 else v for v in x]


def test_summaries_stop_at_the_limit(values):
    columns, df = values
    rows, got = SE.summaries(df, [*columns, "none"], 10)
    assert rows == 3000 and got["none"].n == 0
    for c, x in columns.items():
        assert got[c].n == len(x) and len(got[c].distinct) == min(11, len(np.unique(x)))
        assert SE.value_of(got[c].low) == x.min() and SE.value_of(got[c].high) == x.max()
    assert SE.summaries(df.limit(0), ["normal"], 10)[0] == 0


def test_order_statistics_equal_sorting(values):
    columns, df = values
    _, known = SE.summaries(df, list(columns), 10)
    ranks = {c: [0, 1, len(x) // 3, len(x) // 2, len(x) // 2, len(x) - 1] for c, x in columns.items()}
    got = SE.order_statistics(df, ranks, known)
    for c, x in columns.items():
        assert [got[c][r] for r in ranks[c]] == [float(np.sort(x)[r]) for r in ranks[c]]
    many = {"hot": list(range(0, 3000, 11))}
    found = SE.order_statistics(df, many, known)["hot"]
    assert [found[r] for r in many["hot"]] == np.sort(columns["hot"])[::11].tolist()


def test_quantiles_equal_numpy(values):
    columns, df = values
    _, known = SE.summaries(df, list(columns), 10)
    probs = np.linspace(0, 1, 11)
    got = SE.quantiles(df, probs, known)
    for c, x in columns.items():
        assert np.allclose(got[c], np.quantile(x, probs), rtol=1e-12, atol=0)


def in_order(r):
    return [(v is not None, v if v is not None else 0) if not isinstance(v, str) else (True, v.encode()) for v in r]


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("kinds", ["bigint", "text"])
def test_rows_at_or_before_a_rank(spark, hot, kinds):
    rng = random.Random(6)
    names = ["", "a", "a\0", "ab", "long name of a customer", "long name of a customer!", "é", "漢字", "z" * 30]
    rows = []
    for i in range(900):
        at = dt.datetime(2024, 1, 1) + dt.timedelta(microseconds=0 if hot and i % 3 else rng.randrange(10**10))
        who = rng.choice([None, *(names if kinds == "text" else range(-4, 5))])
        rows.append((at, who, f"t{i % 450}" if kinds == "text" else i % 450))
    kind = "string" if kinds == "text" else "bigint"
    df = spark.createDataFrame(rows, f"at timestamp_ntz, who {kind}, id {kind}").repartition(5)
    ordered = sorted(((r[0], *[x for v in in_order(r[1:]) for x in v]) for r in rows))
    ranks = [-3, 0, 1, 250, 600, 899, 900, 1000]
    conditions = SE.at_or_before(df, ["at", "who", "id"], ranks, 900)
    got = df.agg(*[F.count_if(c) for c in conditions]).first()
    for r, n in zip(ranks, got, strict=True):
        want = 0 if r < 1 else sum(o <= ordered[min(r, 900) - 1] for o in ordered)
        assert n == want, r
    with pytest.raises(TypeError):
        SE.at_or_before(df.withColumn("x", F.lit(1.5)), ["x"], [1], 900)
