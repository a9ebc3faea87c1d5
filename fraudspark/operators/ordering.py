"""Global order without a one-partition window.

`ordered_prefix` gives running (inclusive) sums over a total order inside
each group. One plan at every size:

1. the rows are dealt by ranges of (group, order key) and written with their
   partition's number; Spark samples the bounds over the whole key, so a
   leading value shared by a third of all rows is split by the later columns,
   and the number of ranges follows spark.sql.shuffle.partitions and AQE;
2. per-range totals (at most ranges + groups rows) -> exclusive offsets with a
   window over that small table, broadcast back (size bound by construction);
3. running sums inside `Window.partitionBy(group, range)`.

The ranges are written because their numbers must be the same in steps 2 and 3.

`exact_quantiles` uses it to pick order statistics (numpy 'linear' rule)
without materialising a whole group in one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RANGE = "_pb"


def dealt_by_range(df: DataFrame, keys: Sequence[str], n_ranges: int | None = None) -> DataFrame:
    """df written by ranges of the whole key, with the range's number in `_pb`: numbers ascend with the key.

    Without `n_ranges` there are as many ranges as a shuffle has partitions.
    """
    from fraudspark.sources.tables import scratch_path

    dealt = df.repartitionByRange(n_ranges, *keys) if n_ranges else df.repartitionByRange(*keys)
    path = scratch_path(df.sparkSession, "ranges")
    dealt = dealt.withColumn(RANGE, F.spark_partition_id())
    dealt.write.parquet(path)
    return df.sparkSession.read.schema(dealt.schema).parquet(path)


def ordered_prefix(
    df: DataFrame,
    group_cols: Sequence[str],
    order_cols: Sequence[str],
    sum_cols: Sequence[str],
    *,
    n_buckets: int | None = None,
    prefix: str = "cum_",
) -> DataFrame:
    """Add `cum_<c>` = sum of c over rows <= this row in (order_cols) order, per group.

    The order must be total (ties broken by later order columns). `n_buckets`
    fixes the number of ranges; by default it is that of a shuffle. The result
    does not depend on it.
    """
    group_cols, order_cols, sum_cols = list(group_cols), list(order_cols), list(sum_cols)
    b = dealt_by_range(df, [*group_cols, *order_cols], n_buckets)
    totals = b.groupBy(*group_cols, "_pb").agg(*[F.sum(c).alias(f"_t_{c}") for c in sum_cols])
    wo = Window.orderBy("_pb") if not group_cols else Window.partitionBy(*group_cols).orderBy("_pb")
    wo = wo.rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *group_cols, "_pb", *[F.coalesce(F.sum(f"_t_{c}").over(wo), F.lit(0)).alias(f"_o_{c}") for c in sum_cols]
    )
    wi = Window.partitionBy(*group_cols, "_pb").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
    run = b.select("*", *[F.sum(c).over(wi).alias(f"_r_{c}") for c in sum_cols])
    # offsets: at most ranges + groups rows
    out = run.join(F.broadcast(offsets), [*group_cols, "_pb"], "left")
    out = out.select(
        *[F.col(c) for c in run.columns if not c.startswith("_r_") and c != "_pb"],
        *[(F.col(f"_o_{c}") + F.col(f"_r_{c}")).alias(f"{prefix}{c}") for c in sum_cols],
    )
    return out


def global_rank(df: DataFrame, order_cols: Sequence[str], *, n_buckets: int | None = None,
                name: str = "rank") -> DataFrame:
    """1-based rank in a total order over the whole frame (no unbounded single-task window)."""
    one = df.withColumn("_one", F.lit(1).cast("bigint"))
    out = ordered_prefix(one, [], order_cols, ["_one"], n_buckets=n_buckets)
    return out.withColumnRenamed("cum__one", name).drop("_one")


def exact_quantiles(
    values: DataFrame,
    group_col: str,
    value_col: str,
    probs: Sequence[float],
    *,
    count_col: str | None = None,
    n_buckets: int | None = None,
) -> DataFrame:
    """Exact linear-interpolated quantiles per group: (group, q_index, prob, quantile).

    `values` holds raw values, or distinct values with multiplicities in
    `count_col`. Nulls are ignored. Same rule as numpy's default ('linear').
    """
    v = values.filter(F.col(value_col).isNotNull())
    if count_col is None:
        v = v.groupBy(group_col, value_col).agg(F.count(F.lit(1)).alias("_cnt"))
    else:
        v = v.select(group_col, value_col, F.col(count_col).alias("_cnt"))
    cum = ordered_prefix(v, [group_col], [value_col], ["_cnt"], n_buckets=n_buckets)
    # group sizes: one row per group (bounded)
    sizes = {r[0]: int(r[1]) for r in v.groupBy(group_col).agg(F.sum("_cnt")).collect()}
    # target ranks, 0-based: h = (n-1) p, lo = floor(h), hi = min(lo+1, n-1)
    rows = []
    for g, n in sizes.items():
        for qi, p in enumerate(probs):
            h = (n - 1) * float(p)
            lo = math.floor(h)
            rows.append((g, qi, float(p), h, 0, lo))
            rows.append((g, qi, float(p), h, 1, min(lo + 1, n - 1)))
    gtype = values.schema[group_col].dataType.simpleString()
    targets = values.sparkSession.createDataFrame(
        rows, f"{group_col} {gtype}, q_index int, prob double, _h double, side int, r bigint")
    first = F.col("cum__cnt") - F.col("_cnt")  # rank of the first copy of this value
    last = F.col("cum__cnt") - 1
    c = cum.select(group_col, value_col, first.alias("_first"), last.alias("_last"))
    # targets: groups x probs x 2 rows, broadcast; each value row meets only its group's targets
    hits = c.join(F.broadcast(targets), group_col).filter(
        (F.col("r") >= F.col("_first")) & (F.col("r") <= F.col("_last")))
    picked = hits.groupBy(group_col, "q_index").agg(
        F.first("prob").alias("prob"),
        F.first("_h").alias("_h"),
        F.max(F.when(F.col("side") == 0, F.col(value_col).cast("double"))).alias("_a"),
        F.max(F.when(F.col("side") == 1, F.col(value_col).cast("double"))).alias("_b"),
    )
    t = F.col("_h") - F.floor("_h")
    diff = F.col("_b") - F.col("_a")
    q = F.when(t < 0.5, F.col("_a") + diff * t).otherwise(F.col("_b") - diff * (F.lit(1.0) - t))
    return picked.select(group_col, "q_index", "prob", q.alias("quantile"))
