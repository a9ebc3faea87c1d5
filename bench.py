"""Headline operator timings.

$BENCH_SF_DIR (default /root/testdata/sf0.1) with local[$BENCH_CPUS]:
build_features (raw parquet -> 13 features, forced with the no-op sink),
temporal_split, optimal_threshold, bootstrap_ci, detect_drift, plus
append_features, build_reference and serving_features. Inputs of the later operators are
materialised once (a feature table in the checkpoint folder) and not timed.
Each timing is the median of $BENCH_RUNS warm runs after one warm-up.
Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))

    from pyspark.sql import functions as F

    from fraudspark.operators import drift as DR
    from fraudspark.operators import features as FE
    from fraudspark.operators import metrics as ME
    from fraudspark.operators import split as SP
    from fraudspark.operators import state as ST
    from fraudspark.plans.catalog import SCORE_A, SCORE_B, pseudo_scores
    from fraudspark.session import local_session
    from fraudspark.sources import tables as TB
    from fraudspark.sources.adapter import load_transactions

    spark = local_session(cores=cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")))
    tx = load_transactions(spark, sf_dir)

    def timed(fn) -> float:
        fn()  # warm-up
        ts = []
        for _ in range(runs):
            t0 = time.perf_counter()
            fn()
            ts.append(time.perf_counter() - t0)
        return round(statistics.median(ts), 3)

    q: dict[str, float] = {}
    q["build_features"] = timed(lambda: FE.build_features(tx).write.format("noop").mode("overwrite").save())

    feat_path = TB.scratch_path(spark, "bench-features")
    FE.build_features(tx).write.parquet(feat_path)
    feats = spark.read.parquet(feat_path)
    q["append_features"] = timed(lambda: TB.append_features(feats, TB.scratch_path(spark, "bench-table")))
    q["temporal_split"] = timed(lambda: SP.temporal_split(feats).write.format("noop").mode("overwrite").save())

    split_path = TB.scratch_path(spark, "bench-split")
    pseudo_scores(SP.temporal_split(feats)).write.parquet(split_path)
    sp = spark.read.parquet(split_path)
    val = ME.long_scores(sp.filter(F.col("split") == "validation"), {"A": SCORE_A, "B": SCORE_B})
    q["optimal_threshold"] = timed(lambda: ME.optimal_threshold(val).collect())

    thr = {r["variant"]: r["threshold"] for r in ME.optimal_threshold(val).collect()}
    paired = sp.filter(F.col("split") == "test").select(
        "transaction_id", F.col("is_fraud").alias("label"), "amount",
        F.col(SCORE_A).alias("score_A"), F.col(SCORE_B).alias("score_B"))
    q["bootstrap_ci"] = timed(lambda: ME.bootstrap_cost_difference(paired, thr).collect())

    train = sp.filter(F.col("split") == "train")
    q["build_reference"] = timed(lambda: DR.build_reference(train).collect())
    prof_path = TB.scratch_path(spark, "bench-profile")
    TB.save_profile(DR.build_reference(train), prof_path)
    profile = TB.load_profile(spark, prof_path)
    test = sp.filter(F.col("split") == "test")
    q["detect_drift"] = timed(lambda: DR.detect_drift(profile, test).collect())
    q["serving_features"] = timed(
        lambda: ST.serving_features_batch(tx).write.format("noop").mode("overwrite").save())

    headline = ["build_features", "temporal_split", "optimal_threshold", "bootstrap_ci", "detect_drift"]
    print(json.dumps({
        "metric": "headline_operators_total_wall",
        "value": round(sum(q[k] for k in headline), 3),
        "unit": "sec",
        "queries": q,
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "cpus": cpus,
        "runs": runs,
        "rows": {"events": spark.read.parquet(f"{sf_dir}/events.parquet").count()},
    }))


if __name__ == "__main__":
    main()
