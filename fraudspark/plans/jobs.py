"""Batch jobs: features -> table, train + compare, score + audit, drift check.

Each job takes the session it is given and writes its artefacts as tables
under a folder (a shared path on a cluster). Driver-side values are bounded
scalars only (thresholds, counts, a verdict).
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudspark import schema as S
from fraudspark.operators import drift as DR
from fraudspark.operators import explain as EX
from fraudspark.operators import features as FE
from fraudspark.operators import metrics as ME
from fraudspark.operators import model as MO
from fraudspark.operators import split as SP
from fraudspark.session import ensure_checkpoint_dir
from fraudspark.sources import tables as TB


def feature_job(raw: DataFrame, table_path: str) -> int:
    """Raw transactions -> feature table (partitioned by day, clustered)."""
    return TB.append_features(FE.build_features(raw), table_path)


@dataclass
class TrainResult:
    split: DataFrame
    models: dict
    thresholds: DataFrame
    evaluation: DataFrame
    ci: DataFrame
    verdict: DataFrame
    profile: DataFrame
    importance: DataFrame


def train_job(
    features: DataFrame,
    *,
    n_estimators: int | None = None,
    variants=MO.VARIANTS,
    cost_model: ME.CostModel | None = None,
    out_dir: str | None = None,
    explain: bool = True,
) -> TrainResult:
    """split -> per variant: fit on train, threshold on validation (train if
    empty), evaluate on test -> paired bootstrap -> verdict; profile from the
    train split; importances from the test split."""
    spark = features.sparkSession
    folder = ensure_checkpoint_dir(spark)
    split = SP.temporal_split(features).checkpoint(eager=True)
    spw = SP.scale_pos_weight_value(split)
    train = split.filter(F.col("split") == "train")
    n_val = split.filter(F.col("split") == "validation").limit(1).count()
    thr_part = "validation" if n_val else "train"
    models, scores = MO.fit_variants(train, variants, scale_pos_weight=spw, n_estimators=n_estimators), split
    for v in variants:  # each adds its column to the same rows
        scores = MO.score(models[v], scores, name=f"score_{v}").drop("margin")
    scores = scores.select("transaction_id", "split", S.LABEL, S.AMOUNT, *[f"score_{v}" for v in variants])
    scores = scores.checkpoint(eager=True)
    long = None
    for v in variants:
        part = scores.select("transaction_id", "split", F.lit(v).alias("variant"),
                             F.col(f"score_{v}").alias("score"), F.col(S.LABEL).cast("bigint").alias("label"),
                             F.col(S.AMOUNT).alias("amount"))
        long = part if long is None else long.unionByName(part)
    thresholds = ME.optimal_threshold(long.filter(F.col("split") == thr_part), cost_model).checkpoint(eager=True)
    test_long = long.filter(F.col("split") == "test")
    evaluation = ME.evaluate(test_long, thresholds, cost_model).checkpoint(eager=True)
    t = {r["variant"]: r["threshold"] for r in thresholds.collect()}  # one row per variant
    paired = scores.filter(F.col("split") == "test").select(
        "transaction_id", F.col(S.LABEL).alias("label"), F.col(S.AMOUNT).alias("amount"),
        *[F.col(f"score_{v}") for v in variants])
    ci = ME.bootstrap_cost_difference(paired, t, variants=tuple(variants[:2]), cost_model=cost_model)
    verdict = ME.ab_verdict(ci, incumbent=variants[0], challenger=variants[1])
    profile = DR.build_reference(train)
    importance = None
    if explain:
        test = split.filter(F.col("split") == "test")
        for v in variants:
            imp = EX.global_importance(EX.attributions(test, models[v], folder)).withColumn("variant", F.lit(v))
            importance = imp if importance is None else importance.unionByName(imp)
    if out_dir:
        evaluation.write.mode("overwrite").parquet(f"{out_dir}/evaluation")
        thresholds.write.mode("overwrite").parquet(f"{out_dir}/thresholds")
        verdict.write.mode("overwrite").parquet(f"{out_dir}/verdict")
        TB.save_profile(profile, f"{out_dir}/profile")
        if importance is not None:
            importance.write.mode("overwrite").parquet(f"{out_dir}/importance")
        for v, m in models.items():
            MO.save_model(spark, m, f"{out_dir}/model_{v}")
    return TrainResult(split, models, thresholds, evaluation, ci, verdict, profile, importance)


def score_job(features: DataFrame, model, variant: str, threshold: float | MO.Threshold, *, folder: str,
              audit_path: str | None = None, top_k: int = S.TOP_K_ATTRIBUTIONS) -> DataFrame:
    """Score, flag, explain (top-k reasons as JSON) and optionally append the
    prediction log (all ten columns). One pass without a join, so each input
    row gives one row, whatever its id. `new_customer` and `latency_ms` are
    passed on where the features have them."""
    extra = [c for c in ("new_customer", "latency_ms") if c in features.columns]
    scored = MO.flag(MO.score(model, features.select("transaction_id", "customer_id", S.EVENT_TIME, *S.FEATURES, *extra)),
                     threshold)
    ex = EX.explain(EX.attributed(scored, model, folder))
    if "latency_ms" not in extra:
        ex = ex.withColumn("latency_ms", F.lit(None).cast("double"))
    if "new_customer" not in extra:
        ex = ex.withColumn("new_customer", F.lit(None).cast("boolean"))
    out = ex.select(
        "transaction_id", "customer_id", S.EVENT_TIME, F.lit(variant).alias("variant"), "fraud_probability",
        "threshold", "is_flagged", "base_value", EX.json_payload("attributions", top_k).alias("top_features"),
        "latency_ms", "new_customer", "margin", "shap",
    )
    if audit_path:
        TB.audit_append(out, audit_path)
    return out


def explanation_shift(stored: DataFrame, current: DataFrame, model, *, folder: str,
                      sample_rows: int | None = None) -> float:
    """Shift between the importances stored at training time and those of the current rows.

    All current rows count; with `sample_rows`, so many rows drawn by a hash of
    their ids.
    """
    rows = current if sample_rows is None else EX.importance_sample(current, sample_rows)
    now = EX.global_importance(EX.attributed(rows, model, folder))
    return float(EX.importance_shift(stored, now).first()[0])


def drift_check(profile: DataFrame, current: DataFrame, *, importance_shift: float | None = None,
                dry_run: bool = False) -> DataFrame:
    """Report row + `retrain_requested = drifted and not dry_run`. Submitting a
    retraining job is left to the scheduler; this only emits the flag."""
    model_features = [r[0] for r in profile.select("feature").distinct().collect()]  # <= 13
    cur = current.select(*[c for c in current.columns if c in model_features])
    if not cur.columns:
        raise DR.DriftError("none of the profiled columns is in the current rows")
    rep = DR.drift_report(DR.detect_drift(profile, cur), n_current_rows=cur.count(), importance_shift=importance_shift)
    return rep.withColumn("retrain_requested", F.col("drifted") & F.lit(not dry_run))


def drift_check_job(spark: SparkSession, profile_path: str, feature_table: str, start, end, *,
                    model_path: str | None = None, importance_path: str | None = None,
                    variant: str = MO.VARIANTS[0], dry_run: bool = False) -> DataFrame:
    """The current batch is every row of the feature table in [start, end), labelled or not.

    With a saved model and the importances stored beside it, the report also
    has the shift of explanations. If that fails it is null and the report of
    the features stands.
    """
    if start is None or end is None:
        raise TB.TableError("drift_check needs start and end")
    profile = TB.load_profile(spark, profile_path)
    cur = TB.feature_rows(spark, feature_table, start, end)
    shift = None
    if model_path and importance_path:
        try:
            stored = spark.read.parquet(importance_path).filter(F.col("variant") == variant)
            shift = explanation_shift(stored, cur, MO.load_model(spark, model_path), folder=ensure_checkpoint_dir(spark))
        except (ValueError, PySparkException, Py4JJavaError) as exc:
            logging.getLogger(__name__).error("no shift of explanations: %s", exc)
    return drift_check(profile, cur, importance_shift=shift, dry_run=dry_run)
