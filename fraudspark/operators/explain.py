"""Explanations of scores: attributions beside the rows, reasons, importances and their shift.

Attributions are exact path-dependent tree Shapley values in log-odds
(operators/trees), evaluated in one pass over the rows for either variant.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudspark import schema as S
from fraudspark.functions.expr import direction
from fraudspark.operators.model import Model, ensemble_of
from fraudspark.operators.trees import evaluated


class ExplainerError(ValueError):
    """Attributions are inconsistent with the model."""


def attributed(df: DataFrame, model: Model, folder: str) -> DataFrame:
    """df with `base_value` and `shap` (attributions in feature order) beside each of its rows."""
    S.require_columns(df.columns, S.FEATURES, "rows to explain")
    return evaluated(df, ensemble_of(df.sparkSession, model, folder), shap=True)


def attributions(df: DataFrame, model: Model, folder: str) -> DataFrame:
    """(transaction_id, base_value, shap array in feature order) for every row."""
    return attributed(df.select("transaction_id", *S.FEATURES), model, folder).select(
        "transaction_id", "base_value", "shap")


def explain(scored: DataFrame, attr: DataFrame | None = None) -> DataFrame:
    """Per row: base, probability, and 13 x (feature, value, shap_value, direction).

    `scored` carries its attributions (see `attributed`); those of another
    source come as `attr`, one row for each id, and no scored row is lost
    where it has none.
    """
    j = scored if attr is None else scored.join(attr, "transaction_id", "left")
    items = F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value"),
                 F.col("shap")[i].alias("shap_value"), direction(F.col("shap")[i]).alias("direction"))
        for i, f in enumerate(S.FEATURES)
    ])
    return j.withColumn("attributions", items)


def top_contributions(attrs_col: str = "attributions", k: int = S.TOP_K_ATTRIBUTIONS):
    """k largest |shap| (both signs), stable on ties (feature order)."""
    keyed = F.transform(F.col(attrs_col), lambda a, i: F.struct(
        (-F.abs(a["shap_value"])).alias("k"), i.alias("pos"), a.alias("a")))
    return F.transform(F.slice(F.array_sort(keyed), 1, k), lambda s: s["a"])


def json_payload(attrs_col: str = "attributions", k: int = S.TOP_K_ATTRIBUTIONS):
    return F.to_json(top_contributions(attrs_col, k))


def margin_of(base: str = "base_value", shap: str = "shap"):
    return F.aggregate(F.col(shap), F.col(base), lambda acc, x: acc + x)


def additivity_check(scored_with_attr: DataFrame, tol: float = S.ADDITIVITY_TOLERANCE) -> float:
    """max |base + sum(shap) - margin|; raises above `tol` (one aggregation)."""
    err = scored_with_attr.agg(F.max(F.abs(margin_of() - F.col("margin")))).first()[0]
    if err is not None and err > tol:
        raise ExplainerError(f"base value and attributions miss the margin by up to {err:.2e} (allowed: {tol:.0e})")
    return float(err or 0.0)


def global_importance(attr: DataFrame, variant_col: str | None = None) -> DataFrame:
    """Mean |shap| per feature (per variant): (variant, feature, importance)."""
    keys = [variant_col] if variant_col else []
    long = attr.select(*keys, F.posexplode("shap").alias("pos", "s"))
    names = F.element_at(F.array(*[F.lit(f) for f in S.FEATURES]), F.col("pos") + 1)
    out = long.groupBy(*keys, names.alias("feature")).agg(F.avg(F.abs("s")).alias("importance"))
    return out if variant_col else out.withColumn("variant", F.lit(None).cast("string"))


def importance_align(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Union of feature names, absent = 0: (feature, prev, cur)."""
    p = previous.select("feature", F.col("importance").alias("prev"))
    c = current.select("feature", F.col("importance").alias("cur"))
    return p.join(c, "feature", "full").fillna(0.0, ["prev", "cur"])


def importance_shift(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Total variation between normalised importance profiles, in [0, 1]."""
    a = importance_align(previous, current)
    tot = a.agg(F.sum("prev").alias("sp"), F.sum("cur").alias("sc")).first()
    if not tot["sp"] or tot["sp"] <= 0 or not tot["sc"] or tot["sc"] <= 0:
        raise ExplainerError("an importance profile sums to nothing")
    return a.agg((F.lit(0.5) * F.sum(F.abs(F.col("prev") / F.lit(tot["sp"]) - F.col("cur") / F.lit(tot["sc"]))))
                 .alias("importance_shift"))


def importance_sample(features: DataFrame, n: int = 2000, seed: int = 0) -> DataFrame:
    """Capped importance input: n rows chosen by a hash of the id (unbiased,
    order-independent; a top-n by hash is a distributed take-ordered)."""
    key = F.xxhash64(F.col("transaction_id").cast("string"), F.lit(seed))
    return features.withColumn("_k", key).orderBy("_k").limit(n).drop("_k")


def top_importance(importance: DataFrame, k: int = 8) -> DataFrame:
    """Top-k features per variant, with the shared maximum for a common scale."""
    from pyspark.sql import Window

    w = Window.partitionBy("variant").orderBy(F.desc("importance"), "feature")
    shared = Window.partitionBy()
    return (importance.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .withColumn("shared_max", F.max("importance").over(shared)))
