"""Two gradient-boosted-tree variants, scoring and flagging.

Both variants share the capacity settings (trees, learning rate, depth, row
and column sampling, seed, positive-class weight) so the comparison isolates
the tree-growing policy:
  A  depth-wise trees on Spark ML, 32 histogram bins (the incumbent)
  B  leaf-wise trees (operators/boosting): at most 63 leaves, >= 20 rows per
     leaf, 255 bins (the challenger)
`estimator_for` gives a variant's settings. A fitted A is a PipelineModel, a
fitted B an Ensemble; `ensemble_of` gives the node table of either, through
which both are explained.
"""

from __future__ import annotations

import weakref
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudspark import schema as S
from fraudspark.operators import boosting
from fraudspark.operators.trees import Ensemble, EnsembleError, evaluated, gbt_ensemble

Model = PipelineModel | Ensemble

# Shared capacity of both variants.
SHARED = {
    "n_estimators": 300,
    "learning_rate": 0.05,
    "max_depth": 6,
    "subsample": 0.8,
    "colsample": 0.8,
    "seed": 42,
}
#: What sets the variants apart: how a tree may grow.
GROWTH = {
    "A": {"maxBins": 32, "minInstancesPerNode": 1},
    "B": {"max_bins": 255, "min_rows": 20, "max_leaves": 2 ** SHARED["max_depth"] - 1},
}
VARIANTS = tuple(GROWTH)
LEAF_WISE = "B"
WEIGHT = "_weight"
VECTOR = "_features"


class UnknownVariantError(ValueError):
    """Variant name not in VARIANTS."""


class Threshold(NamedTuple):
    """A fitted decision threshold; block_none: the cheapest decision was to flag nobody."""

    value: float
    block_none: bool = False


def estimator_for(variant: str, n_estimators: int | None = None) -> Pipeline | boosting.Growth:
    """What a variant is fitted with, SHARED settings and its GROWTH: a Spark ML pipeline, or those of leaf-wise trees."""
    growth = GROWTH.get(variant)
    if growth is None:
        raise UnknownVariantError(f"no variant is called {variant!r}; there are {', '.join(VARIANTS)}")
    if variant == LEAF_WISE:
        return boosting.Growth(
            n_trees=n_estimators or SHARED["n_estimators"], learning_rate=SHARED["learning_rate"],
            max_depth=SHARED["max_depth"], subsample=SHARED["subsample"], colsample=SHARED["colsample"],
            seed=SHARED["seed"], **growth)
    gbt = GBTClassifier(
        featuresCol=VECTOR, labelCol="label", weightCol=WEIGHT,
        maxIter=n_estimators or SHARED["n_estimators"], stepSize=SHARED["learning_rate"],
        maxDepth=SHARED["max_depth"], subsamplingRate=SHARED["subsample"],
        featureSubsetStrategy=str(SHARED["colsample"]), seed=SHARED["seed"],
        # cut the boosting lineage every 10 trees (into spark.checkpoint.dir); at depth 6 a row's
        # node is found again sooner than its id is kept: the trees are the same
        cacheNodeIds=False, checkpointInterval=10, **growth,
    )
    return Pipeline(stages=[VectorAssembler(inputCols=[f"_x_{c}" for c in S.FEATURES], outputCol=VECTOR), gbt])


def feature_matrix(df: DataFrame, keep=()) -> DataFrame:
    """The 13 features as doubles in model order (label/amount are never features)."""
    S.require_columns(df.columns, S.FEATURES, "feature frame")
    return df.select(*keep, *[F.col(c).cast("double").alias(f"_x_{c}") for c in S.FEATURES])


def training_frame(df: DataFrame, scale_pos_weight: float) -> DataFrame:
    keep = [c for c in ("transaction_id",) if c in df.columns]
    m = feature_matrix(df, keep=keep + [S.LABEL])
    return m.withColumn("label", F.col(S.LABEL).cast("double")).withColumn(
        WEIGHT, F.when(F.col("label") == 1.0, F.lit(float(scale_pos_weight))).otherwise(F.lit(1.0)))


def fit_variant(train: DataFrame, variant: str, *, scale_pos_weight: float, n_estimators: int | None = None) -> Model:
    from fraudspark.session import ensure_checkpoint_dir

    estimator = estimator_for(variant, n_estimators)
    if not scale_pos_weight > 0:
        raise ValueError(f"positives cannot weigh {scale_pos_weight}")
    ensure_checkpoint_dir(train.sparkSession)
    frame = training_frame(train, scale_pos_weight)
    if isinstance(estimator, boosting.Growth):
        return boosting.fit(frame.withColumnRenamed(WEIGHT, "weight"), [f"_x_{c}" for c in S.FEATURES], estimator)
    return estimator.fit(frame)


def fit_variants(train: DataFrame, variants=VARIANTS, *, scale_pos_weight: float, n_estimators: int | None = None
                 ) -> dict[str, Model]:
    """Each variant fitted on the same rows. A fit is many short jobs, one after the other; the variants' fits
    run side by side, so one's jobs use the cores that the other's leave idle."""
    from fraudspark.session import ensure_checkpoint_dir, ship_package

    ensure_checkpoint_dir(train.sparkSession)
    ship_package(train.sparkSession)
    inherit = inheritable_thread_target(train.sparkSession)
    with ThreadPoolExecutor(max(1, len(variants))) as pool:
        fits = {v: pool.submit(inherit(lambda v=v: fit_variant(
            train, v, scale_pos_weight=scale_pos_weight, n_estimators=n_estimators))) for v in variants}
        return {v: fit.result() for v, fit in fits.items()}


#: Node tables of fitted pipelines, each read once (as long as the model is in use).
_ENSEMBLES: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def ensemble_of(spark: SparkSession, model: Model, folder: str) -> Ensemble:
    """The node table of a fitted variant; a pipeline's is saved in `folder` first."""
    if isinstance(model, Ensemble):
        return model
    if model not in _ENSEMBLES:
        _ENSEMBLES[model] = gbt_ensemble(spark, model, folder)
    return _ENSEMBLES[model]


def save_model(spark: SparkSession, model: Model, path: str) -> None:
    if isinstance(model, Ensemble):
        model.save(spark, path)
    else:
        model.write().overwrite().save(path)


def load_model(spark: SparkSession, path: str) -> Model:
    """A saved variant of either kind."""
    try:
        return Ensemble.load(spark, path)
    except (EnsembleError, PySparkException):  # a pipeline has folders of its own, no node table
        return PipelineModel.load(path)


def score(model: Model, df: DataFrame, keep=("transaction_id",), name: str = "fraud_probability") -> DataFrame:
    """P(fraud) per row, plus the margin in log-odds (2 x raw score of a Spark GBT)."""
    keep = [c for c in df.columns if c in keep or not c.startswith("_x_")]
    if isinstance(model, Ensemble):
        return evaluated(df, model, margin="margin", probability=name).select(*keep, name, "margin")
    m = feature_matrix(df, keep=keep)
    out = model.transform(m)
    return out.select(
        *keep,
        vector_to_array("probability")[1].alias(name),
        (F.lit(2.0) * vector_to_array("rawPrediction")[1]).alias("margin"),
    )


def flag(scored: DataFrame, threshold: float | Threshold, prob_col: str = "fraud_probability") -> DataFrame:
    """is_flagged = probability >= the fitted threshold (within [0, 1]); with block_none nobody is flagged."""
    t = threshold if isinstance(threshold, Threshold) else Threshold(float(threshold))
    if not t.block_none and not 0.0 <= t.value <= 1.0:
        raise ValueError(f"{t.value} is no probability to compare with")
    hit = F.lit(False) if t.block_none else F.col(prob_col) >= F.col("threshold")
    return scored.withColumn("threshold", F.lit(t.value)).withColumn("is_flagged", hit)
