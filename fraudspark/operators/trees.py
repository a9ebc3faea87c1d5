"""Additive ensembles of binary trees, kept as node tables.

A node table has one row per node: tree, node (0 is a root), feature (its
place in FEATURES, -1 at a leaf), threshold (values up to it go left, all
others and missing ones right), left, right, value (a leaf's log-odds) and
cover (training rows, for the attributions). It is as large as the model,
whatever the data; both variants are evaluated through it.

Margins: all trees advance one level at a time over packed arrays, a batch of
rows at once. Attributions are exact path-dependent Shapley values. For a leaf
with value v, path features U (M of them) and a row that satisfies o_j of
feature j's conditions, whose cover ratios multiply to z_j:
  phi_i = v (o_i - z_i) sum_{S in U\\{i}} |S|! (M-|S|-1)! / M! prod_S o prod_{U\\S\\i} z
Every leaf has a small table of these for each pattern o. The leaves below a node
share one table (a "block") where the splits above the node and below it are at most
eight: it has the sum of their attributions for every outcome of these splits, so a
row looks up one line a block. A split is compared with the rows once per tree.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudspark import schema as S

NODE_SCHEMA = T.StructType([
    T.StructField("tree", T.IntegerType()), T.StructField("node", T.IntegerType()),
    T.StructField("feature", T.IntegerType()), T.StructField("threshold", T.DoubleType()),
    T.StructField("left", T.IntegerType()), T.StructField("right", T.IntegerType()),
    T.StructField("value", T.DoubleType()), T.StructField("cover", T.DoubleType()),
])
#: Rows evaluated together in a task.
_ROWS = 4096
#: Splits whose outcomes number the lines of a block's table (a byte holds them).
_BITS = 8


class EnsembleError(ValueError):
    """A node table that is no ensemble of trees."""


def shapley_weights(m: int) -> np.ndarray:
    """|S|! (m-|S|-1)! / m! for |S| = 0 .. m-1."""
    return np.array([math.factorial(k) * math.factorial(m - k - 1) / math.factorial(m) for k in range(m)])


def leaf_tables(v: np.ndarray, z: np.ndarray) -> np.ndarray:
    """(leaves, 2^M, M) attributions of leaves of M features, (leaves, M) ratios, for every pattern of satisfied features."""
    n, m = z.shape
    pats = ((np.arange(2 ** m)[:, None] >> np.arange(m)[None, :]) & 1).astype(float)
    w = shapley_weights(m)
    out = np.zeros((n, 2 ** m, m))
    for i in range(m):
        c = np.zeros((n, 2 ** m, m + 1))
        c[..., 0] = 1.0
        for j in range(m):
            if j != i:
                shifted = np.concatenate([np.zeros((n, 2 ** m, 1)), c[..., :-1]], axis=2)
                c = c * z[:, j, None, None] + pats[:, j, None] * shifted
        out[..., i] = v[:, None] * (pats[:, i] - z[:, i, None]) * (c[..., :m] @ w)
    return out


def leaf_table(v: float, z: np.ndarray) -> np.ndarray:
    """(2^M, M) attributions of one leaf for every pattern of satisfied features."""
    return leaf_tables(np.array([v], float), np.asarray(z, float)[None, :])[0]


@dataclass(frozen=True)
class _Leaf:
    features: tuple[int, ...]                          # distinct features of the path
    conditions: tuple[tuple[tuple[int, bool], ...], ...]  # for each of them: (split of the tree, goes left)
    table: np.ndarray                                  # (2^M, M)


@dataclass(frozen=True)
class _Block:
    """Leaves below a node; the outcomes of `splits` (bit k: splits[k] goes left) number the lines of the table."""

    splits: np.ndarray
    table: np.ndarray                                  # (2^splits, features)


@dataclass(frozen=True)
class _Tree:
    feature: np.ndarray
    bound: np.ndarray                                  # place of each split's threshold among those of its feature
    place: np.ndarray                                  # bit of each split in the numbers of its blocks
    blocks: tuple[_Block, ...]
    leaves: tuple[_Leaf, ...]                          # those below more than _BITS splits, in no block


class Ensemble:
    """Trees of a node table; a row's margin (log-odds) is `bias` and the values of the leaves that it reaches."""

    def __init__(self, nodes: pd.DataFrame, bias: float = 0.0) -> None:
        missing = [f.name for f in NODE_SCHEMA.fields if f.name not in nodes.columns]
        if missing:
            raise EnsembleError(f"the node table lacks {', '.join(missing)}")
        kinds = {f.name: "float64" if f.dataType == T.DoubleType() else "int32" for f in NODE_SCHEMA.fields}
        self.nodes = nodes[NODE_SCHEMA.names].astype(kinds).sort_values(["tree", "node"]).reset_index(drop=True)
        self.bias = float(bias)
        self._pack()
        self._paths: tuple[list[_Tree], float] | None = None

    def _pack(self) -> None:
        n = self.nodes
        trees, at = np.unique(n["tree"].to_numpy(), return_inverse=True)
        sizes = np.bincount(at, minlength=len(trees))
        first = np.cumsum(sizes) - sizes
        if len(n) and (n["node"].to_numpy() != np.arange(len(n)) - first[at]).any():
            raise EnsembleError("nodes of a tree must be numbered from 0 without gaps")
        leaf = n["feature"].to_numpy() < 0
        own, shift = np.arange(len(n)), first[at]
        self.roots = first
        self.feature = np.where(leaf, 0, n["feature"].to_numpy())
        self.threshold = np.where(leaf, np.inf, n["threshold"].to_numpy(dtype=float))
        # a leaf leads to itself, so all trees can take the same number of steps
        self.left = np.where(leaf, own, n["left"].to_numpy() + shift)
        self.right = np.where(leaf, own, n["right"].to_numpy() + shift)
        self.value = np.where(leaf, n["value"].to_numpy(dtype=float), 0.0)
        self.depth = 0
        level = self.roots
        while len(level := level[~leaf[level]]):
            level = np.concatenate([self.left[level], self.right[level]])
            self.depth += 1
            if self.depth > len(n):
                raise EnsembleError("a node leads back to one above it")

    @property
    def n_trees(self) -> int:
        return len(self.roots)

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row of x (n, features)."""
        out = np.empty(len(x))
        for a in range(0, len(x), _ROWS):
            part = x[a:a + _ROWS]
            row = np.arange(len(part))[:, None]
            node = np.broadcast_to(self.roots, (len(part), self.n_trees))
            for _ in range(self.depth):
                node = np.where(part[row, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            out[a:a + _ROWS] = self.bias + self.value[node].sum(axis=1)
        return out

    def paths(self) -> tuple[list[_Tree], float]:
        """Each tree's blocks with their attribution tables, and the base value (the expected log-odds)."""
        if self._paths is None:
            trees, base, bounds = [], self.bias, self.bounds
            for _, rows in self.nodes.groupby("tree", sort=True):
                made, expected = _tree(rows, bounds)
                trees.append(made)
                base += expected
            self._paths = trees, base
        return self._paths

    @property
    def bounds(self) -> list[np.ndarray]:
        """Thresholds of each feature (up to the last that is used), ascending."""
        return [np.unique(self.threshold[self.feature == j]) for j in range(int(self.feature.max(initial=-1)) + 1)]

    @property
    def base_value(self) -> float:
        return self.paths()[1]

    def attributions(self, x: np.ndarray) -> np.ndarray:
        """(n, features) Shapley values of each row of x."""
        trees, bounds = self.paths()[0], self.bounds
        out = np.zeros(x.shape)
        for a in range(0, len(x), _ROWS):
            part = x[a:a + _ROWS]
            # a value is at most the k-th bound where at most k bounds are below it; a missing one has all below it
            under = np.array([np.searchsorted(b, part[:, j]) for j, b in enumerate(bounds)], np.int32)
            phi, line = np.zeros((len(part), len(bounds))), np.empty((len(part), len(bounds)))
            for tree in trees:
                left = under[tree.feature] <= tree.bound[:, None]
                bits = left.astype(np.uint8) << tree.place[:, None]
                for block in tree.blocks:
                    at = np.bitwise_or.reduce(bits[block.splits], axis=0).astype(np.intp)
                    phi += np.take(block.table, at, axis=0, out=line, mode="clip")
                for leaf in tree.leaves:
                    _add_leaf(phi, leaf, left)
            out[a:a + _ROWS, :len(bounds)] = phi
        return out

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the node table and, as tree -1, the bias."""
        bias = pd.DataFrame([(-1, 0, -1, 0.0, -1, -1, self.bias, 0.0)], columns=NODE_SCHEMA.names)
        spark.createDataFrame(pd.concat([self.nodes, bias]), NODE_SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Ensemble:
        nodes = spark.read.schema(NODE_SCHEMA).parquet(path).toPandas()
        bias = nodes.loc[nodes["tree"] < 0, "value"]
        if len(bias) != 1:
            raise EnsembleError(f"no saved ensemble: {path}")
        return cls(nodes[nodes["tree"] >= 0], float(bias.iloc[0]))


def _pattern(leaf: _Leaf, left: np.ndarray) -> np.ndarray:
    """For each row (column of left) the number of the line of the leaf's table: bit k is set where feature k is satisfied."""
    pattern = np.zeros(left.shape[1], np.intp)
    for slot, conditions in enumerate(leaf.conditions):
        pattern |= np.all([left[split] == goes_left for split, goes_left in conditions], axis=0).astype(np.intp) << slot
    return pattern


def _add_leaf(phi: np.ndarray, leaf: _Leaf, left: np.ndarray) -> None:
    phi[:, list(leaf.features)] += leaf.table[_pattern(leaf, left)]


def _tree(rows: pd.DataFrame, bounds: list[np.ndarray]) -> tuple[_Tree, float]:
    """A tree's splits, blocks and leaves, and its expected value."""
    byid = {int(r.node): r for r in rows.itertuples()}
    splits = [r for r in byid.values() if r.feature >= 0]
    number = {int(r.node): i for i, r in enumerate(splits)}
    paths: dict[int, tuple[tuple[int, int, bool, float], ...]] = {}  # of each node: (feature, split, goes left, ratio)
    order, below = [0], {}
    paths[0] = ()
    for node in order:
        r = byid[node]
        if r.feature >= 0:
            for child, goes_left in ((int(r.left), True), (int(r.right), False)):
                ratio = float(byid[child].cover) / float(r.cover) if r.cover else 0.0
                paths[child] = (*paths[node], (int(r.feature), number[node], goes_left, ratio))
                order.append(child)
    for node in reversed(order):  # the splits of each node's subtree
        r = byid[node]
        below[node] = 1 + below[int(r.left)] + below[int(r.right)] if r.feature >= 0 else 0
    ends = [node for node in order if byid[node].feature < 0]
    base = sum(float(byid[node].value) * math.prod(step[3] for step in paths[node]) for node in ends)
    leaves = _leaves({node: (float(byid[node].value), paths[node]) for node in ends if paths[node]})
    place, blocks, deep = np.zeros(len(splits), np.uint8), [], []
    stack = [0]
    while stack:
        node = stack.pop()
        r, depth = byid[node], len(paths[node])
        if depth + below[node] > _BITS:
            if r.feature < 0:
                deep.append(leaves[node])
                continue
            place[number[node]] = min(depth, _BITS - 1)  # no block is below a split deeper than that
            stack += [int(r.left), int(r.right)]
            continue
        inside = [node]
        for n in inside:
            inside += [int(byid[n].left), int(byid[n].right)] if byid[n].feature >= 0 else []
        own = [number[n] for n in inside if byid[n].feature >= 0]
        place[own] = depth + np.arange(len(own))
        used = [step[1] for step in paths[node]] + own
        left = np.zeros((len(splits), 2 ** len(used)), bool)
        left[used] = (np.arange(2 ** len(used)) >> np.arange(len(used))[:, None]) & 1
        table = np.zeros((2 ** len(used), len(bounds)))
        for n in inside:
            if n in leaves:
                _add_leaf(table, leaves[n], left)
        if used:
            blocks.append(_Block(np.array(used), table))
    feature = np.array([int(r.feature) for r in splits], int)
    bound = np.array([np.searchsorted(bounds[r.feature], r.threshold) for r in splits], np.int32)
    return _Tree(feature, bound, place, tuple(blocks), tuple(deep)), base


def _leaves(paths: dict[int, tuple[float, tuple[tuple[int, int, bool, float], ...]]]) -> dict[int, _Leaf]:
    """Leaves by node, of their values and paths; the tables of those with as many features are made together."""
    features = {node: tuple(dict.fromkeys(step[0] for step in path)) for node, (_, path) in paths.items()}
    out = {}
    for m in {len(f) for f in features.values()}:
        nodes = [node for node, f in features.items() if len(f) == m]
        z = [[math.prod(step[3] for step in paths[node][1] if step[0] == f) for f in features[node]] for node in nodes]
        for node, table in zip(nodes, leaf_tables(np.array([paths[n][0] for n in nodes]), np.array(z)), strict=True):
            conditions = tuple(tuple((s, left) for g, s, left, _ in paths[node][1] if g == f) for f in features[node])
            out[node] = _Leaf(features[node], conditions, table)
    return out


def gbt_ensemble(spark: SparkSession, model: PipelineModel, folder: str) -> Ensemble:
    """The node table of a fitted Spark GBT classifier; its probability is sigmoid(2 x raw prediction)."""
    gbt = model.stages[-1]
    path = f"{folder.rstrip('/')}/gbt-{uuid.uuid4().hex[:10]}"
    gbt.write().overwrite().save(path)
    nodes = spark.read.parquet(path + "/data").select(
        F.col("treeID").cast("int").alias("tree"), F.col("nodeData.id").alias("node"),
        F.coalesce(F.col("nodeData.split.featureIndex"), F.lit(-1)).alias("feature"),
        F.coalesce(F.get(F.col("nodeData.split.leftCategoriesOrThreshold"), 0), F.lit(0.0)).alias("threshold"),
        F.col("nodeData.leftChild").alias("left"), F.col("nodeData.rightChild").alias("right"),
        F.col("nodeData.prediction").alias("value"), F.get(F.col("nodeData.impurityStats"), 0).alias("cover"),
    ).toPandas()
    nodes.loc[nodes["left"] < 0, "feature"] = -1
    nodes["value"] *= 2.0 * np.array(gbt.treeWeights)[nodes["tree"].to_numpy()]
    return Ensemble(nodes)


def matrix(batch: pa.RecordBatch, at: Sequence[int]) -> np.ndarray:
    """Columns of a batch as doubles (n, len(at)); nulls are NaN."""
    return np.stack([batch.column(i).cast(pa.float64()).to_numpy(zero_copy_only=False) for i in at], axis=1)


def evaluated(df: DataFrame, ensemble: Ensemble, *, margin: str | None = None, probability: str | None = None,
              shap: bool = False) -> DataFrame:
    """df with the named columns beside each of its rows, and with `base_value` and `shap` where asked for.

    One pass without a join: every row is evaluated, whatever its id. Columns
    of these names in df are replaced.
    """
    from fraudspark.session import ship_package

    spark = df.sparkSession
    S.require_columns(df.columns, S.FEATURES, "rows to evaluate")
    ship_package(spark)
    if shap:
        ensemble.paths()
    shared = spark.sparkContext.broadcast(ensemble)
    new = [T.StructField(c, T.DoubleType()) for c in (margin, probability) if c]
    if shap:
        new += [T.StructField("base_value", T.DoubleType()), T.StructField("shap", T.ArrayType(T.DoubleType()))]
    df = df.drop(*[f.name for f in new])
    schema = T.StructType([*df.schema.fields, *new])
    at, names = [df.columns.index(c) for c in S.FEATURES], schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch, at)
            columns = list(batch.columns)
            if margin or probability:
                m = trees.margins(x)
                columns += [pa.array(m)] if margin else []
                columns += [pa.array(0.5 * (1.0 + np.tanh(0.5 * m)))] if probability else []
            if shap:
                phi = trees.attributions(x)
                ends = np.arange(len(phi) + 1, dtype=np.int32) * phi.shape[1]
                columns += [pa.array(np.full(len(phi), trees.base_value)),
                            pa.ListArray.from_arrays(pa.array(ends), pa.array(phi.ravel()))]
            yield pa.RecordBatch.from_arrays(columns, names)

    return df.mapInArrow(run, schema)
