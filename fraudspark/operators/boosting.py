"""Leaf-wise (best-first) histogram boosting on Spark.

A tree grows by splitting, again and again, the leaf whose best split gains
most, up to a number of leaves. The gain of every split of a leaf comes from
its histograms: sums of gradients, hessians and rows by feature and bin. One
Spark aggregate gives those of the smaller child of every leaf that could be
split; the other child's are the parent's less these. A level is one aggregate:
all its nodes with a gain are split ahead, and best-first order then decides
which of these splits the tree keeps. Where a tree's sample is small enough to
be moved, one shuffle takes the rows of each node of a level to a task as soon
as no node has more rows than a task takes, and each task grows its node's
subtree: the same trees in fewer jobs.

Rows stay in Spark as one byte a feature, in a block of arrays for each task;
tasks add up their rows in numpy and Spark sums the tasks. Features of few bins
are summed together, by a code for their bins, which gives the sums of each.
Gradients are integers (multiples of 2^-24), so sums, and with them the trees,
don't depend on how rows are dealt or on lost tasks. What comes to the driver
is bounded by leaves x features x bins. What a tree's levels read, the bins and
gradients of its sample, is computed once and persisted; the blocks take in the
trees' values, and are persisted or checkpointed anew, every few trees.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from fraudspark.operators.selection import order_statistics, summaries
from fraudspark.operators.trees import NODE_SCHEMA, Ensemble

#: One step of the integer gradients.
SCALE = float(1 << 24)
#: Types of the key, label and weight of a row.
_NUMBERS = (np.int64, np.float64, np.float64)
#: Most codes of features that are summed together.
_CODES = 4096
#: Rows that go down a tree together.
_STEPPED = 1 << 14


@dataclass(frozen=True)
class Growth:
    """Settings of a fit; rows and columns are sampled anew for each tree.

    There is a task a core, of at least `least_rows` rows, and more tasks beyond `rows_per_task` rows each.
    Samples of up to `rows_moved` rows are moved to grow subtrees of up to `rows_per_subtree` rows in a task each.
    """

    n_trees: int = 300
    learning_rate: float = 0.05
    max_leaves: int = 63
    max_depth: int = 6
    min_rows: int = 20
    min_hessian: float = 1e-3
    max_bins: int = 255
    subsample: float = 0.8
    colsample: float = 0.8
    seed: int = 42
    write_every: int = 10
    hold_every: int = 5
    rows_per_task: int = 500_000
    rows_moved: int = 1_000_000
    rows_per_subtree: int = 400_000
    least_rows: int = 100_000
    fan_in: int = 32


@dataclass
class Node:
    """A node in growth: sums of gradient, hessian and rows, in all and (hist) by feature and bin."""

    depth: int
    total: np.ndarray
    hist: np.ndarray | None = None
    feature: int = -1
    bin: int = -1
    gain: float = 0.0
    left: int = -1
    right: int = -1


def bin_edges(train: DataFrame, columns: list[str], max_bins: int) -> list[np.ndarray]:
    """Upper bounds of the bins of each column: its values at equal shares of the rows, exact whatever the partitions.

    A value's bin is the first whose bound is not below it.
    """
    _, known = summaries(train, columns, 0)
    ranks = {c: sorted({-(-k * known[c].n // max_bins) - 1 for k in range(1, max_bins)} - {-1}) for c in columns}
    found = order_statistics(train, ranks, known)
    return [np.unique(np.array(list(found[c].values()), float)) for c in columns]


def binned(train: DataFrame, columns: list[str], edges: list[np.ndarray], id_col: str) -> DataFrame:
    """(key, label, weight, bins): a byte a feature; key decides the rows of each tree's sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = [batch.column(3 + j).to_numpy(zero_copy_only=False) for j in range(len(columns))]
            raw = np.stack([np.searchsorted(e, v).astype(np.uint8) for e, v in zip(edges, x, strict=True)], axis=1)
            ends = np.arange(len(raw) + 1, dtype=np.int32) * raw.shape[1]
            packed = pa.Array.from_buffers(pa.binary(), len(raw), [
                None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(raw))])
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], packed], ["key", "label", "weight", "bins"])

    key = F.xxhash64(F.col(id_col).cast("string"))
    rows = train.select(key.alias("key"), F.col("label").cast("double").alias("label"),
                        F.col("weight").cast("double").alias("weight"), *[F.col(c).cast("double") for c in columns])
    return rows.mapInArrow(run, "key bigint, label double, weight double, bins binary")


def sampled(key: np.ndarray, tree: int, plan: Growth) -> np.ndarray:
    """Which rows are in the sample of a tree, by a hash of key and tree."""
    h = key.view(np.uint64) ^ np.uint64((plan.seed * 1_000_003 + tree) % (1 << 32))
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return (h >> np.uint64(11)).astype(np.float64) < plan.subsample * float(1 << 53)


def columns_of(tree: int, n: int, plan: Growth) -> np.ndarray:
    """The features of a tree's sample."""
    k = max(1, round(plan.colsample * n))
    return np.sort(np.random.default_rng([plan.seed, tree]).permutation(n)[:k])


def gradients(margin: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Integer gradient and hessian of the weighted logistic loss."""
    p = 0.5 * (1.0 + np.tanh(0.5 * margin))
    return np.rint(weight * (p - label) * SCALE), np.rint(weight * p * (1.0 - p) * SCALE)


@dataclass(frozen=True)
class Splits:
    """A tree as the tasks need it: arrays by node; left is -1 at a leaf."""

    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    right: np.ndarray
    depth: int

    @classmethod
    def of(cls, nodes: list[Node]) -> Splits:
        return cls(*(np.array([getattr(n, c) for n in nodes], np.int64) for c in ("feature", "bin", "left", "right")),
                   max(n.depth for n in nodes) - nodes[0].depth)

    def descend(self, bins: np.ndarray, at: np.ndarray | None = None, steps: int | None = None) -> np.ndarray:
        """The node that each row reaches, from the root or the nodes `at`, by as many steps down as there are or given."""
        leaf, own = self.left < 0, np.arange(len(self.left))
        child = np.stack([np.where(leaf, own, self.right), np.where(leaf, own, self.left)], axis=1).ravel()
        feature = np.where(leaf, 0, self.feature)
        if bins.flags.f_contiguous:
            flat, feature, stride = bins.T.ravel(), feature * len(bins), 1
        else:
            flat, stride = bins.ravel(), bins.shape[1]
        out = np.empty(len(bins), np.int64)
        for a in range(0, len(bins), _STEPPED):  # as many rows as the processor's caches hold
            b = min(a + _STEPPED, len(bins))
            row, node = np.arange(a * stride, b * stride, stride), np.zeros(b - a, np.int64) if at is None else at[a:b]
            for _ in range(self.depth if steps is None else steps):
                node = child.take(2 * node + (flat.take(row + feature.take(node)) <= self.bin.take(node)))
            out[a:b] = node
        return out


def best_split(hist: np.ndarray, used: np.ndarray, plan: Growth) -> tuple[float, int, int]:
    """(gain, feature, bin) of the best split of a leaf; of equal gains the first feature and bin. Gain 0: none."""
    left = np.cumsum(hist[used], axis=1).astype(float)
    total = left[:, -1:, :]
    right = total - left
    ok = ((left[..., 2] >= plan.min_rows) & (right[..., 2] >= plan.min_rows)
          & (left[..., 1] >= plan.min_hessian * SCALE) & (right[..., 1] >= plan.min_hessian * SCALE))

    def part(s: np.ndarray) -> np.ndarray:
        return s[..., 0] ** 2 / np.maximum(s[..., 1], 1.0) / SCALE

    gain = np.where(ok, part(left) + part(right) - part(total), 0.0)
    at = int(np.argmax(gain))
    feature, cut = divmod(at, gain.shape[1])
    return float(gain[feature, cut]), int(used[feature]), cut


def grow(root: np.ndarray, used: np.ndarray, plan: Growth,
         child_hists: Callable[[list[Node], list[int]], np.ndarray],
         subtrees: Callable[[list[Node], list[int]], list[list[Node]]] | None = None) -> list[Node]:
    """Grow a tree best-first. child_hists(nodes, asked) gives the histogram of each asked node.

    First every node that may be split is (see `split_all`), then the splits are taken in best-first order.
    """
    return best_first(split_all(root, used, plan, child_hists, subtrees), plan.max_leaves)


def split_all(root: np.ndarray, used: np.ndarray, plan: Growth,
              child_hists: Callable[[list[Node], list[int]], np.ndarray],
              subtrees: Callable[[list[Node], list[int]], list[list[Node]]] | None = None, depth: int = 0) -> list[Node]:
    """Split every node that may be split, from a root at `depth`, level by level, so that a level is one question.

    At the last level the parent's histogram gives the children's sums.
    subtrees(nodes, asked) gives the nodes from each asked one down; it is
    asked once the nodes of a level are small enough (see Growth).
    """
    nodes = [Node(depth, root[used[0]].sum(axis=0), root)]
    if nodes[0].total[2] > plan.rows_moved:
        subtrees = None
    level = [0]
    while level:
        for i in level:
            nodes[i].gain, nodes[i].feature, nodes[i].bin = best_split(nodes[i].hist, used, plan)
        split = [i for i in level if nodes[i].gain > 0]
        deeper = bool(split) and nodes[split[0]].depth + 1 < plan.max_depth
        for i in split:
            n = nodes[i]
            n.left, n.right = len(nodes), len(nodes) + 1
            sums = n.hist[n.feature, :n.bin + 1].sum(axis=0)
            nodes += [Node(n.depth + 1, sums), Node(n.depth + 1, n.total - sums)]
        children = [c for i in split for c in (nodes[i].left, nodes[i].right)] if deeper else []
        done, level = level, []
        if subtrees and children and max(nodes[c].total[2] for c in children) <= plan.rows_per_subtree:
            for c, below in zip(children, subtrees(nodes, children), strict=True):
                graft(nodes, c, below)
        elif children:
            smaller = [min(nodes[i].left, nodes[i].right, key=lambda c: nodes[c].total[2]) for i in split]
            for i, c, hist in zip(split, smaller, child_hists(nodes, smaller), strict=True):
                other = nodes[i].right if c == nodes[i].left else nodes[i].left
                nodes[c].hist, nodes[other].hist = hist, nodes[i].hist - hist
            level = children
        for i in done:
            nodes[i].hist = None
    return nodes


def graft(nodes: list[Node], at: int, below: list[Node]) -> None:
    """Put a subtree, whose root is nodes[at], in its place."""
    shift = len(nodes) - 1

    def moved(n: Node) -> Node:
        return replace(n, left=n.left + shift, right=n.right + shift) if n.left >= 0 else n

    nodes[at] = moved(below[0])
    nodes += [moved(n) for n in below[1:]]


def best_first(nodes: list[Node], max_leaves: int) -> list[Node]:
    """The part of the tree that best-first growth reaches, numbered in that order."""
    out = [replace(nodes[0], left=-1, right=-1)]
    source, open_ = [0], [0]
    while len(open_) and len(out) < 2 * max_leaves - 1:
        best = min((i for i in open_ if nodes[source[i]].left >= 0), key=lambda i: (-out[i].gain, i), default=None)
        if best is None:
            break
        open_.remove(best)
        out[best].left, out[best].right = len(out), len(out) + 1
        for child in (nodes[source[best]].left, nodes[source[best]].right):
            open_.append(len(out))
            out.append(replace(nodes[child], left=-1, right=-1))
            source.append(child)
    return out


def leaf_values(nodes: list[Node], plan: Growth) -> np.ndarray:
    """Value of every node, as if it were a leaf: a Newton step, times the learning rate."""
    total = np.array([n.total for n in nodes], float).reshape(-1, 3)
    return -plan.learning_rate * total[:, 0] / np.maximum(total[:, 1], 1.0)


def node_rows(tree: int, nodes: list[Node], edges: list[np.ndarray], plan: Growth) -> list[tuple]:
    values = leaf_values(nodes, plan)
    out = []
    for i, n in enumerate(nodes):
        leaf = n.left < 0
        bound = edges[n.feature] if not leaf else None
        threshold = 0.0 if leaf else float(bound[n.bin]) if n.bin < len(bound) else float("inf")
        out.append((tree, i, -1 if leaf else n.feature, threshold, n.left, n.right, float(values[i]) if leaf else 0.0,
                    float(n.total[2])))
    return out


#: Features summed together: the features, how many bins each has, and each row's code.
Codes = tuple[tuple[int, ...], tuple[int, ...], np.ndarray]


def together(sizes: Sequence[int]) -> list[tuple[int, ...]]:
    """Features (of so many bins each) that are summed together: those of fewest bins, while their codes are few."""
    groups: list[list[int]] = [[]]
    for f in sorted(range(len(sizes)), key=lambda f: sizes[f]):
        if math.prod(sizes[g] for g in groups[-1]) * sizes[f] > _CODES:
            groups.append([])
        groups[-1].append(f)
    return [tuple(g) for g in groups if len(g) > 1]


def coded(bins: np.ndarray, sizes: Sequence[int]) -> tuple[Codes, ...]:
    """The codes of the rows for each group of features that are summed together."""
    out = []
    for group in together(sizes):
        code = np.zeros(len(bins), np.uint16)
        for f in group:
            code = code * np.uint16(sizes[f]) + bins[:, f]
        out.append((group, tuple(sizes[f] for f in group), code))
    return tuple(out)


def _columnar(bins: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Some rows of bins, each column's bytes side by side."""
    return bins.T[:, rows].T


@dataclass
class Sample:
    """Rows of a tree's sample in one task: bins, codes, and integer gradient and hessian."""

    bins: np.ndarray
    codes: tuple[Codes, ...]
    sums: tuple[np.ndarray, ...]

    def of(self, rows: np.ndarray) -> Sample:
        return Sample(_columnar(self.bins, rows), tuple((f, n, c[rows]) for f, n, c in self.codes),
                      tuple(s[rows] for s in self.sums))

    @classmethod
    def joined(cls, parts: list[Sample]) -> Sample:
        codes = tuple((f, n, np.concatenate([p.codes[i][2] for p in parts])) for i, (f, n, _) in enumerate(parts[0].codes))
        return cls(np.concatenate([p.bins.T for p in parts], axis=1).T, codes,
                   tuple(np.concatenate(c) for c in zip(*(p.sums for p in parts), strict=True)))

    def histogram(self, slot: np.ndarray | None, n_slots: int, width: int, used: np.ndarray) -> np.ndarray:
        return histogram(self.bins, slot, n_slots, self.sums, width, used, self.codes)


@dataclass
class Rows:
    """Training rows of one task: a row of bins each, the margin so far, and their codes."""

    key: np.ndarray
    label: np.ndarray
    weight: np.ndarray
    bins: np.ndarray
    margin: np.ndarray
    codes: tuple[Codes, ...] = ()

    def grown(self, trees: Sequence[tuple[Splits, np.ndarray]]) -> Rows:
        """The rows with the values of these trees in their margins."""
        margin = self.margin
        for splits, values in trees:
            margin = margin + values[splits.descend(self.bins)]
        return replace(self, margin=margin)

    def for_tree(self, tree: int, plan: Growth) -> Sample:
        """The rows in the sample of a tree."""
        on = np.flatnonzero(sampled(self.key, tree, plan))
        sums = gradients(self.margin[on], self.label[on], self.weight[on])
        if all(np.abs(s).max(initial=0.0) < 2.0 ** 31 for s in sums):
            sums = tuple(s.astype(np.int32) for s in sums)
        return replace(Sample(self.bins, self.codes, ()).of(on), sums=sums)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each batch of `binned`: the bytes of each of its columns."""
    for batch in batches:
        if batch.num_rows:
            numbers = [batch.column(i).to_numpy(zero_copy_only=False).astype(t).tobytes() for i, t in enumerate(_NUMBERS)]
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in (
                *numbers, b"".join(batch.column(len(_NUMBERS)).to_pylist()))], batch.schema.names)


def _blocks(rows: Iterator[Row], n_features: int, bias: float, sizes: Sequence[int] = ()) -> Iterator[Rows]:
    """One block with all rows of a task, from those of `_packed`; sizes: how many bins each feature has."""
    columns = list(zip(*rows, strict=True))
    if columns:
        key, label, weight, bins = (np.frombuffer(b"".join(c), t) for c, t in zip(columns, (*_NUMBERS, np.uint8), strict=True))
        bins = np.asfortranarray(bins.reshape(len(key), n_features))
        yield Rows(key, label, weight, bins, np.full(len(key), bias), coded(bins, sizes))


def histogram(bins: np.ndarray, slot: np.ndarray | None, n_slots: int, sums: tuple[np.ndarray, ...], width: int,
              used: np.ndarray, codes: Sequence[Codes] = ()) -> np.ndarray:
    """(slots, features, width, 3) sums and number of the rows of each slot by feature (those used) and bin; slot -1 is
    left out, no slots: all rows are in the first. Features of one code are summed by it."""
    out = np.zeros((n_slots, bins.shape[1], width, 3), np.int64)
    on = slice(None) if slot is None else np.flatnonzero(slot >= 0)
    place = 0 if slot is None else slot[on] * width
    sums = [s[on].astype(float) for s in sums]
    rows, left = len(sums[0]), set(np.asarray(used).tolist())

    def cells(place: np.ndarray | int, of: np.ndarray, n: int) -> Iterator[np.ndarray]:
        cell = place + of[on].astype(np.int64)
        for s in (*sums, None):
            yield np.rint(np.bincount(cell, s, n_slots * n)).astype(np.int64)

    for features, sizes, code in codes:
        mine = [i for i, f in enumerate(features) if f in left]
        if len(mine) < 2 or rows < n_slots * math.prod(sizes):
            continue
        for k, found in enumerate(cells(place // width * math.prod(sizes), code, math.prod(sizes))):
            found = found.reshape(n_slots, *sizes)
            for i in mine:
                others = tuple(a for a in range(1, len(sizes) + 1) if a != i + 1)
                out[:, features[i], :sizes[i], k] = found.sum(axis=others)
        left -= set(features)
    for j in left:
        for k, found in enumerate(cells(place, bins[:, j], width)):
            out[:, j, :, k] = found.reshape(n_slots, width)
    return out


def _summed(hists: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
    """The sum of all histograms."""
    total = sum(hists)
    if isinstance(total, np.ndarray):
        yield total


def _slots(nodes: list[Node], asked: list[int]) -> np.ndarray:
    """The place of each node in asked, or -1."""
    slot_of = np.full(len(nodes), -1)
    slot_of[asked] = np.arange(len(asked))
    return slot_of


def _histograms(data: RDD, n_parts: int, nodes: list[Node] | None, asked: list[int], n_features: int, width: int,
                used: np.ndarray, plan: Growth) -> np.ndarray:
    """Histograms of the asked nodes (of the root, where there is no node yet).

    Each task gives one histogram; they are added up in a tree of Spark
    stages, so the driver gets at most `fan_in` of them.
    """
    growing = Splits.of(nodes) if nodes else None
    n_slots = max(1, len(asked))
    slot_of = _slots(nodes, asked) if nodes else None

    def run(blocks: Iterator[Sample]) -> Iterator[np.ndarray]:
        return _summed(b.histogram(slot_of[growing.descend(b.bins)] if growing else None, n_slots, width, used)[:, used]
                       for b in blocks)

    parts = data.mapPartitions(run)
    while n_parts > plan.fan_in:
        n_parts = -(-n_parts // plan.fan_in)
        parts = parts.repartition(n_parts).mapPartitions(_summed)
    out = np.zeros((n_slots, n_features, width, 3), np.int64)
    for found in parts.collect():
        out[:, used] += found
    return out


def _subtrees(data: RDD, nodes: list[Node], asked: list[int], width: int, used: np.ndarray,
              plan: Growth) -> list[list[Node]]:
    """The nodes from each asked one down (itself first), grown in a task for each, to which its rows in the sample go."""
    growing, slot_of, depth = Splits.of(nodes), _slots(nodes, asked), nodes[asked[0]].depth

    def dealt(b: Sample) -> Iterator[tuple[int, Sample]]:
        slot = slot_of[growing.descend(b.bins)]
        for k in np.unique(slot[slot >= 0]).tolist():
            yield k, b.of(np.flatnonzero(slot == k))

    def grown(rows: Iterator[tuple[int, Sample]]) -> Iterator[tuple[int, list[Node]]]:
        by_node: dict[int, list[Sample]] = {}
        for k, part in rows:
            by_node.setdefault(k, []).append(part)
        for k, parts in by_node.items():
            mine = Sample.joined(parts)
            at = np.zeros(len(mine.bins), np.int64)

            def child_hists(below: list[Node], wanted: list[int]) -> np.ndarray:
                nonlocal at  # each level is asked for once: a step down
                at = Splits.of(below).descend(mine.bins, at, 1)
                return mine.histogram(_slots(below, wanted)[at], len(wanted), width, used)

            yield k, split_all(mine.histogram(None, 1, width, used)[0], used, plan, child_hists, depth=depth)

    found = dict(data.flatMap(dealt).partitionBy(len(asked), int).mapPartitions(grown).collect())
    return [found[k] for k in range(len(asked))]


def fit(train: DataFrame, columns: list[str], plan: Growth = Growth(), *, id_col: str = "transaction_id") -> Ensemble:
    """The ensemble of leaf-wise trees for `label` (0 or 1) with `weight`, on columns (in the order of FEATURES)."""
    from fraudspark.session import ensure_checkpoint_dir, ship_package

    spark = train.sparkSession
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    edges = bin_edges(train, columns, plan.max_bins)
    width = max(len(e) for e in edges) + 1
    total = train.agg(F.sum(F.col("label") * F.col("weight")), F.sum("weight"), F.sum("label"), F.count("label")).first()
    if not total[3] or not 0 < total[2] < total[3]:
        raise ValueError("both classes are needed to fit")
    share = float(total[0]) / float(total[1])
    bias = float(np.log(share / (1.0 - share)))
    n_parts = max(-(-int(total[3]) // plan.rows_per_task),
                  min(spark.sparkContext.defaultParallelism, -(-int(total[3]) // plan.least_rows)))
    dealt = binned(train, columns, edges, id_col).repartition(n_parts, "key")
    packed = dealt.mapInArrow(_packed, "key binary, label binary, weight binary, bins binary")
    sizes = [len(e) + 1 for e in edges]
    data = packed.rdd.mapPartitions(lambda rows: _blocks(rows, len(columns), bias, sizes))
    last: list[tuple[Splits, np.ndarray]] = []  # trees whose values the blocks don't have yet
    held: list[RDD] = []
    rows: list[tuple] = []
    try:
        for tree in range(plan.n_trees):
            used = columns_of(tree, len(columns), plan)
            if tree % plan.hold_every == 0 or tree % plan.write_every == 0:
                data, last = data.map(lambda block, last=tuple(last): block.grown(last)), []
                data.persist(StorageLevel.MEMORY_AND_DISK)
                if tree % plan.write_every == 0:
                    data.checkpoint()
            sample = data.map(lambda block, last=tuple(last), tree=tree: block.grown(last).for_tree(tree, plan))
            sample.persist(StorageLevel.MEMORY_AND_DISK)
            held += [data, sample]

            def asked(nodes: list[Node] | None, wanted: list[int]) -> np.ndarray:
                return _histograms(sample, n_parts, nodes, wanted, len(columns), width, used, plan)

            def below(nodes: list[Node], wanted: list[int]) -> list[list[Node]]:
                return _subtrees(sample, nodes, wanted, width, used, plan)

            root = asked(None, [])[0]
            for old in held[:-2]:  # the root's histogram has filled this tree's sample
                if old is not data:
                    old.unpersist()
            held = held[-2:]
            nodes = grow(root, used, plan, asked, below)
            rows += node_rows(tree, nodes, edges, plan)
            last.append((Splits.of(nodes), leaf_values(nodes, plan)))
    finally:
        for old in held:
            old.unpersist()
    return Ensemble(pd.DataFrame(rows, columns=NODE_SCHEMA.names), bias)
