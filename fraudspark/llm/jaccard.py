"""N-gram Jaccard join by chosen paths.

Each document is the set of its five-word shingles. Equal sets become one
class first (copies are counted, never expanded). Every class has a MinHash
embedding: `width` coordinates, each the least hash of the set under one
function, so that two sets agree on a coordinate with the probability of their
Jaccard similarity.

A run starts with all sets in one node. A node of more than `leaf` sets deals
its sets to child nodes by their value on one coordinate, to at most `depth`
levels; a pair above the threshold stays together on one level with probability
threshold or more. Each level of each run has a coordinate of its own, so runs
fail independently of each other. Runs are repeated
until the recall, 1 - (1 - threshold^depth)^runs at least, reaches the target
(most leaves end at the first level, where it is far higher). Sets in a leaf
are compared by brute force, in blocks of `block` sets when a leaf is large:
first by agreeing coordinates, then exactly. A pair is counted in the first
run in which it shares a leaf, so every link counts once. Nothing is capped.

Links leave the tasks as sums per set and as spanning edges of each compared
block, so a group of k similar sets yields O(k) rows per block, not k^2.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from fraudspark.llm.tables import ship_package, written
from fraudspark.llm.text import Texts, Words, mixed, pieces, window_hashes


#: Rows that go to a Python worker at a time: texts, embeddings or shingles.
WIDE = 1000


@dataclass(frozen=True)
class JoinPlan:
    threshold: float = 0.8
    shingle: int = 5
    width: int = 64
    recall: float = 0.99999
    depth: int = 3
    leaf: int = 128
    block: int = 256

    @property
    def runs(self) -> int:
        return math.ceil(math.log(1 - self.recall) / math.log(1 - self.threshold**self.depth))

    @property
    def coordinates(self) -> int:
        """Coordinates of the embedding: `width`, or as many as give each level of each run its own."""
        return max(self.width, self.runs * self.depth)

    @property
    def least_agreeing(self) -> int:
        """Coordinates on which a pair must agree to be compared exactly: 5.5 standard deviations below the mean."""
        t = self.threshold
        return max(1, math.floor(self.coordinates * t - 5.5 * math.sqrt(self.coordinates * t * (1 - t))))


def shingle_sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, end to end, and each text's bounds.

    A text with words, but fewer than `size`, has one shingle of all its words.
    """
    texts = Texts(column)
    words = Words(texts)
    h = words.hashes()
    shingle, at = window_hashes(h, words.doc, size)
    doc = words.doc[at]
    for k in range(1, size):
        few = np.flatnonzero(words.counts == k)
        if len(few):
            first = words.first[few]
            value = np.zeros(len(few), np.uint64)
            for j in range(k):
                value = mixed(value + h[first + j])
            shingle, doc = np.concatenate([shingle, value]), np.concatenate([doc, few])
    order = np.argsort(shingle)
    order = order[np.argsort(doc[order], kind="stable")]
    shingle, doc = shingle[order], doc[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (shingle[1:] != shingle[:-1])
    shingle, doc = shingle[new], doc[new]
    return shingle, np.searchsorted(doc, np.arange(texts.n + 1))


def min_hashes(shingle: np.ndarray, first: np.ndarray, width: int) -> np.ndarray:
    """The embedding of each non-empty set, one row each: int32 minima under `width` functions."""
    rng = np.random.default_rng(7)
    keys = rng.integers(0, 2**63, (2, width), dtype=np.uint64)
    out = np.empty((len(first), width), np.int32)
    for j in range(width):
        v = (shingle ^ keys[0, j]) * (keys[1, j] * np.uint64(2) + np.uint64(1))
        v ^= v >> np.uint64(32)
        v *= np.uint64(0x9E3779B97F4A7C15)
        out[:, j] = (np.minimum.reduceat(v, first) >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return out


def _sketches(docs: DataFrame, plan: JoinPlan) -> DataFrame:
    """doc_id, a 128-bit key of the shingle set, its size and its embedding; documents without words are left out."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces(batch.column(1)):
                shingle, bounds = shingle_sets(batch.column(1).slice(a, b - a), plan.shingle)
                size = np.diff(bounds)
                full = np.flatnonzero(size)
                if not len(full):
                    continue
                first = bounds[:-1][full]
                keys = [np.add.reduceat(mixed(shingle ^ np.uint64(x)), first).view(np.int64) for x in (3, 5)]
                sketch = min_hashes(shingle, first, plan.coordinates)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a).take(pa.array(full)), *map(pa.array, keys),
                     pa.array(size[full].astype(np.int32)),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(full) + 1, dtype=np.int32) * plan.coordinates),
                                              pa.array(sketch.ravel()))],
                    ["doc_id", "k1", "k2", "size", "sketch"])

    return docs.mapInArrow(rows, f"doc_id {kind}, k1 bigint, k2 bigint, size int, sketch array<int>")


def _leaves(sets: DataFrame, plan: JoinPlan) -> DataFrame:
    """(set_id, run, path, n): the leaf of each set in each run, where it holds n > 1 sets."""

    def child(path: F.Column, level: int) -> F.Column:
        at = (F.col("run") - 1) * plan.depth + level
        return F.xxhash64(path, at, F.element_at("sketch", at))

    def counted(nodes: DataFrame, level: int) -> DataFrame:
        # written, so that the join stands on shuffles alone and Spark can split a node with very many sets
        many = written(nodes.groupBy("path").agg(F.count("*").alias("n")).filter("n > 1"), f"counts-{level}")
        return written(nodes.join(many, "path"), f"nodes-{level}")

    roots = sets.select("set_id", "sketch", F.explode(F.sequence(F.lit(1), F.lit(plan.runs))).alias("run"))
    nodes = counted(roots.select("set_id", "run", child(F.xxhash64("run"), 1).alias("path")), 1)
    leaves = []
    for level in range(2, plan.depth + 1):
        leaves.append(nodes.filter(F.col("n") <= plan.leaf))
        wide = nodes.filter(F.col("n") > plan.leaf).join(sets.select("set_id", "sketch"), "set_id")
        nodes = counted(wide.select("set_id", "run", child(F.col("path"), level).alias("path")), level)
    leaves.append(nodes)
    out = leaves[0]
    for more in leaves[1:]:
        out = out.unionByName(more)
    return out.select("set_id", "run", "path", "n")


def _blocks(leaves: DataFrame, plan: JoinPlan) -> DataFrame:
    """Each leaf row once for each pair of blocks that its block takes part in (a small leaf is one block)."""
    n = F.ceil(F.col("n") / plan.block).cast("int")
    mine = F.pmod(F.xxhash64("set_id", "path"), n).cast("int")
    wide = leaves.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), n - 1)))
    low, high = F.least("mine", "other"), F.greatest("mine", "other")
    return wide.select("set_id", "run", "mine", F.xxhash64("path", low, high).alias("node"),
                       (low == high).alias("within"))


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Batches of a partition sorted by key, cut so that no group is split, with the groups' bounds."""
    held: list[pa.RecordBatch] = []

    def table() -> tuple[pa.Table, np.ndarray]:
        t = pa.Table.from_batches(held).combine_chunks()
        k = t.column(key).to_numpy()
        return t, np.concatenate([[0], np.flatnonzero(k[1:] != k[:-1]) + 1, [len(k)]])

    for batch in batches:
        if not batch.num_rows:
            continue
        k = batch.column(batch.schema.get_field_index(key)).to_numpy()
        last = int(np.searchsorted(k, k[-1]))
        if held and last == 0 and held[-1].column(held[-1].schema.get_field_index(key))[-1].as_py() == k[0]:
            held.append(batch)
            continue
        held.append(batch.slice(0, last))
        held = [x for x in held if x.num_rows]
        if held:
            yield table()
        held = [batch.slice(last)]
    if held:
        yield table()


def _lists(table: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Values and bounds of a list column."""
    column = table.column(name).combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    at = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False), at.astype(np.int64)


def _own_pairs(a: int, b: int, mine: np.ndarray, within: bool, run: int, sketch: np.ndarray, leaf: np.ndarray,
               size: np.ndarray, plan: JoinPlan) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows a..b-1 that this node owns and whose embeddings and sizes allow the threshold."""
    if b - a == 2:
        x, y = np.array([a]), np.array([a + 1])
    else:
        x, y = np.triu_indices(b - a, 1)
        x, y = x + a, y + a
    ok = np.minimum(size[x], size[y]) >= plan.threshold * np.maximum(size[x], size[y])
    if not within:
        ok &= mine[x] != mine[y]
    x, y = x[ok], y[ok]
    found = []
    for at in range(0, len(x), 65536):
        p, q = x[at:at + 65536], y[at:at + 65536]
        near = np.flatnonzero(np.count_nonzero(sketch[p] == sketch[q], axis=1) >= plan.least_agreeing)
        p, q = p[near], q[near]
        same = leaf[p] == leaf[q]
        found.append((p, q, np.argmax(same, axis=1) == run - 1))
    if not found:
        return x, y
    keep = np.concatenate([f[2] for f in found])
    return np.concatenate([f[0] for f in found])[keep], np.concatenate([f[1] for f in found])[keep]


def _packed(embedded: DataFrame, plan: JoinPlan) -> DataFrame:
    """(set_id, copies, size, packed): a byte of each coordinate and 4 bytes of each run's leaf, as one value.

    Sets that agree on a coordinate agree on its byte, so fewer bytes only let
    more pairs through to the exact check. Two leaves of a run share their 4
    bytes by chance in 1 of 2^32 pairs, far below the recall that is left open.
    """
    kind = embedded.schema["set_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sketch = batch.column(3).flatten().to_numpy(zero_copy_only=False).reshape(-1, plan.coordinates)
            leaf = batch.column(4).flatten().to_numpy(zero_copy_only=False).reshape(-1, plan.runs)
            raw = np.hstack([sketch.astype(np.uint8), leaf.astype("<i4").view(np.uint8)])
            at = np.arange(len(raw) + 1, dtype=np.int32) * raw.shape[1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.Array.from_buffers(pa.binary(), len(raw), [
                    None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(raw))])],
                ["set_id", "copies", "size", "packed"])

    return embedded.mapInArrow(run, f"set_id {kind}, copies bigint, size int, packed binary")


def _node_arrays(table: pa.Table, plan: JoinPlan) -> tuple[np.ndarray, ...]:
    packed = table.column("packed").combine_chunks()
    packed = packed.chunk(0) if isinstance(packed, pa.ChunkedArray) else packed
    width = plan.coordinates + 4 * plan.runs
    raw = np.frombuffer(packed.buffers()[2], np.uint8)[packed.offset * width:(packed.offset + len(packed)) * width]
    raw = raw.reshape(-1, width)
    leaf = np.ascontiguousarray(raw[:, plan.coordinates:]).view("<i4")
    return (table.column("mine").to_numpy(), table.column("within").to_numpy(), table.column("run").to_numpy(),
            np.ascontiguousarray(raw[:, :plan.coordinates]), leaf, table.column("size").to_numpy())


def _candidates(rows: DataFrame, plan: JoinPlan) -> DataFrame:
    """(set_id, node, ...) of the sets with a pair that the node must compare exactly."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in _groups(batches, "node"):
            mine, within, runs, sketch, leaf, size = _node_arrays(table, plan)
            take = []
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                if b - a > 1:
                    x, y = _own_pairs(a, b, mine, within[a], runs[a], sketch, leaf, size, plan)
                    take.append(np.union1d(x, y))
            if take and len(every := np.concatenate(take)):
                part = table.select(["set_id", "node", "run", "mine", "within"]).take(pa.array(every))
                yield from part.combine_chunks().to_batches()

    kind = rows.schema["set_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"set_id {kind}, node bigint, run int, mine int, within boolean")


def _linked(x: np.ndarray, y: np.ndarray, values: np.ndarray, at: np.ndarray, a: int, b: int,
            threshold: float) -> np.ndarray:
    """Which of the pairs (x, y) of rows a..b-1 have a Jaccard similarity of the threshold or more."""
    part = values[at[a]:at[b]]
    _, code = np.unique(part, return_inverse=True)
    bounds = at[a:b + 1] - at[a]
    size = np.diff(bounds)
    mark = np.zeros(code.max() + 1, bool)
    out = np.zeros(len(x), bool)
    order = np.argsort(x, kind="stable")
    cut = np.concatenate([[0], np.flatnonzero(np.diff(x[order])) + 1, [len(x)]])
    for s, e in zip(cut[:-1], cut[1:], strict=True):
        some = order[s:e]
        i = x[some[0]] - a
        own = code[bounds[i]:bounds[i + 1]]
        mark[own] = True
        if e - s == 1:
            j = y[some[0]] - a
            both = np.array([np.count_nonzero(mark[code[bounds[j]:bounds[j + 1]]])])
        else:
            both = np.add.reduceat(mark[code], bounds[:-1], dtype=np.int64)[y[some] - a]
        mark[own] = False
        out[some] = both >= threshold * (size[i] + size[y[some] - a] - both) - 1e-9
    return out


def _compared(rows: DataFrame, plan: JoinPlan) -> DataFrame:
    """(set_id, links, root): documents linked to the set in one node, and an edge of the node's spanning forest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in _groups(batches, "node"):
            mine, within, runs, sketch, leaf, size = _node_arrays(table, plan)
            values, at = _lists(table, "shingles")
            ids, copies = table.column("set_id"), table.column("copies").to_numpy()
            links, root = np.zeros(table.num_rows, np.int64), np.arange(table.num_rows)
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                if b - a < 2:
                    continue
                x, y = _own_pairs(a, b, mine, within[a], runs[a], sketch, leaf, size, plan)
                if not len(x):
                    continue
                ok = _linked(x, y, values, at, a, b, plan.threshold)
                x, y = x[ok], y[ok]
                np.add.at(links, x, copies[y])
                np.add.at(links, y, copies[x])
                low = root[a:b]
                while len(x):  # least row of each part, by repeated minima
                    was = low.copy()
                    np.minimum.at(low, x - a, low[y - a])
                    np.minimum.at(low, y - a, low[x - a])
                    low[:] = low[low - a]
                    if (was == low).all():
                        break
            some = np.flatnonzero(links)
            if len(some):
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(some)).combine_chunks(), pa.array(links[some]),
                     ids.take(pa.array(root[some])).combine_chunks()], ["set_id", "links", "root"])

    kind = rows.schema["set_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"set_id {kind}, links bigint, root {kind}")


def components(edges: DataFrame) -> DataFrame:
    """(id, class): the least id of each connected component of edges (u, v), by large-star and small-star steps."""

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = both if large else both.filter("v <= u")
        # written, so that the join stands on shuffles alone and Spark can split or broadcast at a hub
        least = written(near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        out = near.join(least, "u")
        out = out.filter("v > u") if large else out
        made = out.select(F.col("v").alias("u"), F.col("m").alias("v"))
        if not large:
            made = made.unionByName(least.select("u", F.col("m").alias("v")))
        return made.filter("u <> v").distinct()

    edges = written(edges.filter("u <> v").distinct(), "edges")
    before = None
    while True:
        edges = written(star(star(edges, True), False), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("class"))
        before = now


def jaccard_classes(docs: DataFrame, plan: JoinPlan = JoinPlan(), id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, class_id, n_copies, n_links.

    class_id is the least doc_id of the documents joined by links (Jaccard
    similarity of the threshold or more) or by equal shingle sets; n_copies
    counts the other documents with the same set, n_links those with a
    different, similar one. A text without words (or null) has a class of its
    own and no links. A doc_id names one document: repeated rows count as one
    and each gets the same answer; a row with a null id keeps class_id null.
    Other columns are ignored; ties go to the least id.
    """
    spark: SparkSession = docs.sparkSession
    ship_package(spark)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    sketches = written(_sketches(docs.filter("doc_id IS NOT NULL"), plan), "sketches", WIDE)
    sets = written(
        sketches.groupBy("k1", "k2").agg(F.min("doc_id").alias("set_id"), F.countDistinct("doc_id").alias("copies")),
        "sets")
    full = written(sets.join(sketches.select(F.col("doc_id").alias("set_id"), "k1", "k2", "size", "sketch"),
                             ["set_id", "k1", "k2"]).dropDuplicates(["set_id", "k1", "k2"])
                   .select("set_id", "copies", "size", "sketch"), "embeddings")
    leaves = _leaves(full, plan)
    # the leaf of every run as one array; 0 - run where the set is alone, so that it never equals another's
    listed = leaves.groupBy("set_id").agg(F.map_from_entries(F.collect_list(F.struct("run", "path"))).alias("at"))
    alone = F.xxhash64("set_id", F.lit("alone"))
    embedded = full.join(listed, "set_id").select(
        "set_id", "copies", "size", "sketch",
        F.transform(F.sequence(F.lit(1), F.lit(plan.runs)),
                    lambda r: F.coalesce(F.element_at("at", r), alone + r)).alias("leaf"))
    embedded = written(_packed(embedded, plan), "embedded", WIDE)
    blocks = _blocks(leaves, plan)

    def dealt(rows: DataFrame) -> DataFrame:
        return rows.repartition("node").sortWithinPartitions("node")

    near = written(_candidates(dealt(blocks.join(embedded.drop("copies"), "set_id")), plan), "candidates", WIDE)
    needed = near.select("set_id").distinct()
    shingles = _shingles(docs.join(needed, docs["doc_id"] == needed["set_id"], "left_semi"), plan)
    rows = near.join(embedded, "set_id").join(shingles.dropDuplicates(["set_id"]), "set_id")
    found = written(_compared(dealt(rows), plan), "links", WIDE)
    classes = components(found.select(F.col("set_id").alias("u"), F.col("root").alias("v")))
    links = found.groupBy("set_id").agg(F.sum("links").alias("n_links"))
    known = written(
        sets.join(links, "set_id", "left").join(classes, sets["set_id"] == classes["id"], "left")
        .select("k1", "k2", F.coalesce("class", "set_id").alias("class_id"), (F.col("copies") - 1).alias("n_copies"),
                F.coalesce("n_links", F.lit(0)).alias("n_links")), "classes")
    member = sketches.select("doc_id", "k1", "k2").join(known, ["k1", "k2"]).drop("k1", "k2").distinct()
    return docs.select("doc_id").join(member, "doc_id", "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("n_copies", F.lit(0)).cast("bigint").alias("n_copies"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"))


def _shingles(docs: DataFrame, plan: JoinPlan) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces(batch.column(1)):
                shingle, bounds = shingle_sets(batch.column(1).slice(a, b - a), plan.shingle)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a),
                     pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(shingle.view(np.int64)))],
                    ["set_id", "shingles"])

    return docs.mapInArrow(rows, f"set_id {kind}, shingles array<bigint>")


def one_of_each_group(docs: DataFrame, plan: JoinPlan = JoinPlan()) -> DataFrame:
    """docs (all columns) without the documents that are not the least of their class; null ids stay."""
    gone = jaccard_classes(docs, plan).filter("class_id <> doc_id").select(F.col("doc_id").alias("gone_id"))
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")
