"""Best-two-fit packing of documents into sequences of a fixed length.

A sequence is filled greedily, always with the longest unpacked piece that
fits. Then its smallest piece is replaced by the two unpacked pieces that fill
the expanded gap best, if they fill it more tightly.

Only lengths matter to the rule, and there are at most `capacity` of them. So
Spark counts the pieces of each length, the rule runs on these counts (equal
sequences follow each other and are taken in one step, so the work is bounded
by the capacity, not by the documents), and each piece finds its sequence by
its number among the pieces of its length. Pieces are numbered where they are
written; counts per file give the offsets. The result is that of the rule on
all documents at once.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from fraudspark.llm.tables import ship_package, written
from fraudspark.llm.text import pieces
from fraudspark.llm.token_files import shared_encoder


@dataclass(frozen=True)
class PackPlan:
    """Sequences of at most `capacity` tokens; end_id closes each document."""

    capacity: int = 2048
    end_id: int = 0


@dataclass(frozen=True)
class Run:
    """`times` equal sequences, numbered from `first`: uses[i] = (length, copies in each), longest first."""

    first: int
    times: int
    uses: tuple[tuple[int, int], ...]


def best_two_fit(counts: np.ndarray, capacity: int) -> list[Run]:
    """The sequences of the rule for counts[length] pieces of each length (0 to capacity)."""
    left = counts.astype(np.int64).copy()
    left[0] = 0
    runs: list[Run] = []
    first = 0
    while left.any():
        have = np.flatnonzero(left)
        need: dict[int, int] = {}  # pieces of each length that the rule looks at
        gap = capacity

        def longest(most: int) -> int:
            """The longest piece left of at most this length (0: none)."""
            at = int(np.searchsorted(have, most, "right")) - 1
            while at >= 0 and left[have[at]] <= need.get(int(have[at]), 0):
                at -= 1
            return int(have[at]) if at >= 0 else 0

        filled: list[int] = []
        while gap and (size := longest(gap)):
            copies = min(gap // size, int(left[size]) - need.get(size, 0))
            need[size] = need.get(size, 0) + copies
            filled += [size] * copies
            gap -= copies * size
        used = dict(need)
        if gap and len(filled) > 1:
            a, b = _best_two(left, need, have, gap + filled[-1])
            if a + b > filled[-1]:
                used[filled[-1]] -= 1
                for size in (a, b):
                    need[size] = need.get(size, 0) + 1
                    used[size] = used.get(size, 0) + 1
        used = {size: n for size, n in used.items() if n}
        # the next sequence is the same as long as all pieces that the rule looked at are there
        times = min((int(left[size]) - need[size]) // n for size, n in used.items()) + 1
        runs.append(Run(first, times, tuple(sorted(used.items(), reverse=True))))
        for size, n in used.items():
            left[size] -= times * n
        first += times
    return runs


def _best_two(left: np.ndarray, need: dict[int, int], have: np.ndarray, gap: int) -> tuple[int, int]:
    """The two unpacked lengths with the greatest sum of at most gap; of equal sums that with the longest piece."""
    free = left[have].copy()
    for size, n in need.items():
        free[np.searchsorted(have, size)] -= n
    sizes, free = have[free > 0], free[free > 0]
    sizes, free = sizes[sizes < gap], free[sizes < gap]
    if not len(sizes):
        return 0, 0
    other = np.searchsorted(sizes, gap - sizes, "right") - 1
    mine = np.arange(len(sizes))
    other = np.minimum(other, mine)  # the shorter one of the two
    alone = (other == mine) & (free < 2)
    other = np.where(alone, other - 1, other)
    ok = other >= 0
    if not ok.any():
        return 0, 0
    total = np.where(ok, sizes + sizes[np.maximum(other, 0)], -1)
    at = len(total) - 1 - int(np.argmax(total[::-1]))
    return int(sizes[at]), int(sizes[other[at]])


@dataclass(frozen=True)
class _Places:
    """For each length, intervals of piece numbers: begin, copies in a sequence, first sequence, offset there."""

    first: np.ndarray
    begin: np.ndarray
    copies: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray

    def find(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        span = self.begin.max(initial=0) + number.max(initial=0) + 1
        key = self._length * span + self.begin
        at = np.searchsorted(key, length * span + number, "right") - 1
        inside = number - self.begin[at]
        return (self.sequence[at] + inside // self.copies[at],
                self.offset[at] + inside % self.copies[at] * length)

    @property
    def _length(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def _places(runs: list[Run], capacity: int) -> _Places:
    begin = np.zeros(capacity + 1, np.int64)
    rows: list[tuple[int, int, int, int, int]] = []
    for run in runs:
        at = 0
        for size, n in run.uses:
            rows.append((size, int(begin[size]), n, run.first, at))
            begin[size] += n * run.times
            at += size * n
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return _Places(np.searchsorted(table[:, 0], np.arange(capacity + 2)), *(table[:, k].copy() for k in range(1, 5)))


def _pieces(docs: DataFrame, definition: str, plan: PackPlan) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, and part (task) and number (among the task's pieces of the length)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = shared_encoder(definition), TaskContext.get().partitionId()
        seen = np.zeros(plan.capacity + 1, np.int64)
        for batch in batches:
            for a, b in pieces(batch.column(1)):
                flat, at = encoder(batch.column(1).slice(a, b - a), plan.end_id)
                tokens = np.diff(at)
                count = -(-tokens // plan.capacity)
                doc = np.repeat(np.arange(b - a), count)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
                start = piece * plan.capacity
                length = np.minimum(plan.capacity, tokens[doc] - start)
                raw = memoryview(np.ascontiguousarray(flat.astype("<u4"))).cast("B")
                begin = (at[doc] + start).tolist()
                crc = [zlib.crc32(raw[4 * x:4 * (x + n)]) for x, n in zip(begin, length.tolist(), strict=True)]
                order = np.argsort(length, kind="stable")
                some, first, n = np.unique(length[order], return_index=True, return_counts=True)
                number = np.empty(len(length), np.int64)
                number[order] = np.arange(len(length)) - np.repeat(first, n) + np.repeat(seen[some], n)
                seen[some] += n
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a).take(pa.array(doc)), pa.array(piece.astype(np.int32)),
                     pa.array(start.astype(np.int64)), pa.array(length.astype(np.int64)), pa.array(crc, pa.int64()),
                     pa.array(np.full(len(doc), part, np.int32)), pa.array(number)],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "part", "number"])

    return docs.mapInArrow(run, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, part int, "
                                "number bigint")


def pack(docs: DataFrame, tokenizer_path: str, plan: PackPlan = PackPlan(), id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document's ids end with end_id; a longer document is cut into pieces of
    `capacity`. A null or empty text is the end id alone. Each row is a
    document, repeated and null ids too. Which of several pieces of one length
    takes which place is not fixed (it follows the order in which they are
    read). A text may have any length; a task takes a megabyte at a time, a
    longer text alone. An empty table gives no rows. Other columns are ignored.
    """
    ship_package(docs.sparkSession)
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = f.read()
    docs = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    # written: numbers and counts must come from the same run of each task
    cut = written(_pieces(docs, definition, plan), "pieces")
    counts = written(cut.groupBy("length", "part").agg(F.count("*").alias("n")), "counts")
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    # at most `capacity` rows come to the driver
    found = counts.groupBy("length").agg(F.sum("n").alias("n")).toArrow()
    lengths = np.zeros(plan.capacity + 1, np.int64)
    lengths[found.column("length").to_numpy()] = found.column("n").to_numpy()
    places = docs.sparkSession.sparkContext.broadcast(_places(best_two_fit(lengths, plan.capacity), plan.capacity))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sequence, offset = places.value.find(batch.column(3).to_numpy(), batch.column(5).to_numpy())
                yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                                                 ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id",
                                                  "offset"])

    numbered = cut.join(offsets, ["length", "part"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("number") + F.col("before")).alias("number"))
    return numbered.mapInArrow(run, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, "
                                    "sequence_id bigint, offset bigint")
