"""Substring dedup: a Rabin-Karp hash of every window of words, compared in Spark.

Tasks hash all windows of their documents, keep the least document of each
hash they see and send those, sorted and packed by ranges of the hash, to one
group for each range. A group finds for each hash the least document of all
and answers every other document that sent it. The answers meet the texts
again by document, where the repeated windows merge into maximal spans.

A window is told apart by 88 bits of two hashes, so a false match is not to be
expected below 10^13 windows. Answers carry the first 64: they are compared
with the windows of one document only.

A window that very many documents share is reduced in each task first, so its
group gets one entry a task, not one a document. The number of ranges follows
the bytes of the input; no range or document is cut off.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from fraudspark.llm.tables import ship_package
from fraudspark.llm.text import Texts, Words, covered, mixed, pieces, window_hashes


@dataclass(frozen=True)
class WindowPlan:
    """window: words; range_bytes: text bytes whose windows one group holds; gather: windows that a task packs at once."""

    window: int = 13
    range_bytes: int = 8 << 20
    gather: int = 1_500_000


def _packed(values: np.ndarray) -> bytes:
    """Unsigned integers in the fewest whole bytes that hold the largest."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8)
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _unpacked(raw: bytes, n: int) -> np.ndarray:
    width = len(raw) // n
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8).reshape(n, width)
    return out.view("<u8").ravel()


_ENTRY = pa.schema([("part", pa.int32()), ("answer", pa.int32()), ("n", pa.int32()), ("first", pa.int64()),
                    ("low", pa.int64()), ("hashes", pa.binary()), ("docs", pa.binary()), ("checks", pa.binary())])
_ENTRY_DDL = "part int, answer int, n int, first bigint, low bigint, hashes binary, docs binary, checks binary"
_NO_CHECKS = np.zeros(0, np.uint32)


def _three_bytes(check: np.ndarray) -> bytes:
    return np.ascontiguousarray(check.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3]).tobytes()


def _from_three_bytes(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 3, 4), np.uint8)
    out[:, :3] = np.frombuffer(raw, np.uint8).reshape(-1, 3)
    return out.view("<u4").ravel()


def _entries(part: np.ndarray, answer: np.ndarray, h: np.ndarray, doc: np.ndarray,
             check: np.ndarray = _NO_CHECKS) -> Iterator[tuple]:
    """Rows of packed (hash, doc, check), one for each run of equal (part, answer); sorted by hash in a run."""
    cut = np.flatnonzero((np.diff(part) != 0) | (np.diff(answer) != 0)) + 1
    for a, b in zip(np.concatenate([[0], cut]), np.append(cut, len(h)), strict=True):
        if a < b:
            low = int(doc[a:b].min())
            steps = np.diff(h[a:b], prepend=h[a])
            yield (int(part[a]), int(answer[a]), int(b - a), int(h[a:a + 1].view(np.int64)[0]), low, _packed(steps),
                   _packed((doc[a:b] - low).view(np.uint64)), _three_bytes(check[a:b]))


def _read_entries(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    hashes, docs, checks = [], [], []
    names = ("n", "first", "low", "hashes", "docs", "checks")
    for n, first, low, h, d, c in zip(*(table.column(c).to_pylist() for c in names), strict=True):
        hashes.append(np.cumsum(_unpacked(h, n)) + np.uint64(first % (1 << 64)))
        docs.append(_unpacked(d, n).view(np.int64) + low)
        checks.append(_from_three_bytes(c))
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), _NO_CHECKS
    return np.concatenate(hashes), np.concatenate(docs), np.concatenate(checks)


def _by_window(h: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by window, and where each window's entries begin in it."""
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    if (same & (check[order[1:]] != check[order[:-1]])).any():  # two windows share a hash
        order = np.lexsort((check, h))
        same = (h[order[1:]] == h[order[:-1]]) & (check[order[1:]] == check[order[:-1]])
    return order, np.flatnonzero(np.concatenate([[True], ~same]))


def _answers(h: np.ndarray, doc: np.ndarray, parts: int) -> Iterator[tuple]:
    """Entries that tell documents which of their hashes an earlier document has, packed by parts of documents."""
    to = _doc_part(doc, parts)
    order = np.lexsort((h, to))
    yield from _entries(to[order], to[order], h[order], doc[order])


def _doc_part(doc: np.ndarray, parts: int) -> np.ndarray:
    return (mixed(doc.view(np.uint64)) % np.uint64(parts)).astype(np.int32)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ENTRY, strict=True)], schema=_ENTRY)


def _sent(docs: DataFrame, plan: WindowPlan, parts: int) -> DataFrame:
    """Packed windows (answer -1) by range of hash, and answers (answer: part of documents) known within a task."""
    def send(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        h, doc, check = (np.concatenate([x[k] for x in held]) for k in range(3))
        order, first = _by_window(h, check)
        h, doc = h[order], doc[order]
        least = np.minimum.reduceat(doc, first)
        later = doc > np.repeat(least, np.diff(np.append(first, len(h))))
        rows = []
        if later.any():
            pair = np.unique(np.stack([doc[later].view(np.uint64), h[later]]), axis=1)
            for row in _answers(pair[1], pair[0].view(np.int64), parts):
                rows.append(row)
        h = h[first]
        part = (((h >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int32)
        rows += _entries(part, np.full(len(h), -1, np.int32), h, least, check[order[first]])
        yield _batch(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for a, b in pieces(batch.column(1)):
                words = Words(Texts(batch.column(1).slice(a, b - a)))
                h, at = window_hashes(words.hashes(), words.doc, plan.window)
                if len(h):
                    second = words.texts.span_hash(words.start, words.end, 2)
                    check = (window_hashes(second, words.doc, plan.window)[0] >> np.uint64(40)).astype(np.uint32)
                    held.append((h, ids[a:b][words.doc[at]], check))
                if sum(len(x[0]) for x in held) >= plan.gather:
                    yield from send(held)
                    held = []
        if held:
            yield from send(held)

    return docs.mapInArrow(run, _ENTRY_DDL)


def _answered(sent: DataFrame, parts: int) -> DataFrame:
    def run(table: pa.Table) -> pa.Table:
        mine = table.column("answer").to_numpy() < 0
        ready = table.filter(pa.array(~mine))
        rows = list(zip(*(ready.column(c).to_pylist() for c in _ENTRY.names), strict=True))
        rows = [(r[1], *r[1:]) for r in rows]
        h, doc, check = _read_entries(table.filter(pa.array(mine)))
        if len(h):
            order, first = _by_window(h, check)
            h, doc = h[order], doc[order]
            least = np.minimum.reduceat(doc, first)
            later = doc > np.repeat(least, np.diff(np.append(first, len(h))))
            if later.any():
                rows += _answers(h[later], doc[later], parts)
        return pa.Table.from_batches([_batch(rows)] if rows else [], schema=_ENTRY)

    return sent.groupBy("part").applyInArrow(run, _ENTRY_DDL)


def _texts(docs: DataFrame, parts: int) -> DataFrame:
    """Documents by part, their texts packed together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            part = _doc_part(batch.column(0).to_numpy(), parts)
            order = np.argsort(part, kind="stable")
            bounds = np.concatenate([[0], np.flatnonzero(np.diff(part[order])) + 1, [len(part)]])
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                if a == b:
                    continue
                some = pa.array(order[a:b])
                texts = Texts(batch.column(1).take(some))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part[order[a]]]), pa.array([batch.column(0).take(some).to_pylist()]),
                     pa.array([np.diff(texts.bounds).tolist()]), pa.array([pack.compress(texts.data.tobytes())])],
                    ["part", "ids", "sizes", "texts"])

    return docs.mapInArrow(run, "part int, ids array<bigint>, sizes array<bigint>, texts binary")


def _kept(ids: np.ndarray, texts: list[bytes], h: np.ndarray, doc: np.ndarray, size: int) -> Iterator[tuple]:
    """(doc_id, n_words, starts, ends, kept) of documents, given sorted answers."""
    from itertools import compress

    for number, raw in zip(ids.tolist(), texts, strict=True):
        words = raw.split()  # of bytes: at the six ASCII white space characters
        a, b = np.searchsorted(doc, [number, number + 1]) if len(doc) else (0, 0)
        if a == b:
            yield number, len(words), [], [], b" ".join(words)
            continue
        found = Words(Texts(pa.array([raw.decode()])))
        windows, at = window_hashes(found.hashes(), found.doc, size)
        gone = covered(at[np.isin(windows, h[a:b])], size, len(words))
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
        yield number, len(words), edges[::2].tolist(), edges[1::2].tolist(), b" ".join(compress(words, (~gone).tolist()))


def without_repeats(docs: DataFrame, plan: WindowPlan = WindowPlan(), id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, starts, ends (removed spans of words, end exclusive), kept (text).

    A word goes if a window covers it that also starts in a document with a
    smaller doc_id, judged on the input. Kept words are joined by one space. A
    null text is empty. Repeated rows of a doc_id are each returned and don't
    count as earlier than one another; a document with a null id is neither
    earlier nor later than any and keeps all its words. Ids are integers;
    other columns are ignored.
    """
    ship_package(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, math.ceil(size / plan.range_bytes))
    named = docs.filter("doc_id IS NOT NULL")
    answers = _answered(_sent(named, plan, parts), parts)
    schema = "doc_id bigint, n_words bigint, starts array<bigint>, ends array<bigint>, kept string"

    def table(rows: list[tuple]) -> pa.Table:
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
        out = pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                       names=["doc_id", "n_words", "starts", "ends", "kept"])
        return out.set_column(4, "kept", out.column(4).cast(pa.string()))

    def meet(answer: pa.Table, text: pa.Table) -> pa.Table:
        h, doc, _ = _read_entries(answer)
        order = np.argsort(doc, kind="stable")
        h, doc = h[order], doc[order]
        unpack = zstandard.ZstdDecompressor()
        rows: list[tuple] = []
        for ids, sizes, packed in zip(*(text.column(c).to_pylist() for c in ("ids", "sizes", "texts")), strict=True):
            raw = unpack.decompress(packed, max_output_size=max(1, sum(sizes))) if sum(sizes) else b""
            ends = np.cumsum(sizes)
            texts = [raw[e - s:e] for s, e in zip(sizes, ends.tolist(), strict=True)]
            rows += _kept(np.array(ids, np.int64), texts, h, doc, plan.window)
        return table(rows)

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column(1).to_pylist()]
            rows = [(None, *r[1:]) for r in _kept(np.zeros(len(texts), np.int64), texts, *none, plan.window)]
            yield from table(rows).combine_chunks().to_batches()

    met = answers.groupBy("part").cogroup(_texts(named, parts).groupBy("part")).applyInArrow(meet, schema)
    return met.unionByName(docs.filter("doc_id IS NULL").mapInArrow(alone, schema))
