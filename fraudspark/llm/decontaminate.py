"""Benchmark decontamination by spaced-seed hashing.

Words are compared in lower case without punctuation. A mask is a string of 1s
and 0s laid on consecutive words; the seed is the hash of the words under its
1s, so words under 0s may differ. The default masks hit every stretch of 13
words with at most two substituted words (a test proves it).

Benchmark seeds make a bit filter, sized from their number and bounded, which
goes to every task and lets nearly all seeds of the documents pass by. Those
that it holds are joined with the benchmark's seeds in Spark; around each hit
the item is laid over the document on the hit's diagonal and the words are
compared one by one.

Items shorter than `overlap` words have masks of their own: their two halves,
of which one substituted word leaves one whole. Items below `least_words` are
too short to prove anything; `untestable` lists them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from fraudspark.llm.filters import BitFilter, bit_filter
from fraudspark.llm.tables import ship_package, written
from fraudspark.llm.text import WORD_BYTE, Texts, Words, mixed, pieces

_ALNUM = WORD_BYTE.copy()
_ALNUM[:128] = [chr(i).isalnum() for i in range(128)]


@dataclass(frozen=True)
class Seeds:
    """overlap aligned words of which `matched` must be equal prove a leak.

    Items of fewer words must occur whole but for one word; those of fewer
    than least_words are too short to prove anything. The filter that every
    task holds has at most 2^bits bits (16 MB for 27).
    """

    masks: tuple[str, ...] = ("1111111", "111010000111", "111011011", "11111011")
    overlap: int = 13
    matched: int = 11
    least_words: int = 7
    bits: int = 27

    def all_masks(self, lengths: list[int]) -> list[str]:
        """The masks, and for items of these lengths (below `overlap`) their halves."""
        halves = sorted({k for n in lengths for k in (n // 2, n - n // 2)})
        return [*self.masks, *("1" * k for k in halves if "1" * k not in self.masks)]


def _words(column: pa.Array) -> tuple[Words, np.ndarray]:
    words = Words(Texts(pc.utf8_lower(column)), _ALNUM)
    return words, words.hashes()


def _seed_hashes(h: np.ndarray, doc: np.ndarray, seeds: Seeds, lengths: list[int]) -> Iterator[
        tuple[np.ndarray, np.ndarray, int]]:
    """(seed hashes, index of their first word, span) for each mask, those of short items too."""
    for number, mask in enumerate(seeds.all_masks(lengths)):
        n = len(h) - len(mask) + 1
        if n <= 0:
            continue
        at = np.flatnonzero(doc[:n] == doc[len(mask) - 1:])
        value = np.full(len(at), number + 1, np.uint64)
        for k, bit in enumerate(mask):
            if bit == "1":
                value = (value + h[at + k]) * np.uint64(0x9E3779B97F4A7C15)
                value ^= value >> np.uint64(32)
        yield mixed(value), at, len(mask)


def _benchmark(items: DataFrame, seeds: Seeds) -> DataFrame:
    kind = items.schema[0].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, h = _words(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(words.first.astype(np.int32)),
                                                           pa.array(h.view(np.int64)))], ["item_id", "words"])

    return items.mapInArrow(rows, f"item_id {kind}, words array<bigint>").filter(
        F.size("words") >= seeds.least_words).dropDuplicates()


def _item_seeds(items: DataFrame, seeds: Seeds, lengths: list[int]) -> DataFrame:
    kind = items.schema["item_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            at = lists.offsets.to_numpy()
            h = lists.values.to_numpy(zero_copy_only=False)[at[0]:at[-1]].view(np.uint64)
            doc = np.repeat(np.arange(len(lists)), np.diff(at))
            for value, first, _ in _seed_hashes(h, doc, seeds, lengths):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(doc[first])), pa.array(value.view(np.int64)),
                     pa.array((first - (at[:-1] - at[0])[doc[first]]).astype(np.int32))], ["item_id", "seed", "at"])

    return items.select("item_id", "words").mapInArrow(rows, f"item_id {kind}, seed bigint, at int")


def _regions(docs: DataFrame, held: BitFilter, seeds: Seeds, lengths: list[int], reach: int) -> DataFrame:
    """Stretches of documents around seeds that the filter holds: their words and the seeds with their places."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(held)

    def part(ids: pa.Array, column: pa.Array) -> pa.RecordBatch | None:
        words, h = _words(column)
        seed, at, span = [], [], []
        for value, first, size in _seed_hashes(h, words.doc, seeds, lengths):
            hit = np.flatnonzero(shared.value.hits(value))
            seed.append(value[hit])
            at.append(first[hit])
            span.append(np.full(len(hit), size))
        if not sum(map(len, seed)):
            return None
        seed, at, span = np.concatenate(seed), np.concatenate(at), np.concatenate(span)
        order = np.argsort(at, kind="stable")
        seed, at, span = seed[order], at[order], span[order]
        doc = words.doc[at]
        new = np.ones(len(at), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (at[1:] > at[:-1] + reach)
        first = np.flatnonzero(new)
        ends = np.append(first[1:], len(at))
        start = np.maximum(words.first[doc[first]], at[first] - reach)
        stop = np.minimum(words.first[doc[first] + 1], np.maximum.reduceat(at + span, first) + reach)
        size = stop - start
        take = np.arange(size.sum()) + np.repeat(start - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
        begin = start - words.first[doc[first]]
        bounds = pa.array(np.append(first, len(at)).astype(np.int32))
        place = at - np.repeat(start, ends - first)
        return pa.RecordBatch.from_arrays(
            [ids.take(pa.array(doc[first])), pa.array(begin.astype(np.int32)),
             pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)),
                                      pa.array(h[take].view(np.int64))),
             pa.ListArray.from_arrays(bounds, pa.array(seed.view(np.int64))),
             pa.ListArray.from_arrays(bounds, pa.array(place.astype(np.int32)))],
            ["doc_id", "begin", "words", "seeds", "places"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces(batch.column(1)):
                out = part(batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a))
                if out is not None:
                    yield out

    return docs.mapInArrow(
        rows, f"doc_id {kind}, begin int, words array<bigint>, seeds array<bigint>, places array<int>")


def _aligned(pairs: DataFrame, seeds: Seeds) -> DataFrame:
    """Lay each item over its region on the diagonal and keep those with a proven overlap."""
    types = {f.name: f.dataType.simpleString() for f in pairs.schema}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, start, matched = [], [], []
            lists = [(c.offsets.to_numpy(), c.values.to_numpy(zero_copy_only=False))
                     for c in (batch.column(2), batch.column(4))]
            begin, shift = batch.column(1).to_numpy(), batch.column(5).to_numpy()
            for i in range(batch.num_rows):
                text, item = (v[o[i]:o[i + 1]] for o, v in lists)
                d = shift[i]
                a, b = max(0, -d), min(len(item), len(text) - d)
                equal = item[a:b] == text[a + d:b + d]
                size = min(seeds.overlap, len(item))
                need = seeds.matched if len(item) >= seeds.overlap else size - 1
                if b - a < size:
                    continue
                total = np.concatenate([[0], np.cumsum(equal)])
                if (total[size:] - total[:-size]).max() >= need:
                    keep.append(i)
                    start.append(begin[i] + a + d)
                    matched.append(total[-1])
            if keep:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(keep)), batch.column(3).take(pa.array(keep)),
                     pa.array(np.array(start, np.int64)), pa.array(np.array(matched, np.int64)),
                     pc.list_value_length(batch.column(4)).take(pa.array(keep)).cast(pa.int64())],
                    ["doc_id", "item_id", "start_word", "n_matched", "n_item_words"])

    return pairs.mapInArrow(rows, f"doc_id {types['doc_id']}, item_id {types['item_id']}, start_word bigint, "
                                  "n_matched bigint, n_item_words bigint")


def leaks(docs: DataFrame, benchmark: DataFrame, seeds: Seeds = Seeds(), id_col: str = "doc_id",
          text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, start_word, n_matched, n_item_words): each document and benchmark item that overlap.

    The best alignment of a pair is given (most equal words, then the first).
    Null or empty texts and items overlap nothing; rows with a null doc_id or
    item_id can't be named and are left out; repeated rows give one pair;
    items of 7 to 12 words (see Seeds) may miss one word and shorter ones are
    not looked for (`untestable`). A text may have any length: a task takes a
    megabyte at a time, a longer text alone. Other columns are ignored.
    """
    ship_package(docs.sparkSession)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).filter("doc_id IS NOT NULL")
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text"))
    items = written(_benchmark(items.filter("item_id IS NOT NULL"), seeds), "items")
    sizes = items.select(F.size("words").alias("n"))
    reach = sizes.agg(F.max("n")).first()[0] or 0
    lengths = sorted(r["n"] for r in sizes.filter(F.col("n") < seeds.overlap).distinct().collect())
    item_seeds = written(_item_seeds(items, seeds, lengths), "item-seeds")
    # every word of the corpus starts a seed of each mask: very few may pass by chance
    held = bit_filter(item_seeds, "seed", item_seeds.count(), per_hash=512, most=seeds.bits)
    regions = written(_regions(docs, held, seeds, lengths, reach), "regions")
    regions = regions.dropDuplicates(["doc_id", "begin", "words"])
    hits = regions.select(
        "doc_id", "begin", F.xxhash64("words").alias("content"),
        F.explode(F.arrays_zip(F.col("seeds").alias("seed"), F.col("places").alias("place"))).alias("hit"))
    hits = hits.select("doc_id", "begin", "content", "hit.seed", "hit.place")
    shifts = hits.join(item_seeds, "seed").select(
        "doc_id", "begin", "content", "item_id", (F.col("place") - F.col("at")).alias("shift")).distinct()
    pairs = (shifts.join(regions.select("doc_id", "begin", "words", F.xxhash64("words").alias("content")),
                         ["doc_id", "begin", "content"])
             .join(items.withColumnRenamed("words", "item_words"), "item_id")
             .select("doc_id", "begin", "words", "item_id", "item_words", "shift"))
    best = F.max(F.struct("n_matched", (-F.col("start_word")).alias("before"), "n_item_words")).alias("best")
    return _aligned(pairs, seeds).groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", (-F.col("best.before")).alias("start_word"), "best.n_matched", "best.n_item_words")


def untestable(benchmark: DataFrame, seeds: Seeds = Seeds(), item_col: str = "item_id",
               item_text_col: str = "text") -> DataFrame:
    """(item_id, n_words) of the items that are too short to be looked for."""
    ship_package(benchmark.sparkSession)
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text"))
    every = _benchmark(items, replace(seeds, least_words=0))
    return every.select("item_id", F.size("words").alias("n_words")).filter(F.col("n_words") < seeds.least_words)


def without_leaks(docs: DataFrame, benchmark: DataFrame, seeds: Seeds = Seeds()) -> DataFrame:
    """docs (all columns) without the documents that overlap a benchmark item; null ids stay."""
    found = leaks(docs, benchmark, seeds).select(F.col("doc_id").alias("leaking_id")).distinct()
    return docs.join(found, docs["doc_id"] == found["leaking_id"], "left_anti")
