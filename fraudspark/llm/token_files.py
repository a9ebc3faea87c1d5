"""Token ids in ORC files.

Documents are dealt by ranges of doc_id, sorted, encoded and written, a file a
range. ORC stores the ids with integer run-length encoding in stripes, with a
row index and a Bloom filter on doc_id, so readers split files by stripe and
skip stripes and row groups by document id.

The tokenizer is applied to the distinct runs without ASCII white space of some
megabytes of text at a time: its pre-tokenizer drops white space and never
joins characters across it, so the ids are those of the whole text.
"""

from __future__ import annotations

import json
import math
import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from fraudspark.llm.tables import arrow_rows, ship_package, written
from fraudspark.llm.text import Texts, Words, pieces

#: Runs that a task remembers.
MEMORY = 1_200_000
_STOP, _ALNUM = np.zeros(256, bool), np.zeros(256, bool)
_STOP[list(b".,")] = True
_ALNUM[:128] = [chr(i).isalnum() for i in range(128)]


@dataclass(frozen=True)
class FilePlan:
    """file_bytes: text bytes a file; end_id closes each document; batch_rows: rows that go to Python at a time."""

    end_id: int = 2
    file_bytes: int = 32 << 20
    stripe_bytes: int = 16 << 20
    batch_rows: int = 1000
    index_rows: int = 1000
    bloom_fpp: float = 0.01


class RunEncoder:
    """A tokenizers library tokenizer that encodes each distinct run once and remembers it, up to a bound.

    Runs are told apart by two 64-bit hashes. `keys` (sorted), `checks`, `at`
    and `size` say where in `flat` a remembered run's ids are.
    """

    def __init__(self, definition: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        model = json.loads(definition)["model"]
        mark = model.get("end_of_word_suffix") or ""
        self.closes = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True), bool)
        self.closes[[i for t, i in model["vocab"].items() if mark and t.endswith(mark)]] = True
        self._forget()

    def _forget(self) -> None:
        self.keys, self.checks = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.at, self.size, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.uint16)

    def _encoded(self, runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the runs end to end, and how many each has."""
        out: list[tuple[np.ndarray, np.ndarray]] = []
        for begin in range(0, len(runs), 4096):  # the library's results take far more room than the ids
            some = [r.decode() for r in runs[begin:begin + 4096]]
            plain = np.array([r.isalpha() for r in some])
            words = [r for r, p in zip(some, plain.tolist(), strict=True) if p]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) != len(words):  # else each run of letters was one word, and its last id is marked so
                plain[:] = False
                ids, ends = ids[:0], ends[:0]
            rest = [r for r, p in zip(some, plain.tolist(), strict=True) if not p]
            got = [e.ids for e in self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)]
            size = np.empty(len(some), np.int64)
            size[plain], size[~plain] = np.diff(ends, prepend=0), [len(g) for g in got]
            flat = np.empty(size.sum(), np.uint32)
            mine = np.repeat(plain, size)
            flat[mine], flat[~mine] = ids, [i for g in got for i in g]
            out.append((flat, size))
        return np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])

    def _learn(self, keys: np.ndarray, checks: np.ndarray, runs: list[bytes]) -> None:
        flat, size = self._encoded(runs)
        if len(flat) and flat.max() > 0xFFFF and self.flat.dtype == np.uint16:
            self.flat = self.flat.astype(np.uint32)
        place = np.searchsorted(self.keys, keys)
        self.keys, self.checks = np.insert(self.keys, place, keys), np.insert(self.checks, place, checks)
        self.at = np.insert(self.at, place, len(self.flat) + np.cumsum(size) - size)
        self.size = np.insert(self.size, place, size)
        self.flat = np.concatenate([self.flat, flat.astype(self.flat.dtype)])

    def __call__(self, column: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, each closed by end_id, and each text's bounds."""
        texts = Texts(column)
        start, end, doc = _runs(Words(texts))
        which, keys = pd.factorize(texts.span_hash(start, end))
        first = np.empty(len(keys), np.int64)
        first[which[::-1]] = np.arange(len(which))[::-1]
        checks = texts.span_hash(start, end, 2)
        if (checks != checks[first][which]).any():
            return self._plainly(column, end_id)
        order = np.argsort(keys)
        rank = np.empty(len(keys), np.int64)
        rank[order] = np.arange(len(keys))
        which, keys, first, checks = rank[which], keys[order], first[order], checks[first[order]]
        for _ in range(2):
            place = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
            known = self.keys[place] == keys if len(self.keys) else np.zeros(len(keys), bool)
            if known.any() and (self.checks[place[known]] != checks[known]).any():
                return self._plainly(column, end_id)
            new = np.flatnonzero(~known)
            if not len(new):
                break
            if len(self.keys) + len(new) > MEMORY and len(self.keys):
                self._forget()
                new = np.arange(len(keys))
            raw = texts.data.tobytes()
            self._learn(keys[new], checks[new], [raw[a:b] for a, b in zip(
                start[first[new]].tolist(), end[first[new]].tolist(), strict=True)])
        # one more entry stands for the end of a text
        at, size = np.append(self.at[place], len(self.flat)), np.append(self.size[place], 1).astype(np.int64)
        which = np.insert(which, np.searchsorted(doc, np.arange(texts.n), "right"), len(keys))
        each = size[which]
        stop = np.cumsum(each)
        take = np.arange(stop[-1] if len(stop) else 0) + np.repeat(at[which] - stop + each, each)
        flat = np.append(self.flat, np.array([end_id], self.flat.dtype))[take].astype(np.uint32)
        return flat, np.concatenate([[0], stop[which == len(keys)]])

    def _plainly(self, column: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The same without hashes, for the rare texts in which two runs share one."""
        ids = [self.tokenizer.encode(t or "", add_special_tokens=False).ids + [end_id] for t in column.to_pylist()]
        return np.array([i for some in ids for i in some], np.uint32), np.cumsum([0, *map(len, ids)])


@lru_cache(maxsize=1)
def shared_encoder(definition: str) -> RunEncoder:
    """One encoder for all tasks that a Python worker runs."""
    return RunEncoder(definition)


def _runs(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, with a last comma or full stop after an ASCII letter or digit on its own: there tokens always part."""
    data, start, end = words.texts.data, words.start, words.end
    cut = np.flatnonzero((end - start > 1) & _STOP[data[end - 1]])
    cut = cut[_ALNUM[data[end[cut] - 2]]]
    stop = end.copy()
    stop[cut] -= 1
    return (np.insert(start, cut + 1, end[cut] - 1), np.insert(stop, cut + 1, end[cut]),
            np.insert(words.doc, cut + 1, words.doc[cut]))


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, plan: FilePlan = FilePlan(),
                      id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write doc_id, row (order within the file) and ids as ORC, files and rows in ascending doc_id order.

    A null text is empty and has the end id alone. Null ids come first;
    repeated (and null) ids are ordered by a hash of the text, then the text,
    and may be split over files. A text may have any length: a task takes two
    megabytes at a time, a longer text alone. Other columns are ignored.
    """
    ship_package(docs.sparkSession)
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = f.read()
    docs = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(1, math.ceil(size / plan.file_bytes))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, row = shared_encoder(definition), 0
        for batch in batches:
            for a, b in pieces(batch.column(1), 2 << 20):
                flat, at = encoder(batch.column(1).slice(a, b - a), plan.end_id)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(np.arange(row, row + b - a, dtype=np.int64)),
                     pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(flat.view(np.int32)))],
                    ["doc_id", "row", "ids"])
                row += b - a

    dealt = docs.withColumn("hash", F.xxhash64("text")).repartitionByRange(files, "doc_id", "hash")
    encoded = dealt.sortWithinPartitions("doc_id", "hash", "text").drop("hash").mapInArrow(
        run, f"doc_id {kind}, row bigint, ids array<int>")
    with arrow_rows(docs.sparkSession, plan.batch_rows):
        (encoded.write.option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", str(plan.bloom_fpp))
         .option("orc.create.index", "true").option("orc.row.index.stride", str(plan.index_rows))
         .option("orc.stripe.size", str(plan.stripe_bytes)).option("compression", "lz4").orc(path))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, row, ids; filters on doc_id reach the files' indexes and Bloom filters."""
    return spark.read.option("mergeSchema", "false").orc(path)


def token_offsets(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    Rows are numbered within each file and files by their first id, so no
    task holds more than the documents of one file.
    """
    ship_package(spark)
    files = read_token_files(spark, path).select(F.col("_metadata.file_name").alias("file"), "doc_id", "row", "ids")
    kind = files.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(3)
            at = ids.offsets.to_numpy()
            raw = memoryview(np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False).astype("<i4"))).cast("B")
            crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(np.diff(at).astype(np.int64)), pa.array(crc, pa.int64())],
                ["file", "doc_id", "row", "n_tokens", "ids_crc32"])

    rows = written(
        files.mapInArrow(run, f"file string, doc_id {kind}, row bigint, n_tokens bigint, ids_crc32 bigint"), "rows", 4000)
    totals = rows.groupBy("file").agg(F.sum("n_tokens").alias("n"), F.min("doc_id").alias("first"),
                                      F.max("doc_id").alias("last"), F.count("*").alias("rows"),
                                      F.count("doc_id").alias("named"))
    # the ranges with null ids come first, those without another id before the one with both; one id may fill several
    order = Window.orderBy((F.col("rows") > F.col("named")).desc(), F.col("named") > 0, F.asc_nulls_first("first"),
                           F.asc_nulls_first("last"), "file")
    before = totals.select("file", (F.sum("n").over(order) - F.col("n")).alias("before"))
    inside = F.sum("n_tokens").over(Window.partitionBy("file").orderBy("row")) - F.col("n_tokens")
    return rows.withColumn("inside", inside).join(before, "file").select(
        "doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
