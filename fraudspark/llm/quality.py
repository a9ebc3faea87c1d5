"""Quality rules: repetition found with suffix arrays over words.

Each text's words get a suffix array by prefix doubling (many texts at once,
as arrays). The longest common prefix of neighbours in suffix order gives the
deepest LCP interval of every suffix, which is the longest repeated substring
that starts there; the union of those spans over a minimum length is the union
of all maximal repeats. A text fails if the union covers too large a share of
its words or if one repeat is too long.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fraudspark.llm.tables import ship_package
from fraudspark.llm.text import Texts, Words, covered, per_doc, pieces

SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True

DIGEST = ("doc_id {id}, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
          "n_repeat_words bigint, n_span_chars bigint, long_repeat boolean, base_failed boolean, kept boolean")


@dataclass(frozen=True)
class Limits:
    """Base rules: min_words, window (words) and window_percent (of the words).

    Maximal repeats of `span` words or more may cover span_percent of the
    characters in words, and none may be longer than `longest` words.
    """

    min_words: int = 10
    window: int = 5
    window_percent: int = 20
    span: int = 10
    span_percent: int = 20
    longest: int = 100


def repeat_lengths(symbols: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each word the length of the longest substring that starts there and occurs again in its text."""
    n = len(symbols)
    if n == 0:
        return np.zeros(0, np.int64)
    _, code = np.unique(symbols, return_inverse=True)
    order = np.argsort(doc.astype(np.int64) * (code.max() + 1) + code, kind="stable")
    key = doc[order].astype(np.int64) * (code.max() + 1) + code[order]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    # the rank of a group of equal prefixes is the place of its first member, so finished suffixes keep theirs
    rank = np.empty(n + 1, np.int32)
    rank[n] = -1
    rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
    last = np.searchsorted(doc, doc, "right")
    levels, k = [rank.copy()], 1
    size = np.bincount(rank[:n], minlength=n)
    active = np.flatnonzero(size[rank[:n]] > 1)
    while len(active):
        after = active + k
        second = np.where(after < last[active], rank[np.minimum(after, n)], -1).astype(np.int64)
        pair = rank[active].astype(np.int64) * (n + 1) + second + 1
        by = np.argsort(pair, kind="stable")
        ranked, pair = active[by], pair[by]
        fresh = np.concatenate([[True], pair[1:] != pair[:-1]])
        group = np.concatenate([[True], rank[ranked[1:]] != rank[ranked[:-1]]])
        place = np.arange(len(by))
        inside = place - np.flatnonzero(group)[np.cumsum(group) - 1]
        value = rank[ranked] + inside
        rank[ranked] = value[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]
        k *= 2
        levels.append(rank.copy())
        many = np.bincount(rank[ranked], minlength=n)
        active = ranked[many[rank[ranked]] > 1]
    suffix = np.empty(n, np.int64)
    suffix[rank[:n]] = np.arange(n)
    a, b = suffix[:-1], suffix[1:]
    near = levels[0][a] == levels[0][b]
    a, b = a[near], b[near]
    common = np.zeros(len(a), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        r = levels[level]
        common[r[np.minimum(a + common, n)] == r[np.minimum(b + common, n)]] += 1 << level
    out = np.zeros(n, np.int64)
    np.maximum.at(out, a, common)
    np.maximum.at(out, b, common)
    return out


def measure(column: pa.Array, limits: Limits) -> dict[str, np.ndarray]:
    """The rules' figures for each text of an Arrow string array (a null is an empty text)."""
    texts = Texts(column)
    words = Words(texts)
    n, total = texts.n, len(words.start)
    byte_doc = np.repeat(np.arange(n), np.diff(texts.bounds))
    points = words.inside & ((texts.data & 0xC0) != 0x80)  # one byte of each code point
    longest = repeat_lengths(words.hashes(), words.doc)
    in_window = covered(np.flatnonzero(longest >= limits.window), limits.window, total)
    at = np.flatnonzero(longest >= limits.span)
    in_span = covered(at, longest[at], total)
    chars = np.diff(np.concatenate([[0], np.cumsum(points)])[np.stack([words.start, words.end])], axis=0)[0]
    top = np.zeros(n, np.int64)
    np.maximum.at(top, words.doc, longest)

    breaks = texts.data == 0x0A
    edges = np.zeros(len(texts.data) + 1, bool)
    edges[texts.bounds] = True
    line_start = np.flatnonzero(edges[:-1] | np.concatenate([[False], breaks[:-1]])[:len(breaks)])
    stop = np.append(line_start[1:], len(texts.data))
    line_end = stop - (breaks[stop - 1] if len(stop) else 0)
    inside = np.concatenate([[0], np.cumsum(words.inside)])
    real = inside[line_end] > inside[line_start]
    line_start, line_end = line_start[real], line_end[real]
    line_doc = byte_doc[line_start]
    lines = np.stack([line_doc.astype(np.uint64), texts.span_hash(line_start, line_end)], axis=1)
    distinct = np.unique(lines, axis=0)[:, 0].astype(np.int64) if len(lines) else np.zeros(0, np.int64)

    out = {
        "n_words": words.counts.astype(np.int64),
        "word_chars": per_doc(points, byte_doc, n),
        "n_symbols": per_doc(SYMBOL[texts.data], byte_doc, n),
        "n_dup_lines": np.bincount(line_doc, minlength=n) - np.bincount(distinct, minlength=n),
        "n_repeat_words": per_doc(in_window, words.doc, n),
        "n_span_chars": per_doc(chars * in_span, words.doc, n),
        "longest_repeat": top,
    }
    w = out["n_words"]
    out["long_repeat"] = top > limits.longest
    out["base_failed"] = (w < limits.min_words) | (100 * out["n_repeat_words"] > limits.window_percent * w)
    too_much = 100 * out["n_span_chars"] > limits.span_percent * out["word_chars"]
    out["kept"] = ~(out["base_failed"] | out["long_repeat"] | too_much)
    return out


def quality_report(docs: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row per document with the figures and the verdict.

    A null or empty text has no words and fails; a null id is passed through;
    repeated rows are judged alike and all returned; other columns are ignored.
    """
    ship_package(docs.sparkSession)
    docs = docs.select(id_col, text_col)
    schema = DIGEST.format(id=docs.schema[0].dataType.simpleString())
    names = [x.split()[0] for x in schema.split(", ")][1:]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces(batch.column(1)):
                figures = measure(batch.column(1).slice(a, b - a), limits)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), *(pa.array(figures[c]) for c in names)], ["doc_id", *names])

    return docs.mapInArrow(rows, schema)


def quality_filter(docs: DataFrame, limits: Limits = Limits(), text_col: str = "text") -> DataFrame:
    """The documents that pass, with all their columns (whatever their names)."""
    ship_package(docs.sparkSession)
    at = docs.columns.index(text_col)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces(batch.column(at)):
                part = batch.slice(a, b - a)
                yield part.filter(pa.array(measure(part.column(at), limits)["kept"]))

    return docs.mapInArrow(rows, docs.schema)
