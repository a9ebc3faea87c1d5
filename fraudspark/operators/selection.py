"""Order statistics by radix descent: no row is sorted, ranked, written or shuffled.

A value is an integer code with the value's order. Codes are counted by their
highest digit, the digit in which a wanted rank lies is known from the counts,
and the next scan counts the next digit of the codes that begin so. A scan
returns at most ranks x 2^bits counts, whatever the data, and a value (or key)
held by a third of all rows is one count.

* `order_statistics`: values at many ranks of many numeric columns, one scan a
  digit for all columns together.
* `at_or_before`: for ranks in the order of a composite key (integers, times
  or texts), conditions that hold for the rows up to the rank.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudspark.functions.expr import epoch_micros

_SIGN = np.uint64(1 << 63)


# --------------------------------------------------------------------------- many numeric columns
def codes_of(values: np.ndarray) -> np.ndarray:
    """Unsigned integers in the order of the doubles (0.0 and -0.0 are one; NaN comes last)."""
    raw = (values + 0.0).view(np.uint64)
    return np.where(raw & _SIGN, ~raw, raw | _SIGN)


def value_of(code: int) -> float:
    c = np.array([code], np.uint64)
    return float(np.where(c & _SIGN, c & ~_SIGN, ~c).view(np.float64)[0])


@dataclass
class ColumnSummary:
    """What one scan tells of a column: non-null rows, distinct values up to a bound, least and greatest code."""

    n: int = 0
    distinct: set = field(default_factory=set)
    low: int = 0
    high: int = 0


def _columns(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    for j, column in enumerate(batch.columns):
        yield j, codes_of(column.drop_null().to_numpy(zero_copy_only=False).astype(np.float64))


def summaries(frame: DataFrame, columns: Sequence[str], limit: int) -> tuple[int, dict[str, ColumnSummary]]:
    """(rows, summary of each numeric column). Distinct values are counted up to limit + 1 and then no further."""
    if not columns:
        return frame.count(), {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, n = 0, np.zeros(len(columns), np.int64)
        seen: list[np.ndarray] = [np.zeros(0, np.uint64)] * len(columns)
        low, high = np.full(len(columns), 2**64 - 1, np.uint64), np.zeros(len(columns), np.uint64)
        for batch in batches:
            rows += batch.num_rows
            for j, code in _columns(batch):
                if len(code):
                    n[j] += len(code)
                    low[j], high[j] = min(low[j], code.min()), max(high[j], code.max())
                    if len(seen[j]) <= limit:
                        # a bounded look first: most columns pass the limit within it
                        seen[j] = np.unique(np.concatenate([seen[j], code[:64 * (limit + 1)]]))
                        if len(seen[j]) <= limit:
                            seen[j] = np.unique(np.concatenate([seen[j], code]))
                        seen[j] = seen[j][:limit + 1]
        # column -1 is the number of rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(-1, len(columns), dtype=np.int32)), pa.array(np.append(rows, n)),
             pa.array([[], *(s.view(np.int64) for s in seen)], pa.list_(pa.int64())),
             pa.array(np.append(np.uint64(0), low).view(np.int64)), pa.array(np.append(np.uint64(0), high).view(np.int64))],
            ["column", "n", "seen", "low", "high"])

    numeric = frame.select(*[F.col(c).cast("double").alias(c) for c in columns])
    parts = numeric.mapInArrow(run, "column int, n bigint, seen array<bigint>, low bigint, high bigint")
    flip = F.lit(-2**63).cast("bigint")  # signed order of unsigned codes
    filled = F.col("n") > 0
    merged = parts.groupBy("column").agg(
        F.sum("n").alias("n"),
        F.slice(F.array_distinct(F.flatten(F.collect_list(F.slice("seen", 1, limit + 1)))), 1, limit + 1).alias("seen"),
        F.min(F.when(filled, F.col("low").bitwiseXOR(flip))).alias("low"),
        F.max(F.when(filled, F.col("high").bitwiseXOR(flip))).alias("high"))
    rows, out = 0, {c: ColumnSummary() for c in columns}
    for r in merged.collect():  # one row a column
        if r["column"] < 0:
            rows = r["n"]
        elif r["n"]:
            out[columns[r["column"]]] = ColumnSummary(r["n"], set(r["seen"]), r["low"] + 2**63, r["high"] + 2**63)
    return rows, out


def order_statistics(frame: DataFrame, ranks: Mapping[str, Sequence[int]],
                     known: Mapping[str, ColumnSummary]) -> dict[str, dict[int, float]]:
    """{column: {rank: value}} for 0-based ranks among the non-null values of numeric columns.

    `known` are the columns' summaries. Counts of a column and a scan: at most
    2^17, over all its ranks.
    """
    columns = [c for c in ranks if len(ranks[c])]
    if not columns:
        return {c: {} for c in ranks}
    bits = max(4, 17 - max(len(set(ranks[c])) for c in columns).bit_length())
    # targets of a column: (rank among the codes that begin with prefix, prefix), from the highest bit that differs
    shift = {c: (known[c].low ^ known[c].high).bit_length() for c in columns}
    at = {c: {int(r): (int(r), known[c].low >> shift[c]) for r in set(ranks[c])} for c in columns}
    numeric = frame.select(*[F.col(c).cast("double").alias(c) for c in columns])
    while any(shift.values()):
        step = {c: max(0, shift[c] - bits) for c in columns}
        prefixes = [np.unique(np.array([p for _, p in at[c].values()], np.uint64)) for c in columns]
        found = _digit_counts(numeric, prefixes, [shift[c] for c in columns], [step[c] for c in columns])
        for j, c in enumerate(columns):
            if not shift[c]:
                continue
            heads, counts = found[j]
            total = np.concatenate([[0], np.cumsum(counts)])
            begin = np.searchsorted(heads, np.array([p << (shift[c] - step[c]) for _, p in at[c].values()], np.uint64))
            for (rank, (left, _)), b in zip(list(at[c].items()), begin, strict=True):
                i = int(np.searchsorted(total, total[b] + left, "right")) - 1
                at[c][rank] = (int(left - (total[i] - total[b])), int(heads[i]))
        shift = step
    return {c: {r: value_of(p) for r, (_, p) in at.get(c, {}).items()} for c in ranks}


def _digit_counts(numeric: DataFrame, prefixes: list[np.ndarray], shift: list[int],
                  step: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each column, (code >> step, count) of the codes that begin with one of the prefixes, sorted."""

    def head(code: np.ndarray, by: int) -> np.ndarray:
        return code >> np.uint64(by) if by < 64 else np.zeros(len(code), np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros(len(p) << (s - t), np.int64) for p, s, t in zip(prefixes, shift, step, strict=True)]
        for batch in batches:
            for j, code in _columns(batch):
                if not shift[j]:
                    continue
                begin = head(code, shift[j])
                which = np.minimum(np.searchsorted(prefixes[j], begin), len(prefixes[j]) - 1)
                on = prefixes[j][which] == begin
                digit = head(code[on], step[j]) & np.uint64((1 << (shift[j] - step[j])) - 1)
                cell = (which[on] << (shift[j] - step[j])) + digit.astype(np.int64)
                total[j] += np.bincount(cell, minlength=len(total[j]))
        for j, counts in enumerate(total):
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(some), j, np.int32)), pa.array(some), pa.array(counts[some])], ["column", "cell", "n"])

    table = (numeric.mapInArrow(run, "column int, cell bigint, n bigint").groupBy("column", "cell")
             .agg(F.sum("n").alias("n")).toArrow())
    column, cell, n = (table.column(c).to_numpy() for c in ("column", "cell", "n"))
    out = []
    for j, (p, s, t) in enumerate(zip(prefixes, shift, step, strict=True)):
        mine = np.flatnonzero(column == j)
        mine = mine[np.argsort(cell[mine])]
        width = s - t
        heads = (p[cell[mine] >> width] << np.uint64(width)) + (cell[mine] & ((1 << width) - 1)).astype(np.uint64)
        out.append((heads, n[mine]))
    return out


def quantiles(frame: DataFrame, probs: Sequence[float], known: Mapping[str, ColumnSummary]) -> dict[str, list[float]]:
    """Linearly interpolated quantiles (numpy's default) of the numeric columns in `known`."""
    wanted = {c: [((s.n - 1) * float(p)) for p in probs] for c, s in known.items()}
    ranks = {c: sorted({r for h in hs for r in (math.floor(h), min(math.floor(h) + 1, known[c].n - 1))})
             for c, hs in wanted.items()}
    values = order_statistics(frame, ranks, known)
    out: dict[str, list[float]] = {}
    for c, hs in wanted.items():
        out[c] = []
        for h in hs:
            a, b = values[c][math.floor(h)], values[c][min(math.floor(h) + 1, known[c].n - 1)]
            t = h - math.floor(h)
            out[c].append(a + (b - a) * t if t < 0.5 else b - (b - a) * (1.0 - t))
    return out


# --------------------------------------------------------------------------- composite keys
_DIGIT = 14
_CHUNK = 7


def _text_code(text: Column, chunk: int) -> Column:
    """Seven bytes of a text and whether it ends in them, as an integer in the order of the bytes."""
    raw = F.encode(text, "UTF-8")
    part = F.substring(raw, 1 + _CHUNK * chunk, _CHUNK)
    left = F.greatest(F.octet_length(raw) - _CHUNK * chunk, F.lit(0))
    padded = F.rpad(F.hex(part), 2 * _CHUNK, "0")
    return F.conv(padded, 16, 10).cast("bigint") * 16 + F.least(left, F.lit(_CHUNK + 1))


def key_codes(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """Integer columns whose order, first to last, is that of the keys (nulls first)."""
    out: list[Column] = []
    for k in keys:
        kind, c = df.schema[k].dataType, F.col(k)
        if df.schema[k].nullable:
            out.append(c.isNotNull().cast("bigint"))
        if isinstance(kind, T.TimestampNTZType):
            out.append(F.coalesce(epoch_micros(k), F.lit(0)))
        elif isinstance(kind, T.IntegralType):
            out.append(F.coalesce(c.cast("bigint"), F.lit(0)))
        elif isinstance(kind, T.StringType):
            text = F.coalesce(c, F.lit(""))
            longest = df.agg(F.max(F.octet_length(text))).first()[0] or 0
            out += [_text_code(text, j) for j in range(max(1, math.ceil(longest / _CHUNK)))]
        else:
            raise TypeError(f"no order by radix for {k}: {kind.simpleString()}")
    return out


@dataclass
class _Bucket:
    """Codes low..high, the rank wanted among them (1 is the first) and how many rows they have."""

    low: int
    high: int
    rank: int
    size: int

    @property
    def done(self) -> bool:
        return self.rank == self.size or self.low == self.high


def _descend(df: DataFrame, code: Column, buckets: list[_Bucket]) -> list[_Bucket]:
    """Narrow each bucket until the rank is its last row or it is a single code."""
    while any(not b.done for b in buckets):
        wide = [b for b in buckets if not b.done]
        shift = max(0, max(b.high - b.low for b in wide).bit_length() - _DIGIT)
        inside = F.lit(False)
        for b in {(b.low, b.high) for b in wide}:
            inside = inside | code.between(F.lit(b[0]), F.lit(b[1]))
        counts = df.filter(inside).groupBy(F.shiftright(code, shift).alias("head")).agg(F.count(F.lit(1)).alias("n"))
        rows = sorted((r["head"], r["n"]) for r in counts.collect())  # at most ranks x 2^14, and two at the ends
        for b in wide:
            left = b.rank
            for head, n in rows:
                low, high = max(b.low, head << shift), min(b.high, ((head + 1) << shift) - 1)
                if low > high:
                    continue
                if left <= n:
                    b.low, b.high, b.rank, b.size = low, high, left, n
                    break
                left -= n
    return buckets


def at_or_before(df: DataFrame, keys: Sequence[str], ranks: Sequence[int], n: int) -> list[Column]:
    """For each 1-based rank, a condition on df's rows: they come up to that rank in the order of the keys.

    n is the number of rows. Rows that agree on all keys stay together on the
    earlier side. Rank 0 (or less) holds for no row, rank n for every row.
    """
    inner = [r for r in ranks if 0 < r < n]
    found: Iterator[Column] = iter(())
    if inner:
        codes = key_codes(df, keys)
        ends = df.agg(*[f(c) for c in codes for f in (F.min, F.max)]).first()
        found = iter(_conditions(df, [(c, *ends[2 * i:2 * i + 2]) for i, c in enumerate(codes)], inner, n))
    return [F.lit(r >= n) if not 0 < r < n else next(found) for r in ranks]


def _conditions(df: DataFrame, codes: list[tuple[Column, int, int]], ranks: list[int], n: int) -> list[Column]:
    """codes: each with bounds of its values."""
    (code, low, high), rest = codes[0], codes[1:]
    if low == high and rest:  # the same for all rows
        return _conditions(df, rest, ranks, n)
    out = []
    for b in _descend(df, code, [_Bucket(low, high, r, n) for r in ranks]):
        if b.rank == b.size or not rest:
            out.append(code <= F.lit(b.high))
        else:
            tied = df.filter(code == F.lit(b.low))
            out.append((code < F.lit(b.low)) | ((code == F.lit(b.low)) & _conditions(tied, rest, [b.rank], b.size)[0]))
    return out
