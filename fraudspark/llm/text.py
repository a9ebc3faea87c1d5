"""Words and hashes of whole Arrow string batches, without Python strings.

A word is a maximal run of bytes outside \\x20 and \\x09-\\x0D (all ASCII, so
the rule is the same on UTF-8 bytes and on code points). Hashes are 64-bit
polynomials over randomly mapped bytes, taken from prefix sums; they depend on
the content alone, not on the batch, the process or the machine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORD_BYTE = np.ones(256, bool)
WORD_BYTE[[0x20, *range(0x09, 0x0E)]] = False

_rng = np.random.default_rng(20240229)
_BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ODD = [int(x) * 2 + 1 for x in _rng.integers(2**61, 2**62, 4)]
_MIX = np.uint64(0x9E3779B97F4A7C15)
_powers: dict[tuple[int, bool], np.ndarray] = {}


def powers(base: int, n: int, inverse: bool = False) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, or those of its inverse; kept and grown."""
    have = _powers.get((base, inverse))
    if have is None or len(have) < n:
        b = pow(base, -1, 1 << 64) if inverse else base
        size = 1 << max(16, (max(n, 1) - 1).bit_length())
        steps = np.full(size, b, np.uint64)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        _powers[(base, inverse)] = have
    return have[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser, so that low and high bits are equally good."""
    h = h ^ (h >> np.uint64(31))
    h = h * _MIX
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


class Texts:
    """Some consecutive texts of a batch as one byte array with bounds (nulls are empty)."""

    def __init__(self, column: pa.Array) -> None:
        column = pc.fill_null(column, "") if column.null_count else column
        width = np.int64 if pa.types.is_large_string(column.type) else np.int32
        n = len(column)
        if n:
            _, at, data = column.buffers()
            at = np.frombuffer(at, width)[column.offset:column.offset + n + 1].astype(np.int64)
            raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
            self.data = raw[at[0]:at[-1]]
            self.bounds = at - at[0]
        else:
            self.data, self.bounds = np.zeros(0, np.uint8), np.zeros(1, np.int64)
        self.n = n
        self._prefix: dict[int, np.ndarray] = {}

    def span_hash(self, start: np.ndarray, end: np.ndarray, function: int = 0) -> np.ndarray:
        """Hash of the bytes start..end-1 of each span; equal bytes give equal hashes. function: 0, or 2 for another."""
        base, prefix = _ODD[function], self._prefix.get(function)
        if prefix is None:
            prefix = self._prefix[function] = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum(_BYTE_CODE[self.data] * powers(base, len(self.data)), out=prefix[1:])
        h = (prefix[end] - prefix[start]) * powers(base, len(self.data), inverse=True)[start]
        return mixed(h + (end - start).astype(np.uint64) * _MIX)


class Words:
    """Words of some texts: `doc` (index of the text), byte `start` and `end`, `first` (first word of each text)."""

    def __init__(self, texts: Texts, word_byte: np.ndarray = WORD_BYTE) -> None:
        inside = word_byte[texts.data]
        size = len(inside)
        edge = np.zeros(size + 1, bool)
        edge[texts.bounds] = True
        before = np.zeros(size, bool)
        before[1:] = inside[:-1]
        after = np.zeros(size, bool)
        after[:-1] = inside[1:]
        before[edge[:-1]] = False
        after[edge[1:]] = False
        self.inside = inside
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, texts.bounds)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(texts.n), self.counts)
        self.texts = texts

    def hashes(self) -> np.ndarray:
        return self.texts.span_hash(self.start, self.end)


def window_hashes(words: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Rabin-Karp hashes of all windows of `size` words inside one text, and the index of their first word."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    prefix = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * powers(_ODD[1], len(words)), out=prefix[1:])
    at = np.flatnonzero(doc[:n] == doc[size - 1:])
    h = (prefix[at + size] - prefix[at]) * powers(_ODD[1], len(words), inverse=True)[at]
    return mixed(h), at


def covered(start: np.ndarray, length: np.ndarray | int, n: int) -> np.ndarray:
    """Which of n positions lie in the union of the spans start..start+length-1."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, start, 1)
    np.add.at(step, start + length, -1)
    return np.cumsum(step[:-1]) > 0


def per_doc(values: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(doc, weights=values, minlength=n).astype(np.int64)


def pieces(column: pa.Array, max_bytes: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of rows with at most max_bytes of text each, one row at least: bounds a task's memory."""
    size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total = np.concatenate([[0], np.cumsum(size)])
    at = 0
    while at < len(size):
        to = max(at + 1, int(np.searchsorted(total, total[at] + max_bytes, "right")) - 1)
        yield at, to
        at = to
