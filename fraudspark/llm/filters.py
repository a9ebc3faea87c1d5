"""Bit filters: a set of 64-bit hashes as a bit table, small enough to send to every task."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

#: Shifts of a hash that give the places of its bits.
_PROBES = (0, 17, 34)


@dataclass(frozen=True)
class BitFilter:
    """Holds every hash it was made of, and few others; `words` are the 2^bits bits."""

    bits: int
    words: np.ndarray

    def hits(self, h: np.ndarray) -> np.ndarray:
        """Which of the hashes the filter holds."""
        at = np.arange(len(h))
        low = np.uint64((1 << self.bits) - 1)
        for k in _PROBES:
            cell = (h[at] >> np.uint64(k)) & low
            held = self.words[(cell >> np.uint64(6)).astype(np.int64)] >> (cell & np.uint64(63))
            at = at[(held & np.uint64(1)).astype(bool)]
        out = np.zeros(len(h), bool)
        out[at] = True
        return out


def table_bits(count: int, per_hash: int = 16, most: int = 27) -> int:
    """Size of a filter of `count` hashes: `per_hash` bits each, in all at most 2^most (16 MB for 27)."""
    return min(most, max(10, (max(1, count) * per_hash - 1).bit_length()))


def bit_filter(hashes: DataFrame, column: str, count: int, per_hash: int = 16, most: int = 27) -> BitFilter:
    """The filter of a column of hashes (bigint) with `count` rows.

    Sized from the count up to 2^most bits; of other hashes it holds about
    (3 / per_hash)^3. The driver gets at most
    2^(most - 6) words of it. A filter at its bound lets more hashes pass by
    chance; what uses it must check them, so results don't change.
    """
    bits = table_bits(count, per_hash, most)
    cells = hashes.select(F.explode(F.array(
        *(F.shiftrightunsigned(column, k).bitwiseAND(F.lit((1 << bits) - 1)) for k in _PROBES))).alias("cell"))
    slots = (cells.select(F.shiftright("cell", 6).cast("int").alias("slot"),
                          F.expr("shiftleft(1L, cast(cell & 63 as int))").alias("bit"))
             .groupBy("slot").agg(F.bit_or("bit").alias("bits")).toArrow())
    words = np.zeros(1 << (bits - 6), np.uint64)
    words[slots.column("slot").to_numpy()] = slots.column("bits").to_numpy().view(np.uint64)
    return BitFilter(bits, words)
