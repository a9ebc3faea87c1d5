"""Language identification by rank-order profiles.

A profile is the list of a language's most frequent character n-grams (one to
three letters, a space at word ends), from most to least frequent. A
document's own list is compared with each profile by the out-of-place
distance: the sum over its n-grams of how far their ranks differ, or the
greatest rank where the profile lacks one. The nearest language wins.

Profiles count every n-gram of every training document: tasks count within
their batches, Spark sums the counts and keeps the leading ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from fraudspark.llm.tables import ship_package, written
from fraudspark.llm.text import pieces

_letters: np.ndarray | None = None


@dataclass(frozen=True)
class ProfilePlan:
    """ranks: n-grams in a profile and in a document's list."""

    ranks: int = 400


def letters() -> np.ndarray:
    """Which code points are letters."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def grams(text: str) -> np.ndarray:
    """n-grams of 1 to 3 characters as integers of 21 bits a character; runs of other characters are one space."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letter = letters()[points]
    if not letter.any():
        return np.zeros(0, np.int64)
    last = np.concatenate([letter[1:], [True]])
    kept = letter | last  # of a run of other characters the one before a letter stays
    kept[-1] = True
    line = np.where(letter, points, 0x20)[kept].astype(np.int64)
    line = np.concatenate([[0x20] if line[0] != 0x20 else [], line, [0x20] if line[-1] != 0x20 else []]).astype(np.int64)
    two = line[:-1] | (line[1:] << 21)
    three = two[:-1] | (line[2:] << 42)
    return np.concatenate([line[line != 0x20], two, three])


def counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values = np.sort(values)
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, int)
    return values[first], np.diff(np.append(first, len(values)))


def top_grams(text: str, ranks: int) -> np.ndarray:
    """A text's most frequent n-grams, from most to least; ties by their code."""
    keys, counts = counted(grams(text))
    if len(keys) > ranks:  # all that may be among the first
        least = np.partition(counts, len(counts) - ranks)[len(counts) - ranks]
        keep = counts >= least
        keys, counts = keys[keep], counts[keep]
    return keys[np.argsort(-counts, kind="stable")][:ranks]


class Profiles:
    """Ranked n-grams of each language; ranks x languages integers."""

    def __init__(self, ranked: dict[str, np.ndarray], ranks: int) -> None:
        self.names = sorted(ranked)
        self.ranks = ranks
        self.keys, self.places = [], []
        for name in self.names:
            order = np.argsort(ranked[name])
            self.keys.append(ranked[name][order])
            self.places.append(order.astype(np.int64))

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, score): the score is the share by which the nearest profile is closer than the farthest possible."""
        own = top_grams(text, self.ranks) if text else np.zeros(0, np.int64)
        if not len(own) or not self.names:
            return "und", 0.0
        mine = np.arange(len(own))
        best, name = self.ranks * len(own) + 1, "und"
        for language, keys, places in zip(self.names, self.keys, self.places, strict=True):
            at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
            away = np.where(keys[at] == own, np.abs(places[at] - mine), self.ranks)
            total = int(away.sum())
            if total < best:
                best, name = total, language
        return name, 1.0 - best / (self.ranks * len(own))


def learn(docs: DataFrame, plan: ProfilePlan = ProfilePlan(), text_col: str = "text", lang_col: str = "lang") -> Profiles:
    """Profiles of all languages of the labelled documents (null texts or labels, and texts without letters, teach nothing)."""
    ship_package(docs.sparkSession)
    docs = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).dropna()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            languages = batch.column(0).to_pylist()
            held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
            for a, b in pieces(batch.column(1), 4 << 20):
                by: dict[str, list[np.ndarray]] = {}
                for language, text in zip(languages[a:b], batch.column(1).slice(a, b - a).to_pylist(), strict=True):
                    by.setdefault(language, []).append(grams(text))
                for language, some in by.items():
                    held.setdefault(language, []).append(counted(np.concatenate(some)))
            for language, some in held.items():
                keys, to = np.unique(np.concatenate([s[0] for s in some]), return_inverse=True)
                counts = np.bincount(to, np.concatenate([s[1] for s in some]), len(keys)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([language] * len(keys)), pa.array(keys), pa.array(counts)],
                                                 ["lang", "gram", "n"])

    sums = docs.mapInArrow(count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = written(sums.withColumn("place", place).filter(F.col("place") <= plan.ranks), "profiles")
    ranked: dict[str, list[int]] = {}
    for row in top.orderBy("lang", "place").toLocalIterator():
        ranked.setdefault(row["lang"], []).append(row["gram"])
    return Profiles({k: np.array(v, np.int64) for k, v in ranked.items()}, plan.ranks)


def predict(docs: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, lang_pred, score (0 to 1).

    A null text or one without letters is `und` with a score of 0, as is
    everything if there are no profiles. Equal distances go to the first
    language by name. Null ids are passed through, repeated rows each
    predicted, other columns ignored.
    """
    ship_package(docs.sparkSession)
    docs = docs.select(id_col, text_col)
    kind = docs.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces(batch.column(1)):
                found = [profiles.predict(t) for t in batch.column(1).slice(a, b - a).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array([f[0] for f in found]), pa.array([f[1] for f in found])],
                    ["doc_id", "lang_pred", "score"])

    return docs.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
