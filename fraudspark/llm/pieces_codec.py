"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie.

Spaces become the marker U+2581 and one marker is put before the text. The
best segmentation has the greatest sum of log scores; a character that no
piece covers falls back to its UTF-8 bytes as one edge with a fixed penalty.
Of equal sums the longer last piece wins, at every place.

Pieces hold the marker only in front, so a text can be cut before each run of
markers (and around characters that no piece holds) without changing the best
path. Each cut is encoded once per task and remembered, up to a bound.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fraudspark.llm.tables import ship_package
from fraudspark.llm.text import pieces

MARK = "▁"
#: Segments that a task remembers, and the longest that it does (characters).
MEMORY, MEMORABLE = 300_000, 48


@dataclass(frozen=True)
class Vocabulary:
    """pieces[i] has the id i and the log score scores[i]; None where the id is not for text (control, bytes)."""

    pieces: tuple[str | None, ...]
    scores: tuple[float, ...]
    byte_ids: tuple[int, ...]
    unknown_penalty: float = 10.0


def load_vocabulary(path: str) -> Vocabulary:
    """Read a public SentencePiece model.

    The model's stored scores of a BPE vocabulary are minus the rank of a
    piece, not log probabilities. Log scores are taken from the rank by
    Zipf's law: -ln(rank + 2) - ln(ln(size)).
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.vocab_size()
    text = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)
                                        or model.is_unused(i))]
    names: list[str | None] = [None] * n
    scores = [0.0] * n
    for rank, i in enumerate(sorted(text, key=lambda i: (-model.get_score(i), i))):
        names[i] = model.id_to_piece(i)
        scores[i] = float(np.float32(-np.log(rank + 2) - np.log(np.log(len(text)))))
    byte = {model.id_to_piece(i): i for i in range(n) if model.is_byte(i)}
    return Vocabulary(tuple(names), tuple(scores), tuple(byte[f"<0x{b:02X}>"] for b in range(256)))


class DoubleArray:
    """A trie over UTF-8 bytes: the child of state s by byte b is base[s] + b + 1 if check there is s."""

    def __init__(self, keys: dict[bytes, int]) -> None:
        children: list[dict[int, int]] = [{}]
        value = [-1]
        for key, number in keys.items():
            at = 0
            for b in key:
                to = children[at].get(b)
                if to is None:
                    to = children[at][b] = len(children)
                    children.append({})
                    value.append(-1)
                at = to
            value[at] = number
        size = 2 * len(children) + 1024
        base, check, leaf = (np.full(size, x, np.int32) for x in (0, -1, -1))
        taken = np.zeros(size, bool)
        taken[0] = True
        check[0] = -2
        place, free, wide = {0: 0}, 1, 1
        # nodes with many children are placed first, while there is room; parents come before children
        depth = [[0]]
        while depth[-1]:
            depth.append([c for node in depth[-1] for c in children[node].values()])
        for node in (x for level in depth for x in sorted(level, key=lambda x: -len(children[x]))):
            s = place[node]
            leaf[s] = value[node]
            if not children[node]:
                continue
            codes = np.array(sorted(children[node]))
            while taken[free]:
                free += 1
            at = wide = max(wide, free)
            while len(codes) > 1 or free <= codes[0]:
                if at + 1024 >= size:
                    base, check, leaf = (np.concatenate([x, np.full(size, y, np.int32)])
                                         for x, y in ((base, 0), (check, -1), (leaf, -1)))
                    taken = np.concatenate([taken, np.zeros(size, bool)])
                    size *= 2
                cells = at + np.flatnonzero(~taken[at:at + 512])
                starts = cells[cells > codes[0]] - codes[0] - 1
                fits = starts[~taken[starts[:, None] + codes + 1].any(axis=1)]
                if len(fits):
                    break
                at = wide = at + 512
            start = free - int(codes[0]) - 1 if len(codes) == 1 and free > codes[0] else int(fits[0])
            base[s] = start
            check[start + codes + 1] = s
            taken[start + codes + 1] = True
            for c in codes.tolist():
                place[children[node][c]] = start + c + 1
        self.base, self.check, self.leaf = base, check, leaf


_shared: dict[str, Codec] = {}


class Codec:
    """Encoder and decoder of one vocabulary; small enough to send to every task."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        keys = {p.encode(): i for i, p in enumerate(vocabulary.pieces) if p}
        self.trie = DoubleArray(keys)
        body = [p.lstrip(MARK) for p in vocabulary.pieces if p]
        held = set("".join(body))
        if any(MARK in b for b in body):
            self.cut = None
        elif "\n" in held:
            self.cut = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        else:
            self.cut = re.compile(f"\n|{MARK}+[^{MARK}\n]*|[^{MARK}\n]+")
        self.key = hashlib.sha256(repr(vocabulary).encode()).hexdigest()
        self._ready = False

    def __getstate__(self) -> dict[str, object]:
        return {k: v for k, v in self.__dict__.items() if k in ("vocabulary", "trie", "cut", "key")} | {"_ready": False}

    def shared(self) -> Codec:
        """The codec of this vocabulary that all tasks of a Python worker use, with what it remembers."""
        if self.key not in _shared:
            _shared.clear()
            _shared[self.key] = self
        return _shared[self.key]

    def _prepare(self) -> None:
        """The tables as lists, which are faster to index one by one."""
        v = self.vocabulary
        self.base, self.check, self.leaf = (x.tolist() for x in (self.trie.base, self.trie.check, self.trie.leaf))
        self.score = list(v.scores)
        real = [s for s, p in zip(v.scores, v.pieces, strict=True) if p]
        self.fallback = min(real, default=0.0) - v.unknown_penalty
        self.surface: list[bytes] = [(p or "").replace(MARK, " ").encode() for p in v.pieces]
        for b, i in enumerate(v.byte_ids):
            self.surface[i] = bytes([b])
        self.known: dict[str, bytes] = {}
        self._ready = True

    def segment(self, text: str) -> list[int]:
        """Ids of the best segmentation of one cut."""
        raw = text.encode()
        n = len(raw)
        base, check, leaf, score = self.base, self.check, self.leaf, self.score
        low = float("-inf")
        best, back, piece = [low] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        i = 0
        while i < n:
            b = raw[i]
            width = 1 if b < 0x80 else 2 if b < 0xE0 else 3 if b < 0xF0 else 4
            here = best[i]
            whole = False
            s, j = 0, i
            while j < n:
                t = base[s] + raw[j] + 1
                if check[t] != s:
                    break
                s = t
                j += 1
                p = leaf[s]
                if p >= 0:
                    whole = whole or j == i + width
                    value = here + score[p]
                    if value > best[j]:
                        best[j], back[j], piece[j] = value, i, p
            if not whole:
                j = i + width
                if here + self.fallback > best[j]:
                    best[j], back[j], piece[j] = here + self.fallback, i, -1
            i += width
        out: list[int] = []
        j = n
        while j:
            i = back[j]
            if piece[j] >= 0:
                out.append(piece[j])
            else:
                out.extend(self.vocabulary.byte_ids[x] for x in reversed(raw[i:j]))
            j = i
        out.reverse()
        return out

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian 32-bit integers; the empty text has none."""
        if not self._ready:
            self._prepare()
        if not text:
            return b""
        text = MARK + text.replace(" ", MARK)
        known = self.known
        out = []
        for cut in self.cut.findall(text) if self.cut else [text]:
            ids = known.get(cut)
            if ids is None:
                ids = np.array(self.segment(cut), "<i4").tobytes()
                if len(cut) <= MEMORABLE:
                    if len(known) >= MEMORY:
                        known.clear()
                    known[cut] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: list[int]) -> str:
        """The text of ids: byte pieces join into characters, markers become spaces, the first one goes."""
        if not self._ready:
            self._prepare()
        raw = b"".join(map(self.surface.__getitem__, ids))
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


def encode(docs: DataFrame, codec: Codec, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_tokens, token_ids, decoded, round_trip.

    The ids are decoded again; round_trip tells whether that gives the text
    (it always does, unless the text itself holds the marker U+2581, which
    decodes to a space). A null text has no ids and decodes to null; an empty
    one has none and decodes to ''. Null ids are passed through, repeated rows
    are each encoded, other columns are ignored.
    """
    ship_package(docs.sparkSession)
    docs = docs.select(id_col, text_col)
    kind = docs.schema[0].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec.shared()
        for batch in batches:
            for a, b in pieces(batch.column(1)):
                texts = batch.column(1).slice(a, b - a).to_pylist()
                ids = [own.encode(t or "") for t in texts]
                at = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int32)
                flat = np.frombuffer(b"".join(ids), "<i4")
                listed = flat.tolist()
                back = [None if t is None else own.decode(listed[at[i]:at[i + 1]]) for i, t in enumerate(texts)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(np.diff(at).astype(np.int64)),
                     pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                     pa.ListArray.from_arrays(pa.array(at), pa.array(flat)), pa.array(back, pa.string()),
                     pa.array([x == y for x, y in zip(texts, back, strict=True)], pa.bool_())],
                    ["doc_id", "n_tokens", "ids_crc32", "token_ids", "decoded", "round_trip"])

    return docs.mapInArrow(rows, f"doc_id {kind}, n_tokens bigint, ids_crc32 bigint, token_ids array<int>, "
                                 "decoded string, round_trip boolean")
