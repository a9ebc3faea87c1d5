"""Secret scans: fixed patterns, and a battery of randomness tests on long tokens.

Tokens of letters, digits and +/_=- are cut at inner '=', so the value of
name=value stands alone, and further at '_', '-', '+' and '/', so the last name
of a path does. Each string is given the smallest encoding that holds its
characters, and takes three tests against uniform random characters of
that alphabet: chi-squared uniformity, runs above and below the middle, and
lag-one serial correlation. A token that none of them rejects looks random;
it is reported if looking so is also surprising for ordinary text: a Markov
chain over kinds of characters (names keep to one case, numbers keep together)
with measured letter frequencies, both restricted to the alphabet. The
likelihood of the token under it, divided by that under uniform characters, is
a p-value by Markov's inequality. It falls with the token's length, and the
Benjamini-Hochberg step-up rule over the document's strings that have an
encoding holds the rate of false discoveries.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from fraudspark.llm.tables import ship_package
from fraudspark.llm.text import pieces

# fixed values: the base patterns
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "random")
#: Strings of a token between '=' (padding may follow), and these cut further.
CUTS = tuple(re.compile(f"[^={cut}]+(?:=+(?![A-Za-z0-9+/_-]))?") for cut in ("", "_\\-", "+/", "+/_\\-"))
KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")

_LOWER, _UPPER, _DIGIT = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: Alphabets of the encodings, smallest first; digits alone are numbers, letters alone are words.
ENCODINGS = {name: {c: i for i, c in enumerate(chars)} for name, chars in (
    ("hex", _DIGIT + "abcdef"), ("HEX", _DIGIT + "ABCDEF"), ("base32", _UPPER + "234567"),
    ("base36", _DIGIT + _LOWER), ("BASE36", _DIGIT + _UPPER), ("base62", _UPPER + _LOWER + _DIGIT),
    ("base64", _UPPER + _LOWER + _DIGIT + "+/"), ("base64url", _UPPER + _LOWER + _DIGIT + "-_"))}
#: Letters of ordinary tokens, parts in 1000 from a to z, and the next character's kind (lower, upper, digit, other)
#: after each kind, in parts of 100: measured on the 8523 long tokens of Python's library with both letters and digits
#: (letters: on half of them, 4 at least).
LETTERS = dict(zip(_LOWER, (79, 21, 49, 49, 112, 23, 19, 19, 60, 4, 8, 37, 34, 57, 57, 41, 4, 51, 89, 97, 31, 13, 10,
                            13, 18, 6), strict=True))
NEXT = {"l": {"l": 79, "u": 3, "d": 5, "s": 13}, "u": {"l": 26, "u": 58, "d": 9, "s": 7},
        "d": {"l": 15, "u": 5, "d": 72, "s": 8}, "s": {"l": 74, "u": 8, "d": 15, "s": 3}}


@dataclass(frozen=True)
class Battery:
    """Tokens of min_length characters or more are tested.

    alpha: level at which the three tests together reject randomness.
    rate: false discoveries allowed among the reported tokens.
    """

    min_length: int = 20
    alpha: float = 0.003
    rate: float = 0.01


def _upper(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def encoding(token: str) -> str | None:
    """The smallest encoding of a token with both letters and digits (padding taken off)."""
    chars = set(token)
    if not any(c.isdigit() for c in chars) or not any(c.isalpha() for c in chars):
        return None
    return next((name for name, alphabet in ENCODINGS.items() if chars <= alphabet.keys()), None)


def _kind(c: str) -> str:
    return "l" if c.islower() else "u" if c.isupper() else "d" if c.isdigit() else "s"


def _ordinary(alphabet: dict[str, int]) -> tuple[list[float], list[list[float]]]:
    """Log likelihood of ordinary over random text: of a first character, and of each one after each other."""
    kinds: dict[str, list[str]] = {}
    for c in alphabet:
        kinds.setdefault(_kind(c), []).append(c)
    share = {}
    for some in kinds.values():
        weights = [LETTERS.get(c.lower(), 1) for c in some]
        share.update({c: w / sum(weights) for c, w in zip(some, weights, strict=True)})
    size = len(alphabet)
    first = [math.log(share[c] * len(kinds[_kind(c)])) for c in alphabet]
    after = {k: [math.log(share[c] * size * NEXT[k][_kind(c)] / sum(NEXT[k][x] for x in kinds)) for c in alphabet]
             for k in kinds}
    return first, [after[_kind(c)] for c in alphabet]


_ORDINARY = {name: _ordinary(alphabet) for name, alphabet in ENCODINGS.items()}


def p_values(token: str) -> tuple[float, float] | None:
    """(p of random characters, p of ordinary text); None if no encoding fits."""
    token = token.rstrip("=")
    name = encoding(token)
    n = len(token)
    if name is None or n < 3:
        return None
    alphabet = ENCODINGS[name]
    size = len(alphabet)
    digits = [alphabet[c] for c in token]
    counts = [0] * size
    for d in digits:
        counts[d] += 1
    chi = size / n * sum(c * c for c in counts) - n
    spread = math.sqrt(2 * (size - 1) * (n - 1) / n)
    uniform = _upper((chi - (size - 1)) / spread)
    high = [2 * d >= size for d in digits]
    ones = sum(high)
    zeros = n - ones
    runs = 1 + sum(a != b for a, b in zip(high, high[1:], strict=False))
    mean = 2 * ones * zeros / n + 1
    var = (mean - 1) * (mean - 2) / (n - 1)
    runs_p = 2 * _upper(abs(runs - mean) / math.sqrt(var)) if var > 0 else 0.0
    mid = sum(digits) / n
    total = sum((d - mid) ** 2 for d in digits)
    lag = sum((a - mid) * (b - mid) for a, b in zip(digits, digits[1:], strict=False))
    serial_p = 2 * _upper(abs(lag / total * n + 1) / math.sqrt(n)) if total else 0.0
    first, after = _ORDINARY[name]
    natural = first[digits[0]] + sum(after[a][b] for a, b in zip(digits, digits[1:], strict=False))
    return min(1.0, 3 * min(uniform, runs_p, serial_p)), math.exp(min(0.0, natural))


def parts(text: str, start: int, end: int, least: int) -> list[tuple[int, int]]:
    """Spans of the strings of `least` characters or more to test in a token, the longest first.

    The token is cut at each inner '='. What lies between is tested whole, cut at '_' and '-' (base64 may be left),
    cut at '+' and '/' (base64url may be left), and cut at all four; padding stays with the string before it.
    """
    found = set()
    for cut in CUTS:
        for m in cut.finditer(text, start, end):
            if len(m.group().rstrip("=")) >= least:
                found.add(m.span())
    return sorted(found, key=lambda s: (s[0] - s[1], s))


def random_spans(text: str, pattern: re.Pattern[str], battery: Battery) -> list[tuple[int, int]]:
    """Spans of the strings that pass the battery under the document's rate of false discoveries.

    A string and parts of it are tested each for itself, so spans may overlap.
    """
    tested = []
    for m in pattern.finditer(text):
        for a, b in parts(text, m.start(), m.end(), battery.min_length):
            if p := p_values(text[a:b]):
                tested.append((p[1] if p[0] >= battery.alpha else 1.0, a, b))
    tested.sort()
    last = 0
    for k, (p, _, _) in enumerate(tested, 1):
        if p <= battery.rate * k / len(tested):
            last = k
    return [(a, b) for _, a, b in tested[:last]]


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Unions of the overlapping spans."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's number, end) of the fixed patterns, sorted."""
    found = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


class Scanner:
    """Finds all spans of a text."""

    def __init__(self, battery: Battery = Battery()) -> None:
        self.battery = battery
        self.token = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % battery.min_length)

    def __call__(self, text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
        """The base spans, and all spans: tokens that look random are added where no base span lies."""
        base = base_spans(text)
        free = [(a, b) for a, b in random_spans(text, self.token, self.battery)
                if all(b <= s or e <= a for s, _, e in base)]
        more = [(a, 3, b) for a, b in united(free)]
        return base, sorted(base + more) if more else base


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan(docs: DataFrame, battery: Battery = Battery(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts of each kind, a digest of the base spans, and all spans (code points).

    A null text is empty and has no spans (''); null ids are passed through;
    repeated rows are each scanned; other columns are ignored.
    """
    ship_package(docs.sparkSession)
    docs = docs.select(id_col, text_col)
    kind = docs.schema[0].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(battery)
        for batch in batches:
            for a, b in pieces(batch.column(1)):
                counts: list[list[int]] = [[], [], [], []]
                digest, listed = [], []
                for text in batch.column(1).slice(a, b - a).to_pylist():
                    base, every = scanner(text or "")
                    for k in range(4):
                        counts[k].append(sum(s[1] == k for s in every))
                    digest.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                    listed.append(_joined(every))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), *(pa.array(c, pa.int64()) for c in counts),
                     pa.array(digest), pa.array(listed)],
                    ["doc_id", "n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans"])

    return docs.mapInArrow(rows, f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, n_random bigint, "
                                 "base_sha256 string, spans string")


def redacted(text: str, spans: list[tuple[int, int, int]], mark: str = "[SECRET]") -> str:
    """The text with each union of overlapping spans replaced by the mark."""
    out, at = [], 0
    for a, _, b in spans:
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, battery: Battery = Battery(), text_col: str = "text",
           chars_col: str | None = "n_chars") -> DataFrame:
    """docs with every secret replaced by a mark, and the count of characters (if there) brought up to date.

    Rows without secrets, null texts and all other columns are unchanged.
    """
    ship_package(docs.sparkSession)
    at = docs.columns.index(text_col)
    chars = docs.columns.index(chars_col) if chars_col in docs.columns else None

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(battery)
        for batch in batches:
            for a, b in pieces(batch.column(at)):
                part = batch.slice(a, b - a)
                texts = part.column(at).to_pylist()
                counts = part.column(chars).to_pylist() if chars is not None else []
                changed = False
                for i, text in enumerate(texts):
                    if text and (spans := scanner(text)[1]):
                        texts[i], changed = redacted(text, spans), True
                        if chars is not None:
                            counts[i] = len(texts[i])
                if changed:
                    columns = list(part.columns)
                    columns[at] = pa.array(texts, part.schema.field(at).type)
                    if chars is not None:
                        columns[chars] = pa.array(counts, part.schema.field(chars).type)
                    part = pa.RecordBatch.from_arrays(columns, schema=part.schema)
                yield part

    return docs.mapInArrow(rows, docs.schema)
