"""Phrase mining, ranked search and packing against brute force on small fixtures."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from fraudspark.llm import packing, phrases, queries, ranking

public_tokenizers = pytest.importorskip("public_tokenizers")
#: Extra columns have names that operators use inside.
DDL = "doc_id bigint, text string, lang string, n bigint, length int, part string, h string, rank int, tokens string"
EXTRA = (7, 1, "p", "h", 1, "t")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def texts():
    rng = random.Random(5)
    vocabulary = ["de", "en", "the", "Of", "a", *(f"w{i}" for i in range(12)), "é", "x-y", "漢"]
    ends = [" ", " ", " ", " ", "  ", "\t", ", ", ".", "\n", "; "]
    made = ["".join(rng.choice(vocabulary) + rng.choice(ends) for _ in range(rng.randint(1, 60))) for _ in range(60)]
    return [*made, *[made[0]] * 15, None, "", " .\n", "new york city " * 40, "NEW YORK " * 20, "the the the the " * 30,
            "AKIA long " * 3000]


@pytest.fixture(scope="module")
def rows():
    found = [(i * 3, t, [None, "en", "de", "und"][i % 4], *EXTRA) for i, t in enumerate(texts())]
    return [*found, found[3], (None, "a null id new york city", "en", *EXTRA)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DDL).repartition(5)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DDL)


# 11: phrase mining


def brute_phrases(rows, plan):
    count, total = Counter(), Counter()
    for r in rows:
        lang = r[2] if r[2] is not None else "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (r[1] or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            count.update((lang, *w[i:i + k]) for k in range(1, plan.longest + 1) for i in range(len(w) - k + 1))
    frequent = {p: n for p, n in count.items() if n >= plan.support and len(p) > 2}
    dropped = set()
    for (lang, *w), n in frequent.items():
        for k in range(2, len(w)):
            dropped |= {(lang, *w[i:i + k]) for i in range(len(w) - k + 1)
                        if 100 * n >= plan.contained_percent * count[(lang, *w[i:i + k])]}
    found = defaultdict(list)
    for (lang, *w), a in frequent.items():
        if (lang, *w) not in dropped:
            cuts = [(count[(lang, *w[:k])], count[(lang, *w[k:])]) for k in range(1, len(w))]
            score, _, part, rest = min((2000000 * a // (x + y), k, x, y) for k, (x, y) in enumerate(cuts))
            found[lang].append((-score, -a, " ".join(w).encode(), part, rest))
    return sorted((lang, i, p.decode(), -a, x, y, total[lang], -s) for lang, some in found.items()
                  for i, (s, a, p, x, y) in enumerate(sorted(some)[:plan.top], 1))


def found_phrases(docs, plan):
    out = phrases.collocations(docs, plan)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in out.collect())


@pytest.mark.parametrize("plan", [phrases.PhrasePlan(), phrases.PhrasePlan(support=3, top=40, block=400),
                                  phrases.PhrasePlan(support=1, longest=3, top=10**6)])
def test_collocations_against_brute_force(docs, rows, plan):
    want = brute_phrases(rows, plan)
    assert len(want) > 5
    assert found_phrases(docs, plan) == want


def test_collocations_of_nothing(docs, nothing):
    assert found_phrases(nothing, phrases.PhrasePlan()) == []
    assert found_phrases(docs, phrases.PhrasePlan(support=10**6)) == []


def test_scores_are_exact_beyond_64_bits(spark):
    big = 6 * 10**12
    row = spark.range(1).selectExpr(f"{big}L AS a", f"{big + 1}L AS l", f"{big + 2}L AS r").selectExpr(
        "CAST((CAST(a AS DECIMAL(20,0)) * 2000000) div (CAST(l AS DECIMAL(20,0)) + r) AS BIGINT) AS score").first()
    assert row["score"] == 2000000 * big // (2 * big + 3)


def test_trie_counts_random_phrases():
    rng = np.random.default_rng(1)
    text = rng.zipf(1.3, 20000).astype(np.uint64) % np.uint64(500) + np.uint64(1)
    run = np.sort(rng.integers(0, 900, len(text)))
    lang = run % 3 - 1  # -1: a language without phrases
    windows = Counter()
    for k in (1, 2, 3, 4):
        for i in range(len(text) - k + 1):
            if run[i] == run[i + k - 1] and lang[i] >= 0:
                windows[(int(lang[i]), *map(int, text[i:i + k]))] += 1
    keys = [key for key in sorted(windows) if len(key) > 2 or key[1] % 2]
    trie = phrases.PhraseTrie(np.array([key[0] for key in keys]), [np.array(key[1:], np.uint64) for key in keys])
    counts = np.zeros(len(trie.check), np.int64)
    for state in trie.advance(text, run, lang, 4):
        counts += np.bincount(state, minlength=len(counts))
    got = {keys[trie.accept[s]]: int(counts[s]) for s in np.flatnonzero(trie.accept >= 0)}
    assert got == {key: windows[key] for key in keys}


# 12: ranked search


def brute_search(rows, items, top):
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    bags = [(r[0], Counter(term.findall((r[1] or "").translate(LOWER)))) for r in rows]
    bags = [(i, b) for i, b in bags if b]
    total, df = sum(sum(b.values()) for _, b in bags), Counter(t for _, b in bags for t in b)
    wanted = defaultdict(set)
    for item, text, *_ in items:
        if item is not None:
            wanted[item] |= set(term.findall((text or "").translate(LOWER)))
    out = []
    for item, terms in wanted.items():
        scored = []
        for i, b in bags:
            m = 100 - 90 + 90 * sum(b.values()) * len(bags) // total
            score = sum(math.floor(1000 * math.log((2 * len(bags) + 2) / (2 * df[t] + 1)))
                        * (1000000000 * b[t] // (1000 * b[t] + 8 * m)) for t in terms if b[t])
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, n, i, -s) for n, (s, _, _, i) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=repr)


ITEMS = [(0, "the de New-York w1!", 1), (1, "w3 w3 W4 é 漢 x", 1), (1, "w5", 1), (2, None, 1), (3, "zzz", 1), (4, "", 1),
         (None, "the", 1), (5, "akia city", 1), (5, "akia city", 1), (9, "the of a w0 w1 w2 w3 w4 w5 w6 w7 w8", 1)]


@pytest.mark.parametrize("plan", [ranking.SearchPlan(), ranking.SearchPlan(top=3, block_terms=2),
                                  ranking.SearchPlan(top=200)])
def test_search_against_brute_force(spark, docs, rows, plan):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string, score int")
    out = ranking.ranked_search(docs, items, plan)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    got = sorted((tuple(r) for r in out.collect()), key=repr)
    want = brute_search(rows, ITEMS, plan.top)
    assert len(want) > 10
    assert got == want


def test_search_takes_empty_sides(spark, docs, nothing):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string, score int")
    assert ranking.ranked_search(nothing, items).count() == 0
    assert ranking.ranked_search(docs, items.limit(0)).count() == 0
    some, none = ranking.ranked_search(docs, items), ranking.ranked_search(docs, items.limit(0))
    assert some.schema.simpleString() == none.schema.simpleString()


def test_search_takes_text_ids(spark, docs, rows):
    items = spark.createDataFrame([(str(i), t) for i, t, _ in ITEMS[:2]], "item_id string, text string")
    named = docs.withColumn("doc_id", docs["doc_id"].cast("string"))
    got = {tuple(r) for r in ranking.ranked_search(named, items, ranking.SearchPlan(top=500)).collect()}
    want = brute_search(rows, ITEMS[:2], 500)
    assert {(a, c, d) for a, _, c, d in got} == {(str(a), None if c is None else str(c), d) for a, _, c, d in want}


def test_terms_that_share_a_hash_are_told_apart():
    keys, checks = np.array([5, 5, 5, 9], np.uint64), np.array([1, 2, 3, 1], np.uint64)
    h, c = np.array([5, 5, 9, 9, 4, 10, 5], np.uint64), np.array([3, 1, 1, 2, 1, 1, 9], np.uint64)
    assert ranking._numbers(h, c, (keys, checks)).tolist() == [2, 0, 3, -1, -1, -1, -1]


# 13: packing


def plain_best_two_fit(lengths, capacity):
    """The rule, a sequence at a time, on a list of pieces."""
    left, out = sorted(lengths, reverse=True), []
    while left:
        filled, rest = [], []
        for size in left:
            (filled if sum(filled) + size <= capacity else rest).append(size)
        gap = capacity - sum(filled) + filled[-1]
        pairs = [(a + b, a, i, j) for i, a in enumerate(rest) for j, b in enumerate(rest) if i < j and a + b <= gap]
        if len(filled) > 1 and sum(filled) < capacity and pairs:
            total, _, i, j = max(pairs, key=lambda p: (p[0], p[1]))
            if total > filled[-1]:
                small = filled.pop()
                filled += [rest[i], rest[j]]
                rest = sorted([small, *(x for k, x in enumerate(rest) if k not in (i, j))], reverse=True)
        out.append(tuple(sorted(filled, reverse=True)))
        left = rest
    return out


@pytest.mark.parametrize("seed", range(60))
def test_counts_give_the_sequences_of_the_plain_rule(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 20, 64, 100])
    kinds = [rng.randint(1, capacity) for _ in range(rng.randint(1, 9))]
    lengths = [rng.choice(kinds) for _ in range(rng.randint(0, 70))]
    runs = packing.best_two_fit(np.bincount(lengths, minlength=capacity + 1), capacity)
    got = [tuple(s for s, n in r.uses for _ in range(n)) for r in runs for _ in range(r.times)]
    assert got == plain_best_two_fit(lengths, capacity)
    assert [r.first for r in runs] == [sum(x.times for x in runs[:i]) for i in range(len(runs))]


def test_two_pieces_replace_the_smallest():
    # greedy: 6 + 3 leaves 1 of 10; 2 + 2 in the place of 3 fill it
    runs = packing.best_two_fit(np.bincount([6, 3, 2, 2], minlength=11), 10)
    assert [r.uses for r in runs] == [((6, 1), (2, 2)), ((3, 1),)]


def test_steps_do_not_grow_with_the_documents():
    counts = np.bincount(np.random.default_rng(2).integers(1, 2049, 20000), minlength=2049)
    few, many = (packing.best_two_fit(counts * k, 2048) for k in (1, 10**9))
    assert len(many) < 3 * len(few) < 30000
    assert sum(r.times * sum(s * n for s, n in r.uses) for r in many) == int((counts * 10**9 * np.arange(2049)).sum())


@pytest.mark.parametrize("capacity", [2048, 16])
def test_pack_holds_the_contract(docs, rows, capacity):
    from tokenizers import Tokenizer

    path = queries.public_tokenizer("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    out = packing.pack(docs, path, packing.PackPlan(capacity=capacity))
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    got = [tuple(r) for r in out.collect()]
    want = []
    for r in rows:
        ids = [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 0]
        for k, a in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[a:a + capacity], "<u4")
            want.append((r[0], k, a, len(part), zlib.crc32(part.tobytes())))
    assert sorted((g[:5] for g in got), key=repr) == sorted(want, key=repr)
    held = defaultdict(list)
    for g in got:
        held[g[5]].append((g[6], g[3]))
    for some in held.values():
        at = 0
        for offset, length in sorted(some):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(held) == len(plain_best_two_fit([w[3] for w in want], capacity))


def test_pack_of_nothing(nothing):
    assert packing.pack(nothing, queries.public_tokenizer("word_bpe_49k.json")).count() == 0
