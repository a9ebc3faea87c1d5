"""Whole methods restated plainly: the k-d tree of op1 and the out-of-place distance of op8."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fraudspark.llm import language, sharding


def texts(n, seed):
    rng = random.Random(seed)
    made = ["".join(rng.choice("ab é\n.漢") for _ in range(int(rng.expovariate(1 / 80)))) for _ in range(n)]
    return [*made, *[made[0]] * (n // 3), None, "", "one line", "x" * 30_000, "\n" * 50]


def plain_tree(rows, names, n_shards):
    """rows: (place, size, hash, {dimension: value}); the shard of each by recursive splits at weighted medians."""
    whole = {n: max(r[3][n] for r in rows) - min(r[3][n] for r in rows) for n in names}
    shard = {}

    def split(members, first, k):
        if k == 1 or not members:
            shard.update({r[0]: first for r in members})
            return
        spread = {n: (max(r[3][n] for r in members) - min(r[3][n] for r in members)) / whole[n] if whole[n] else 0.0
                  for n in names}
        dim = max(names, key=lambda n: (spread[n], -names.index(n)))
        low, high = (f(r[3][dim] for r in members) for f in (min, max))

        def code(r):
            step = math.floor((r[3][dim] - low) / (high - low) * (2**31 - 1)) if high > low else 0
            return (step << 32) + ((r[2] % 2**64) >> 32)

        left, target = k // 2, sum(r[1] for r in members) * (k // 2) / k
        bytes_of = Counter()
        for r in members:
            bytes_of[code(r)] += r[1]
        below = 0
        for at in sorted(bytes_of):
            if below + bytes_of[at] >= target:
                break
            below += bytes_of[at]
        with_left = below + bytes_of[at] / 2 <= target
        right = [r for r in members if code(r) > at or code(r) == at and not with_left]
        split([r for r in members if r not in right], first, left)
        split(right, first + left, k - left)

    split(rows, 0, n_shards)
    return shard


@pytest.mark.parametrize("n_shards", [1, 2, 5, 8])
def test_shards_are_those_of_the_plain_tree(spark, n_shards):
    rows = [(i, t) for i, t in enumerate(texts(90, n_shards))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    text = F.coalesce("text", F.lit(""))
    sized = df.select("doc_id", text.alias("text"), (F.octet_length(text) + 1).cast("bigint").alias("size"))
    dims = sharding.text_dimensions(F.col("text"), F.col("size"))
    named = sized.select("doc_id", "size", F.xxhash64("text").alias("hash"), *[c.alias(n) for n, c in dims.items()])
    measured = [(r["doc_id"], r["size"], r["hash"], {n: r[n] for n in dims}) for r in named.collect()]
    got = {r["doc_id"]: r["shard"] for r in sharding.shards(df, sharding.ShardPlan(n_shards=n_shards)).collect()}
    assert got == plain_tree(measured, list(dims), n_shards)


def gram_ranks(some, ranks):
    count = Counter()
    for text in some:
        line = " " + re.sub(r"[\W\d_]+", " ", text.lower()).strip() + " "
        if line.strip():
            count.update(line[i:i + n] for n in (1, 2, 3) for i in range(len(line) - n + 1) if line[i:i + n] != " ")
    code = lambda g: sum(ord(x) << 21 * k for k, x in enumerate(g))
    return {g: place for place, g in enumerate(sorted(count, key=lambda g: (-count[g], code(g)))[:ranks])}


@pytest.mark.parametrize("ranks", [5, 40])
def test_predictions_follow_the_out_of_place_distance(spark, ranks):
    rng = random.Random(ranks)
    alphabets = {"x": "aeinst ", "y": "aeioup ", "z": "éàe nst"}
    rows = [(i, lang, "".join(rng.choice(alphabets[lang]) for _ in range(rng.randint(0, 120)))) for i in range(60)
            for lang in [rng.choice("xyz")]]
    rows += [(90, "twin", r[2]) for r in rows if r[1] == "x"]  # the same profile: equal distances go to the first name
    rows += [(91, None, "en text"), (92, "x", None), (93, "x", "12 !"), (94, "z", "é" * 20_000)]
    df = spark.createDataFrame(rows, "doc_id bigint, lang string, text string").repartition(4)
    profiles = {lang: gram_ranks([t for _, own, t in rows if own == lang and t], ranks) for lang in ("twin", "x", "y", "z")}
    got = language.predict(df, language.learn(df, language.ProfilePlan(ranks=ranks))).collect()
    want = []
    for i, _, text in rows:
        own = gram_ranks([text or ""], ranks)
        if not own:
            want.append((i, "und", 0.0))
            continue
        away = {lang: sum(abs(p[g] - place) if g in p else ranks for g, place in own.items()) for lang, p in profiles.items()}
        best = min(sorted(away), key=lambda lang: away[lang])
        want.append((i, best, round(1 - away[best] / (ranks * len(own)), 12)))
    assert sorted((r[0], r[1], round(r[2], 12)) for r in got) == sorted(want)
    assert any(w[1] == "twin" for w in want) and not any(w[1] == "x" for w in want)
