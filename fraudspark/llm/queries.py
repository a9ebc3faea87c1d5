"""The registered queries of the operators, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession, functions as F

from fraudspark.llm import (
    chat,
    decontaminate,
    jaccard,
    language,
    packing,
    phrases,
    pieces_codec,
    quality,
    ranking,
    secrets,
    sharding,
    substrings,
    token_files,
)
from fraudspark.llm.tables import documents, folder

WORDS_SQL = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def public_tokenizer(name: str) -> str:
    """Path of a vocabulary file of a public tokenizer."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.shards(documents(spark, sf_dir), sharding.ShardPlan(n_shards=8))
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.without_repeats(documents(spark, sf_dir))
    removed = F.aggregate(F.zip_with("starts", "ends", lambda a, b: b - a), F.lit(0).cast("bigint"), lambda s, x: s + x)
    return found.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


SUBSTRINGS_SQL = rf"""
WITH base AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
win AS (SELECT doc_id, i, w[i:i + 12] AS g
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM base)),
hit AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS least FROM win)
        WHERE least < doc_id),
gone AS (SELECT DISTINCT doc_id, i + o AS i FROM hit, range(0, 13) r(o)),
word AS (SELECT doc_id, i, w[i] AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM base)),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS t, count(*) AS n
         FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT b.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(k.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(k.t, '')) AS kept_sha256
FROM base b LEFT JOIN kept k USING (doc_id)"""


@lru_cache(maxsize=2)
def piece_codec(path: str | None = None) -> pieces_codec.Codec:
    """The codec of the pipeline and of op4; path: a SentencePiece model."""
    path = path or public_tokenizer("piece_bpe_32k.model")
    return pieces_codec.Codec(pieces_codec.load_vocabulary(path))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces_codec.encode(documents(spark, sf_dir), piece_codec())


def op5_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = folder(spark, "tokens.orc")
    token_files.write_token_files(documents(spark, sf_dir), path, public_tokenizer("word_bpe_49k.json"))
    return token_files.token_offsets(spark, path)


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(documents(spark, sf_dir))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    third = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1, F.lit(False))
    profiles = language.learn(docs.filter(~third))
    return language.predict(docs, profiles).select("doc_id", third.alias("held_out"), "lang_pred", "score")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(documents(spark, sf_dir))


def _covered_sql(size: int) -> str:
    """Word positions (doc_id, i) inside a window of `size` words that occurs again in its document."""
    return f"""
      SELECT DISTINCT doc_id, i + o AS i FROM (
        SELECT doc_id, i FROM (
          SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c
          FROM (SELECT doc_id, i, w[i:i + {size - 1}] AS g
                FROM (SELECT doc_id, w, unnest(range(1, len(w) - {size - 2})) AS i FROM base))
        ) WHERE c > 1), range(0, {size}) r(o)"""


QUALITY_SQL = rf"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS text, {WORDS_SQL} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
five AS ({_covered_sql(5)}),
ten AS ({_covered_sql(10)}),
long AS (SELECT DISTINCT doc_id FROM ({_covered_sql(101)})),
c5 AS (SELECT doc_id, count(*) AS n FROM five GROUP BY doc_id),
c10 AS (SELECT t.doc_id, sum(length(b.w[t.i])) AS n FROM ten t JOIN base b USING (doc_id) GROUP BY t.doc_id),
m AS (
  SELECT b.doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum([length(x) for x in w]), 0)::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(c5.n, 0)::BIGINT AS n_repeat_words,
         coalesce(c10.n, 0)::BIGINT AS n_span_chars, long.doc_id IS NOT NULL AS long_repeat
  FROM base b LEFT JOIN c5 USING (doc_id) LEFT JOIN c10 USING (doc_id) LEFT JOIN long USING (doc_id)),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT *, NOT (base_failed OR long_repeat OR 100 * n_span_chars > 20 * word_chars) AS kept FROM f"""

def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_classes(documents(spark, sf_dir))


JACCARD_SQL = rf"""
WITH RECURSIVE base AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents WHERE doc_id IS NOT NULL),
sh AS (
  SELECT DISTINCT doc_id, g FROM (
    SELECT doc_id, w[i:i + 4] AS g
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM base WHERE len(w) > 0))),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y, c = p.n AND c = q.n AS same FROM pairs JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
  WHERE 10 * c >= 8 * (p.n + q.n - c)),
reach AS (SELECT x, x AS y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y),
least AS (SELECT x, min(y) AS class_id FROM reach GROUP BY x),
sums AS (SELECT x, count(*) FILTER (WHERE same) AS n_copies, count(*) FILTER (WHERE NOT same) AS n_links
         FROM links GROUP BY x)
SELECT doc_id, coalesce(class_id, doc_id) AS class_id, coalesce(n_copies, 0)::BIGINT AS n_copies,
       coalesce(n_links, 0)::BIGINT AS n_links
FROM documents LEFT JOIN least ON least.x = doc_id LEFT JOIN sums ON sums.x = doc_id"""

def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(documents(spark, sf_dir))


def _phrases_sql() -> str:
    """All phrases of one to four words, counted by their words."""
    cuts = " UNION ALL ".join(
        f"SELECT f.lang, f.g, f.c AS a, {k} AS k, p.c AS l, q.c AS r FROM f JOIN f p ON p.lang = f.lang AND p.g = f.g[:{k}] "
        f"JOIN f q ON q.lang = f.lang AND q.g = f.g[{k + 1}:] WHERE len(f.g) > {k}" for k in (1, 2, 3))
    inside = " UNION ALL ".join(
        f"SELECT lang, g[{i}:{i + n - 1}] AS g, c FROM f WHERE len(g) = {size}"
        for size in (3, 4) for n in range(2, size) for i in range(1, size - n + 2))
    grams = " UNION ALL ".join(
        f"SELECT lang, w[i:i + {n - 1}] AS g FROM (SELECT lang, w, unnest(range(1, len(w) - {n - 2})) AS i FROM piece)"
        for n in (1, 2, 3, 4))
    return rf"""
WITH piece AS (
  SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents)),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM piece GROUP BY lang),
f AS (SELECT lang, g, count(*) AS c FROM ({grams}) GROUP BY lang, g HAVING count(*) >= 30),
cut AS (SELECT *, ((2000000::HUGEINT * a) // (l + r))::BIGINT AS score FROM ({cuts})),
worst AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
longer AS (SELECT lang, g, max(c) AS most FROM ({inside}) GROUP BY lang, g),
kept AS (
  SELECT w.*, array_to_string(w.g, ' ') AS phrase FROM worst w LEFT JOIN longer o ON o.lang = w.lang AND o.g = w.g
  WHERE o.most IS NULL OR 100 * o.most < 80 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n.n,
       score
FROM kept JOIN n USING (lang) QUALIFY rank <= 2000"""


PHRASES_SQL = _phrases_sql()


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.ranked_search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


TERMS_SQL = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
             r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")
SEARCH_SQL = rf"""
WITH bag AS (SELECT doc_id, {TERMS_SQL} AS t FROM documents),
doc AS (SELECT doc_id, t, len(t) AS n FROM bag WHERE len(t) > 0),
total AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM doc),
tf AS (SELECT doc_id, n, x, count(*) AS tf FROM (SELECT doc_id, n, unnest(t) AS x FROM doc) GROUP BY ALL),
weight AS (SELECT x, floor(1000 * ln((2.0::DOUBLE * any_value(docs) + 2) / (2.0::DOUBLE * count(*) + 1)))::BIGINT AS w
           FROM tf, total GROUP BY x),
item AS (SELECT DISTINCT item_id, unnest({TERMS_SQL}) AS x FROM benchmark),
score AS (
  SELECT item_id, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * docs) // terms)))))::BIGINT AS score
  FROM tf JOIN weight USING (x) JOIN item USING (x), total GROUP BY item_id, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM score WHERE score > 0 QUALIFY rank <= 10"""


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizer("word_bpe_49k.json"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_kd_shards": op1_kd_shards,
    "op2_decontamination": op2_decontamination,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_token_orc": op5_token_orc,
    "op6_secret_scan": op6_secret_scan,
    "op7_chat_format": op7_chat_format,
    "op8_language_id": op8_language_id,
    "op9_quality_rules": op9_quality_rules,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_phrase_mining": op11_phrase_mining,
    "op12_ranked_search": op12_ranked_search,
    "op13_best_fit_packing": op13_best_fit_packing,
}

ORACLE: dict[str, str] = {
    "op3_substring_dedup": SUBSTRINGS_SQL,
    "op9_quality_rules": QUALITY_SQL,
    "op10_jaccard_join": JACCARD_SQL,
    "op11_phrase_mining": PHRASES_SQL,
    "op12_ranked_search": SEARCH_SQL,
}
