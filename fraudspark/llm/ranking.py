"""Ranked lexical search with bag deduplication.

Only terms of the items can change a score, so each document is restricted to
the items' vocabulary: its term frequencies there and its length norm m are
all that its scores depend on. Documents with the same frequencies and the
same m form a class (dealt by hash, told apart by the whole vector); a class
is scored once against all items, and only the best classes are expanded into
their members, by ascending doc_id.

The vocabulary goes to the tasks in blocks of items of bounded size, one pass
over the documents each. Scores are 64-bit integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from fraudspark.llm.tables import ship_package, written
from fraudspark.llm.text import Texts, Words, pieces
from fraudspark.operators.ordering import ordered_prefix

#: Bytes of a term (ASCII letters and digits, all others beyond ASCII) and lower case of A-Z.
_TERM = np.zeros(256, bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass(frozen=True)
class SearchPlan:
    """top documents an item; block_terms (item, term) rows of at most one block of items, and its last item's."""

    top: int = 10
    block_terms: int = 1 << 18


def _terms(column: pa.Array) -> tuple[Words, np.ndarray, np.ndarray]:
    """Terms of the texts with their two hashes, which together stand for a term."""
    texts = Texts(column)
    texts.data = _LOWER[texts.data]
    words = Words(texts, _TERM)
    return words, words.hashes(), texts.span_hash(words.start, words.end, 2)


def _item_terms(items: DataFrame) -> DataFrame:
    """(item_id, h, check), distinct: rows of one item_id are one item."""
    kind = items.schema["item_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces(batch.column(1)):
                words, h, check = _terms(batch.column(1).slice(a, b - a))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a).take(pa.array(words.doc)), pa.array(h.view(np.int64)),
                     pa.array(check.view(np.int64))], ["item_id", "h", "check"])

    return items.mapInArrow(run, f"item_id {kind}, h bigint, check bigint").distinct()


def _vocabulary(terms: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct terms of a block, sorted by both; at most plan.block_terms and one item's."""
    table = terms.select("h", "check").distinct().toArrow()
    h, check = (table.column(c).to_numpy().view(np.uint64) for c in ("h", "check"))
    order = np.lexsort((check, h))
    return h[order], check[order]


def _numbers(h: np.ndarray, check: np.ndarray, vocabulary: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Place of each term in the vocabulary, -1 where it isn't in it."""
    keys, checks = vocabulary
    at = np.searchsorted(keys, h)
    out = np.full(len(h), -1, np.int64)
    open_ = np.flatnonzero(at < len(keys))
    while len(open_):  # terms that share the first hash follow each other
        open_ = open_[keys[at[open_]] == h[open_]]
        same = checks[at[open_]] == check[open_]
        out[open_[same]] = at[open_[same]]
        open_ = open_[~same]
        at[open_] += 1
        open_ = open_[at[open_] < len(keys)]
    return out


def _bags(docs: DataFrame, vocabulary: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(doc_id, n, terms, tfs) of each document with a term; terms are places in the vocabulary, ascending."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(shared.value[0])
        for batch in batches:
            for a, b in pieces(batch.column(1)):
                words, h, check = _terms(batch.column(1).slice(a, b - a))
                number = _numbers(h, check, shared.value)
                held = number >= 0
                pair, tf = np.unique(words.doc[held] * size + number[held], return_counts=True)
                full = np.flatnonzero(words.counts)
                bounds = pa.array(np.append(np.searchsorted(pair, full * size), len(pair)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a).take(pa.array(full)), pa.array(words.counts[full].astype(np.int64)),
                     pa.ListArray.from_arrays(bounds, pa.array((pair % max(1, size)).astype(np.int32))),
                     pa.ListArray.from_arrays(bounds, pa.array(tf.astype(np.int32)))], ["doc_id", "n", "terms", "tfs"])

    return docs.mapInArrow(run, f"doc_id {kind}, n bigint, terms array<int>, tfs array<int>")


def _frequencies(bags: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=size)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["term", "df"])

    got = bags.select("terms").mapInArrow(run, "term int, df bigint").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    out = np.zeros(size, np.int64)
    out[got.column("term").to_numpy()] = got.column("df").to_numpy()
    return out


@dataclass(frozen=True)
class _Postings:
    """Items of each term: items[first[t]:first[t + 1]], numbers into `ids`; weight[t] is the term's."""

    ids: pa.Array
    first: np.ndarray
    items: np.ndarray
    weight: np.ndarray


def _postings(terms: DataFrame, vocabulary: tuple[np.ndarray, np.ndarray], df: np.ndarray, n_docs: int) -> _Postings:
    table = terms.select("item_id", "h", "check").toArrow()
    coded = table.column("item_id").combine_chunks().dictionary_encode()
    item = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    term = _numbers(table.column("h").to_numpy().view(np.uint64), table.column("check").to_numpy().view(np.uint64),
                    vocabulary)
    order = np.lexsort((item, term))
    weight = np.floor(1000 * np.log((2.0 * n_docs + 2) / (2.0 * df + 1))).astype(np.int64)
    return _Postings(coded.dictionary, np.searchsorted(term[order], np.arange(len(vocabulary[0]) + 1)), item[order],
                     weight)


def _best_classes(classes: DataFrame, postings: _Postings, plan: SearchPlan) -> DataFrame:
    """(item_id, score, least, m, terms, tfs): the best classes of each item in each task.

    `top` classes by score and least doc_id are enough: each brings a document
    that comes before all documents of the classes behind it.
    """
    kind = classes.schema["least"].dataType.simpleString()
    item_kind = pa.types.is_integer(postings.ids.type) and "bigint" or "string"
    shared = classes.sparkSession.sparkContext.broadcast(postings)

    def scores(p: _Postings, m: np.ndarray, row: np.ndarray, term: np.ndarray, tf: np.ndarray) -> np.ndarray:
        out = np.zeros((len(m), len(p.ids)), np.int64)
        value = p.weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[row]))
        order = np.argsort(term, kind="stable")
        cut = np.concatenate([[0], np.flatnonzero(np.diff(term[order])) + 1, [len(term)]])
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            if a < b:
                some = order[a:b]
                t = term[some[0]]
                items = p.items[p.first[t]:p.first[t + 1]]
                out[row[some][:, None], items] += value[some][:, None]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, best = shared.value, None
        step = max(64, (1 << 20) // max(1, len(p.ids)))
        for batch in (part.slice(a, step) for part in batches for a in range(0, part.num_rows, step)):
            lists = batch.column(2)
            length = lists.value_lengths().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(batch.num_rows), length)
            found = scores(p, batch.column(1).to_numpy(), row, lists.flatten().to_numpy(zero_copy_only=False),
                           batch.column(3).flatten().to_numpy(zero_copy_only=False).astype(np.int64))
            # by least doc_id (nulls last), so that a stable order by score keeps it
            least = pc.sort_indices(batch.column(0), sort_keys=[("", "ascending")], null_placement="at_end").to_numpy()
            order = least[np.argsort(-found[least], axis=0, kind="stable")[:plan.top]]
            value = np.take_along_axis(found, order, axis=0)
            ok = value > 0
            item = np.broadcast_to(np.arange(len(p.ids)), value.shape)[ok]
            take = batch.take(pa.array(order[ok]))
            rows = pa.Table.from_arrays([pa.array(item), pa.array(value[ok]), *take.columns],
                                        ["item", "score", "least", "m", "terms", "tfs"])
            best = rows if best is None else pa.concat_tables([best, rows])
            if best.num_rows > 4 * plan.top * len(p.ids):
                best = _top(best, plan.top)
        if best is not None:
            best = _top(best, plan.top)
            ids = p.ids.take(best.column("item").combine_chunks()).cast("int64" if item_kind == "bigint" else "string")
            yield from best.set_column(0, "item_id", ids).combine_chunks().to_batches()

    return classes.select("least", "m", "terms", "tfs").mapInArrow(
        run, f"item_id {item_kind}, score bigint, least {kind}, m bigint, terms array<int>, tfs array<int>")


def _top(rows: pa.Table, top: int) -> pa.Table:
    """The first `top` rows of each item by score (descending) and least doc_id."""
    rows = rows.take(pc.sort_indices(rows, [("item", "ascending"), ("score", "descending"),
                                                    ("least", "ascending")], null_placement="at_end"))
    item = rows.column("item").to_numpy()
    place = np.arange(len(item)) - np.searchsorted(item, item)
    return rows.filter(pa.array(place < top))


def ranked_search(docs: DataFrame, items: DataFrame, plan: SearchPlan = SearchPlan(), id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the `top` best documents of each item, those with a score above 0.

    Null and empty texts have no term; such a document counts nowhere and such
    an item has no rows. Each row of docs is a document (repeated ids and rows
    with a null id too: null comes last among equal scores, equal ids follow
    each other). Rows of one item_id are one item; a null item_id can't be
    named and is left out. Equal scores go by ascending doc_id. Texts may have
    any length: a task takes a megabyte at a time, a longer text alone. An
    empty table on either side gives no rows. Other columns are ignored.
    """
    spark: SparkSession = docs.sparkSession
    ship_package(spark)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    items = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text"))
    kinds = {"item_id": items.schema["item_id"].dataType, "doc_id": docs.schema["doc_id"].dataType}
    terms = written(_item_terms(items.filter("item_id IS NOT NULL")), "item-terms")
    sizes = terms.groupBy("item_id").agg(F.count("*").alias("n"))
    placed = ordered_prefix(sizes, [], ["item_id"], ["n"])
    placed = placed.select("item_id", F.floor((F.col("cum_n") - F.col("n")) / plan.block_terms).cast("int").alias("block"))
    terms = written(terms.join(placed, "item_id"), "item-blocks")
    results = [_block(docs, terms.filter(F.col("block") == r["block"]).drop("block"), plan)
               for r in terms.select("block").distinct().orderBy("block").collect()]
    if not results:
        return spark.createDataFrame([], "rank int, score bigint").select(
            F.lit(None).cast(kinds["item_id"]).alias("item_id"), "rank", F.lit(None).cast(kinds["doc_id"]).alias("doc_id"),
            "score")
    return reduce(DataFrame.unionByName, results).select(
        F.col("item_id").cast(kinds["item_id"]).alias("item_id"), "rank", "doc_id", "score")


def _block(docs: DataFrame, terms: DataFrame, plan: SearchPlan) -> DataFrame:
    vocabulary = _vocabulary(terms)
    bags = written(_bags(docs, vocabulary), "bags")
    n_docs, length = bags.agg(F.count("*"), F.sum("n")).first()
    postings = _postings(terms, vocabulary, _frequencies(bags, len(vocabulary[0])), n_docs)
    norm = F.expr(f"10 + (90 * n * {n_docs}L) div {length or 1}L").cast("bigint")
    bags = bags.filter(F.size("terms") > 0).select("doc_id", norm.alias("m"), "terms", "tfs")
    bag = ["m", "terms", "tfs"]
    classes = written(bags.groupBy(*bag).agg(F.min("doc_id").alias("least")), "classes")
    order = [F.desc("score"), F.asc_nulls_last("least")]
    best = written(_best_classes(classes, postings, plan)
                   .withColumn("place", F.row_number().over(Window.partitionBy("item_id").orderBy(*order)))
                   .filter(F.col("place") <= plan.top).drop("place"), "best")
    # the first members of each class: hot classes are cut to `top` in each task before they move
    members = bags.withColumn("place", F.row_number().over(
        Window.partitionBy(*bag).orderBy(F.asc_nulls_last("doc_id")))).filter(F.col("place") <= plan.top).drop("place")
    members = members.join(best.select(*bag).distinct(), bag, "left_semi")
    ranked = best.join(members, bag).withColumn("rank", F.row_number().over(
        Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))))
    return ranked.filter(F.col("rank") <= plan.top).select("item_id", "rank", "doc_id", "score")
