"""Sharding by a k-d tree over metadata, with distributed weighted medians.

All rows start in one node that is to become k leaves. A node of several
leaves is split along its widest dimension (its range as a part of the whole
table's) at the weighted quantile that gives each side the bytes of its
leaves. The quantile is exact: values are placed on 2^31 steps of the node's
range, a hash of the text breaks ties, and the 63-bit code of the split is
found 16 bits at a time from sums of bytes per digit. Rows are never ordered,
and at most 65536 sums of a node meet. Only DataFrame operations are used.

The dimensions come from the text alone, so equal texts share every code and
stay in one shard; a crowded value is split by the hash.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from fraudspark.llm.tables import written

DIGITS, DIGIT_BITS = 4, 16


@dataclass(frozen=True)
class ShardPlan:
    """Shards of about target_bytes, or exactly n_shards; slot_rows: rows numbered together in one task."""

    target_bytes: int = 256 << 20
    n_shards: int | None = None
    slot_rows: int = 50_000


def text_dimensions(text: Column, size: Column) -> dict[str, Column]:
    """Metadata of a text: log size, characters a byte, spaces a byte, log lines."""
    chars = F.length(text)
    lines = chars - F.length(F.replace(text, F.lit("\n"))) + 1
    spaces = chars - F.length(F.replace(text, F.lit(" ")))
    return {"log_size": F.log2(size.cast("double")), "chars": chars / size, "spaces": spaces / size,
            "lines": F.log2(lines.cast("double"))}


def _digit(j: int) -> Column:
    """The j-th group of 16 bits of the code, from the top (the first has 15)."""
    return F.shiftright("code", DIGIT_BITS * (DIGITS - 1 - j)).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1))


def _splits(coded: DataFrame) -> DataFrame:
    """(node, at, below, here): the code where the bytes of a node reach its target, the bytes before it and at it."""
    part = coded.filter("k > 1").select("node", "size", "code", "target")
    found = None
    for j in range(DIGITS):
        if found is not None:
            part = part.join(found.select("node", "at", "below"), "node").filter(
                F.shiftright("code", DIGIT_BITS * (DIGITS - j)) == F.col("at")).select(
                "node", "size", "code", "target", "at", "below")
        else:
            part = part.select("*", F.lit(0).cast("bigint").alias("at"), F.lit(0).cast("bigint").alias("below"))
        sums = part.groupBy("node", _digit(j).alias("digit")).agg(
            F.sum("size").alias("here"), F.first("target").alias("target"), F.first("at").alias("at"),
            F.first("below").alias("below"))
        upto = F.sum("here").over(Window.partitionBy("node").orderBy("digit"))
        best = F.min(F.struct("digit", "upto", "here", "at", "target")).alias("best")
        reached = sums.withColumn("upto", F.col("below") + upto).filter("upto >= target").groupBy("node").agg(best)
        found = written(reached.select(
            "node", (F.shiftleft("best.at", DIGIT_BITS) + F.col("best.digit")).alias("at"),
            (F.col("best.upto") - F.col("best.here")).alias("below"), "best.here", "best.target"), f"splits-{j}")
        part = part.drop("at", "below")
    return found


def _halved(rows: DataFrame, names: list[str], whole: dict[str, float]) -> DataFrame:
    """One level of the tree: each node of k > 1 leaves becomes two, numbered by their first leaf."""
    stats = rows.filter("k > 1").groupBy("node").agg(
        F.sum("size").alias("bytes"), *(F.min(n).alias(f"{n}_low") for n in names),
        *(F.max(n).alias(f"{n}_high") for n in names))
    widths = [(F.col(f"{n}_high") - F.col(f"{n}_low")) / whole[n] if whole[n] else F.lit(0.0) for n in names]
    widest = F.greatest(*widths)
    pick = F.lit(len(names) - 1)
    for i in reversed(range(len(names))):
        pick = F.when(widths[i] == widest, i).otherwise(pick)
    stats = written(stats.select(
        "node", "bytes", pick.alias("dim"),
        *(F.struct(F.col(f"{n}_low").alias("low"), F.col(f"{n}_high").alias("high")).alias(f"{n}_range")
          for n in names)), "nodes")
    low, span, value = F.lit(None).cast("double"), F.lit(None).cast("double"), F.lit(None).cast("double")
    for i, n in enumerate(names):
        mine = F.col("dim") == i
        low = F.when(mine, F.col(f"{n}_range.low")).otherwise(low)
        span = F.when(mine, F.col(f"{n}_range.high") - F.col(f"{n}_range.low")).otherwise(span)
        value = F.when(mine, F.col(n)).otherwise(value)
    step = F.coalesce(F.floor((value - low) / F.nullif(span, F.lit(0.0)) * (2**31 - 1)), F.lit(0)).cast("bigint")
    left = F.floor(F.col("k") / 2).cast("int")
    coded = rows.join(stats, "node", "left").select(
        *rows.columns, (F.shiftleft(step, 32) + F.shiftrightunsigned("hash", 32)).alias("code"),
        (F.col("bytes") * left / F.col("k")).alias("target"))
    coded = written(coded, "coded")
    splits = _splits(coded)
    # the rows of the split's own code go to the side that misses the target by less
    go = splits.select("node", "at", (F.col("below") + F.col("here") / 2 <= F.col("target")).alias("with_left"))
    out = coded.join(go, "node", "left")
    right = (F.col("k") > 1) & ((F.col("code") > F.col("at")) | ((F.col("code") == F.col("at")) & ~F.col("with_left")))
    return written(out.select(
        *(c for c in rows.columns if c not in ("node", "k")),
        F.when(right, F.col("node") + left).otherwise(F.col("node")).cast("int").alias("node"),
        F.when(F.col("k") == 1, 1).when(right, F.col("k") - left).otherwise(left).cast("int").alias("k")), "level")


def shards(docs: DataFrame, plan: ShardPlan = ShardPlan(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard (from 0), slot (gapless from 0 in each shard).

    size is the text's UTF-8 bytes plus 1. A null text is empty; null ids are
    passed through; rows of equal texts, repeated rows included, share a
    shard; slots follow a hash of the id, then the id. An empty table has no
    rows. Other columns are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    size = (F.octet_length(text) + 1).cast("bigint")
    dims = text_dimensions(F.col("text"), F.col("size"))
    names = list(dims)
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), size.alias("size")).select(
        "doc_id", "size", F.crc32("text").alias("text_crc32"), F.xxhash64("text").alias("hash"),
        F.lit(0).alias("node"), *(c.alias(n) for n, c in dims.items()))
    rows = written(rows, "rows")
    total = rows.agg(F.count("*").alias("n"), F.sum("size").alias("bytes"),
                     *((F.max(n) - F.min(n)).alias(n) for n in names)).first()
    leaves = plan.n_shards or max(1, math.ceil((total["bytes"] or 0) / plan.target_bytes))
    rows = rows.withColumn("k", F.lit(leaves))
    for _ in range(math.ceil(math.log2(leaves)) if total["n"] else 0):
        rows = _halved(rows, names, total.asDict())
    parts = max(1, math.ceil(total["n"] / leaves / plan.slot_rows))
    rows = rows.select("doc_id", "size", "text_crc32", F.col("node").alias("shard"),
                       F.pmod(F.xxhash64("doc_id"), F.lit(parts)).alias("part"), "hash")
    counts = rows.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")
    place = F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id", "hash"))
    return rows.withColumn("place", place).join(
        counts.select("shard", "part", before.alias("before")), ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("place") - 1).alias("slot"))
