"""Chat formatting with minimum-cost role repair.

Legal conversations are: an optional system turn, then user and assistant in
turn, the assistant last. A dynamic program over that automaton keeps,
relabels or merges each turn, or puts empty turns before it, at the least
total cost; then each turn becomes a fragment of the rendered text. Fragments
of a conversation, in order, make the whole.

The cost of a stretch of turns from one state to another is a matrix, and
matrices combine by (min, +). A long conversation is cut into blocks of
turns; each block gives its matrix, the few matrices of a conversation are
combined in order, and each block is then repaired on its own between its
known end states. No task needs a whole conversation.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from fraudspark.llm.tables import ship_package, written
from fraudspark.operators.ordering import RANGE, dealt_by_range

ROLES = ("system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = 0, 1, 2, 3
ALIASES = {"human": "user", "prompter": "user", "bot": "assistant", "model": "assistant", "gpt": "assistant",
           "ai": "assistant", "developer": "system"}
#: Legal next turns.
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
INFINITE = 1 << 60
Matrix = list[list[int]]


@dataclass(frozen=True)
class Costs:
    """relabel: another role than given; name: a role where none is known; merge: into the turn before; insert: an empty turn."""

    relabel: int = 4
    name: int = 1
    merge: int = 2
    insert: int = 3
    block_turns: int = 4096


def role_number(role: str | None) -> int:
    """1 to 3, or 0 if the role is null or unknown."""
    name = (role or "").strip().lower()
    name = ALIASES.get(name, name)
    return ROLES.index(name) + 1 if name in ROLES else 0


def _steps(costs: Costs) -> dict[int, list[tuple[int, int, int, str, tuple[int, ...]]]]:
    """For each given role: (from, to, cost, action, empty turns put before), the best for each pair of states."""
    out = {}
    for role in range(4):
        best: dict[tuple[int, int], tuple] = {}
        for a in NEXT:
            for label in (SYSTEM, USER, ASSISTANT):
                change = 0 if label == role else costs.name if role == 0 else costs.relabel
                done = "keep" if label == role else "relabel"
                ways = []
                if a == label:
                    ways.append((change + costs.merge, 1, "merge" if label == role else "merge_relabel", ()))
                if label in NEXT[a]:
                    ways.append((change, 0, done, ()))
                for extra in NEXT[a]:
                    if label in NEXT[extra]:
                        ways.append((change + costs.insert, 2, done, (extra,)))
                    for more in NEXT[extra]:
                        if label in NEXT[more]:
                            ways.append((change + 2 * costs.insert, 3, done, (extra, more)))
                if ways:
                    cost, _, action, empty = min(ways)
                    best[a, label] = (a, label, cost, action, empty)
        out[role] = sorted(best.values())
    return out


def _endings(costs: Costs) -> list[int]:
    """Cost of ending in each state: empty turns up to the assistant's."""
    return [2 * costs.insert, 2 * costs.insert, costs.insert, 0]


def matrix(roles: list[int], costs: Costs) -> Matrix:
    """Least cost of a stretch from each state to each state."""
    steps = _steps(costs)
    out = [[0 if a == b else INFINITE for b in range(4)] for a in range(4)]
    for role in roles:
        new = [[INFINITE] * 4 for _ in range(4)]
        for a, b, cost, _, _ in steps[role]:
            for s in range(4):
                if out[s][a] + cost < new[s][b]:
                    new[s][b] = out[s][a] + cost
        out = new
    return out


def joints(blocks: list[Matrix], costs: Costs) -> list[tuple[int, int]]:
    """(entry, exit) state of each block of a conversation on a path of least cost; ties go to the lower state."""
    ahead = [_endings(costs)]
    for m in reversed(blocks):
        ahead.append([min(m[a][b] + ahead[-1][b] for b in range(4)) for a in range(4)])
    ahead.reverse()
    out, state = [], START
    for i, m in enumerate(blocks):
        to = min(range(4), key=lambda b: (m[state][b] + ahead[i + 1][b], b))
        out.append((state, to))
        state = to
    return out


def repair(roles: list[int], entry: int, end: int, costs: Costs) -> list[tuple[int, int, str, tuple[int, ...]]]:
    """(role, cost, action, empty turns before) of each turn, from entry to end at least cost; ties to the lower state."""
    steps = _steps(costs)
    cost = [INFINITE] * 4
    cost[entry] = 0
    back = []
    for role in roles:
        new, via = [INFINITE] * 4, [None] * 4
        for step in steps[role]:
            a, b, c = step[:3]
            if cost[a] + c < new[b]:
                new[b], via[b] = cost[a] + c, step
        back.append(via)
        cost = new
    out = []
    for via in reversed(back):
        a, b, c, action, empty = via[end]
        out.append((b, c, action, empty))
        end = a
    out.reverse()
    return out


def _open(role: int) -> str:
    return f"<|{ROLES[role - 1]}|>\n"


CLOSE = "<|end|>\n"


def fragment(state: int, turn: tuple[int, int, str, tuple[int, ...]], text: str | None, last: bool) -> str:
    """What a turn adds to the rendered text after a turn of the given state (0: none)."""
    role, _, action, empty = turn
    if action.startswith("merge"):
        out = "\n\n" + (text or "")
    else:
        out = (CLOSE if state else "") + "".join(_open(e) + CLOSE for e in empty) + _open(role) + (text or "")
    if last:
        out += CLOSE + (_open(ASSISTANT) + CLOSE if role == USER else
                        _open(USER) + CLOSE + _open(ASSISTANT) + CLOSE if role == SYSTEM else "")
    return out


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows of a sorted partition by equal leading columns."""
    key, held = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:keys] != key:
                if held:
                    yield key, held
                key, held = row[:keys], []
            held.append(row[keys:])
    if held:
        yield key, held


def _sorted_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return df.select(*keys, *order, *(c for c in df.columns if c not in keys + order)).repartition(
        *keys).sortWithinPartitions(*keys, *order)


def _in_blocks(rows: DataFrame, block_turns: int) -> DataFrame:
    """rows with the number of their block: `block_turns` rows of a conversation by position.

    Rows are dealt by ranges of (conversation, order) and written, so a long
    conversation lies in several ranges; a row's position is its place in its
    range and the rows of the ranges before.
    """
    order = ["turn", "role", "tie", "nth"]
    conv = F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit(""))  # never null
    keyed = rows.withColumns({"conv": conv, "nth": F.monotonically_increasing_id()})
    dealt = dealt_by_range(keyed, ["conv", *order])
    totals = dealt.groupBy("conv", RANGE).agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("conv").orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("conv", RANGE, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("conv", RANGE).orderBy(*order)) - 1
    return dealt.withColumn("place", place).join(before, ["conv", RANGE]).select(
        "conv_id", F.floor((F.col("before") + F.col("place")) / block_turns).cast("bigint").alias("block"), *order, "text")


def format_chats(turns: DataFrame, costs: Costs = Costs(), conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per given turn: conv_id, block, place, turn, role, new_role, action, inserted, cost, fragment.

    Turns are ordered by turn (null first), then role, then text; block and
    place give that order. Blocks hold `block_turns` rows by position, so any
    number of null or equal turns is split. A text may have any length. Roles are read without case and surrounding space,
    with some aliases; a null or unknown role takes whichever fits. A null
    text is empty. Rows of a null conv_id form one conversation. Repeated rows
    are turns like any others (they merge). Empty turns after the last one
    are in its fragment, and its cost. Other columns are ignored.
    """
    ship_package(turns.sparkSession)
    rows = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                        F.col(role_col).cast("string").alias("role"), F.col(text_col).alias("text"))
    kind, when = (rows.schema[c].dataType.simpleString() for c in ("conv_id", "turn"))
    # the order within a block needs the texts' order only, so a hash of the text stands in for it
    rows = _in_blocks(rows.withColumn("tie", F.coalesce(F.xxhash64("text"), F.lit(0))), costs.block_turns)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = [(*key, [c for line in matrix([role_number(r[1]) for r in held], costs) for c in line])
               for key, held in _runs(batches, 2)]
        if out:
            conv, number, cells = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(conv), pa.array(number, pa.int64()), pa.array(cells)],
                                             ["conv_id", "block", "cells"])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for (conv,), held in _runs(batches, 1):
            found = joints([[list(r[1][4 * s:4 * s + 4]) for s in range(4)] for r in held], costs)
            out += [(conv, r[0], a, b, i + 1 == len(held)) for i, (r, (a, b)) in enumerate(zip(held, found, strict=True))]
        if out:
            columns = zip(*out, strict=True)
            kinds = [None, pa.int64(), pa.int32(), pa.int32(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                             ["conv_id", "block", "entry", "exit", "final"])

    def rendered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for (conv, number), held in _runs(batches, 2):
            entry, end, final = held[0][5:8]
            fixed = repair([role_number(r[1]) for r in held], entry, end, costs)
            state = entry
            for place, (r, turn) in enumerate(zip(held, fixed, strict=True)):
                last = final and place + 1 == len(held)
                cost = turn[1] + (_endings(costs)[turn[0]] if last else 0)
                out.append((conv, number, place, r[0], r[1], ROLES[turn[0] - 1], turn[2],
                            [ROLES[e - 1] for e in turn[3]], cost, fragment(state, turn, r[4], last)))
                state = turn[0]
            if len(out) >= 5000:
                yield table(out)
                out = []
        if out:
            yield table(out)

    names = ["conv_id", "block", "place", "turn", "role", "new_role", "action", "inserted", "cost", "fragment"]

    def table(out: list[tuple]) -> pa.RecordBatch:
        kinds = [None, pa.int64(), pa.int64(), None, pa.string(), pa.string(), pa.string(), pa.list_(pa.string()),
                 pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    short = _sorted_by(rows.drop("text"), ["conv_id", "block"], ["turn", "role", "tie", "nth"])
    matrices = short.mapInArrow(summed, f"conv_id {kind}, block bigint, cells array<bigint>")
    ends = written(_sorted_by(matrices, ["conv_id"], ["block"]).mapInArrow(
        joined, f"conv_id {kind}, block bigint, entry int, exit int, final boolean"), "ends")
    known = rows.join(ends.withColumnsRenamed({"conv_id": "c", "block": "b"}),
                      F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b"))).drop("c", "b")
    known = known.select("conv_id", "block", "turn", "role", "tie", "nth", "text", "entry", "exit", "final")
    return _sorted_by(known, ["conv_id", "block"], ["turn", "role", "tie", "nth"]).mapInArrow(
        rendered, f"conv_id {kind}, block bigint, place bigint, turn {when}, role string, new_role string, "
                  "action string, inserted array<string>, cost bigint, fragment string")


def whole_chats(fragments: DataFrame) -> DataFrame:
    """(conv_id, rendered): each conversation's fragments as one text, for conversations that fit in one row."""
    parts = F.array_sort(F.collect_list(F.struct("block", "place", "fragment")))
    return fragments.groupBy("conv_id").agg(F.array_join(F.transform(parts, lambda p: p["fragment"]), "").alias("rendered"))
