"""Operator 6: chat formatting with minimum-cost role repair.

A legal conversation is an optional system turn, then user and assistant in turn, and ends with the assistant. For each given turn
the repair may keep it as a turn, give it another role, merge it into the turn before, or put an empty turn before
it; dynamic programming finds the cheapest way. A turn's choices are a 4 x 4 matrix of costs between states of the
automaton, and matrices of consecutive turns combine (min, +), so that a long conversation is repaired in
segments: first their matrices, then the states at their borders, then each one's turns.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, partitions, read, slices

ROLES = ("system", "user", "assistant")
#: States: nothing yet, or the role of the last turn.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
#: Costs: merging, another role (UNKNOWN where the given one is none of ROLES), an empty turn.
MERGE, RELABEL, UNKNOWN, INSERT = 2, 3, 1, 4
#: Turns of a segment, and bytes of their texts (or one turn), at most.
SEGMENT, BYTES = 1024, 1 << 20
FAR = 1 << 40


def choices(role: str | None) -> list[tuple[int, int, int, str, int | None]]:
    """(from, to, cost, action, state of an inserted empty turn): a given turn's edges, in the order that breaks ties."""
    out = []
    for state in range(4):
        for to in (SYSTEM, USER, ASSISTANT):
            own = 0 if role == ROLES[to - 1] else UNKNOWN if role not in ROLES else RELABEL
            act = "keep" if own == 0 else "relabel"
            if to in NEXT[state]:
                out.append((state, to, own, act, None))
            elif state == to:
                out.append((state, to, MERGE + own, "merge" if own == 0 else "merge relabel", None))
                continue
            for mid in NEXT[state]:
                if to in NEXT[mid]:
                    out.append((state, to, INSERT + own, act, mid))
        if state in (USER, ASSISTANT):  # the same role again, with the other's empty turn between
            own = 0 if role == ROLES[state - 1] else UNKNOWN if role not in ROLES else RELABEL
            out.append((state, state, INSERT + own, "keep" if own == 0 else "relabel", USER + ASSISTANT - state))
    return out


_EDGES = {r: choices(r) for r in (*ROLES, None)}
#: Cost of ending in a state: a conversation that doesn't end with the assistant gets an empty turn.
END = {START: 0, SYSTEM: 2 * INSERT, USER: INSERT, ASSISTANT: 0}


def _edges(role: str | None) -> list[tuple[int, int, int, str, int | None]]:
    return _EDGES.get(role, _EDGES[None])


def segment_costs(roles: list[str | None]) -> list[int]:
    """The 16 cheapest costs from each state to each."""
    m = [[0 if i == j else FAR for j in range(4)] for i in range(4)]
    for role in roles:
        new = [[FAR] * 4 for _ in range(4)]
        for a, b, c, _, _ in _edges(role):
            for i in range(4):
                new[i][b] = min(new[i][b], m[i][a] + c)
        m = new
    return [x for row in m for x in row]


def borders(matrices: list[list[int]]) -> list[tuple[int, int]]:
    """(state before, state after) of each segment on a cheapest way through all (ties: the smallest states from the end)."""
    cost = [[0, FAR, FAR, FAR]]
    for m in matrices:
        cost.append([min(cost[-1][i] + m[4 * i + j] for i in range(4)) for j in range(4)])
    state = min(range(4), key=lambda s: (cost[-1][s] + END[s], s))
    out = []
    for k in range(len(matrices) - 1, -1, -1):
        before = next(i for i in range(4) if cost[k][i] + matrices[k][4 * i + state] == cost[k + 1][state])
        out.append((before, state))
        state = before
    return out[::-1]


def repair(roles: list[str | None], first: int = START, last: int | None = None) -> list[tuple[int, str, int | None]]:
    """(state, action, state of an empty turn put before) of each turn on a cheapest way from first to last (None: any, its end cost counted)."""
    cost = [[0 if s == first else FAR for s in range(4)]]
    how: list[list] = []
    for role in roles:
        best, by = [FAR] * 4, [None] * 4
        for e in _edges(role):
            if cost[-1][e[0]] + e[2] < best[e[1]]:
                best[e[1]], by[e[1]] = cost[-1][e[0]] + e[2], e
        cost.append(best)
        how.append(by)
    state = min(range(4), key=lambda s: (cost[-1][s] + END[s], s)) if last is None else last
    out = []
    for by in reversed(how):
        e = by[state]
        out.append((state, e[3], e[4]))
        state = e[0]
    return out[::-1]


def total_cost(roles: list[str | None]) -> int:
    m = segment_costs(roles)
    return min(m[s] + END[s] for s in range(4)) if roles else 0


def opened(state: int) -> str:
    return f"<|im_start|>{ROLES[state - 1]}\n"


CLOSED = "<|im_end|>\n"


def render(roles: list[str | None], texts: list[str | None], first: int, last: int, ends: bool) -> list[tuple]:
    """Per turn: new role, action, role of the empty turn before, and its part of the rendered conversation."""
    out, before = [], first
    for i, (state, action, empty) in enumerate(repair(roles, first, last)):
        body = (texts[i] or "").replace("<|", "< |")
        if action.startswith("merge"):
            part = "\n" + body
        else:
            part = (CLOSED if before != START else "") + (opened(empty) + CLOSED if empty else "") + opened(state) + body
        if ends and i == len(roles) - 1:
            part += CLOSED
            for s in {SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,)}.get(state, ()):
                part += opened(s) + CLOSED
        out.append((ROLES[state - 1], action, ROLES[empty - 1] if empty else None, part))
        before = state
    return out


def format_chats(turns: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """turns (conv_id, turn long, role, text, ...): (conv_id, turn, role, new_role, action, inserted, rendered), one row for each row of turns.

    The parts of a conversation joined in the order of turn (nulls last), role (nulls first), then xxhash64 of the text, are the rendered
    conversation. Rows are sorted by range, so that a conversation of any length, and turns that repeat, go over many tasks, and cut there into segments.
    Only the segments' matrices of a conversation meet, 128 bytes for SEGMENT turns. Defined cases: a null
    or unknown role takes any role at a low cost; a null text is empty; null conv_ids
    are one conversation; markers in texts are broken up ("<|" to "< |"); other columns are not read.
    """
    spark = turns.sparkSession
    kind = turns.schema["conv_id"].dataType.simpleString()
    d = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    by = ["conv_id", F.col("turn").isNull(), "turn", "role", F.xxhash64("text"), "_row"]
    ordered = d.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(partitions(spark), *by).sortWithinPartitions(*by).drop("_row")
    item = pa.list_(pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, n = TaskContext.get().partitionId() << 32, 0
        conv, own, size = None, [], 0
        ready: list[tuple] = []

        def flush(conv_type: pa.DataType) -> pa.RecordBatch:
            cols = list(zip(*ready, strict=True))
            ready.clear()
            return pa.record_batch([pa.array(c, t) for c, t in zip(cols, (conv_type, pa.int64(), item, pa.list_(pa.int64())), strict=True)], names=["conv_id", "seg", "items", "m"])

        held, conv_type = 0, None
        for b in slices(batches):
            conv_type = b["conv_id"].type
            for c, turn, role, text in zip(*(b[x].to_pylist() for x in ("conv_id", "turn", "role", "text")), strict=True):
                if own and (c != conv or len(own) >= segment or size >= BYTES):
                    ready.append((conv, at + n, own, segment_costs([x["role"] for x in own])))
                    held, n, own, size = held + size, n + 1, [], 0
                    if held >= BYTES or len(ready) >= 4096:
                        yield flush(conv_type)
                        held = 0
                conv = c
                own.append({"turn": turn, "role": role, "text": text})
                size += len(text or "")
        if own:
            ready.append((conv, at + n, own, segment_costs([x["role"] for x in own])))
        if ready:
            yield flush(conv_type)

    grouped = materialize(ordered.mapInArrow(cut, f"conv_id {kind}, seg long, items array<struct<turn:long,role:string,text:string>>, m array<long>"), "segments")

    def states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(x["seg"], *s, x is all_[-1]) for all_ in b["all"].to_pylist() for x, s in zip(all_, borders([y["m"] for y in all_]), strict=True)]
            cols = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int32(), pa.bool_()), strict=True)], names=["seg", "first", "last", "ends"])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "turn", "role", "new_role", "action", "inserted", "rendered"]
        for whole in batches:
            for k in range(0, whole.num_rows, 16):
                b, rows = whole.slice(k, 16), []
                for i, items, first, last, ends in zip(*(b[c].to_pylist() for c in ("conv_id", "items", "first", "last", "ends")), strict=True):
                    done = render([x["role"] for x in items], [x["text"] for x in items], first, last, ends)
                    rows += [(i, x["turn"], x["role"], *d) for x, d in zip(items, done, strict=True)]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (b["conv_id"].type, pa.int64(), *[pa.string()] * 5), strict=True)], names=names)

    per = grouped.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("seg", "m"))).alias("all"))
    ways = materialize(per.mapInArrow(states, "seg long, first int, last int, ends boolean"), "ways")
    j = grouped.select("conv_id", "seg", "items").join(ways, "seg").select("conv_id", "items", "first", "last", "ends")
    return j.mapInArrow(decode, f"conv_id {kind}, turn long, role string, new_role string, action string, inserted string, rendered string")


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(read(spark, sf_dir, "conversations"))
