"""Minimum-cost repair of the roles of a conversation, and its rendering.

Legal are: an optional system turn, then user and assistant in turn, ending with the assistant. Each turn may keep its
role or be relabelled, be merged into the turn before it, or get empty turns inserted before it; the cheapest sequence
of choices is a shortest path over (turn, role so far). Costs: RELABEL, UNKNOWN (a role that is none of the three), MERGE,
INSERT. Among equal costs the earlier choice in the order keep, merge, insert, then system, user, assistant stands.

A conversation of any length is repaired: rows are range partitioned, each partition's stretch of a conversation gives
a 4 x 4 matrix of least costs between roles, the matrices of a conversation are chained, and each stretch is then
repaired between the two roles that the chain chose. One row per turn is returned with its piece of the rendering;
the pieces of a conversation, in order, are its text. Turns are ordered by turn, role and text, nulls first.

Null roles are unknown ones, null texts are empty, rows without a conversation's id are one conversation. Repeated rows are
turns of their own. Texts are carried as they are, however long; columns besides the four play no part. An empty table gives no rows.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

ROLES = ("system", "user", "assistant")
RELABEL, UNKNOWN, MERGE, INSERT = 2, 1, 1, 3
NEVER = 1 << 40
#: States: nothing yet, then the last role.
START, SYSTEM, USER, ASSISTANT = range(4)
_LEGAL = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
OPEN, CLOSE = "<|{role}|>\n", "<|end|>\n"


@lru_cache(maxsize=None)
def bridge(before: int, to: int) -> tuple[int, ...] | None:
    """Fewest roles to insert so that `to` may follow; to 0: so that the conversation may end."""
    paths: list[tuple[int, tuple[int, ...]]] = [(before, ())]
    for state, path in paths:
        if (state == ASSISTANT) if to == START else (to in _LEGAL[state]):
            return path
        if len(path) < 3:
            paths += [(n, (*path, n)) for n in _LEGAL[state]]
    return None


@lru_cache(maxsize=None)
def steps(role: str | None) -> tuple[tuple[int, int, int, str], ...]:
    """(state before, state after, cost, action) of every way to take a turn."""
    own = ROLES.index(role) + 1 if role in ROLES else 0
    out = []
    for before in range(4):
        for to in (SYSTEM, USER, ASSISTANT):
            label = 0 if to == own else RELABEL if own else UNKNOWN
            ways = [(label, "keep")] if to in _LEGAL[before] else []
            if before == to:
                ways.append((label + MERGE, "merge"))
            path = bridge(before, to)
            if path:
                ways.append((label + INSERT * len(path), "insert"))
            if ways:
                cost, action = min(ways, key=lambda w: w[0])
                out.append((before, to, cost, action))
    return tuple(out)


def matrix(roles: list) -> list[int]:
    """Least cost from each state to each state over the turns, row by row."""
    table = np.full((4, 4), NEVER, np.int64)
    np.fill_diagonal(table, 0)
    for role in roles:
        new = np.full((4, 4), NEVER, np.int64)
        for before, to, cost, _ in steps(role):
            np.minimum(new[:, to], table[:, before] + cost, out=new[:, to])
        table = new
    return np.minimum(table, NEVER).ravel().tolist()


def chain(stretches: list[tuple[int, list[int]]]) -> list[tuple[int, int, int, bool, int]]:
    """(stretch, state at its start, state at its end, last, total cost) for a conversation's stretches."""
    stretches = sorted(stretches)
    costs, back = [NEVER] * 4, []
    costs[START] = 0
    for _, m in stretches:
        new, via = [NEVER] * 4, [START] * 4
        for a in range(4):
            for b in range(4):
                if costs[a] + m[4 * a + b] < new[b]:
                    new[b], via[b] = costs[a] + m[4 * a + b], a
        costs = new
        back.append(via)
    ends = [c + INSERT * len(bridge(s, START)) if c < NEVER else NEVER for s, c in enumerate(costs)]
    state = min(range(4), key=ends.__getitem__)
    total, out = ends[state], []
    for i in range(len(stretches) - 1, -1, -1):
        before = back[i][state]
        out.append((stretches[i][0], before, state, i == len(stretches) - 1, total))
        state = before
    return out[::-1]


def repair(roles: list, begin: int, end: int) -> list[tuple[int, str, tuple[int, ...]]]:
    """(role given, action, roles inserted before) for each turn, from state begin to state end at least cost."""
    costs, back = [NEVER] * 4, []
    costs[begin] = 0
    for role in roles:
        new, via = [NEVER] * 4, [(START, "keep")] * 4
        for before, to, cost, action in steps(role):
            if costs[before] + cost < new[to]:
                new[to], via[to] = costs[before] + cost, (before, action)
        costs = new
        back.append(via)
    out, state = [], end
    for via in reversed(back):
        before, action = via[state]
        out.append((state, action, bridge(before, state) if action == "insert" else ()))
        state = before
    return out[::-1]


def render(texts: list, plan: list[tuple[int, str, tuple[int, ...]]], begin: int, end: int, last: bool) -> list[str]:
    """Each turn's piece of the text. A turn's closing mark is written when the next one opens, or at the end."""
    head = lambda role: OPEN.format(role=ROLES[role - 1])
    pieces, fresh = [], begin == START
    for text, (role, action, inserted) in zip(texts, plan):
        if action == "merge":
            pieces.append("\n" + (text or ""))
        else:
            pieces.append("".join(("" if fresh and i == 0 else CLOSE) + head(r) for i, r in enumerate((*inserted, role))) + (text or ""))
        fresh = False
    if last and pieces:
        pieces[-1] += CLOSE + "".join(head(r) + CLOSE for r in bridge(end, START))
    return pieces


def repaired(df: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per turn: key, turn, stretch, place (order), role, new_role, action, inserted, total_cost, piece."""
    cols = df.select(F.col(key).alias("key"), F.col(turn).alias("turn"), F.lower(F.trim(role)).alias("role"), F.col(text).alias("text"))
    names = ["key", "turn", "role", "text"]
    spread = cols.withColumn("tie", F.monotonically_increasing_id())
    sorted_rows = spread.repartitionByRange(*names, "tie").sortWithinPartitions(*names, "tie")
    placed = stored(sorted_rows.select(*names, F.spark_partition_id().alias("stretch"), F.monotonically_increasing_id().alias("place")), "turns")
    turns = F.array_sort(F.collect_list(F.struct("place", "turn", "role", "text")))
    stretches = stored(placed.groupBy("key", "stretch").agg(turns.alias("turns")), "stretches")

    @F.udf("array<bigint>", useArrow=True)
    def costs(roles):
        return matrix(list(roles))

    @F.udf("array<struct<stretch:int,begin:int,end:int,last:boolean,total:bigint>>", useArrow=True)
    def chained(found):
        return [dict(zip(("stretch", "begin", "end", "last", "total"), c)) for c in chain([(f["stretch"], list(f["costs"])) for f in found])]

    ways = stretches.select("key", F.struct("stretch", costs(F.transform("turns", lambda t: t["role"])).alias("costs")).alias("s")).groupBy("key").agg(F.collect_list("s").alias("found"))
    chosen = ways.select(F.col("key").alias("_key"), F.inline(chained("found"))).withColumnRenamed("stretch", "_stretch")
    same = F.col("key").eqNullSafe(F.col("_key")) & (F.col("stretch") == F.col("_stretch"))
    ready = stretches.join(chosen, same).select("key", "stretch", "turns", "begin", "end", "last", "total")

    kind = df.schema[key].dataType.simpleString()
    turn_kind = df.schema[turn].dataType.simpleString()
    schema = f"{key} {kind}, {turn} {turn_kind}, stretch int, place long, role string, new_role string, action string, inserted int, total_cost long, piece string"

    def run(batches):
        for b in batches:
            out = []
            for r in b.to_pylist():
                roles, texts = [t["role"] for t in r["turns"]], [t["text"] for t in r["turns"]]
                plan = repair(roles, r["begin"], r["end"])
                for t, (new, action, inserted), piece in zip(r["turns"], plan, render(texts, plan, r["begin"], r["end"], r["last"])):
                    what = action if new and ROLES[new - 1] == t["role"] else f"{action}+relabel"
                    out.append((r["key"], t["turn"], r["stretch"], t["place"], t["role"], ROLES[new - 1], what, len(inserted), r["total"], piece))
            kinds = (b.schema.field("key").type, b.schema.field("turns").type.value_type.field("turn").type, pa.int32(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*out)) or [()] * 10, kinds)], names=[f.strip().rsplit(" ", 1)[0] for f in schema.split(",")])

    return ready.mapInArrow(run, schema)
