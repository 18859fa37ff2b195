"""Chat formatting with a minimum-cost repair of roles.

A legal conversation is an optional system turn and then user and assistant turns
in alternation, closed by the assistant. A turn is kept, relabelled, merged into
the turn before it, or preceded by an inserted empty turn; dynamic programming
over the automaton's states finds the cheapest repair.

Turns are range-partitioned by conversation and order, so one conversation may lie
in any number of parts. A part's piece of a conversation is a min-plus matrix from
entry to exit states; only the first and the last piece of a part can continue
elsewhere. These border pieces are multiplied in runs of FAN parts, and the
products again, until a conversation has at most FAN of them; the states chosen
there are handed down the same way. Each part then traces its own repair.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histoweave.llm.common import cut

START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {"system": SYSTEM, "user": USER, "assistant": ASSISTANT}
NAMES = {v: k for k, v in ROLES.items()}
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
#: Costs of a repair; relabelling and merging add up.
RELABEL, MERGE, INSERT = 2, 1, 2
#: Inserted roles that close a conversation in a state, and what that costs.
CLOSING = {START: (), SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}
#: What begins a mark, and what stands for it inside a text.
ESCAPE = ("<|", "<\\|")
#: Rows of a part, and bytes of text; a part is dealt with as one group of rows.
PART_ROWS, PART_BYTES = 50_000, 64 << 20
#: Pieces of one conversation that are joined in one task.
FAN = 1_000
_FAR = 10**15


def moves(role: int | None) -> list[tuple[int, int, int, str, tuple[int, ...]]]:
    """(from, to, cost, action, inserted) of a turn, in the order in which ties are broken; null is an unknown role."""
    out = []
    for p in range(4):
        for q in NEXT[p]:
            out.append((p, q, 0 if q == role else RELABEL, "keep" if q == role else "relabel", ()))
        if p != START:
            out.append((p, p, MERGE + (0 if p == role else RELABEL), "merge", ()))
        for x in NEXT[p]:
            for q in NEXT[x]:
                out.append((p, q, INSERT + (0 if q == role else RELABEL), "insert", (x,)))
    return sorted(out, key=lambda m: ("keep", "merge", "relabel", "insert").index(m[3]))


MOVES = {r: moves(r) for r in (None, SYSTEM, USER, ASSISTANT)}


def role_of(name: str | None) -> int | None:
    return ROLES.get((name or "").strip().lower())


def _forward(roles: list[int | None], cost: list[int]) -> tuple[list[int], list[list[tuple | None]]]:
    back = []
    for r in roles:
        new, how = [_FAR] * 4, [None] * 4
        for m in MOVES[r]:
            c = cost[m[0]] + m[2]
            if c < new[m[1]]:
                new[m[1]], how[m[1]] = c, m
        cost = new
        back.append(how)
    return cost, back


def matrix(roles: list[int | None]) -> list[list[int]]:
    """Least cost from each state before the turns to each state after them."""
    return [_forward(roles, [0 if s == p else _FAR for s in range(4)])[0] for p in range(4)]


def best_end(cost: list[int]) -> int:
    return min(range(4), key=lambda s: (cost[s] + INSERT * len(CLOSING[s]), s))


def trace(roles: list[int | None], entry: int = START, leave: int | None = None) -> list[tuple]:
    """The moves of the cheapest repair from state `entry` to `leave`, or to a closed conversation."""
    cost, back = _forward(roles, [0 if s == entry else _FAR for s in range(4)])
    state = best_end(cost) if leave is None else leave
    out = []
    for how in reversed(back):
        out.append(how[state])
        state = how[state][0]
    return out[::-1]


def render(text: str | None, move: tuple, last: bool, mark: str = "<|{}|>\n", end: str = "<|end|>\n") -> str:
    """What a turn adds to the formatted conversation. A turn is closed by the next one that isn't merged, or by the last row.

    The start of a mark inside a text is escaped, so no text can end its turn or
    begin another one.
    """
    p, q, _, action, inserted = move
    text = (text or "").replace(*ESCAPE)
    out = "\n" if action == "merge" else (end if p != START else "") + "".join(mark.format(NAMES[x]) + end for x in inserted) + mark.format(NAMES[q])
    out += text
    if last:
        out += end + "".join(mark.format(NAMES[x]) + end for x in CLOSING[q])
    return out


def _pieces(pdf: pd.DataFrame) -> Iterator[tuple[int, pd.DataFrame]]:
    pdf = pdf.sort_values("pos")
    name = pdf["conv"].to_numpy()
    cuts = [0, *(np.flatnonzero(name[1:] != name[:-1]) + 1).tolist(), len(pdf)]
    for lo, hi in zip(cuts, cuts[1:]):
        yield name[lo], pdf.iloc[lo:hi]


def _borders(pdf: pd.DataFrame) -> pd.DataFrame:
    pieces = list(_pieces(pdf))
    ends = pieces[:1] if len(pieces) == 1 else [pieces[0], pieces[-1]]
    rows = [(pdf["part"].iloc[0], c, [x for row in matrix([role_of(r) for r in p["role"]]) for x in row]) for c, p in ends]
    return pd.DataFrame(rows, columns=["part", "conv", "cost"])


def product(a: list[int], b: list[int]) -> list[int]:
    """Of two min-plus matrices, row by row."""
    return [min(_FAR, *(a[4 * p + x] + b[4 * x + q] for x in range(4))) for p in range(4) for q in range(4)]


def walk(matrices: list[list[int]], entry: int = START, leave: int | None = None) -> list[tuple[int, int]]:
    """Entry and exit state of each piece on the cheapest way through all of them, to `leave` or to a closed conversation."""
    cost, back = [0 if s == entry else _FAR for s in range(4)], []
    for m in matrices:
        new = [min((cost[p] + m[4 * p + q], p) for p in range(4)) for q in range(4)]
        cost = [c for c, _ in new]
        back.append([p for _, p in new])
    state, out = best_end(cost) if leave is None else leave, []
    for how in reversed(back):
        out.append((how[state], state))
        state = how[state]
    return out[::-1]


BORDER = "part long, conv string, cost array<long>"
STATES = "part long, conv string, entry int, leave int, ends boolean"


def _multiplied(fan: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("part")
        return pd.DataFrame({"part": [pdf["part"].iloc[0] // fan], "conv": [pdf["conv"].iloc[0]], "cost": [functools.reduce(product, map(list, pdf["cost"]))]})

    return run


def _walked(pdf: pd.DataFrame) -> pd.DataFrame:
    """States of some pieces in a row, from the state that their product enters to the one that it leaves."""
    pdf = pdf.sort_values("part")
    ends, leave = bool(pdf["up_ends"].iloc[0]), int(pdf["up_leave"].iloc[0])
    states = walk([list(c) for c in pdf["cost"]], int(pdf["up_entry"].iloc[0]), None if leave < 0 else leave)
    last = [False] * (len(pdf) - 1) + [ends]
    return pd.DataFrame({"part": pdf["part"].to_numpy(), "conv": pdf["conv"].to_numpy(), "entry": [a for a, _ in states], "leave": [b for _, b in states], "ends": last})


def resolve(borders: DataFrame, fan: int = FAN) -> DataFrame:
    """(part, conv, entry, leave, ends) of each border piece of borders(part, conv, cost)."""
    levels = [borders]
    while (levels[-1].groupBy("conv").count().agg(F.max("count")).first()[0] or 0) > fan:
        up = levels[-1].withColumn("up", F.floor(F.col("part") / fan)).groupBy("conv", "up")
        levels.append(cut(up.applyInPandas(_multiplied(fan), BORDER)))
    top = levels.pop().select("*", F.lit(START).alias("up_entry"), F.lit(-1).alias("up_leave"), F.lit(True).alias("up_ends"))
    states = top.groupBy("conv").applyInPandas(_walked, STATES)
    while levels:
        above = states.select(F.col("part").alias("up"), "conv", F.col("entry").alias("up_entry"), F.col("leave").alias("up_leave"), F.col("ends").alias("up_ends"))
        below = levels.pop().withColumn("up", F.floor(F.col("part") / fan)).join(above, ["conv", "up"])
        states = below.groupBy("conv", "up").applyInPandas(_walked, STATES)
    return states


OUT = "part int, pos long, conv string, turn long, source_role string, role string, action string, inserted string, cost int, rendered string"


def format_chats(turns: DataFrame, part_rows: int = PART_ROWS, part_bytes: int = PART_BYTES) -> DataFrame:
    """One row per row of turns(conv_id, turn, role, text), with its repair and what it adds to the conversation.

    In order of part and pos the `rendered` of a conversation are its formatted
    text. Turns are in order of turn, nulls first, then role and text; repeated
    rows are turns of their own. Null and unknown roles have to be relabelled or
    merged; null texts are empty. Rows with a null conv_id are one conversation.
    A conv_id may be of any type that casts to a string and back. Of equally cheap
    repairs keeping goes before merging, relabelling and inserting, turn by turn
    from the end. The start of a mark in a text is escaped.
    `inserted` names the empty turns put before, and after a last turn. Other
    columns are ignored. There are so many parts that one has `part_rows` rows and
    `part_bytes` bytes of text on average; a text longer than that is still one row.
    """
    kind = turns.schema["conv_id"].dataType
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("conv", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")))
    n, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    parts = max(1, -(-n // part_rows), -(-size // part_bytes))
    keys = ["conv", "turn", "role", F.xxhash64("text"), "text", "tie"]
    rows = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    rows = cut(rows.select(F.spark_partition_id().cast("long").alias("part"), F.monotonically_increasing_id().alias("pos"), "conv", "turn", "role", "text"))
    borders = cut(rows.select("part", "pos", "conv", "role").groupBy("part").applyInPandas(_borders, BORDER))
    states = resolve(borders)

    def run(pdf: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        part, out = int(pdf["part"].iloc[0]), []
        borders = {c: (e, x, last) for c, e, x, last in zip(known["conv"], known["entry"], known["leave"], known["ends"])}
        for conv, piece in _pieces(pdf):
            entry, leave, ends = borders.get(conv, (START, None, True))
            plan = trace([role_of(r) for r in piece["role"]], entry, leave)
            for i, (row, m) in enumerate(zip(piece.itertuples(), plan)):
                last = ends and i == len(plan) - 1
                added = [NAMES[x] for x in (*m[4], *(CLOSING[m[1]] if last else ()))]
                cost = m[2] + (INSERT * len(CLOSING[m[1]]) if last else 0)
                out.append((part, row.pos, conv, row.turn, row.role, NAMES[m[1]], m[3], ",".join(added), cost, render(row.text, m, last)))
        return pd.DataFrame(out, columns=[c.split()[0] for c in OUT.split(", ")]).astype({"turn": "Int64"})

    found = rows.groupBy("part").cogroup(states.groupBy("part")).applyInPandas(run, OUT)
    named = F.when(F.col("conv") != "", F.expr("substring(conv, 2)")).cast(kind).alias("conv_id")
    return found.select(*(named if c.startswith("conv ") else c.split()[0] for c in OUT.split(", ")))
