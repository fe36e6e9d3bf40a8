"""Chat formatting with minimum-cost role repair.

A legal conversation is an optional system turn, then user and assistant in
turn, and it ends with the assistant. Dynamic programming over that automaton
(nothing yet, system, user, assistant) reads the given turns in order. Each
turn keeps its role or is relabelled, and either merges into the open turn of
that role or follows it, empty turns being inserted where the automaton needs
them; empty turns may also close the conversation. The repair of least total
cost is rendered. No given text is dropped.

The automaton has four states, so a stretch of turns is a 4 x 4 table of least
costs, and tables of neighbouring stretches combine by (min, +). Turns are
sorted over ranges of (conv_id, turn, ...) and cut into segments of at most
`SEGMENT` turns; for conversations of several segments the tables alone pick
the states at the seams, and then every segment is repaired and rendered on its
own. So a conversation may be as long as the table: no task holds more than a
segment's texts, or one small table per segment.

A row of the result is a part of a conversation; its parts' `rendered` strings
in order are the conversation. One of at most `SEGMENT` turns has one part.

Defined cases: turns are ordered by turn (null last), role, text; a null
conv_id is one conversation; a null or unknown role must be relabelled; a null
text is empty; `<|` inside a text is written `< |`, so no text can end a turn.
Ties take the least state, then merging, then following.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, shuffle_partitions

#: Costs of a repair: a wrong role is taken to be rarer than a missing turn.
MERGE, RELABEL, INSERT = 2, 6, 3
#: Turns in a segment at most.
SEGMENT = 256
ROLES = ("", "system", "user", "assistant")  # by state; 0: nothing yet
NEXT = {0: (1, 2), 1: (2,), 2: (3,), 3: (2,)}
FAR = 1 << 40
TURN_SEP = "\n\n"


def _bridge(state: int, role: int) -> tuple[int, ...] | None:
    """The fewest empty turns that let `role` follow `state`."""
    ways = [()] if role in NEXT[state] else [(mid,) for mid in NEXT[state] if role in NEXT[mid]]
    ways += [(a, b) for a in NEXT[state] for b in NEXT[a] if role in NEXT[b]]
    return ways[0] if ways else None


BRIDGE = {(s, r): _bridge(s, r) for s in range(4) for r in (1, 2, 3)}
#: Empty turns that close a conversation after each state.
CLOSING = {0: (), 1: (2, 3), 2: (3,), 3: ()}


def _steps() -> dict[int, list[tuple[int, int, int, bool]]]:
    """By given role (0: unknown): (from state, to state, cost, merges)."""
    out: dict[int, list] = {}
    for given in range(4):
        out[given] = []
        for state in range(4):
            for role in (1, 2, 3):
                label = 0 if role == given else RELABEL
                if state == role:
                    out[given].append((state, role, label + MERGE, True))
                if BRIDGE[state, role] is not None:
                    out[given].append((state, role, label + INSERT * len(BRIDGE[state, role]), False))
    return out


STEPS = _steps()


def role_numbers(roles: list[str | None]) -> list[int]:
    return [ROLES.index(r) if r in ROLES[1:] else 0 for r in roles]


def costs(given: list[int]) -> list[int]:
    """Row-major 4 x 4 table: least cost from one state to another over the turns."""
    table = [0 if a == b else FAR for a in range(4) for b in range(4)]
    for g in given:
        new = [FAR] * 16
        for s, t, c, _ in STEPS[g]:
            for a in range(0, 16, 4):
                if table[a + s] + c < new[a + t]:
                    new[a + t] = table[a + s] + c
        table = new
    return table


def repair(given: list[int], start: int, end: int | None) -> tuple[int, list[tuple[int, bool, tuple[int, ...]]], int]:
    """(cost, per turn (role, merges, empty turns before it), end state) of the
    cheapest way from `start` to `end`, or to the end state that closes cheapest."""
    best, back = [0 if s == start else FAR for s in range(4)], []
    for g in given:
        new, came = [FAR] * 4, [None] * 4
        for s, t, c, merges in STEPS[g]:
            if best[s] + c < new[t]:
                new[t], came[t] = best[s] + c, (s, merges)
        best = new
        back.append(came)
    if end is None:
        end = min(range(4), key=lambda s: best[s] + INSERT * len(CLOSING[s]))
    path, state = [], end
    for came in reversed(back):
        s, merges = came[state]
        path.append((state, merges, () if merges else BRIDGE[s, state]))
        state = s
    return best[end], path[::-1], end


def header(role: int) -> str:
    return f"<|{ROLES[role]}|>\n"


FOOTER = "<|end|>\n"


def render(texts: list[str | None], given: list[int], start: int, end: int | None, last: bool
           ) -> tuple[int, list[str], list[str], str]:
    """(cost, roles, actions, rendered) of a stretch that begins in state `start`."""
    cost, path, stop = repair(given, start, end)
    out, actions, open_turn = [], [], start != 0
    for (role, merges, empty), text, g in zip(path, texts, given):
        for e in empty:
            out.append((FOOTER if open_turn else "") + header(e))
            open_turn = True
        if merges:
            out.append(TURN_SEP)
        else:
            out.append((FOOTER if open_turn else "") + header(role))
            open_turn = True
        out.append((text or "").replace("<|", "< |"))
        actions.append("+".join([f"insert:{ROLES[e]}" for e in empty] + (["relabel"] if g != role else [])
                                + (["merge"] if merges else [])) or "keep")
    if last:
        for e in CLOSING[stop]:
            out.append((FOOTER if open_turn else "") + header(e))
            open_turn = True
            actions.append(f"insert:{ROLES[e]}")
        cost += INSERT * len(CLOSING[stop])
        out.append(FOOTER if open_turn else "")
    return cost, [ROLES[r] for r, _, _ in path], actions, "".join(out)


def _segments(size: int):
    """Sorted turns to rows (seg, conv_id, roles, texts, costs); segment numbers rise with the order."""
    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n = TaskContext.get().partitionId() << 32, 0
        conv, roles, texts, done, held = None, [], [], [], 0

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in done], pa.int64()), pa.array([r[1] for r in done], pa.int64()),
                 pa.array([r[2] for r in done], pa.list_(pa.int32())), pa.array([r[3] for r in done], pa.list_(pa.string())),
                 pa.array([costs(r[2]) for r in done], pa.list_(pa.int64()))],
                ["seg", "conv_id", "given", "texts", "costs"])

        for batch in batches:
            c, r, t = (batch.column(k).to_pylist() for k in range(3))
            for conv_id, role, text in zip(c, role_numbers(r), t):
                if roles and (conv_id != conv or len(roles) >= size):
                    done.append((task + n, conv, roles, texts))
                    n, roles, texts = n + 1, [], []
                    if held > 8 << 20:
                        yield rows()
                        done, held = [], 0
                conv = conv_id
                roles.append(role)
                texts.append(text)
                held += len(text or "")
        if roles:
            done.append((task + n, conv, roles, texts))
        if done:
            yield rows()
    return segments


def _seams(pdf: pd.DataFrame) -> pd.DataFrame:
    """States at the seams of one conversation of several segments."""
    pdf = pdf.sort_values("seg")
    tables = [np.array(x).reshape(4, 4) for x in pdf["costs"]]
    best, back = np.array([0, FAR, FAR, FAR]), []
    for t in tables:
        ways = best[:, None] + t
        back.append(ways.argmin(axis=0))
        best = ways.min(axis=0)
    closing = [INSERT * len(CLOSING[s]) for s in range(4)]
    state, ends = int((best + closing).argmin()), []
    for came in reversed(back):
        ends.append(state)
        state = int(came[state])
    ends = ends[::-1]
    return pd.DataFrame({"seg": pdf["seg"], "part": range(len(ends)), "start_state": [0, *ends[:-1]],
                         "end_state": ends, "last": [False] * (len(ends) - 1) + [True]})


RESULT = ("conv_id long, part long, n_turns long, cost long, roles array<string>, actions array<string>, rendered string")


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", segment: int = SEGMENT) -> DataFrame:
    """A row per conversation part: conv_id, part (from 0), n_turns, cost, roles
    (of the given turns after repair), actions and the rendered text."""
    rows = turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                        F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    keys = [F.col("conv_id"), F.col("turn").asc_nulls_last(), F.col("role"), F.col("text")]
    segs = cut(rows.repartitionByRange(shuffle_partitions(turns.sparkSession), *keys).sortWithinPartitions(*keys)
               .select("conv_id", "role", "text")
               .mapInArrow(_segments(segment), "seg long, conv_id long, given array<int>, texts array<string>, costs array<long>"))
    several = (segs.groupBy(F.col("conv_id").alias("c")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("given")).alias("turns"))
               .filter("n > 1"))
    same = F.col("conv_id").eqNullSafe(F.col("c"))
    # a conversation that the ranges cut by chance, and that fits, is one segment again
    short = several.filter(F.col("turns") <= segment)
    whole = (segs.join(short, same, "left_semi").groupBy("conv_id")
             .agg(F.sort_array(F.collect_list(F.struct("seg", "given", "texts"))).alias("s"))
             .select(F.col("s")[0]["seg"].alias("seg"), "conv_id", F.flatten("s.given").alias("given"),
                     F.flatten("s.texts").alias("texts"), F.lit(None).cast("array<long>").alias("costs")))
    seams = (segs.select("seg", "conv_id", "costs")
             .join(several.filter(F.col("turns") > segment), same, "left_semi")
             .groupBy("conv_id").applyInPandas(_seams, "seg long, part long, start_state int, end_state int, last boolean"))

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                alone = r["part"] is None
                cost, roles, actions, text = render(r["texts"], r["given"], 0 if alone else r["start_state"],
                                                    None if alone else r["end_state"], alone or r["last"])
                out.append((r["conv_id"], 0 if alone else r["part"], len(roles), cost, roles, actions, text))
            if out:
                cols = list(zip(*out))
                kinds = [pa.int64()] * 4 + [pa.list_(pa.string())] * 2 + [pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                                 ["conv_id", "part", "n_turns", "cost", "roles", "actions", "rendered"])

    every = segs.join(short, same, "left_anti").unionByName(whole)
    return (every.join(seams, "seg", "left").select("conv_id", "given", "texts", "part", "start_state", "end_state", "last")
            .mapInArrow(parts, RESULT))
