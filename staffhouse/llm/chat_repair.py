"""Chat formatting: the cheapest repair of a conversation's roles, then its rendering.

A legal conversation is an optional system turn, then user and assistant turns in alternation, the last one
an assistant's. Every input turn is kept, relabelled or merged into the turn before it, and empty turns
may be inserted; each has a price, and dynamic programming over the automaton of legal turns finds
the least total. Costs of a stretch of turns form a small matrix (state before x state after), and such
matrices combine in any grouping, so a conversation of any length is solved in blocks:
matrices, a scan over blocks for the cost still to come, the choices of every block, a scan over the states.
Sorted ranges of rows are the parts; only the first and the last conversation of a part can go on in another.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffhouse.llm.common import stage

START, SYSTEM, USER, ASSISTANT = range(4)       # what the last output turn was
ROLES = ("system", "user", "assistant")
ALIASES = {"human": "user", "customer": "user", "bot": "assistant", "gpt": "assistant", "model": "assistant", "ai": "assistant", "developer": "system"}
RELABEL, MERGE, INSERT, FAR = 8, 2, 5, 1 << 40
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
# cost of ending in a state: an assistant's turn is missing after a user's, both after a system's
END = np.array([0, 2 * INSERT, INSERT, 0], np.int64)


def _moves() -> list[list[tuple[int, int, int, int | None, bool]]]:
    """For every input role (3: unknown or null): (state, cost, state after, inserted role, merged), cheapest order first."""
    out = []
    for role in range(4):
        found = []
        for state in range(4):
            for to in (SYSTEM, USER, ASSISTANT):
                price = 0 if role == to - 1 else RELABEL
                if to in NEXT[state]:
                    found.append((state, price, to, None, False))
                if to == state:
                    found.append((state, price + MERGE, to, None, True))
                for mid in NEXT[state]:
                    if mid != SYSTEM and to in NEXT[mid]:
                        found.append((state, price + INSERT, to, mid, False))
        out.append(sorted(found, key=lambda m: (m[0], m[1], m[4], m[3] is not None, m[2])))
    return out


MOVES = _moves()


def role_number(role) -> int:
    name = str(role).strip().lower() if isinstance(role, str) else ""
    name = ALIASES.get(name, name)
    return ROLES.index(name) if name in ROLES else 3


def transfer(roles: list[int]) -> np.ndarray:
    """Least cost from every state before the turns to every state after them."""
    m = np.where(np.eye(4, dtype=bool), 0, FAR).astype(np.int64)
    for r in roles:
        new = np.full((4, 4), FAR, np.int64)
        for state, cost, to, _, _ in MOVES[r]:
            new[:, to] = np.minimum(new[:, to], m[:, state] + cost)
        m = new
    return m


def choices(roles: list[int], rest: np.ndarray) -> tuple[list[list[tuple]], list[int]]:
    """For every turn and state the move on a cheapest path to the end, and the cost from every state before
    the first of these turns; ``rest``: cost still to come after the last. Of equally cheap moves the first in ``MOVES`` counts, whatever the blocks."""
    out, rest = [], [int(x) for x in rest]
    for r in reversed(roles):
        best: list = [None] * 4
        cost = [FAR] * 4
        for move in MOVES[r]:
            c = move[1] + rest[move[2]]
            if c < cost[move[0]]:
                cost[move[0]], best[move[0]] = c, move
        out.append(best)
        rest = cost
    return out[::-1], rest


def _piece(role: int, text: str, first: bool) -> str:
    return ("" if first else "<|im_end|>\n") + f"<|im_start|>{ROLES[role - 1]}\n{text}"


def _stretches(frame: pd.DataFrame) -> Iterator[tuple[int, bool, pd.DataFrame]]:
    """(conv_id, touches an end of the part, its rows) of one part in order."""
    frame = frame.sort_values("at", kind="stable")
    conv = frame["conv_id"].to_numpy()
    cuts = [0, *(np.flatnonzero(conv[1:] != conv[:-1]) + 1).tolist(), len(conv)]
    for low, high in zip(cuts, cuts[1:]):
        yield int(conv[low]), low == 0 or high == len(conv), frame.iloc[low:high]


def _blocks(frame: pd.DataFrame) -> pd.DataFrame:
    """Matrices of the conversations that may go on in another part: a part's first and last one."""
    part = frame["part"].iloc[0]
    return pd.DataFrame([(conv, part, transfer(x["r"].tolist()).ravel().tolist()) for conv, edge, x in _stretches(frame) if edge], columns=["conv_id", "part", "m"])


def _rest(frame: pd.DataFrame) -> pd.DataFrame:
    """Cost still to come after each block of one conversation; one row a block."""
    frame = frame.sort_values("part")
    rest, out = END, []
    for m in reversed(frame["m"].tolist()):
        out.append(rest.tolist())
        rest = (np.asarray(m).reshape(4, 4) + rest).min(axis=1)
    return pd.DataFrame({"conv_id": frame["conv_id"], "part": frame["part"], "rest": out[::-1], "cost": int(rest[START])})


def _maps(frame: pd.DataFrame) -> pd.DataFrame:
    """The state after a block, and how many turns it puts out, for every state before it."""
    out = []
    for conv, edge, x in _stretches(frame):
        if not edge:
            continue
        picked, after, turns = choices(x["r"].tolist(), np.asarray(x["rest"].iloc[0]))[0], [], []
        for state in range(4):
            n = 0
            for best in picked:
                if best[state] is None:
                    break
                _, _, to, mid, merged = best[state]
                n += (mid is not None) + (not merged)
                state = to
            after.append(state)
            turns.append(n)
        out.append((conv, x["part"].iloc[0], after, turns))
    return pd.DataFrame(out, columns=["conv_id", "part", "after", "turns"])


def _entries(frame: pd.DataFrame) -> pd.DataFrame:
    """The state before each block of one conversation, and the output turns before it."""
    frame = frame.sort_values("part")
    state, n, out = START, 0, []
    last = len(frame) - 1
    for i, (after, turns) in enumerate(zip(frame["after"], frame["turns"])):
        out.append((state, n, i == last))
        state, n = int(after[state]), n + int(turns[state])
    return pd.DataFrame({"conv_id": frame["conv_id"], "part": frame["part"], "state": [o[0] for o in out], "seen": [o[1] for o in out], "closes": [o[2] for o in out]})


def _emit(frame: pd.DataFrame) -> pd.DataFrame:
    rows: list[tuple] = []
    for conv, edge, x in _stretches(frame):
        known = edge and isinstance(x["closes"].iloc[0], (bool, np.bool_))
        rest = np.asarray(x["rest"].iloc[0]) if known else END
        state, turn, closes = (int(x["state"].iloc[0]), int(x["seen"].iloc[0]), bool(x["closes"].iloc[0])) if known else (START, 0, True)
        picked, least = choices(x["r"].tolist(), rest)
        total = int(x["cost"].iloc[0]) if known else int(least[START])
        for at, role, r, text, best in zip(x["at"], x["role"], x["r"], x["text"], picked):
            _, _, to, mid, merged = best[state]
            if mid is not None:
                turn += 1
                rows.append((conv, turn, at, 0, "insert", None, ROLES[mid - 1], _piece(mid, "", turn == 1), total))
            turn += not merged
            action = ("merge" if merged else "keep") if r == to - 1 else ("merge+relabel" if merged else "relabel")
            rows.append((conv, turn, at, 1, action, role if isinstance(role, str) else None, ROLES[to - 1], "\n" + text if merged else _piece(to, text, turn == 1), total))
            state = to
        if closes:
            for i, mid in enumerate({SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,)}.get(state, ())):
                turn += 1
                rows.append((conv, turn, at, 2 + i, "insert", None, ROLES[mid - 1], _piece(mid, "", False), total))
            rows.append((conv, turn, at, 4, "end", None, rows[-1][6], "<|im_end|>\n", total))
    return pd.DataFrame(rows, columns=["conv_id", "out_turn", "at", "sub", "action", "role", "out_role", "piece", "cost"])


def repair(conversations: DataFrame) -> DataFrame:
    """conv_id, out_turn (from 1), at, sub (order of the pieces), action, role, out_role, piece, cost (of the whole
    conversation). The pieces of a conversation in the order (at, sub), joined, are its rendering.

    Turns are in the order of ``turn``; ties and repeated rows by role and text, null turns first. A null or
    unknown role is relabelled at the usual price, a null text is an empty one, a null conv_id is a
    conversation of its own kind (all such rows together), extra columns are ignored, an empty table gives no
    rows. Sorted ranges of rows are the blocks, so a conversation may be as long as the table."""
    rows = (conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
            .withColumn("salt", F.xxhash64("text")))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "salt", "text")]
    rows = rows.repartitionByRange(*order[:4]).sortWithinPartitions(*order)
    name = F.lower(F.trim(F.coalesce("role", F.lit(""))))
    known = F.create_map(*[x for a, r in [*ALIASES.items(), *((r, r) for r in ROLES)] for x in (F.lit(a), F.lit(ROLES.index(r)))])
    rows = stage(rows.select(F.coalesce("conv_id", F.lit(-1 << 63)).alias("conv_id"), "role", "text", F.coalesce(F.element_at(known, name), F.lit(3)).alias("r"),
                             F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "op1_turns")
    key = ["conv_id", "part"]
    light = rows.select("conv_id", "part", "at", "r")
    m = light.groupBy("part").applyInPandas(_blocks, "conv_id long, part int, m array<long>")
    rest = stage(m.groupBy("conv_id").applyInPandas(_rest, "conv_id long, part int, rest array<long>, cost long"), "op1_rest")
    maps = light.join(rest.select(*key, "rest"), key, "left").groupBy("part").applyInPandas(_maps, "conv_id long, part int, after array<int>, turns array<long>")
    entry = maps.groupBy("conv_id").applyInPandas(_entries, "conv_id long, part int, state int, seen long, closes boolean")
    solved = stage(rest.join(entry, key), "op1_blocks")
    out = rows.join(solved, key, "left").groupBy("part").applyInPandas(
        _emit, "conv_id long, out_turn long, at long, sub int, action string, role string, out_role string, piece string, cost long")
    return out.withColumn("conv_id", F.when(F.col("conv_id") != F.lit(-1 << 63), F.col("conv_id")))
