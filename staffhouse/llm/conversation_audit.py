"""Conversation structure repair with an audit: faults are counted, and the cheapest edits that make the roles
legal are found together with their least description.

The dynamic program walks the rows once and keeps, for each of four states, the least cost and the
audit that reaches it. Audits share their beginnings: each is a node of linked letters with
its ancestors at powers of two and a rolling hash of all letters up to it. Costs that tie are
decided by the audits, whose first difference is found by climbing while hashes differ; nodes of
one arena with one text are one node, so an equal hash is verified by identity and a collision falls back to
the letters.

Blocks of 4,096 rows in order are solved on their own, from every state they may begin in. A conversation
that goes on in other blocks is put together from one small summary a block: least costs, and the
order of the audits behind them. That order is enough, as audits that end in different states
differ within the block, so no task holds a conversation's rows at once, however long it is.
"""
from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import cmp_to_key

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staffhouse.llm.common import stage

START, SYSTEM, USER, ASSISTANT = range(4)           # the last output role
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)
INITIALS = ("s", "u", "a")                          # code 3: any other initial
BLOCK_BITS = 12
REROLE, DELETE, INSERT, LATE = 2, 3, 2, 1
WHITE = "\t\n\x0b\x0c\r "
FAR = 1 << 60
END = ((0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, ""))
LEGAL = {(0, 1), (1, 2), (2, 1)}                    # su, ua, au


def _next(state: int) -> int:
    """The role that an insertion or a relabelled row has after ``state``."""
    return ASSISTANT if state == USER else USER


def _moves(fault: int, code: int, state: int) -> list[tuple[int, str, int]]:
    """(cost, letters, state after) of the ways to treat one row. Insertions are made right before a row that
    stays; one is always enough there, and before a deleted row they can as well come after it (DI < ID)."""
    out = [(DELETE, "D", state)]
    if fault in (BLANK, DUPLICATE):
        return out
    late = LATE if fault == TRUNCATED else 0
    if code == 0 and state == START:
        out.append((late, "K", SYSTEM))
    for role in (USER, ASSISTANT):
        letter, cost = ("K", late) if code + 1 == role else ("R", late + REROLE)
        out.append((cost, letter, role) if _next(state) == role else (cost + INSERT, "I" + letter, role))
    return out


MOVES = [[[_moves(f, c, s) for s in range(4)] for c in range(4)] for f in range(4)]


class Audits:
    """Audit texts as nodes that share their beginnings; node 0 is the empty text."""

    def __init__(self, modulus: int = (1 << 61) - 1):
        self.modulus = modulus
        self.letter, self.depth, self.hash, self.up, self.child = [""], [0], [0], [()], {}

    def extend(self, node: int, letters: str) -> int:
        for x in letters:
            new = self.child.get((node, x))
            if new is None:
                new = self.child[node, x] = len(self.letter)
                self.letter.append(x)
                self.depth.append(self.depth[node] + 1)
                self.hash.append((self.hash[node] * 131 + ord(x)) % self.modulus)
                up, k = [node], 0
                while k < len(self.up[up[k]]):      # the ancestor 2^(k+1) letters up
                    up.append(self.up[up[k]][k])
                    k += 1
                self.up.append(tuple(up))
            node = new
        return node

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(out))

    def _lift(self, node: int, depth: int) -> int:
        while self.depth[node] > depth:
            step = self.depth[node] - depth
            node = self.up[node][step.bit_length() - 1]
        return node

    def compare(self, p: int, q: int) -> int:
        """-1, 0 or 1 as the text of p is less than, equal to or greater than that of q."""
        if p == q:
            return 0
        depth = min(self.depth[p], self.depth[q])
        a, b = self._lift(p, depth), self._lift(q, depth)
        if self.hash[a] == self.hash[b]:
            if a == b:                              # one begins with the other
                return -1 if self.depth[p] < self.depth[q] else 1
            return self._letters(p, q)
        for k in reversed(range(len(self.up[a]))):
            if k < len(self.up[a]) and self.hash[self.up[a][k]] != self.hash[self.up[b][k]]:
                a, b = self.up[a][k], self.up[b][k]
        if self.up[a][0] != self.up[b][0]:
            return self._letters(p, q)
        return -1 if self.letter[a] < self.letter[b] else 1

    def _letters(self, p: int, q: int) -> int:
        """After a collision of hashes."""
        x, y = self.text(p), self.text(q)
        return (x > y) - (x < y)

    def before(self, p: int, x: str, q: int, y: str) -> bool:
        """Whether the text of p and then x is less than that of q and then y."""
        if p == q:
            return x < y
        depth = min(self.depth[p], self.depth[q])
        if self._lift(p, depth) == self._lift(q, depth):
            return self.text(p) + x < self.text(q) + y
        return self.compare(p, q) < 0


def solve(codes: list[int], faults: list[int], entry: int, modulus: int = (1 << 61) - 1) -> tuple[list[int], list[int], Audits]:
    """Least cost and audit node for every state after these rows, and the nodes."""
    audits = Audits(modulus)
    cost, node = [FAR] * 4, [0] * 4
    cost[entry] = 0
    for c, f in zip(codes, faults):
        best: list = [None] * 4
        for x, moves in enumerate(MOVES[f][c]):
            if cost[x] >= FAR:
                continue
            for w, letters, y in moves:
                t, b = cost[x] + w, best[y]
                if b is None or t < b[0] or t == b[0] and audits.before(node[x], letters, b[1], b[2]):
                    best[y] = (t, node[x], letters)
        for y, b in enumerate(best):
            cost[y], node[y] = (FAR, 0) if b is None else (b[0], audits.extend(b[1], b[2]))
    return cost, node, audits


def finish(cost: list[int], node: list[int], audits: Audits) -> int:
    """The state to end in."""
    best = None
    for x in range(4):
        t = cost[x] + END[x][0]
        if cost[x] < FAR and (best is None or t < best[0] or t == best[0] and audits.before(node[x], END[x][1], node[best[1]], END[best[1]][1])):
            best = (t, x)
    return best[1]


def _illegal(codes: list[int]) -> int:
    return sum(pair not in LEGAL for pair in zip(codes, codes[1:]))


def _stretches(rows: pa.Table) -> Iterator[tuple[int | None, bool, list[int], list[int], list[int]]]:
    """(conv_id, at an end of the block, at, codes, faults) of one block's conversations in order."""
    rows = rows.sort_by("at")
    conv, at, code, fault = (rows[c].to_pylist() for c in ("conv_id", "at", "code", "fault"))
    cuts = [0, *(i for i in range(1, len(conv)) if conv[i] != conv[i - 1]), len(conv)]
    for low, high in zip(cuts, cuts[1:]):
        yield conv[low], low == 0 or high == len(conv), at[low:high], code[low:high], fault[low:high]


SUMMARY = "conv_id long, block long, cost array<long>, place array<int>, head int, tail int"


def _summaries(rows: pa.Table) -> pa.Table:
    """For the conversations that may go on in another block: cost and place (order of the audits) of every
    state after the block, for every state before it."""
    out = []
    block = rows["block"][0].as_py()
    for conv, edge, _, codes, faults in _stretches(rows):
        if not edge:
            continue
        costs, places = [], []
        for entry in range(4):
            cost, node, audits = solve(codes, faults, entry)
            order = sorted((y for y in range(4) if cost[y] < FAR), key=cmp_to_key(lambda x, y: audits.compare(node[x], node[y])))
            costs += cost
            places += [order.index(y) if y in order else 0 for y in range(4)]
        out.append({"conv_id": conv, "block": block, "cost": costs, "place": places, "head": codes[0], "tail": codes[-1]})
    kinds = [("conv_id", pa.int64()), ("block", pa.int64()), ("cost", pa.list_(pa.int64())), ("place", pa.list_(pa.int32())), ("head", pa.int32()), ("tail", pa.int32())]
    return pa.Table.from_pylist(out, pa.schema(kinds))


class _Chain:
    """One conversation's blocks in order: five bytes and a long are kept for each."""

    def __init__(self, conv: int | None):
        self.conv, self.blocks, self.came, self.joins = conv, array("q"), bytearray(), bytearray()
        self.cost, self.place, self.tail = [0, FAR, FAR, FAR], [0] * 4, None

    def add(self, row: dict) -> None:
        self.blocks.append(row["block"])
        self.joins.append(self.tail is not None and (self.tail, row["head"]) not in LEGAL)
        self.tail = row["tail"]
        cost, order, came = [FAR] * 4, [(0, 0)] * 4, [0] * 4
        for x in range(4):
            for y in range(4):
                w = row["cost"][4 * x + y]
                if self.cost[x] < FAR and w < FAR:
                    t, o = self.cost[x] + w, (self.place[x], row["place"][4 * x + y])
                    if t < cost[y] or t == cost[y] and o < order[y]:
                        cost[y], order[y], came[y] = t, o, x
        rank = sorted((order[y], y) for y in range(4) if cost[y] < FAR)
        self.place = [next((i for i, (_, z) in enumerate(rank) if z == y), 0) for y in range(4)]
        self.cost = cost
        self.came += bytes(came)

    def solved(self) -> Iterator[pa.RecordBatch]:
        last = len(self.blocks) - 1
        state = min((x for x in range(4) if self.cost[x] < FAR), key=lambda x: (self.cost[x] + END[x][0], self.place[x]))
        for high in range(last + 1, 0, -8192):
            rows = []
            for i in reversed(range(max(0, high - 8192), high)):
                before = self.came[4 * i + state]
                rows.append((self.conv, self.blocks[i], before, state, i == last, self.joins[i]))
                state = before
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int32()))],
                                             names=["conv_id", "block", "entry", "exit", "closes", "joins"])


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (conv_id, block): the states before and after every block on the best way."""
    chain = None
    for b in batches:
        for row in b.to_pylist():
            if chain is None or chain.conv != row["conv_id"]:
                if chain is not None:
                    yield from chain.solved()
                chain = _Chain(row["conv_id"])
            chain.add(row)
    if chain is not None:
        yield from chain.solved()


EDITS = "conv_id long, at long, sub int, edit string, role string, cost long, illegal long"


def _edits(rows: pa.Table, solved: pa.Table) -> pa.Table:
    """The edits of one block, and for each of its conversations a row without edit: its part of cost and illegal."""
    out: list[tuple] = []
    known = {r["conv_id"]: r for r in solved.to_pylist()}
    for conv, _, at, codes, faults in _stretches(rows) if len(rows) else ():
        way = known.get(conv)
        state = START if way is None else way["entry"]
        cost, node, audits = solve(codes, faults, state)
        last = finish(cost, node, audits) if way is None else way["exit"]
        closes = way is None or way["closes"]
        total = cost[last] + (END[last][0] if closes else 0)
        out.append((conv, None, None, None, None, total, _illegal(codes) + (way["joins"] if way else 0)))
        i = sub = 0
        for x in audits.text(node[last]):
            role = None
            if x in "IR":
                state = _next(state)
                role = "user" if state == USER else "assistant"
            elif x == "K":
                state = codes[i] + 1
            out.append((conv, at[i], sub, x, role, None, None))
            i, sub = (i, sub + 1) if x == "I" else (i + 1, 0)
        if closes:
            for sub, x in enumerate(END[last][1], 1):
                state = _next(state)
                out.append((conv, at[-1], sub + len(END), x, "user" if state == USER else "assistant", None, None))
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64())
    columns = list(zip(*out)) or [()] * 7
    return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds)], names=[c.split()[0] for c in EDITS.split(", ")])


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after the fixed damage; nulls are one space, except that a null conv_id or turn stays so."""
    space = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                space(F.col("role")).alias("role"), space(F.col("text")).alias("text"))
    rows = rows.withColumn("way", F.crc32(F.concat_ws(":", space(F.col("conv_id")), space(F.col("turn"))).cast("binary")) % 20).filter("way <> 0")
    text = F.when(F.col("way") == 1, "").when(F.col("way") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(F.col("way") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       F.explode(F.sequence(F.lit(1), F.when(F.col("way") == 3, 2).otherwise(1))).alias("copy"))
    return rows.drop("copy")


def in_order(rows: DataFrame) -> DataFrame:
    """``rows`` with ``at``, growing in the order (conv_id, turn, role, text), nulls first, and their ``block``. Equal rows
    are dealt by where they came from, so that no task has to take them all."""
    rows = rows.withColumns({"salt": F.xxhash64("text"), "came": F.monotonically_increasing_id()})
    key = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "salt")]
    rows = rows.repartitionByRange(*key, "came").sortWithinPartitions(*key[:3], "text")
    return stage(rows.select("conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("at")), "op11_rows")


def faults(rows: DataFrame) -> DataFrame:
    """conv_id, turn, at, code (of the role's initial), fault (the first that holds)."""
    core = F.rtrim("text", F.lit(WHITE))
    first = rows.groupBy("conv_id", "role", F.sha2("text", 256).alias("text")).agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    initial = F.substring("role", 1, 1)
    code = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    own = rows.select("conv_id", "turn", "at", code.alias("code"), (core == "").alias("blank"), (~F.right(core, F.lit(1)).isin(".", "!", "?")).alias("open"))
    fault: Column = F.when(F.col("blank"), BLANK).when(F.col("first").isNull(), DUPLICATE).when(F.col("open"), TRUNCATED).otherwise(NONE)
    return stage(own.join(first, "at", "left").select("conv_id", "turn", "at", "code", fault.alias("fault")), "op11_faults")


def edits(marked: DataFrame) -> DataFrame:
    """The cheapest edits, least audit first, of every conversation in ``faults``; see ``_edits``."""
    light = marked.select("conv_id", "at", "code", "fault", F.shiftright("at", BLOCK_BITS).alias("block"))
    ends = light.groupBy("block").applyInArrow(_summaries, SUMMARY)
    solved = (ends.repartition("conv_id").sortWithinPartitions("conv_id", "block")
              .mapInArrow(_chains, "conv_id long, block long, entry int, exit int, closes boolean, joins int"))
    return stage(light.groupBy("block").cogroup(solved.groupBy("block")).applyInArrow(_edits, EDITS), "op11_edits")


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """conv_id, at, sub, edit (K, R, D or I), role and text: the repaired conversation in the order (at, sub), with the deleted
    rows still in it."""
    steps = found.filter("edit is not null").select("at", "sub", "edit", F.col("role").alias("new"))
    own = F.col("edit") != "I"
    return rows.join(steps, "at").select("conv_id", "at", "sub", "edit", F.coalesce("new", "role").alias("role"), F.when(own, F.col("text")).otherwise("").alias("text"))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (conv_id, at, sub): the audit and the hash of each conversation, read as a stream."""
    open_, conv, audit, h, fresh = False, None, [], None, True

    def row():
        return pa.record_batch([pa.array([conv], pa.int64()), pa.array(["".join(audit)]), pa.array([h.hexdigest()])], names=["conv_id", "audit", "repaired_sha256"])

    for b in batches:
        for c, edit, role, text in zip(*(b.column(i).to_pylist() for i in (0, 3, 4, 5))):
            if not open_ or c != conv:
                if open_:
                    yield row()
                open_, conv, audit, h, fresh = True, c, [], hashlib.sha256(), True
            audit.append(edit)
            if edit != "D":
                h.update(f"{'' if fresh else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
                fresh = False
    if open_:
        yield row()


def audit(conversations: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 for every conv_id.

    Rows of one turn are ordered by role, then text; null turns come first, a null conv_id is a
    conversation of its own, equal rows are duplicates of the first. Only the first letter of a role
    counts for legality; a kept row keeps its whole role. A gap beyond a long is null. Conversations
    without rows after damage have zeros, an empty audit and the hash of an empty text; an empty table
    gives no rows; extra columns are ignored. The audit and the hash of a conversation are one value each, so
    the last step streams each conversation through one task, a row at a time."""
    rows = in_order(damaged(conversations))
    marked = faults(rows)
    found = edits(marked)
    count = lambda fault: F.sum(F.when(F.col("fault") == fault, 1).otherwise(0))
    turns = marked.groupBy("conv_id", "turn").agg(count(BLANK).alias("blank"), count(DUPLICATE).alias("duplicate"), count(TRUNCATED).alias("truncated"))
    wide = F.col("turn").cast("decimal(38,0)")
    gaps = (F.max(wide) - F.min(wide) + 1 - F.count("turn")).cast("string").try_cast("long")
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    counts = turns.groupBy("conv_id").agg(F.when(F.count("turn") > 0, gaps).otherwise(0).alias("gaps"), *(F.sum(c).alias(c) for c in names[1:4]))
    totals = found.filter("edit is null").groupBy("conv_id").agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"))
    digest = (repaired(rows, found).repartition("conv_id").sortWithinPartitions("conv_id", "at", "sub")
              .mapInArrow(_digest, "conv_id long, audit string, repaired_sha256 string"))
    out = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    there = F.lit(False)
    for i, part in enumerate((counts, totals, digest)):
        part = part.withColumnRenamed("conv_id", f"c{i}").withColumn(f"has{i}", F.lit(True))
        out = out.join(part, F.col("conv_id").eqNullSafe(F.col(f"c{i}")), "left")
        there = F.coalesce(F.col(f"has{i}"), F.lit(False)) if i == 0 else there
    zero = lambda c: F.when(there, F.col(c)).otherwise(0).cast("long").alias(c)
    return out.select("conv_id", *map(zero, names), F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
