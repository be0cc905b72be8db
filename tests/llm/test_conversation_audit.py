"""The conversation audit against an exhaustive search by (cost, audit), in blocks of every size."""
import hashlib
import heapq
import random
import re
import zlib

import pytest

from staffhouse.llm import conversation_audit as C

SCHEMA = "conv_id long, turn long, role string, text string, at long, edit string, cost string, block int, fault string"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, 5, "x", "y", 1, "z") for r in rows], SCHEMA)


def least(rows):
    """rows of (role, text, fault) -> (cost, audit, repaired lines): the first end of a search in the order (cost, audit)."""
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, roles, lines = heapq.heappop(heap)
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, audit, "\n".join(lines)
        if (i, audit, roles) in seen or not re.fullmatch("s?(ua)*u?", roles):
            continue
        seen.add((i, audit, roles))
        if len(roles) < len(rows) + 4:
            for r in ("user", "assistant"):
                heapq.heappush(heap, (cost + 2, audit + "I", i, roles + r[0], (*lines, f"{r}:")))
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, roles, lines))
            if fault not in ("blank", "duplicate"):
                late = fault == "truncated"
                if role[:1] in ("s", "u", "a"):
                    heapq.heappush(heap, (cost + late, audit + "K", i + 1, roles + role[0], (*lines, f"{role}:{text}")))
                for r in ("user", "assistant"):
                    heapq.heappush(heap, (cost + late + 2, audit + "R", i + 1, roles + r[0], (*lines, f"{r}:{text}")))


def brute(rows):
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        way = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if way == 0:
            continue
        text = "" if way == 1 else re.sub("[.!?]", "", text) if way == 2 else text
        convs[conv] += [(turn, "user" if way == 4 else role, text)] * (2 if way == 3 else 1)
    out = {}
    for conv, own in convs.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, marked = set(), []
        for _, role, text in own:
            chars = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not chars else "duplicate" if (role, text) in seen else "truncated" if chars[-1] not in ".!?" else None
            seen.add((role, text))
            marked.append((role, text, fault))
        turns = {t for t, _, _ in own if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(x[0][:1] + y[0][:1] not in ("su", "ua", "au") for x, y in zip(marked, marked[1:]))
        cost, audit, text = least(marked)
        out[conv] = (gaps, *(sum(f == k for _, _, f in marked) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def made(n, longest, seed):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        usual = ["user", "assistant"]
        for turn in range(rng.randrange(0, longest)):
            role = usual[turn % 2] if rng.random() < .7 else rng.choice(["user", "assistant", "system", "tool", "", None, "unknown", "sys"])
            text = rng.choice(["Yes.", "No!", "what", "so ", " \t\n", "", None, "End.\x0b", "Köln?", f"Text {rng.random()}."])
            rows.append((conv, None if rng.random() < .04 else turn * rng.choice([1, 1, 3]), role, text))
    return rows + [(None, 1, "user", "a."), (None, None, None, None), (None, 2, "assistant", "b."), (77, 1, "user", "x"), (77, 1, "user", "x"), (77, 1, "assistant", "x")]


def answers(df):
    got = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect()}
    return got


@pytest.mark.parametrize("bits", [12, 1])
def test_audit_matches_an_exhaustive_search(spark, monkeypatch, bits):
    monkeypatch.setattr(C, "BLOCK_BITS", bits)
    rows = made(60, 8, 5)
    assert answers(C.audit(conversations(spark, rows))) == brute(rows)


def test_a_conversation_over_many_blocks_has_the_same_audit(spark, monkeypatch):
    rng = random.Random(1)
    rows = [(9, t, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["a.", "b", "c?", " "])+ str(t) * (t % 3) + rng.choice(".!,")) for t in range(3000)]
    whole = answers(C.audit(conversations(spark, rows)))
    monkeypatch.setattr(C, "BLOCK_BITS", 4)
    assert answers(C.audit(conversations(spark, rows))) == whole
    repaired = C.repaired(r := C.in_order(C.damaged(conversations(spark, rows))), C.edits(C.faults(r))).orderBy("at", "sub").collect()
    assert re.fullmatch("(s?(ua)+)?", "".join(x.role[0] for x in repaired if x.edit != "D"))
    assert "".join(x.edit for x in repaired) == whole[9][6]


def test_hash_collisions_do_not_change_the_audit():
    rng = random.Random(8)
    for n in range(1, 60):
        codes, faults = [rng.randrange(4) for _ in range(n)], [rng.randrange(4) for _ in range(n)]
        cost, node, audits = C.solve(codes, faults, C.START)
        weak_cost, weak_node, weak = C.solve(codes, faults, C.START, modulus=3)
        assert cost == weak_cost
        assert [audits.text(x) for x in node] == [weak.text(x) for x in weak_node]


def test_compare_is_the_order_of_texts():
    rng = random.Random(4)
    for modulus in ((1 << 61) - 1, 2):
        a = C.Audits(modulus)
        nodes = {"".join(rng.choice("DIKR") for _ in range(rng.randrange(9))): 0 for _ in range(200)}
        nodes = {t: a.extend(0, t) for t in nodes}
        for x, p in nodes.items():
            assert a.text(p) == x
            for y, q in nodes.items():
                assert a.compare(p, q) == (x > y) - (x < y)
                assert a.before(p, "K", q, "D") == (x + "K" < y + "D")


def test_conversations_of_nothing(spark):
    assert C.audit(conversations(spark, [])).count() == 0
    gone = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    row = C.audit(conversations(spark, [(5, gone, "user", "a.")])).collect()
    assert [tuple(r) for r in row] == [(5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    far = C.audit(conversations(spark, [(5, -1 << 63, "user", "a."), (5, (1 << 63) - 1, "assistant", "b.")])).collect()
    assert far[0].gaps is None
