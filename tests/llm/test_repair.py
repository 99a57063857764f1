import hashlib
import heapq
import random
import re
import zlib

import pytest
from llm_fixtures import SF

from roadlens.llm import conversation_repair as C
from roadlens.llm import queries

COLS = "conv_id long, turn long, role string, text string, gone string, slice int"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        out += [(conv, turn, "user" if code == 4 else role, text)] * {0: 0, 3: 2}.get(code, 1)
    return out


def plan(rows):
    """Cheapest (cost, audit, turns) over whole edit sequences, by search in
    the order of (cost, audit); the last role decides what may follow."""
    after = {"": "su", "s": "u", "u": "a", "a": "u"}
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, last, turns = heapq.heappop(heap)
        if (i, last) in seen:
            continue
        seen.add((i, last))
        if i == len(rows) and last in ("", "a"):
            return cost, audit, turns
        for r, name in (("u", "user"), ("a", "assistant")):
            if r in after[last]:
                heapq.heappush(heap, (cost + 3, audit + "I", i, r, (*turns, f"{name}:")))
        if i == len(rows):
            continue
        role, text, bad = rows[i]
        heapq.heappush(heap, (cost + 4, audit + "D", i + 1, last, turns))
        if bad in ("blank", "duplicate"):
            continue
        more = 3 if bad == "truncated" else 0
        if role[:1] and role[:1] in after[last]:
            heapq.heappush(heap, (cost + more, audit + "K", i + 1, role[:1], (*turns, f"{role}:{text}")))
        for r, name in (("u", "user"), ("a", "assistant")):
            if r in after[last]:
                heapq.heappush(heap, (cost + more + 3, audit + "R", i + 1, r, (*turns, f"{name}:{text}")))


def brute(original):
    rows = damage(original)
    out = {}
    for conv in {r[0] for r in original}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        said, read, turns = set(), [], [r[1] for r in own if r[1] is not None]
        for _, _, role, text in own:
            w = re.sub(r"[\x20\x09-\x0D]", "", text)
            bad = "blank" if not w else "duplicate" if (role, text) in said else "truncated" if w[-1] not in ".!?" else ""
            said.add((role, text))
            read.append((role, text, bad))
        cost, audit, repaired = plan(read)
        bad = [b for _, _, b in read]
        pairs = [x[0][:1] + y[0][:1] for x, y in zip(read, read[1:])]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *[bad.count(x) for x in ("blank", "duplicate", "truncated")],
            sum(p not in ("su", "ua", "au") for p in pairs),
            cost, audit, hashlib.sha256("\n".join(repaired).encode()).hexdigest(),
        )
    return out


def check(df, rows, **more):
    got = {r.conv_id: tuple(r)[1:] for r in C.repair(C.damaged(df), **more).collect()}
    assert got == brute(rows)
    return got


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r)[1:] for r in queries.op12_conversation_repair(spark, SF).collect()}
    assert got == brute(rows)


def random_rows(rng, convs, longest):
    texts = ["Yes.", "no", "Why?", "", None, "  \n", "ok!", "Well. \n", "é", " "]
    roles = ["user", "assistant", "system", "tool", None, "", "User", "u"]
    rows = []
    for c in convs:
        for t in range(rng.randint(1, longest)):
            turn = rng.choice([t, t, t, t, t + 2, None, 0])
            rows.append((c, turn, rng.choice(roles[:3] * 5 + roles), rng.choice(texts) if rng.random() < 0.5 else f"text {rng.randint(0, 99)}{rng.choice('.!?x')}"))
    return rows


@pytest.mark.parametrize("piece", [1, 3, 4096])
def test_random_conversations(spark, piece):
    rng = random.Random(piece)
    rows = random_rows(rng, [*range(60), None, -5, 10**15], 12)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], COLS)
    got = check(df, rows, piece=piece)
    assert {x for r in got.values() for x in r[6]} == set("DIKR")


def test_one_conversation_holds_most_rows(spark):
    """It lies on all partitions, and its pieces are joined."""
    rng = random.Random(7)
    rows = random_rows(rng, range(20), 4)
    rows += [(77, t // 3 if t % 50 else None, rng.choice(["user", "assistant", "system"]), f"text {rng.randint(0, 300)}{rng.choice('..x')}") for t in range(900)]
    rows += [(78, 2**60 + 1, "user", "same.")] * 300
    check(spark.createDataFrame([(*r, "x", 1) for r in rows], COLS), rows, piece=16)


def test_edges(spark):
    assert C.repair_digest(spark.createDataFrame([], COLS)).collect() == []
    gone = next(i for i in range(100) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = [(gone, 0, "user", "Hi.")]
    got = check(spark.createDataFrame([(*r, "x", 1) for r in rows], COLS), rows)
    assert got[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    long_ = [(1, t, "user" if t % 2 else "assistant", "x" * 300_000 + ".") for t in range(6)]
    check(spark.createDataFrame([(*r, "x", 1) for r in long_], COLS), long_)


def test_tables_come_from_the_grammar():
    assert not any(len(v) > 1 for v in C.lr_tables()[1].values())
    for roles, legal in (("", True), ("ua", True), ("suauaua", True), ("s", False), ("u", False), ("su", False), ("sua", True)):
        stack = C.START
        for r in roles:
            stack = C.shift(stack, r)
        assert C.accepted(stack) == legal
    assert C.shift(C.START, "a") is None and C.shift(C.shift(C.START, "s"), "s") is None
