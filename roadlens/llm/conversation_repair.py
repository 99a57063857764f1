"""Repair of conversations by generalised LR parsing of their roles.

A legal conversation has role initials ``(s?(ua)+)?``. SLR tables are built
from that grammar; a graph-structured stack then reads a conversation's rows,
each of which may be kept, rerolled or deleted, with empty turns inserted
anywhere, every action at its cost. Stacks with equal tops are merged, the one
of the smallest (cost, audit) stays; the audit lists the edits' initials.

Rows are dealt out by ranges of (conversation, turn, role, text), so one
conversation may lie on many partitions. A conversation that lies inside a
partition is repaired there. Of one that crosses a border, or is long, every
piece of rows is read from each possible stack top on its own, and the pieces'
results are joined in order.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.common import Scratch

# The grammar's rules; upper case names are rules, lower case ones role initials.
RULES = (("C", ""), ("C", "sT"), ("C", "T"), ("T", "ua"), ("T", "Tua"))
ROLES = {"u": "user", "a": "assistant"}  # what a row may be rerolled to or inserted as
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
PIECE = 4096  # rows of a long conversation that are read at once
_WORD = re.compile(r"[^\x20\x09-\x0D]")
_LEGAL = {"su", "ua", "au"}

Stack = tuple  # (state, stack below)
Tops = dict  # state -> (cost, audit, stack)


@functools.cache
def lr_tables() -> tuple[dict, dict, dict]:
    """Shifts and gotos {(state, symbol): state}, reductions {(state, next): [(rule, length)]}
    and the states that accept, by the next symbol ``$``."""
    names = {left for left, _ in RULES}
    follow = {x: set() for x in names} | {"C": {"$"}}
    first = {x: set() for x in names}
    changed = True
    while changed:
        before = sum(map(len, [*follow.values(), *first.values()]))
        for left, right in RULES:
            if right:
                first[left] |= first[right[0]] if right[0] in names else {right[0]}
            for x, after in zip(right, [*right[1:], None], strict=False):
                if x in names:
                    follow[x] |= follow[left] if after is None else first[after] if after in names else {after}
        changed = before != sum(map(len, [*follow.values(), *first.values()]))

    def closed(items: set) -> frozenset:
        todo, out = list(items), set(items)
        while todo:
            _, right, dot = todo.pop()
            for left, r in RULES if dot < len(right) else ():
                if left == right[dot] and (new := (left, r, 0)) not in out:
                    out.add(new)
                    todo.append(new)
        return frozenset(out)

    states = [closed({("", "C", 0)})]
    move, reduce_ = {}, {}
    for i, state in enumerate(states):
        for x in sorted({right[dot] for _, right, dot in state if dot < len(right)}):
            to = closed({(left, right, dot + 1) for left, right, dot in state if dot < len(right) and right[dot] == x})
            if to not in states:
                states.append(to)
            move[i, x] = states.index(to)
        for left, right, dot in sorted(state):
            if left and dot == len(right):
                for x in follow[left]:
                    reduce_.setdefault((i, x), []).append((left, len(right)))
    return move, reduce_, {(move[0, "C"], "$")}


@functools.cache
def _reduced(stack: Stack, next_: str) -> tuple[Stack, ...]:
    """The stack and all that reductions make of it when ``next_`` follows."""
    move, reduce_, _ = lr_tables()
    out = [stack]
    for s in out:
        for left, n in reduce_.get((s[0], next_), ()):
            below = s
            for _ in range(n):
                below = below[1]
            out.append((move[below[0], left], below))
    return tuple(out)


@functools.cache
def shift(stack: Stack, role: str) -> Stack | None:
    """The stack after a turn of that role; none where it can't stand there."""
    move = lr_tables()[0]
    for s in _reduced(stack, role):
        if (s[0], role) in move:
            return (move[s[0], role], s)
    return None


@functools.cache
def accepted(stack: Stack) -> bool:
    return any((s[0], "$") in lr_tables()[2] for s in _reduced(stack, "$"))


START: Stack = (0, None)


@functools.cache
def tops() -> dict[int, Stack]:
    """A stack for every state that can be on top after a turn."""
    found, todo = {0: START}, [START]
    for s in todo:
        for role in "sua":
            to = shift(s, role)
            if to is not None and to[0] not in found:
                found[to[0]] = to
                todo.append(to)
    return found


def _put(out: Tops, stack: Stack | None, cost: int, audit: str) -> bool:
    """Merges a stack into those with its top; true where it is the better one."""
    if stack is None:
        return False
    old = out.get(stack[0])
    if old is not None and old[:2] <= (cost, audit):
        return False
    out[stack[0]] = (cost, audit, stack)
    return True


def _with_inserts(now: Tops) -> Tops:
    out, todo = dict(now), list(now)
    while todo:
        cost, audit, stack = out[todo.pop()]
        for role in ROLES:
            to = shift(stack, role)
            if _put(out, to, cost + INSERT, audit + "I"):
                todo.append(to[0])
    return out


def read(now: Tops, rows: list[tuple[str, str]]) -> Tops:
    """Stacks after ``rows``: (role initial, fault or ""). A fault is
    ``blank``, ``duplicate`` or ``truncated``."""
    for initial, fault in rows:
        out: Tops = {}
        more = TRUNCATED if fault == "truncated" else 0
        for cost, audit, stack in _with_inserts(now).values():
            _put(out, stack, cost + DELETE, audit + "D")
            if fault in ("blank", "duplicate"):
                continue
            _put(out, shift(stack, initial), cost + more, audit + "K")
            for role in ROLES:
                _put(out, shift(stack, role), cost + more + REROLE, audit + "R")
        now = out
    return now


def cheapest(now: Tops) -> tuple[int, str]:
    """Cost and audit of the best legal conversation."""
    return min((cost, audit) for cost, audit, stack in _with_inserts(now).values() if accepted(stack))


def fault(role: str, text: str, repeated: bool) -> str:
    said = _WORD.findall(text)
    if not said:
        return "blank"
    if repeated:
        return "duplicate"
    return "" if said[-1] in ".!?" else "truncated"


class Repaired:
    """Applies an audit to rows as they come and takes the digest of what it yields."""

    def __init__(self, audit: str):
        self.audit, self.at, self.sha, self.role, self.some = audit, 0, hashlib.sha256(), "", False

    def _turn(self, role: str, text: str) -> None:
        line = f"{role}:{text}"
        self.sha.update((f"\n{line}" if self.some else line).encode("utf-8", "surrogatepass"))
        self.some, self.role = True, role[:1]

    def _due(self) -> str:
        return "assistant" if self.role == "u" else "user"

    def _inserts(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self._turn(self._due(), "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self._inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            self._turn(role if edit == "K" else self._due(), text)

    def digest(self) -> str:
        self._inserts()
        return self.sha.hexdigest()


def damaged(turns: DataFrame) -> DataFrame:
    """The contract's damage: by crc32(``conv_id:turn``) % 20, 0 drops a row
    (``gone``), 1 empties its text, 2 takes its ``.!?`` away, 3 repeats it, 4
    makes it the user's. A null is one space, but as an id or turn stays null."""
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    code = F.col("code")
    return (
        turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), role.alias("role"), text.alias("text"))
        .withColumn("code", F.crc32(key.cast("binary")) % 20)
        .withColumn("copy", F.explode(F.when(code == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        .select(
            "conv_id",
            "turn",
            F.when(code == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(code == 1, "").when(code == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
            (code == 0).alias("gone"),
        )
    )


_OUT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_ROW = "slice int, seq long, turn long, role string, text string, gone boolean"
_COUNTS = ("blank", "duplicate", "truncated")


def repair(rows: DataFrame, piece: int = PIECE) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text, gone):
    its turn gaps, faults by the first that a row has, illegal neighbours,
    the cheapest repair's cost and audit, and the digest of its turns.

    Rows go by turn, nulls first, then by role and text; those marked ``gone``
    only name their conversation. A null ``conv_id`` is a conversation of its own. A row
    whose role starts with anything but s, u and a, or is empty, can't be
    kept. A conversation without rows has zeros and empty strings' values.
    """
    scratch = Scratch(rows.sparkSession, "repair")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = ["conv_id", "turn", "role", "text", "gone", "place"]
    placed = rows.withColumn("place", F.monotonically_increasing_id())  # deals out equal rows, too
    dealt = placed.repartitionByRange(parts, *key).sortWithinPartitions(*key).withColumn("slice", F.spark_partition_id())
    done = scratch.keep(dealt.drop("place").mapInArrow(lambda b: _slice(b, piece), f"{_OUT}, done boolean, {_ROW}"), "done")
    names = [x.split(" ")[0] for x in _OUT.split(", ")]
    long = _across(done.where("NOT done").select("conv_id", *[x.split(" ")[0] for x in _ROW.split(", ")]), piece)
    return done.where("done").select(*names).unionByName(long)


def repair_digest(turns: DataFrame) -> DataFrame:
    """The rows of op12."""
    return repair(damaged(turns))


def _rows(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*[b.column(c).to_pylist() for c in names], strict=True)


def _slice(batches: Iterator[pa.RecordBatch], piece: int) -> Iterator[pa.RecordBatch]:
    """Repairs a partition's conversations but the first and the last, which may
    cross its borders, and long ones: their rows go on as they are."""
    out, size = [], 0
    held, conv, on, seq = [], None, True, 0  # ``on``: the rows go on
    start = True
    schema = _schema(f"{_OUT}, done boolean, {_ROW}")
    blank = [None] * 8

    def passed(rows: list) -> list:
        return [(rows_conv, *blank, False, *r) for rows_conv, *r in rows]

    for c, turn, role, text, gone, at in _rows(batches, "conv_id", "turn", "role", "text", "gone", "slice"):
        if start or c != conv:
            if not start and not on:
                out.append((conv, *_whole([r[3:] for r in held]), True, *[None] * 6))
            elif held:
                out += passed(held)
            held, on, conv = [], start, c
            start = False
        held.append((c, at, seq, turn, role, text, gone))
        seq += 1
        size += len(text) + 100
        if len(held) >= (256 if on else piece):
            on = True
            out += passed(held)
            held = []
        if len(out) >= 1000 or size > 4 << 20:
            yield _batch(out, schema)
            out, size = [], 0
    out += passed(held)
    if out:
        yield _batch(out, schema)


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _whole(rows: list[tuple]) -> tuple:
    """Result columns of a conversation's rows (turn, role, text, gone)."""
    seen, read_rows, kept = set(), [], []
    for turn, role, text, gone in rows:
        if gone:
            continue
        read_rows.append((role[:1], fault(role, text, (role, text) in seen)))
        seen.add((role, text))
        kept.append((turn, role, text))
    cost, audit = cheapest(read({0: (0, "", START)}, read_rows))
    out = Repaired(audit)
    for _, role, text in kept:
        out.row(role, text)
    faults = [f for _, f in read_rows]
    turns = {t for t, _, _ in kept if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(x[0] + y[0] not in _LEGAL for x, y in zip(read_rows, read_rows[1:], strict=False))
    return gaps, *[faults.count(x) for x in _COUNTS], illegal, cost, audit, out.digest()


def _across(rows: DataFrame, piece: int) -> DataFrame:
    """Conversations that lie on several partitions, or are long."""
    conv = F.coalesce("conv_id", F.lit(0)).alias("c"), F.col("conv_id").isNull().alias("no_id")
    rows = rows.select(*conv, *[x.split(" ")[0] for x in _ROW.split(", ")])
    place = F.struct("slice", "seq")
    said = ["c", "no_id", F.sha2(F.col("role").cast("binary"), 256).alias("r"), F.sha2(F.col("text").cast("binary"), 256).alias("t")]
    first = rows.where("NOT gone").select(*said, place.alias("place")).groupBy("c", "no_id", "r", "t").agg(F.min("place").alias("place"), F.count("*").alias("n"))
    again = first.where("n > 1").drop("n")  # a row said once needs no test
    keyed = rows.select("*", *said[2:])
    faulty = keyed.join(again, ["c", "no_id", "r", "t"], "left").withColumn(
        "repeated", F.col("place").isNotNull() & (F.col("place") < place)
    )
    # A piece is what one partition holds of a conversation, or PIECE rows of that.
    pieces = faulty.select("c", "no_id", "slice", "seq", F.floor(F.col("seq") / piece).alias("piece"), "turn", "role", "text", "gone", "repeated")
    read_pieces = pieces.groupBy("c", "no_id", "slice", "piece").applyInArrow(_read_piece, _PIECE)
    plans = read_pieces.groupBy("c", "no_id").applyInArrow(_join_pieces, _PLAN)
    # The digest takes the rows in order: a stream of them behind the plan.
    stream = plans.withColumn("kind", F.lit(0)).unionByName(
        rows.where("NOT gone").select("c", "no_id", "slice", "seq", "role", "text").withColumn("kind", F.lit(1)), allowMissingColumns=True
    )
    order = ["c", "no_id", "kind", "slice", "seq"]
    return stream.repartition("c", "no_id").sortWithinPartitions(*order).mapInArrow(_digests, _OUT)


_EDGE = "low long, high long, turns long, head string, tail string, blank long, duplicate long, truncated long, illegal long"
_PIECE = f"c long, no_id boolean, slice int, piece long, n long, {_EDGE}, entry array<int>, exit array<int>, cost array<long>, audit array<string>"
_PLAN = "c long, no_id boolean, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}
    kinds |= {f"array<{k}>": pa.list_(v) for k, v in kinds.items()}
    return pa.schema([(n, kinds[k]) for n, k in (x.split(" ") for x in ddl.split(", "))])


def _read_piece(group: pa.Table) -> pa.Table:
    """A piece's counts, and the best way through it from each stack top."""
    rows = sorted(group.to_pylist(), key=lambda r: r["seq"])
    key = [rows[0][x] for x in ("c", "no_id", "slice", "piece")]
    rows = [r for r in rows if not r["gone"]]
    said = [(r["role"][:1], fault(r["role"], r["text"], r["repeated"])) for r in rows]
    turns = [r["turn"] for r in rows if r["turn"] is not None]
    ways = []
    for top, stack in tops().items():
        ways += [(top, to, cost, audit) for to, (cost, audit, _) in read({top: (0, "", stack)}, said).items()]
    faults = [f for _, f in said]
    illegal = sum(x[0] + y[0] not in _LEGAL for x, y in zip(said, said[1:], strict=False))
    edge = [min(turns, default=None), max(turns, default=None), len(set(turns))]
    edge += [said[0][0] if said else None, said[-1][0] if said else None, *[faults.count(x) for x in _COUNTS], illegal]
    row = (*key, len(said), *edge, *[list(x) for x in zip(*ways, strict=True)])
    return pa.Table.from_batches([_batch([row], _schema(_PIECE))])


def _join_pieces(group: pa.Table) -> pa.Table:
    """A conversation's plan from its pieces in order."""
    pieces = sorted(group.to_pylist(), key=lambda p: (p["slice"], p["piece"]))
    now: Tops = {0: (0, "", START)}
    low = high = tail = None
    turns = illegal = 0
    for p in pieces:
        if not p["n"]:
            continue
        out: Tops = {}
        for entry, to, cost, audit in zip(p["entry"], p["exit"], p["cost"], p["audit"], strict=True):
            if entry in now:
                _put(out, tops()[to], now[entry][0] + cost, now[entry][1] + audit)
        now = out
        illegal += p["illegal"] + (tail is not None and tail + p["head"] not in _LEGAL)
        tail = p["tail"]
        if p["low"] is not None:
            turns += p["turns"] - (high == p["low"])
            low, high = p["low"] if low is None else low, p["high"]
    cost, audit = cheapest(now)
    gaps = 0 if low is None else high - low + 1 - turns
    row = (pieces[0]["c"], pieces[0]["no_id"], gaps, *[sum(p[x] for p in pieces) for x in _COUNTS], illegal, cost, audit)
    return pa.Table.from_batches([_batch([row], _schema(_PLAN))])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = _schema(_OUT)
    plan, out, done = None, None, []

    def close() -> None:
        if plan is not None:
            done.append((*plan, out.digest()))

    names = ["c", "no_id", "kind", "gaps", *_COUNTS, "illegal", "cost", "audit", "role", "text"]
    for c, no_id, kind, *rest, role, text in _rows(batches, *names):
        if kind == 0:
            close()
            plan, out = (None if no_id else c, *rest), Repaired(rest[-1])
        else:
            out.row(role, text)
        if len(done) >= 500:
            yield _batch(done, schema)
            done = []
    close()
    if done:
        yield _batch(done, schema)
