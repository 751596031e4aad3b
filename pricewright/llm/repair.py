"""Conversation structure repair by shortest paths over small integer costs.

A conversation's rows, in order, and what role may come next (nothing yet, after a system turn, after a user, after an assistant) span a
graph of layers of four states. Edits are its arcs: Keep costs 0, Rerole and Insert 3, Delete 4, and a truncated row that stays 3 more. Distances to
the end come from Dial's algorithm: a ring of buckets, one for each distance that is still open, as no arc is longer than 6. Then the arcs that
distances show to be tight are walked from the start, always that of the least initial, which gives the cheapest edits' least audit.

Conversations of at most LONG_ROWS rows and LONG_BYTES of text are repaired whole, dealt by conversation. A longer one never meets in one
task: its rows are dealt over ranges that Spark cuts by rows, and each block of them becomes a 4 x 4 table of distances between the states before and
after it. Running over a conversation's blocks, backwards, gives the distances where blocks end; with them, each block is walked from all four states,
and a run forwards picks the one it is entered with. Only the repaired text is then read in order by one task a conversation, in a stream, since
SHA-256 can't be put together from parts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, ship, tidied, tidy

KEEP, REROLE, INSERT, DELETE, TRUNCATED = 0, 3, 3, 4, 3
BLANK, DUPLICATE, CUT = 1, 2, 3
#: By state (0: nothing yet, 1: after a system turn, 2: after a user, 3: after an assistant): the initial that may follow (and s at 0), its role, the state it leads to.
ALLOWED, ROLE, NEXT = "uuau", ("user", "user", "assistant", "user"), (2, 2, 3, 2)
BEFORE = tuple([p for p in range(4) if NEXT[p] == q] for q in range(4))
#: What inserts cost from each state to an end.
END = (0, 2 * INSERT, INSERT, 0)
FAR = 1 << 60
LEGAL = ("su", "ua", "au")

LONG_ROWS = 10_000
LONG_BYTES = 32 << 20
#: A block of a long conversation has at most 2 ** BLOCK_BITS rows.
BLOCK_BITS = 17


def distances(initials: str, faults: list[int], goal: tuple[int, ...]) -> list[int]:
    """The least cost from each node, 4 * row + state, to the layer after the last row, whose states cost goal."""
    n = len(initials)
    dist = [FAR] * (4 * n + 4)
    base = min(goal)
    width = max(KEEP, REROLE + TRUNCATED, INSERT, DELETE, *(g - base for g in goal if g < FAR)) + 1
    ring: list[list[int]] = [[] for _ in range(width)]
    open_ = 0
    for q, g in enumerate(goal):
        if g < FAR:
            dist[4 * n + q] = g - base
            ring[g - base].append(4 * n + q)
            open_ += 1
    d = 0
    while open_:
        bucket = ring[d % width]
        while bucket:
            v = bucket.pop()
            open_ -= 1
            if dist[v] < d:
                continue
            i, q = v >> 2, v & 3
            into = [(v - q + p, INSERT) for p in BEFORE[q]] if i < n else []
            if i:
                into.append((v - 4, DELETE))
                if faults[i - 1] in (0, CUT):
                    more, c = TRUNCATED * (faults[i - 1] == CUT), initials[i - 1]
                    into += [(v - 4 - q + p, more + (KEEP if c == ALLOWED[p] else REROLE)) for p in BEFORE[q]]
                    if q == 1 and c == "s":
                        into.append((v - 4 - q, more + KEEP))
            for u, cost in into:
                if d + cost < dist[u]:
                    dist[u] = d + cost
                    ring[(d + cost) % width].append(u)
                    open_ += 1
        d += 1
    return [x + base if x < FAR else FAR for x in dist]


def walk(initials: str, faults: list[int], dist: list[int], state: int) -> tuple[str, int]:
    """The edits' initials along the tight arcs from the first layer's state, and the state they end in."""
    out, i, q = [], 0, state
    while i < len(initials):
        here, c, more = dist[4 * i + q], initials[i], TRUNCATED * (faults[i] == CUT)
        kept = NEXT[q] if c == ALLOWED[q] else 1 if c == "s" and q == 0 else None
        if dist[4 * i + 4 + q] + DELETE == here:
            out.append("D")
            i += 1
        elif dist[4 * i + NEXT[q]] + INSERT == here:
            out.append("I")
            q = NEXT[q]
        else:
            keep = kept is not None and dist[4 * i + 4 + kept] + more + KEEP == here
            out.append("K" if keep else "R")
            q, i = kept if keep else NEXT[q], i + 1
    return "".join(out), q


def ending(state: int) -> str:
    return "I" * (END[state] // INSERT)


class Repaired:
    """Puts edits, given piece by piece, into effect; keeps the hash of the repaired lines, not the lines."""

    def __init__(self) -> None:
        self.q, self.edits, self.at, self.hash, self.any, self.audit = 0, "", 0, hashlib.sha256(), False, []

    def more(self, edits: str) -> None:
        assert self.at == len(self.edits)
        self.edits, self.at = edits, 0
        self.audit.append(edits)

    def _line(self, role: str, text: str) -> None:
        self.hash.update((("\n" if self.any else "") + role + ":").encode())
        self.hash.update(text.encode())
        self.any = True

    def inserts(self) -> None:
        while self.at < len(self.edits) and self.edits[self.at] == "I":
            self._line(ROLE[self.q], "")
            self.q, self.at = NEXT[self.q], self.at + 1

    def row(self, role: str, text: str) -> None:
        self.inserts()
        edit = self.edits[self.at]
        self.at += 1
        if edit == "R":
            role = ROLE[self.q]
        if edit != "D":
            self._line(role, text)
            self.q = 1 if self.q == 0 and role[:1] == "s" else NEXT[self.q]


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def illegal(initials: list[str] | str) -> int:
    return sum(a + b not in LEGAL for a, b in zip(initials[:-1], initials[1:], strict=True))


def repair(rows: list[tuple[int | None, str, str, int]]) -> tuple[int, int, int, int, int, int, str, str]:
    """RESULT's values for a conversation's damaged rows in order: turn, role, text, fault (0, BLANK or CUT)."""
    seen: set[tuple[str, str]] = set()
    faults = []
    for _, role, text, fault in rows:
        faults.append(DUPLICATE if fault != BLANK and (role, text) in seen else fault)
        seen.add((role, text))
    turns = {x[0] for x in rows if x[0] is not None}
    initials = "".join(x[1][:1] or " " for x in rows)
    dist = distances(initials, faults, END)
    audit, q = walk(initials, faults, dist, 0)
    done = Repaired()
    done.more(audit + ending(q))
    for _, role, text, _ in rows:
        done.row(role, text)
    done.inserts()
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return gaps, faults.count(BLANK), faults.count(DUPLICATE), faults.count(CUT), illegal(initials), dist[0], done.edits, done.hash.hexdigest()


def damaged(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, turn, role, text, fault (0, BLANK or CUT), digest (of role and text), times (0: dropped, 2: repeated)."""
    or_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(or_space(id_col), F.lit(":"), or_space(turn_col)).cast("binary")) % 20
    rows = conversations.select(F.col(id_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), or_space(role_col).alias("role"), or_space(text_col).alias("text"), kind.alias("kind"))
    text: Column = F.when(F.col("kind").isin(0, 1), "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).alias("times"))
    inked = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    fault = F.when(inked == "", BLANK).when(~F.right(inked, F.lit(1)).isin(".", "!", "?"), CUT).otherwise(0)
    digest = F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256))
    return rows.select("conv_id", "turn", "role", "text", fault.alias("fault"), digest.alias("digest"), "times")


def _whole(rows: DataFrame) -> DataFrame:
    """The results of conversations that one task may hold; rows of no times only name their conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: list[tuple[int | None, str, str, int]] = []
        at, last, kind = False, None, None

        def out(done: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], kind), *[pa.array([x[1][c] for x in done]) for c in range(8)]], names=["conv_id", *[f.split()[0] for f in RESULT.split(", ")]])

        for batch in batches:
            kind, done = batch.column("conv_id").type, []
            for conv, turn, role, text, fault, times in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "fault", "times")), strict=True):
                if at and conv != last:
                    done.append((last, repair(own)))
                    own = []
                at, last = True, conv
                own += [(turn, role, text, fault)] * times
            if done:
                yield out(done)
        if at:
            yield out([(last, repair(own))])

    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "digest").drop("digest")
    return rows.mapInArrow(tidied(run), f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, {RESULT}")


def _columns(t: pa.Table, *names: str) -> list[list]:
    return [t.column(c).to_pylist() for c in names]


def _block(key: tuple, marks: pa.Table) -> pa.Table:
    """A block's counts and distances between the states before and after it, row by row."""
    with tidy():
        initials, faults = _columns(marks.sort_by("pos"), "initial", "fault")
        one = [distances("".join(initials), faults, tuple(0 if e == q else FAR for e in range(4)))[:4] for q in range(4)]
        counts = [faults.count(BLANK), faults.count(DUPLICATE), faults.count(CUT), illegal(initials)]
        return pa.table({"conv_id": marks.column("conv_id").slice(0, 1), "block": [key[1].as_py()], "first": [initials[0]], "last": [initials[-1]], "counts": [counts], "between": [[one[e][q] for q in range(4) for e in range(4)]]})


def _goals(key: tuple, blocks: pa.Table) -> pa.Table:
    """For each block of a conversation, what the states after it cost; the conversation's counts with the first block."""
    number, first, last, counts, between = _columns(blocks.sort_by("block"), "block", "first", "last", "counts", "between")
    goals, goal = [], list(END)
    for m in reversed(between):
        goals.append(goal)
        goal = [min(min(m[4 * q + e] + goal[e] for e in range(4)), FAR) for q in range(4)]
    total = [sum(x[c] for x in counts) for c in range(4)]
    total[3] += sum(a + b not in LEGAL for a, b in zip(last[:-1], first[1:], strict=True))
    n = len(number)
    return pa.table({"conv_id": blocks.column("conv_id"), "block": number, "goal": goals[::-1], "total": pa.array([[*total, goal[0]], *[None] * (n - 1)], pa.list_(pa.int64()))})


def _walks(key: tuple, marks: pa.Table, goals: pa.Table) -> pa.Table:
    """A block's walks from each of the four states."""
    with tidy():
        initials, faults = _columns(marks.sort_by("pos"), "initial", "fault")
        goal = tuple(goals.column("goal")[0].as_py())
        dist = distances("".join(initials), faults, goal)
        walks = [walk("".join(initials), faults, dist, q) if dist[q] < FAR else ("", 0) for q in range(4)]
        return pa.table({"conv_id": marks.column("conv_id").slice(0, 1), "block": [key[1].as_py()], "ends": [[w[1] for w in walks]], "edits": [[w[0] for w in walks]]})


def _entries(key: tuple, ends: pa.Table) -> pa.Table:
    """The state that each block of a conversation is entered with, and what inserts follow it."""
    number, to = _columns(ends.sort_by("block"), "block", "ends")
    states = [0]
    for x in to:
        states.append(x[states[-1]])
    return pa.table({"conv_id": ends.column("conv_id"), "block": number, "entry": states[:-1], "after": [""] * (len(number) - 1) + [ending(states[-1])]})


def _long(rows: DataFrame, block_bits: int) -> DataFrame:
    kind = rows.schema["conv_id"].dataType.simpleString()
    turns = rows.select("conv_id", "turn", "digest", "role", "text", "fault", F.explode(F.sequence(F.lit(1), "times"))).drop("col").withColumn("tie", F.monotonically_increasing_id())
    turns = turns.repartitionByRange("conv_id", "turn", "digest", "tie").sortWithinPartitions("conv_id", "turn", "digest", "tie").withColumn("pos", F.monotonically_increasing_id())
    turns = materialize(turns, "turns")
    initial = F.when(F.col("role") == "", " ").otherwise(F.substring("role", 1, 1)).alias("initial")
    marks = turns.select("conv_id", "pos", F.shiftright("pos", block_bits).alias("block"), initial, "fault", "digest")
    first = marks.groupBy(F.col("conv_id").alias("of"), F.col("digest").alias("like")).agg(F.min("pos").alias("first"), F.count("*").alias("n")).filter("n > 1")
    marks = marks.join(first, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("like")), "left")
    fault = F.when((F.col("fault") != BLANK) & (F.col("pos") > F.col("first")), DUPLICATE).otherwise(F.col("fault")).alias("fault")
    marks = materialize(marks.select("conv_id", "block", "pos", "initial", fault), "marks")
    by = ["conv_id", "block"]
    blocks = materialize(marks.groupBy(*by).applyInArrow(_block, f"conv_id {kind}, block long, first string, last string, counts array<long>, between array<long>"), "blocks")
    goals = materialize(blocks.groupBy("conv_id").applyInArrow(_goals, f"conv_id {kind}, block long, goal array<long>, total array<long>"), "goals")
    walks = materialize(marks.groupBy(*by).cogroup(goals.groupBy(*by)).applyInArrow(_walks, f"conv_id {kind}, block long, ends array<long>, edits array<string>"), "walks")
    entries = materialize(walks.select(*by, "ends").groupBy("conv_id").applyInArrow(_entries, f"conv_id {kind}, block long, entry long, after string"), "entries")
    of = entries.select(F.col("conv_id").alias("of"), F.col("block").alias("at"), "entry", "after")
    pieces = walks.join(of, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("block") == F.col("at")))
    pieces = pieces.select("conv_id", F.shiftleft("block", block_bits).alias("pos"), F.lit(0).alias("line"), F.lit(None).cast("string").alias("role"), F.concat(F.col("edits")[F.col("entry")], "after").alias("text"))
    lines = pieces.unionByName(turns.select("conv_id", "pos", F.lit(1).alias("line"), "role", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, last = None, None

        def out(type_: pa.DataType) -> pa.RecordBatch:
            done.inserts()
            return pa.RecordBatch.from_arrays([pa.array([last], type_), pa.array(["".join(done.audit)]), pa.array([done.hash.hexdigest()])], names=["conv_id", "audit", "repaired_sha256"])

        for batch in batches:
            for conv, line, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "line", "role", "text")), strict=True):
                if done is not None and conv != last:
                    yield out(batch.column("conv_id").type)
                    done = None
                done, last = done or Repaired(), conv
                if line:
                    done.row(role, text)
                else:
                    done.more(text)
        if done is not None:
            yield out(batch.column("conv_id").type)

    texts = lines.repartition("conv_id").sortWithinPartitions("conv_id", "pos", "line").drop("pos").mapInArrow(tidied(run), f"conv_id {kind}, audit string, repaired_sha256 string")
    gaps = turns.groupBy("conv_id").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).alias("gaps")).select(F.col("conv_id").alias("g_id"), "gaps")
    totals = goals.filter("total is not null").select(F.col("conv_id").alias("t_id"), *[F.col("total")[i].alias(c) for i, c in enumerate(_COUNTS[1:])])
    out = texts.join(gaps, F.col("conv_id").eqNullSafe(F.col("g_id"))).join(totals, F.col("conv_id").eqNullSafe(F.col("t_id")))
    return out.select("conv_id", *_COUNTS, "audit", "repaired_sha256")


def repair_conversations(conversations: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", long_rows: int = LONG_ROWS, long_bytes: int = LONG_BYTES, block_bits: int = BLOCK_BITS) -> DataFrame:
    """Damages the rows by crc32 of `conv_id:turn`, then repairs each conversation: conv_id and RESULT's columns.

    Rows stand by turn (null turns first), then by the hash of role and text, whatever order they come in. Null roles and texts are one
    space; a null conv_id is a conversation of its own; an empty role has the initial " ". Rows that repeat are all kept, and are
    duplicates but for the first. A conversation that loses all its rows gets zeros, an empty audit and the hash of nothing. Turns are cast
    to long. Other columns are ignored, whatever their names. A long conversation's audit is one string all the same.
    """
    ship(conversations.sparkSession)
    rows = damaged(conversations, id_col, turn_col, role_col, text_col)
    size = rows.groupBy(F.col("conv_id").alias("of")).agg(F.sum("times").alias("n"), F.sum(F.octet_length("text").cast("long") * F.col("times")).alias("bytes"))
    long_ = materialize(size.filter((F.col("n") > long_rows) | (F.col("bytes") > long_bytes)).select("of"), "long")
    same = F.col("conv_id").eqNullSafe(F.col("of"))
    live = rows.filter("times > 0")
    # A conversation whose rows are all dropped, however many, is named by one row.
    gone = rows.filter("times = 0").select("conv_id").distinct().select("conv_id", *[F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields[1:-1]], F.lit(0).alias("times"))
    if long_.isEmpty():
        return _whole(live.unionByName(gone))
    return _whole(live.unionByName(gone).join(long_, same, "left_anti")).unionByName(_long(live.join(long_, same, "left_semi"), block_bits))
