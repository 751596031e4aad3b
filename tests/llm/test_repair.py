"""Structure repair: all edits of short conversations, long ones in blocks against whole ones, odd inputs."""

import hashlib
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pricewright.llm import repair
from pricewright.llm.repair import _COUNTS

TURNS = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def every_repair(rows, most):
    """(cost, audit, lines) of every edit of up to `most` cost that gives a legal sequence of roles; the least of them."""
    best = []

    def go(i, cost, audit, lines):
        if cost > most or len(audit) > 12:
            return
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", "".join(r[:1] or " " for r, _ in lines)):
            best.append((cost, audit, "\n".join(f"{r}:{t}" for r, t in lines)))
        for new in ("user", "assistant"):
            go(i, cost + 3, audit + "I", [*lines, (new, "")])
        if i < len(rows):
            role, text, fault = rows[i]
            go(i + 1, cost + 4, audit + "D", lines)
            if fault not in (1, 2):
                more = 3 * (fault == 3)
                go(i + 1, cost + more, audit + "K", [*lines, (role, text)])
                for new in ("user", "assistant"):
                    go(i + 1, cost + 3 + more, audit + "R", [*lines, (new, text)])

    go(0, 0, "", [])
    return min(best)


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "U", ""]), st.sampled_from(["Hi.", "No", "", " \n", "Why?! ", "z."])), max_size=4))
@settings(max_examples=60, deadline=None)
def test_repair_is_the_cheapest_and_least(own):
    rows = [(i, r, t, 1 if not t.strip(SPACE) else 0 if t.rstrip(SPACE)[-1] in ".!?" else 3) for i, (r, t) in enumerate(own)]
    seen, faults = set(), []
    for _, r, t, f in rows:
        faults.append(2 if f != 1 and (r, t) in seen else f)
        seen.add((r, t))
    got = repair.repair(rows)
    cost, audit, lines = every_repair([(r, t, f) for (_, r, t, _), f in zip(rows, faults, strict=True)], got[5])
    assert (got[5], got[6], got[7]) == (cost, audit, hashlib.sha256(lines.encode()).hexdigest())
    assert got[1:4] == (faults.count(1), faults.count(2), faults.count(3))


def plain(rows):
    """The result by conversation, from (conv_id, turn, role, text)."""
    out = {}
    for conv, turn, role, text in rows:
        own = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        ink = text.rstrip(SPACE)
        key = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
        own += [(turn is not None, turn or 0, key, (turn, role, text, 1 if not ink else 0 if ink[-1] in ".!?" else 3))] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return {c: repair.repair([x[3] for x in sorted(own)]) for c, own in out.items()}


def result(df):
    return {r.conv_id: (*[r[c] for c in _COUNTS], r.audit, r.repaired_sha256) for r in df.collect()}


def talk(rng, convs, turns):
    texts = ["Yes.", "No!", "Oh", "", "\n", "What? ", "a b c.", None]
    return [(c, t if rng.random() < 0.95 else None, rng.choice(["user", "assistant", "system", "user", "assistant", "tool", None]), rng.choice([*texts, f"text {t}."])) for c in convs for t in range(rng.randrange(turns))]


def test_conversations_whole_and_in_blocks(spark):
    """Long conversations, cut in blocks of 8 rows, and of all lengths of blocks, equal those repaired whole."""
    rng = random.Random(3)
    rows = talk(rng, [None, *range(25)], 12) + talk(rng, [100, 101], 400)
    want = plain(rows)
    df = spark.createDataFrame(rows, TURNS).repartition(5)
    assert result(repair.repair_conversations(df)) == want
    assert result(repair.repair_conversations(df, long_rows=20, block_bits=3)) == want
    assert result(repair.repair_conversations(df, long_rows=0, long_bytes=0, block_bits=5)) == {c: x for c, x in want.items()}


def test_one_conversation_of_equal_rows_is_dealt_over_blocks(spark):
    rows = [(7, 1, "user", "Again.")] * 500 + [(7, 2, "assistant", "Never.")] * 3
    got = repair.repair_conversations(spark.createDataFrame(rows, TURNS).repartition(4), long_rows=50, block_bits=4)
    assert result(got) == plain(rows)


def test_repair_odd(spark):
    """Nulls anywhere, a very long text, odd columns, a string id, no rows; a conversation that loses every row."""
    gone = next(c for c in range(10_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = [(gone, 0, "user", "x."), (None, None, None, None), (5, None, "user", "y " * 400_000), (5, 3, None, "z"), (6, 2**61, "user", "End."), (6, 1, "ässistant", "É.")]
    df = spark.createDataFrame(rows, TURNS).withColumns({"fault": F.lit("clash"), "pos": F.lit(1), "of": F.lit(2)})
    got = result(repair.repair_conversations(df))
    assert got == plain(rows) and got[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert result(repair.repair_conversations(df, long_bytes=100)) == got
    text_ids = df.withColumn("conv_id", F.col("conv_id").cast("string"))
    assert result(repair.repair_conversations(text_ids)) == {None if c is None else str(c): x for c, x in got.items()}
    assert repair.repair_conversations(df.limit(0)).count() == 0


@pytest.mark.parametrize("n", [0, 1, 50_000])
def test_costs_of_a_long_alternation(n):
    dist = repair.distances("ua" * n, [0] * (2 * n), repair.END)
    assert dist[0] == 0 and repair.walk("ua" * n, [0] * (2 * n), dist, 0) == ("K" * (2 * n), 3 if n else 0)
