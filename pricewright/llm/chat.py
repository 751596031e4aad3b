"""Chat formatting after cumulative-snapshot collapse.

Chat logs often hold a conversation again and again as it grows. A conversation whose turns are the first turns of another one,
or that equals one with a smaller id, is dropped; the others (the maximal ones) are rendered.

Each turn's row gets two 64-bit hashes of its place in the conversation, role and text; their running exclusive-or is a
128-bit hash of the turns so far. A conversation goes if (number of turns, its hash) is among the proper prefixes' hashes of
all conversations, in an anti-join. Turns are dealt over ranges of (conversation, turn, role, beginning of the text), which Spark cuts by
rows: a very long conversation, also one whose turns have no number or all the same, falls in many ranges. Running hashes are made within
each range, from the exclusive-or of the conversation's ranges before it. Rendered text comes in rows of RUN turns, so nothing
collects a conversation. Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

RUN = 256
#: Characters of a text by which turns of one number and role are dealt over ranges.
HEAD = 64


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, n (turns of the conversation), k (turns up to here), h1 and h2 (their hash)."""
    t = turns.withColumns({"x1": F.xxhash64("turn", "role", "text", F.lit(1)), "x2": F.xxhash64(F.lit(2), "text", "role", "turn"), "head": F.substring("text", 1, HEAD)})
    t = materialize(t.repartitionByRange("conv_id", "turn", "role", "head").drop("head").withColumn("part", F.spark_partition_id()), "ranges")
    parts = t.groupBy("conv_id", "part").agg(F.count("*").alias("n"), F.bit_xor("x1").alias("r1"), F.bit_xor("x2").alias("r2"))
    # One row for each range that a conversation falls in.
    w = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    parts = parts.select(
        F.col("conv_id").alias("of"), F.col("part").alias("at"), F.sum("n").over(Window.partitionBy("conv_id")).alias("n"), F.coalesce(F.sum("n").over(w), zero).alias("n0"),
        F.coalesce(F.bit_xor("r1").over(w), zero).alias("p1"), F.coalesce(F.bit_xor("r2").over(w), zero).alias("p2"),
    )
    w = Window.partitionBy("conv_id", "part").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    t = t.withColumns({"k": F.count("*").over(w), "a1": F.bit_xor("x1").over(w), "a2": F.bit_xor("x2").over(w)})
    t = t.join(parts, (t["conv_id"] == parts["of"]) & (t["part"] == parts["at"]))
    return t.select("conv_id", "turn", "role", "text", "n", (F.col("k") + F.col("n0")).alias("k"), F.col("a1").bitwiseXOR(F.col("p1")).alias("h1"), F.col("a2").bitwiseXOR(F.col("p2")).alias("h2"))


def render(role: Column, text: Column) -> Column:
    """One turn; '<|' within a text gets a space between, so that no text holds a control mark."""
    clean = lambda c: F.replace(c, F.lit("<|"), F.lit("< |"))
    return F.concat(F.lit("<|im_start|>"), clean(role), F.lit("\n"), clean(text), F.lit("<|im_end|>\n"))


def format_chats(conversations: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, run, n_turns (of the conversation), n_equal (conversations that equal it, itself included), text; for each maximal conversation, a row for each RUN turns.

    Turns are ordered by number, then role and text; a turn's number is part of it. Rows that repeat a turn exactly count once.
    A null role is 'unknown', a null text is empty, a null turn number comes first as -1. Rows with a null conv_id belong to no conversation and are left out.
    Columns other than the four named are ignored, whatever their names. Texts come whole: a row is as long as its RUN turns.
    """
    turns = conversations.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("conv_id"), F.coalesce(F.col(turn_col).cast("long"), F.lit(-1).cast("long")).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("unknown")).alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    ).distinct()
    rows = materialize(prefix_hashes(turns), "turns")
    whole = rows.filter("k = n").select("conv_id", "k", "h1", "h2")
    different = whole.groupBy("k", "h1", "h2").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_equal"))
    proper = rows.filter("k < n").select("k", "h1", "h2").distinct()
    maximal = different.join(proper, ["k", "h1", "h2"], "left_anti").select(F.col("conv_id").alias("of"), F.col("k").alias("n_turns"), "n_equal")
    kept = rows.join(maximal, F.col("conv_id") == F.col("of")).withColumn("run", F.floor((F.col("k") - 1) / RUN).cast("long"))
    parts = kept.groupBy("conv_id", "run", "n_turns", "n_equal").agg(F.array_sort(F.collect_list(F.struct("k", render(F.col("role"), F.col("text")).alias("s")))).alias("a"))
    return parts.select("conv_id", "run", "n_turns", "n_equal", F.array_join(F.col("a")["s"], "").alias("text"))
