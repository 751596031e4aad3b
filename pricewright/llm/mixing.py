"""Mixing sources to target weights by Efraimidis-Spirakis sampling, with DataFrame functions only.

Sources, ordered by code point with null last, weigh 1, 2, 3 and so on, repeating. They share 100 % of all sizes by weight; a
source's target stops at `cap` times its size, and what is over is shared again by weight among the others until none is
above. That fixed point is found at once: in ascending order of cap * size / weight, sources are capped as long as the level
(what is left / the weight left) exceeds that ratio, and the others get level * weight.

A source's target consists of complete epochs (each of its documents once) and a rest smaller than its size, filled by a
sample: each document gets the key -ln(u) / w, with u from a hash of its id and text and w its quality weight, and documents are
taken in ascending order of keys until their sizes reach the rest; of the document there, only the words still missing are taken.

A source may hold a third of all rows, so no window spans a source: keys are dealt into ranges of about BUCKET_ROWS rows, range
totals are prefix-summed, and only the ranges' own rows are sorted. Rows that repeat id and text have one key; they are counted before
that, and written out again at the end in parts of SAME_ROWS. Text is read once: ids, sizes and weights are written to the
shared folder first. What stays in one task is a table of a row for each source (some ten millions are fine), and for each source the
totals of its ranges (MAX_RANGES for each unit of the keys' logarithm at most).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

BUCKET_ROWS = 1_000
MAX_RANGES = 1 << 14
SAME_ROWS = 100_000
WORDS = r"[^\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
CAP = 3


def n_words(text: Column) -> Column:
    """How many runs of other than ASCII white space a text has; null has none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORDS)).cast("long")


def quality_weight(text: Column) -> Column:
    """1 for a text without symbols, down to 1/21 for one of symbols only."""
    t = F.coalesce(text, F.lit(""))
    return F.lit(1.0) / (F.lit(1.0) + F.lit(20.0) * F.regexp_count(t, F.lit(SYMBOLS)) / F.greatest(F.length(t), F.lit(1)))


def uniform(id_: Column, text: Column) -> Column:
    """A number in (0, 1) from the md5 of the id as text, a colon and the text; a null id counts as 'null', a null text as empty."""
    whole = F.concat(F.coalesce(id_.cast("string"), F.lit("null")), F.lit(":"), F.coalesce(text, F.lit("")))
    h = F.conv(F.substring(F.md5(whole.cast("binary")), 1, 13), 16, 10).cast("long")
    return (h.cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, cap: int = CAP) -> DataFrame:
    """From rows of (source, size): source, rows, source_size, weight, target. A row for each source."""
    s = sizes.groupBy("source").agg(F.count("*").alias("rows"), F.sum("size").alias("source_size"))
    # One row for each source: the windows below sort that small table.
    s = s.withColumn("weight", (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % 3 + 1)
    by_ratio = Window.orderBy(F.col("source_size") * cap / F.col("weight"), F.col("source").asc_nulls_last())
    above = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    s = s.withColumns({"total": F.sum("source_size").over(everything), "weights": F.sum("weight").over(everything), "capped": cap * F.coalesce(F.sum("source_size").over(above), F.lit(0)), "gone": F.coalesce(F.sum("weight").over(above), F.lit(0)), "place": F.row_number().over(by_ratio)})
    s = s.withColumn("level", (F.col("total") - F.col("capped")).cast("double") / (F.col("weights") - F.col("gone")))
    # The first source, in that order, that the level of those from it on leaves within its cap.
    fits = F.when(F.col("level") <= F.col("source_size") * cap / F.col("weight"), F.struct("place", "level"))
    s = s.withColumn("level", F.min(fits).over(everything)["level"])
    limit = (F.col("source_size") * cap).cast("double")
    return s.select("source", "rows", "source_size", "weight", F.least(limit, F.coalesce(F.col("level") * F.col("weight"), limit)).alias("target"))


def mix(docs: DataFrame, *, cap: int = CAP, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", bucket_rows: int = BUCKET_ROWS, same_rows: int = SAME_ROWS, with_hash: bool = False) -> DataFrame:
    """A row for each row of docs: doc_id, size, source_size, target, taken (words that the mix takes, repeats counted); with_hash also text_hash (xxhash64 of the text).

    The null source is a source of its own. Null and empty texts have size 0 and are taken 0 times; a mix without words has targets 0.
    Rows that repeat an id count each on its own; those that repeat its text as well come one after the other in the sample.
    Other columns are ignored, whatever their names. Reruns agree.
    """
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), text.alias("text"))
    key = -F.log(uniform(F.col("doc_id"), F.col("text"))) / quality_weight(F.col("text"))
    rows = materialize(rows.select("doc_id", "source", F.xxhash64("text").alias("text_hash"), n_words(F.col("text")).alias("size"), key.alias("key")), "mix")
    targets = source_targets(rows, cap)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    targets = targets.withColumn("epochs", epochs).withColumn("rest", F.round(F.col("target")).cast("long") - F.col("epochs") * F.col("source_size"))
    targets = materialize(targets, "targets").withColumnRenamed("source", "of")

    largest = targets.agg(F.max("rows")).first()[0] or 0
    ranges = max(1, min(MAX_RANGES, -(-largest // bucket_rows)))
    # Whatever the weights' scale, a range of the key's logarithm holds at most 0.37 / ranges of the different rows of one weight.
    range_ = F.floor(F.log("key") * ranges).cast("long")
    rows = rows.groupBy("doc_id", "source", "text_hash", "size", "key").agg(F.count("*").alias("same")).withColumn("range", range_)
    totals = rows.groupBy("source", "range").agg(F.sum(F.col("size") * F.col("same")).alias("range_size"))
    before = F.coalesce(F.sum("range_size").over(Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    totals = totals.select(F.col("source").alias("in_source"), F.col("range").alias("in_range"), before.alias("before"))
    totals = totals.join(targets, F.col("in_source").eqNullSafe(F.col("of"))).select("in_source", "in_range", "before", "source_size", "target", "epochs", "rest")

    w = Window.partitionBy("source", "range").orderBy("key", "doc_id", "size", "text_hash").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("within", F.coalesce(F.sum(F.col("size") * F.col("same")).over(w), F.lit(0).cast("long")))
    rows = rows.join(totals, F.col("source").eqNullSafe(F.col("in_source")) & (F.col("range") == F.col("in_range")))
    rows = materialize(rows.withColumn("left", F.col("rest") - F.col("before") - F.col("within")).select("doc_id", "text_hash", "size", "source_size", "target", "epochs", "left", "same"), "ranked")
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    few = rows.filter(F.col("same") <= same_rows).withColumn("nth", F.explode(F.sequence(zero, F.col("same") - 1)))
    many = rows.filter(F.col("same") > same_rows).withColumn("first", F.explode(F.sequence(zero, F.col("same") - 1, F.lit(same_rows).cast("long"))))
    if not many.isEmpty():
        many = many.repartition("doc_id", "text_hash", "first").withColumn("nth", F.explode(F.sequence(F.col("first"), F.least(F.col("first") + same_rows, F.col("same")) - one)))
        few = few.unionByName(many.drop("first"))
    part = F.greatest(zero, F.least(F.col("size"), F.col("left") - F.col("nth") * F.col("size")))
    return few.select("doc_id", "size", "source_size", "target", (F.col("epochs") * F.col("size") + part).alias("taken"), *(["text_hash"] if with_hash else []))


def copies(taken: Column, size: Column) -> Column:
    """How often a document is put in the mix: complete times, and once more if at least half of its words are still taken."""
    return F.when(size > 0, F.floor(taken / size + 0.5)).otherwise(F.lit(0)).cast("int")
