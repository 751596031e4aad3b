"""Accuracy of the matcher on labelled pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.labelled_pairs import PAIRS
from .identity import with_fingerprint
from .match import compare


def decide(pairs: DataFrame) -> DataFrame:
    """pairs (id, category, expected, left_title, right_title) with the matcher's decision, confidence and reason on their titles; each different title
    of a category is worked on once."""
    title = lambda c: pairs.select("category", F.col(c).alias("title"))
    own = with_fingerprint(title("left_title").union(title("right_title")).distinct())
    for c, k in (("left_title", "l"), ("right_title", "r")):
        named = own.select(F.col("category").alias(f"{k}c"), F.col("title").alias(f"{k}t"), F.col("fp").alias(k))
        pairs = pairs.join(named, (F.col("category") == F.col(f"{k}c")) & (F.col(c) == F.col(f"{k}t"))).drop(f"{k}c", f"{k}t")
    return compare(pairs).select("id", "category", "expected", "left_title", "right_title", "decision", "confidence", "reason")


def decided_pairs(spark: SparkSession, rows: list[tuple[str, str, str, str]] | None = None) -> DataFrame:
    """category, expected, left_title, right_title, decision, confidence, reason of labelled pairs of titles."""
    return decide(spark.createDataFrame([(i, *r) for i, r in enumerate(rows or PAIRS)], "id int, category string, expected string, left_title string, right_title string")).drop("id")


def metrics(decided: DataFrame) -> DataFrame:
    """One row of counts and ratios (in percent). Pairs expected to match that go to review count neither way; others count as rightly kept apart."""
    is_, want = F.col("decision"), F.col("expected")
    n = lambda c: F.count_if(c)
    m = decided.agg(
        F.count("*").alias("total_pairs"), n((want == "match") & (is_ == "match")).alias("true_positives"), n((want != "match") & (is_ != "match")).alias("true_negatives"),
        n((want != "match") & (is_ == "match")).alias("false_positives"), n((want == "match") & (is_ == "no_match")).alias("false_negatives"),
        n(((want == "review") & (is_ != "match")) | ((want != "review") & (is_ == "review"))).alias("review_queue_count"),
    )
    ratio = lambda a, b, empty: F.when(b > 0, a / b * 100).otherwise(F.lit(empty))
    tp, tn, fp, fn = (F.col(c) for c in ("true_positives", "true_negatives", "false_positives", "false_negatives"))
    m = m.withColumns({"precision": ratio(tp, tp + fp, 100.0), "recall": ratio(tp, tp + fn, 100.0), "false_positive_rate": ratio(fp, fp + tn, 0.0), "false_negative_rate": ratio(fn, fn + tp, 0.0)})
    return m.withColumn("f1_score", F.when(F.col("precision") + F.col("recall") > 0, 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0))
