"""Reviews: pages by cursor up to a cap, and evidence on aspects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.rules import ordered
from .cluster import shared_table

PAGE_LIMIT = 100


def in_order(pages: DataFrame) -> DataFrame:
    """pages (product_id, cursor, next_cursor, reviews) that a product's chain of cursors reaches, with page_no from 1 and a reason if the chain breaks
    there: the page without a cursor is the first, each next_cursor names the page after it.

    Pages come in any order; a chain is ranked in rounds that double its ranked length: each round adds the pages 2^k places on, then squares
    the table of jumps. A chain ends with a page without reviews or next_cursor. A next_cursor that came before breaks it ("repeated
    cursor"), as does one without a page ("no such page"). Of several pages with one cursor one counts (the smallest next_cursor); rows without a product are left out.
    """
    own = pages.filter("product_id is not null").withColumns({"k_": F.coalesce(F.concat(F.lit("c"), "cursor"), F.lit("")), "r_": F.xxhash64(F.col("next_cursor"))})
    one = own.groupBy("product_id", "k_").agg(F.min_by(F.struct("cursor", "next_cursor", "reviews"), F.struct("next_cursor", "r_")).alias("p"))
    # Pages get numbers, so that rounds handle pairs of numbers and no texts.
    one = shared_table(one.select(F.monotonically_increasing_id().alias("id"), "product_id", "k_", "p.*"), "pages")
    live = F.col("next_cursor").isNotNull() & (F.coalesce(F.size("reviews"), F.lit(0)) > 0)
    # What a page leads to, and through how many pages.
    to = one.filter(live).select("product_id", F.concat(F.lit("c"), "next_cursor").alias("k_"), F.col("id").alias("a"))
    jump = following = shared_table(to.join(one.select("product_id", "k_", F.col("id").alias("b")), ["product_id", "k_"]).select("a", "b"), "jumps")
    step, n = 1, 0
    ranked = shared_table(one.filter("k_ = ''").select("id", F.lit(0).cast("long").alias("at")), "ranked")
    now = ranked.count()
    while now > n:
        n = now
        on = ranked.join(jump.withColumnRenamed("a", "id"), "id").select(F.col("b").alias("id"), (F.col("at") + step).alias("at"))
        ranked = shared_table(ranked.unionByName(on).groupBy("id").agg(F.min("at").alias("at")), "ranked")
        step, now = 2 * step, ranked.count()
        if now > n:
            jump = shared_table(jump.join(jump.select(F.col("a").alias("b"), F.col("b").alias("c")), "b").select("a", F.col("c").alias("b")), "jumps")
    after = following.join(ranked.select(F.col("id").alias("b"), F.col("at").alias("next_at")), "b").select(F.col("a").alias("id"), "next_at")
    out = one.join(ranked.join(after, "id", "left"), "id")
    reason = F.when(live, ordered([(F.col("next_at").isNull(), F.lit("no such page")), (F.col("next_at") <= F.col("at"), F.lit("repeated cursor"))]))
    return out.select("product_id", (F.col("at") + 1).alias("page_no"), "cursor", "next_cursor", "reviews", reason.alias("reason"))


def page_faults(pages: DataFrame) -> DataFrame:
    """pages (product_id, page_no, cursor, reviews: array of struct with product_id) that break a rule, with the reason: a cursor that came before, a page
    of more than PAGE_LIMIT reviews, or one with another product's reviews."""
    return _judged(pages.withColumns(_marks())).filter("reason is not null").drop(*_marks())


def _marks() -> dict[str, Column]:
    """What rules ask of a page's reviews."""
    return {"n_": F.size("reviews"), "other_": F.exists("reviews", lambda r: r["product_id"] != F.col("product_id"))}


def _judged(pages: DataFrame) -> DataFrame:
    w = Window.partitionBy("product_id", "cursor")
    reason = ordered([
        (F.col("cursor").isNotNull() & (F.col("page_no") > F.col("first_")), F.lit("repeated cursor")), (F.col("n_") > PAGE_LIMIT, F.lit("too many reviews on a page")),
        (F.col("other_"), F.lit("reviews of another product")),
    ])
    return pages.withColumn("first_", F.min("page_no").over(w)).withColumn("reason", reason).drop("first_")


def collect_reviews(pages: DataFrame, maximum: int) -> DataFrame:
    """The first `maximum` reviews of each product, in order of pages and places; pages after an empty one or after a faulty one don't count.

    Pages are counted, without their reviews, before those that count are taken apart: reviews are never sorted.
    """
    if not 0 <= maximum <= 500:
        raise ValueError("a product's reviews are capped at 500")
    marks = _judged(pages.select("product_id", "page_no", "cursor", *[c.alias(k) for k, c in _marks().items()]))
    ends = marks.filter((F.coalesce("n_", F.lit(0)) <= 0) | F.col("reason").isNotNull())
    stops = ends.groupBy("product_id").agg(F.min("page_no").alias("stop"))
    live = pages.join(stops, "product_id", "left").filter(F.col("stop").isNull() | (F.col("page_no") < F.col("stop")))
    w = Window.partitionBy("product_id").orderBy("page_no", "cursor").rowsBetween(Window.unboundedPreceding, -1)
    live = live.withColumn("before_", F.coalesce(F.sum(F.size("reviews")).over(w), F.lit(0)).cast("int"))
    rows = live.select("product_id", "before_", F.posexplode(F.slice("reviews", F.lit(1), F.greatest(F.lit(maximum) - F.col("before_"), F.lit(0)))).alias("place", "review"))
    return rows.select("product_id", (F.col("before_") + F.col("place") + 1).alias("n"), "review")


def aspects(spark) -> DataFrame:  # noqa: ANN001
    """category, aspect: what may be said of a category's products."""
    return spark.createDataFrame([(c, a) for c, t in fixed.TAXONOMY.items() for a in t["aspects"]], "category string, aspect string")


def valid_evidence(evidence: DataFrame) -> DataFrame:
    """evidence (category, aspect, sentiment, confidence) with a known aspect and a confidence from 0 to 1."""
    known = F.broadcast(aspects(evidence.sparkSession))
    return evidence.filter(F.col("confidence").between(0, 1)).join(known, ["category", "aspect"], "left_semi")


def aspect_summary(evidence: DataFrame, keys: list[str]) -> DataFrame:
    """keys, aspect, mentions, positive, negative, mean_confidence."""
    e = valid_evidence(evidence)
    return e.groupBy(*keys, "aspect").agg(F.count("*").alias("mentions"), F.count_if(F.col("sentiment") == "positive").alias("positive"), F.count_if(F.col("sentiment") == "negative").alias("negative"), F.avg("confidence").alias("mean_confidence"))
