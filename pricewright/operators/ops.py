"""Operations on batches: frontier, recrawl windows, lifecycle, plans, capped reviews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.rules import ordered
from ..functions.text import canonical_url


def backoff_minutes(errors: Column, base: int = 30) -> Column:
    """base, doubled with each error after the first, four times at most."""
    return (F.lit(base) * F.pow(F.lit(2), F.least(errors - 1, F.lit(4)))).cast("int")


def recrawl_minutes(status: Column, volatile: Column, stable: Column, errors: Column) -> Column:
    """Minutes until the next crawl: errors, then lifecycle, then how prices behave."""
    return ordered([
        (errors > 0, backoff_minutes(errors)), (status == "DISCONTINUED", F.lit(7 * 24 * 60)), (status.isin("UNAVAILABLE", "STALE"), F.lit(48 * 60)),
        (volatile, F.lit(30)), (stable, F.lit(24 * 60)),
    ], F.lit(4 * 60))


def later(t: Column, minutes: Column) -> Column:
    return t + F.make_dt_interval(mins=minutes.cast("int"))


def is_due(recrawl_after: Column, now: Column) -> Column:
    return recrawl_after.isNull() | (now >= recrawl_after)


def enqueue(frontier: DataFrame, urls: DataFrame) -> DataFrame:
    """frontier (canonical_url, url, source, category, priority, status, error_count, recrawl_after, seq) with urls (url, source, category, priority, seq): one row for
    each canonical URL; the first one found stays, with the best priority of all."""
    new = urls.withColumns({"canonical_url": canonical_url(F.col("url")), "source": F.lower(F.trim("source")), "status": F.lit("pending"), "error_count": F.lit(0), "recrawl_after": F.lit(None).cast("timestamp")})
    both = frontier.withColumn("old_", F.lit(0)).unionByName(new.withColumn("old_", F.lit(1)).select(*frontier.columns, "old_"))
    w = Window.partitionBy("canonical_url")
    both = both.withColumns({"n_": F.row_number().over(w.orderBy("old_", "seq", "url")), "priority": F.min("priority").over(w)})
    return both.filter("n_ = 1").drop("n_", "old_")


def added(frontier: DataFrame, urls: DataFrame) -> int:
    """How many canonical URLs enqueue() would add to the frontier."""
    return urls.select(canonical_url(F.col("url")).alias("canonical_url")).distinct().join(frontier, "canonical_url", "left_anti").count()


def pop(frontier: DataFrame, n: int, now: Column, source: str | None = None) -> DataFrame:
    """The n items to crawl next, as in_progress: due ones by priority, due time and URL."""
    ready = frontier.filter(is_due(F.col("recrawl_after"), now) & (F.col("status") != "in_progress"))
    if source:
        ready = ready.filter(F.col("source") == source.strip().lower())
    return ready.orderBy("priority", F.col("recrawl_after").asc_nulls_first(), "canonical_url").limit(n).withColumn("status", F.lit("in_progress"))


def completed(items: DataFrame, now: Column, hours: int = 24) -> DataFrame:
    return items.withColumns({"status": F.lit("completed"), "recrawl_after": later(now, F.lit(hours * 60)), "error_count": F.lit(0)})


def failed(items: DataFrame, now: Column, base: int = 30) -> DataFrame:
    n = F.col("error_count") + 1
    return items.withColumns({"status": F.lit("failed"), "error_count": n, "recrawl_after": later(now, backoff_minutes(n, base))})


def frontier_stats(frontier: DataFrame) -> DataFrame:
    states = ("pending", "in_progress", "completed", "failed")
    return frontier.agg(F.count("*").alias("total_urls"), *[F.count_if(F.col("status") == s).alias(s) for s in states])


def missed_state(missed: Column) -> Column:
    """Lifecycle after so many missed crawls in a row (one or more)."""
    return ordered([(missed >= 10, F.lit("DISCONTINUED")), (missed >= 3, F.lit("UNAVAILABLE")), (missed >= 1, F.lit("STALE"))])


def lifecycle(crawls: DataFrame, key: str, order: list[str], ok: Column, in_stock: Column) -> DataFrame:
    """crawls with missed_crawls and lifecycle_status after each, in order: a success resets the count, a miss adds one (gaps and islands)."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    c = crawls.withColumns({"ok_": ok, "island_": F.count_if(ok).over(w)})
    run = Window.partitionBy(key, "island_").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    c = c.withColumn("missed_crawls", F.count_if(~F.col("ok_")).over(run))
    status = F.when(F.col("ok_"), F.when(in_stock, F.lit("ACTIVE")).otherwise(F.lit("UNAVAILABLE"))).otherwise(missed_state(F.col("missed_crawls")))
    return c.withColumn("lifecycle_status", status).drop("ok_", "island_")


def profiles(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(fixed.PROFILES, "profile string, max_products_per_source int, product_batch_size int, max_reviews_per_product int, max_concurrency int, minimum_request_delay_seconds double")


def collection_plan(requests: DataFrame) -> DataFrame:
    """requests (source, category, profile, available_products) with the run's bounds; unknown profiles and negative numbers fail."""
    p = F.broadcast(profiles(requests.sparkSession))
    r = requests.join(p, "profile", "left")
    sound = F.when(F.col("max_products_per_source").isNull(), F.raise_error(F.concat(F.lit("unsupported collection profile: "), F.col("profile"))).cast("int")).when(F.col("available_products") < 0, F.raise_error(F.lit("available products cannot be negative")).cast("int")).otherwise(F.col("max_products_per_source"))
    planned = F.least(F.col("available_products"), sound)
    r = r.withColumn("planned_products", planned)
    reviews = F.col("planned_products") * F.col("max_reviews_per_product")
    return r.withColumns({"maximum_review_records": reviews, "maximum_total_records": F.col("planned_products") + reviews})


def capped(rows: DataFrame, keys: list[str], order: list[str], n: int) -> DataFrame:
    """The first n rows of each key (a limit as a feature: pages of reviews up to the hard cap)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("n_", F.row_number().over(w)).filter(F.col("n_") <= n).drop("n_")


def taxonomy(spark: SparkSession) -> DataFrame:
    """department, category, label, subcategory, subcategory_label; a row for each subcategory."""
    rows = [(t["department"], code, t["label"], s, label) for code, t in fixed.TAXONOMY.items() for s, label in t["subcategories"].items()]
    return spark.createDataFrame(rows, "department string, category string, label string, subcategory string, subcategory_label string")


def supported(rows: DataFrame) -> DataFrame:
    """rows (retailer, category) with supported: whether that retailer has the category."""
    known = [(r, c) for r, cs in fixed.RETAILER_CATEGORIES.items() for c in cs]
    k = F.broadcast(rows.sparkSession.createDataFrame(known, "r_ string, c_ string"))
    out = rows.join(k, (F.lower(F.trim("retailer")) == F.col("r_")) & (F.lower(F.trim("category")) == F.col("c_")), "left")
    return out.withColumn("supported", F.col("r_").isNotNull()).drop("r_", "c_")


def unsupported_rows(rows: DataFrame) -> DataFrame:
    """Rows (category, subcategory) that aren't in the taxonomy, with the reason: what to put in quarantine."""
    t = F.broadcast(taxonomy(rows.sparkSession).select(F.col("category").alias("c_"), F.col("subcategory").alias("s_")))
    cats = F.broadcast(taxonomy(rows.sparkSession).select(F.col("category").alias("k_")).distinct())
    out = rows.join(cats, F.lower(F.trim("category")) == F.col("k_"), "left").join(t, (F.lower(F.trim("category")) == F.col("c_")) & (F.lower(F.trim("subcategory")) == F.col("s_")), "left")
    reason = ordered([(F.col("k_").isNull(), F.concat(F.lit("unsupported category: "), F.col("category"))), (F.col("subcategory").isNotNull() & F.col("s_").isNull(), F.concat(F.lit("unsupported subcategory: "), F.col("subcategory")))])
    return out.withColumn("reason", reason).filter("reason is not null").drop("k_", "c_", "s_")
