"""Tables as DataFrame rewrites: idempotent upserts, identifiers, price history, runs.

An upsert is a full outer join of the old table with the new rows on the key; write its result as the table's next version.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed


def latest(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last row of each key in the order given; merged before the shuffle, so a key with many rows is no large task."""
    rest = [c for c in rows.columns if c not in keys]
    r = rows.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]), F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])).alias("r_"))
    return r.select(*[F.col(f"`{c}`") if c in keys else F.col("r_").getField(c).alias(c) for c in rows.columns])


def latest_by(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """latest, by columns of rows, which are carried once; what they leave open the other columns decide, so none may be a map."""
    rest = [c for c in rows.columns if c not in (*keys, *order)]
    r = rows.groupBy(*keys).agg(F.max(F.struct(*[F.col(f"`{c}`") for c in (*order, *rest)])).alias("r_"))
    return r.select(*[F.col(f"`{c}`") if c in keys else F.col("r_").getField(c).alias(c) for c in rows.columns])


def first(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("n_", F.row_number().over(w)).filter("n_ = 1").drop("n_")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], *, keep: list[str] = (), default: dict[str, Column] | None = None) -> DataFrame:
    """old with new's rows: those with a new key are added, others replaced but for the columns in keep. new has a row for each key at most.

    default: columns that every row of new gets, also where old has another value.
    """
    marked = new.withColumns({**(default or {}), "new_": F.lit(True)})
    a, b = old.alias("a"), marked.alias("b")
    on = None
    for k in keys:
        c = F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
        on = c if on is None else on & c
    out = []
    for c in old.columns:
        o, n = F.col(f"a.{c}"), F.col(f"b.{c}") if c in marked.columns else F.lit(None)
        out.append((F.coalesce(o, n) if c in (*keys, *keep) else F.when(F.col("b.new_"), n).otherwise(o)).alias(c))
    return a.join(b, on, "full").select(*out)


def upsert_products(old: DataFrame, new: DataFrame) -> DataFrame:
    """By id: all columns of new products; of known ones only model_name, attributes and updated_at change."""
    changing = {"model_name", "attributes", "updated_at"}
    return upsert(old, new, ["id"], keep=[c for c in old.columns if c not in changing])


def upsert_listings(old: DataFrame, new: DataFrame) -> DataFrame:
    """By (source, source_product_id): first_seen_at, brand and source_url stay, missed_crawls returns to 0, lifecycle follows the stock."""
    stock = {"missed_crawls": F.lit(0), "lifecycle_status": F.when(F.col("in_stock"), F.lit("ACTIVE")).otherwise(F.lit("UNAVAILABLE"))}
    return upsert(old, new, ["source", "source_product_id"], keep=["first_seen_at", "brand", "source_url"], default=stock)


def upsert_offers(old: DataFrame, new: DataFrame) -> DataFrame:
    """By (source, source_product_id): the latest offer; title and source_url stay."""
    stock = {"missed_crawls": F.lit(0), "lifecycle_status": F.when(F.col("in_stock"), F.lit("ACTIVE")).otherwise(F.lit("UNAVAILABLE"))}
    return upsert(old, new, ["source", "source_product_id"], keep=["title", "source_url"], default=stock)


def upsert_counts(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """One row: inserted (rows of new whose key old hasn't) and written (all of new)."""
    known = old.select(*[F.col(k).alias(f"{k}_") for k in keys]).withColumn("known_", F.lit(True))
    on = None
    for k in keys:
        c = new[k].eqNullSafe(known[f"{k}_"])
        on = c if on is None else on & c
    return new.join(known, on, "left").agg(F.count_if(F.col("known_").isNull()).alias("inserted"), F.count("*").alias("written"))


def by_id(products: DataFrame, ids: list) -> DataFrame:
    """The products with these ids."""
    return products.filter(F.col("id").isin(ids))


def surrogate(*keys: Column) -> Column:
    return F.xxhash64(*keys)


def identifiers(offers: DataFrame) -> DataFrame:
    """canonical_product_id, identifier_type, identifier_value, source, seq: of offers with cluster_id, source, source_product_id, attributes, seq.

    Amazon's own ids count as ASIN; values of 3 to 64 characters; the first writer of a (type, value) has it.
    """
    a = lambda k: F.trim(F.try_element_at("attributes", F.lit(k)))
    kinds = [("gtin", "GTIN"), ("ean", "EAN"), ("mpn", "MPN"), ("model number", "MPN"), ("item model number", "MPN"), ("asin", "ASIN")]
    found = [F.struct(F.lit("ASIN").alias("t"), F.when(F.lower("source") == "amazon", F.trim("source_product_id")).alias("v"))] + [F.struct(F.lit(t).alias("t"), a(k).alias("v")) for k, t in kinds]
    rows = offers.select(F.col("cluster_id").alias("canonical_product_id"), "source", "seq", F.explode(F.array(*found)).alias("x"))
    rows = rows.filter(F.length("x.v").between(3, 64)).select("canonical_product_id", F.col("x.t").alias("identifier_type"), F.col("x.v").alias("identifier_value"), "source", "seq")
    return first(rows, ["identifier_type", "identifier_value"], [F.col("seq"), F.col("canonical_product_id")]).withColumn("confidence", F.lit(1.0))


def add_identifiers(old: DataFrame, new: DataFrame) -> DataFrame:
    """old with new's identifiers that it hasn't."""
    return old.unionByName(new.select(*old.columns).join(old, ["identifier_type", "identifier_value"], "left_anti"))


OBSERVATIONS = "offer_id string, price_paise long, mrp_paise long, coupon_price_paise long, in_stock boolean, seller string, observed_at timestamp"


def price_observations(listings: DataFrame) -> DataFrame:
    """Append-only price points."""
    return listings.select(F.concat_ws(":", "source", "source_product_id").alias("offer_id"), "price_paise", "mrp_paise", "coupon_price_paise", "in_stock", "seller", "observed_at")


def price_changes(history: DataFrame, keys: list[str], order: list[str], price: str = "price_paise") -> DataFrame:
    """Observations whose price differs from the one before, with previous_paise and change_paise."""
    w = Window.partitionBy(*keys).orderBy(*order)
    h = history.withColumn("previous_paise", F.lag(price).over(w))
    return h.filter(F.col("previous_paise") != F.col(price)).withColumn("change_paise", F.col(price) - F.col("previous_paise"))


def price_as_of(asked: DataFrame, history: DataFrame, keys: list[str], at: str, observed: str, carry: list[str], tie: list[str]) -> DataFrame:
    """asked with the columns in carry of the last observation of its key at or before `at`: one sort of both together, no range join."""
    h = history.select(*keys, F.col(observed).alias("t_"), F.struct(*carry).alias("o_"), *[F.col(c).alias(f"k_{c}") for c in tie], F.lit(0).alias("side_"), F.lit(None).alias("q_"))
    q = asked.select(*keys, F.col(at).alias("t_"), F.lit(None).alias("o_"), *[F.lit(None).alias(f"k_{c}") for c in tie], F.lit(1).alias("side_"), F.struct(*asked.columns).alias("q_"))
    w = Window.partitionBy(*keys).orderBy("t_", "side_", *[f"k_{c}" for c in tie]).rowsBetween(Window.unboundedPreceding, 0)
    both = h.unionByName(q).withColumn("last_", F.last("o_", ignorenulls=True).over(w)).filter("side_ = 1")
    return both.select("q_.*", *[F.col(f"last_.{c}").alias(c) for c in carry])


def finish_runs(runs: DataFrame, finished: DataFrame) -> DataFrame:
    """runs with status, counts, completed_at and duration_seconds (never negative) of those in finished, by id."""
    r = upsert(runs, finished, ["id"], keep=["source", "category", "started_at"])
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    seconds = (micros("completed_at") - micros("started_at")) / 1e6
    return r.withColumn("duration_seconds", F.when(F.col("completed_at").isNotNull(), F.greatest(seconds, F.lit(0.0))))


def lifecycle_distribution(listings: DataFrame) -> DataFrame:
    """lifecycle_status, listings; the four states are there always, others if they occur."""
    known = listings.sparkSession.createDataFrame([(s,) for s in fixed.LIFECYCLES], "lifecycle_status string")
    n = listings.groupBy("lifecycle_status").agg(F.count("*").alias("n"))
    return known.join(n, "lifecycle_status", "full").select("lifecycle_status", F.coalesce("n", F.lit(0)).alias("listings"))


def set_lifecycle(listings: DataFrame, changes: DataFrame) -> DataFrame:
    """listings with lifecycle_status and missed_crawls of changes (source, source_product_id, both columns)."""
    return upsert(listings, changes.join(listings.select("source", "source_product_id"), ["source", "source_product_id"], "left_semi"), ["source", "source_product_id"], keep=[c for c in listings.columns if c not in ("lifecycle_status", "missed_crawls")])
