"""The main jobs: raw records to tables, and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import cluster, identity, ops, store
from ..sources import discovery, retail
from ..streaming.ledger import Ledger, Tables

PRODUCTS = "id string, category string, brand string, model_name string, family string, chip string, ram_gb int, storage_gb int, screen_size_inches double, gpu_model string, attributes map<string,string>, updated_at timestamp"
LISTINGS = "source string, source_product_id string, canonical_product_id string, source_url string, title string, brand string, model_name string, quality_status string, quality_score int, quality_flags array<string>, in_stock boolean, lifecycle_status string, missed_crawls int, first_seen_at timestamp, last_seen_at timestamp"
OFFERS = "source string, source_product_id string, canonical_product_id string, source_url string, title string, price_paise long, mrp_paise long, coupon_price_paise long, in_stock boolean, lifecycle_status string, missed_crawls int, seller string, rating double, review_count int, observed_at timestamp"
IDENTIFIERS = "canonical_product_id string, identifier_type string, identifier_value string, source string, confidence double"


def accepted(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(raw records to parse, those for quarantine with the reason): missing ids, unknown categories and hosts, ids that come twice.

    Every record is in one of the two. A record without a source, an id, a category or a URL goes to quarantine.
    """
    keys = ["source", "source_product_id"]
    twice = raw.filter(F.col(keys[0]).isNotNull() & F.col(keys[1]).isNotNull()).groupBy(*keys).agg(F.count("*").alias("n_")).filter("n_ > 1")
    r = raw.join(twice, keys, "left")
    known = ops.taxonomy(raw.sparkSession).select("category").distinct()
    r = r.join(F.broadcast(known.withColumnRenamed("category", "k_")), F.lower(F.trim("category")) == F.col("k_"), "left")
    missing = F.col("source").isNull() | F.col("source_product_id").isNull()
    reason = F.when(missing, "missing id").when(F.col("k_").isNull(), "unsupported category").when(~discovery.allowed_host(F.col("source_url"), F.col("source")), "host not allowed").when(F.col("n_") > 1, "duplicate id")
    r = r.withColumn("reason", reason).drop("n_", "k_")
    return r.filter("reason is null").drop("reason"), r.filter("reason is not null")


def reconcile_raw(raw: DataFrame) -> DataFrame:
    """Raw records (with seq) through parsing, gate and clustering."""
    return cluster.reconcile(retail.parse_listings(raw))


def empty_tables(spark) -> dict[str, DataFrame]:  # noqa: ANN001
    kinds = {"products": PRODUCTS, "retailer_products": LISTINGS, "offers": OFFERS, "product_identifiers": IDENTIFIERS}
    return {k: spark.createDataFrame([], s) for k, s in kinds.items()}


def next_tables(tables: dict[str, DataFrame], reconciled: DataFrame, now: str) -> dict[str, DataFrame]:
    """The tables' next versions after a run, with price_observations to append. Running twice gives the same tables."""
    at = F.lit(now).cast("timestamp")
    linked = reconciled.filter("cluster_id is not null").withColumn("canonical_product_id", F.col("cluster_id"))
    seeds = linked.filter("seq = cluster_seq").select(F.col("cluster_id").alias("id"), *[F.col(f"fp.{c}") for c in ("category", "brand", "model_name", "family", "chip", "ram_gb", "storage_gb", "screen_size_inches", "gpu_model", "attributes")], "seq").withColumn("updated_at", at)
    seeds = store.first(seeds, ["id"], [F.col("seq")]).drop("seq")
    last = store.latest(linked, ["source", "source_product_id"], [F.col("observed_at"), F.col("seq")])
    last = last.withColumns({"lifecycle_status": F.lit(""), "missed_crawls": F.lit(0), "first_seen_at": F.col("observed_at").cast("timestamp"), "last_seen_at": F.col("observed_at").cast("timestamp"), "observed_at": F.col("observed_at").cast("timestamp")})
    pick = lambda kind: last.select(*[F.col(x.split(" ", 1)[0]) for x in kind.replace(", ", ",").split(",") if " " in x])
    fresh = store.identifiers(linked.withColumn("attributes", F.col("attributes"))).drop("seq")
    return {
        "products": store.upsert_products(tables["products"], seeds), "retailer_products": store.upsert_listings(tables["retailer_products"], pick(LISTINGS)), "offers": store.upsert_offers(tables["offers"], pick(OFFERS)),
        "product_identifiers": store.add_identifiers(tables["product_identifiers"], fresh), "price_observations": store.price_observations(linked),
    }


OBSERVED = ("price_observations", "seeds")


def catalog(spark, path: str) -> Ledger:  # noqa: ANN001
    """The tables under a ledger, with price observations and the clusters' seeds, whose rows are only added."""
    kinds = {"products": PRODUCTS, "retailer_products": LISTINGS, "offers": OFFERS, "product_identifiers": IDENTIFIERS, "price_observations": store.OBSERVATIONS, "seeds": f"id long, fp struct<{identity.FINGERPRINT.replace(' ', ':').replace(',:', ', ')}>"}
    return Ledger(spark, path, kinds, added=OBSERVED)


def apply_batch(tables: Tables, listings: DataFrame, now: str) -> Tables:
    """The tables after a batch of listings (seq after all earlier ones), which is compared with the stored seeds only: for Ledger.apply_once or Ledger.sink."""
    reconciled = cluster.shared_table(cluster.reconcile(listings, tables["seeds"]), "reconciled")
    return next_tables(tables, reconciled, now) | {"seeds": cluster.seeds_of(reconciled)}


def write_report(reconciled: DataFrame, path: str) -> None:
    """Totals, sources and clusters as JSON in folders of their own."""
    cluster.report_totals(reconciled).write.mode("overwrite").json(f"{path}/totals")
    cluster.source_breakdown(reconciled).write.mode("overwrite").json(f"{path}/sources")
    cluster.clusters(reconciled).drop("fp").write.mode("overwrite").json(f"{path}/clusters")


def discover_sitemap(maps: DataFrame, source: str, sitemap_url: str, limit: int = 100, category: str = "laptop") -> dict:
    """The freshest `limit` products of a landed sitemap; maps: source, sitemap_url, content."""
    own = maps.filter((F.col("source") == source) & (F.col("sitemap_url") == sitemap_url))
    ids = [r.source_product_id for r in discovery.references(discovery.sitemap_items(own, category), category, limit).collect()]
    return {"source": source, "sitemap_url": sitemap_url, "category": category, "discovered_count": len(ids), "product_ids": ids}
