"""Clustering of listings into canonical variants, and their price analytics.

The rule, over listings in order of seq: a listing joins the first seed that it matches; on the way, the first seed that it would need review with
takes it as a review candidate; a listing with neither becomes a seed. Only seeds' fingerprints are compared.

In set terms: listings of one fingerprint are one node (at its first seq), two nodes have an edge if they match or need review, and the seeds are
the lexicographically first maximal independent set of nodes. It is found in rounds: an undecided node becomes a seed when no earlier undecided node
or seed has an edge to it, and drops out when a seed has. Then each listing looks for the earliest seed before it that matches its
fingerprint. Rounds are written to the shared folder; no block of listings comes together in one task.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.canonical import json_map, json_object, json_string
from ..functions.spread import spread
from .identity import with_fingerprint
from .match import MATCH, REVIEW, candidate_pairs, compare, facts
from .quality import classify


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder's path under spark.checkpoint.dir; only a local session without that setting gets a folder of its own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = _local_dir(spark)
    return f"{base.rstrip('/')}/pricewright/{name}-{uuid.uuid4().hex}"


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """df written under spark.checkpoint.dir and read again."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_dirs: dict[str, str] = {}


def _local_dir(spark: SparkSession) -> str:
    import tempfile

    return _dirs.setdefault(spark.sparkContext.applicationId, "file://" + tempfile.mkdtemp(prefix="pricewright-"))


def first_independent(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """id of the seeds: nodes (id), edges (i, j); order by id."""
    e = edges.select(F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j")).filter("i <> j").distinct()
    e = shared_table(e, "edges")
    touched = e.select(F.col("j").alias("id")).distinct()
    seeds = nodes.select("id").join(touched, "id", "left_anti")  # nothing comes before them
    open_ = touched
    fresh = seeds
    while True:
        e = shared_table(e, "edges")
        out = e.join(fresh.select(F.col("id").alias("i")), "i", "left_semi").select(F.col("j").alias("id")).distinct()
        open_ = shared_table(open_.join(out, "id", "left_anti"), "open")
        if open_.isEmpty():
            return seeds
        # Edges from nodes that are still open; a node without any becomes a seed.
        e = shared_table(e.join(open_.select(F.col("id").alias("i")), "i", "left_semi").join(open_.select(F.col("id").alias("j")), "j", "left_semi").select("i", "j"), "edges")
        fresh = shared_table(open_.join(e.select(F.col("j").alias("id")).distinct(), "id", "left_anti"), "seeds")
        seeds = seeds.union(fresh)
        open_ = open_.join(fresh, "id", "left_anti")


def leader_assign(rows: DataFrame, links: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
    """rows (seq, node) with match_seed and review_seed (nodes); links: (i, j, decision) of nodes, in either direction. node: the first seq of a fingerprint.

    earlier: seeds (id) of runs before, all before the rows and without links to each other; they stay seeds.
    """
    nodes = rows.select(F.col("node").alias("id")).distinct()
    nodes = nodes if earlier is None else nodes.union(earlier.select("id"))
    near = links.filter(F.col("decision").isin(MATCH, REVIEW))
    seeds = shared_table(first_independent(nodes, near), "seeds")
    near = near.union(near.select(F.col("j").alias("i"), F.col("i").alias("j"), "decision")).distinct()
    near = near.join(seeds.select(F.col("id").alias("i")), "i", "left_semi")
    own = rows.join(near.withColumnRenamed("j", "node"), "node").filter("i < seq")
    best = own.groupBy("seq").agg(F.min(F.when(F.col("decision") == MATCH, F.col("i"))).alias("m"), F.min(F.when(F.col("decision") == REVIEW, F.col("i"))).alias("v"))
    out = rows.join(best, "seq", "left")
    seed = (F.col("node") == F.col("seq")) & F.col("m").isNull() & F.col("v").isNull()
    match = F.when(seed, F.col("seq")).otherwise(F.col("m"))
    return out.select("seq", "node", match.alias("match_seed"), F.when(F.col("m").isNull() | (F.col("v") < F.col("m")), F.col("v")).alias("review_seed"))


def leader_reference(decisions: dict[tuple[int, int], str], n: int) -> list[tuple[int | None, int | None]]:
    """The rule as a loop over rows 0..n-1, for tests: (match seed, review seed) of each."""
    seeds: list[int] = []
    out: list[tuple[int | None, int | None]] = []
    for p in range(n):
        match = review = None
        for s in seeds:
            d = decisions.get((s, p), "no_match")
            if d == MATCH:
                match = s
                break
            if d == REVIEW and review is None:
                review = s
        if match is None and review is None:
            seeds.append(p)
            match = p
        out.append((match, review))
    return out


def cluster_id(fp: Column) -> Column:
    """A stable id: the hash of the seed's category, brand, name and attributes as canonical JSON, so that the order of attributes doesn't count."""
    text = json_object({k: json_string(fp[k]) for k in ("category", "brand", "model_name")} | {"attributes": json_map(fp["attributes"])})
    return F.concat(F.lit("clus_"), F.substring(F.sha2(text.cast("binary"), 256), 1, 16))


def seeds_of(reconciled: DataFrame, seeds: DataFrame | None = None) -> DataFrame:
    """id and fp of the seeds after a run, with those from before: what the next batch is compared with."""
    new = reconciled.filter(F.col("seq") == F.col("cluster_seq")).select(F.col("seq").alias("id"), "fp")
    return new if seeds is None else seeds.select("id", "fp").unionByName(new)


def reconcile_batches(batches: list[DataFrame]) -> DataFrame:
    """Listings batch by batch, in order: each is compared with the seeds that are stored so far; the result is that of one run over all."""
    out, seeds = None, None
    for b in batches:
        r = shared_table(reconcile(b, seeds), "batch")
        seeds = shared_table(seeds_of(r, seeds), "seeds")
        out = r if out is None else out.unionByName(r)
    return out


def reconcile(listings: DataFrame, seeds: DataFrame | None = None) -> DataFrame:
    """listings (with seq, the order of ingestion, no two alike) with quality columns, fp, cluster_id and cluster_seq of the cluster joined, and
    review_cluster_id, review_cluster_seq of the one to be reviewed with; all null for rejected listings.

    seeds (id, fp; seeds_of() earlier runs, all with smaller seq): the listings are compared with these and with each other, and with nothing
    else that was there before. Since only seeds are ever compared with, batch after batch gives the clusters of one run over all.
    """
    q = shared_table(with_fingerprint(classify(spread(listings, "seq"))), "listings")
    live = q.filter("quality_status <> 'REJECTED'").select("seq", "fp")
    key = F.sha2(F.to_json("fp"), 256)
    keyed = shared_table(live.select("seq", key.alias("key")), "keys")
    firsts = keyed.groupBy("key").agg(F.min("seq").alias("node"))
    rows = shared_table(keyed.join(firsts, "key").select("seq", "node"), "nodes")
    heads = shared_table(live.join(firsts.select(F.col("node").alias("seq")), "seq", "left_semi").select(F.col("seq").alias("id"), "fp", F.lit(True).alias("fresh")), "heads")
    own = facts(F.col("fp"))
    pairs = heads.select(F.col("id").alias("i"), F.col("id").alias("j"), F.col("fp").alias("l"), F.col("fp").alias("r"), own.alias("lf_"), own.alias("rf_"))
    if seeds is not None:
        seeds = seeds.select("id", "fp", F.lit(False).alias("fresh"))
        # A seed's fingerprint that comes again is paired with it, whatever blocks say.
        old = seeds.select(F.col("id").alias("i"), F.col("fp").alias("l"), own.alias("lf_"), key.alias("key"))
        again = old.join(heads.select(F.col("id").alias("j"), F.col("fp").alias("r"), own.alias("rf_"), key.alias("key")), "key")
        pairs = pairs.unionByName(again.select(*pairs.columns))
        heads = shared_table(heads.unionByName(seeds), "heads")
    pairs = pairs.unionByName(candidate_pairs(heads))
    links = shared_table(compare(pairs).select("i", "j", "decision").filter(F.col("decision") != "no_match"), "links")
    placed = leader_assign(rows, links, seeds)
    ids = heads.select(F.col("id").alias("s"), cluster_id(F.col("fp")).alias("cid"))
    named = lambda c, a, b: ids.select(F.col("s").alias(c), F.col("cid").alias(a), F.col("s").alias(b))
    placed = placed.join(named("match_seed", "cluster_id", "cluster_seq"), "match_seed", "left").join(named("review_seed", "review_cluster_id", "review_cluster_seq"), "review_seed", "left")
    return q.join(placed.select("seq", "cluster_id", "cluster_seq", "review_cluster_id", "review_cluster_seq"), "seq", "left")


def price_stats(offers: DataFrame, keys: list[str], price: str = "price_paise", source: str = "source", in_stock: str = "in_stock", seq: str = "seq") -> DataFrame:
    """keys, offers, sources, best_price_paise, best_source, max_price_paise, price_spread_paise, savings_paise; multi_source.

    Only offers in stock count, or all if none is. The cheapest, then the earliest, gives best_source.
    """
    stock = F.coalesce(F.col(in_stock), F.lit(False))
    p, s = F.col(price), F.lower(F.trim(F.col(source)))
    pick = lambda on: F.struct(F.min(F.when(on, F.struct(p, F.col(seq), F.col(source).alias("src")))).alias("lo"), F.max(F.when(on, p)).alias("hi"), F.count_if(on).alias("n"))
    g = offers.groupBy(*keys).agg(F.count("*").alias("offers"), F.count_distinct(s).alias("sources"), pick(stock).alias("a"), pick(F.lit(True)).alias("b"))
    x = F.when(F.col("a.n") > 0, F.col("a")).otherwise(F.col("b"))
    g = g.withColumn("x", x)
    best, high = F.col(f"x.lo.{price}"), F.col("x.hi")
    return g.select(*keys, "offers", "sources", best.alias("best_price_paise"), F.col("x.lo.src").alias("best_source"), high.alias("max_price_paise"), (high - best).alias("price_spread_paise"), F.when(F.col("x.n") > 1, high - best).otherwise(F.lit(0).cast("long")).alias("savings_paise"), (F.col("sources") > 1).alias("multi_source"))


def clusters(reconciled: DataFrame) -> DataFrame:
    """A row for each cluster: its seed's fingerprint, offers and review candidates in order, and price analytics."""
    offer = F.struct("seq", *[F.col(c) for c in ("source", "source_product_id", "title", "price_paise", "in_stock", "quality_status", "quality_score")])
    linked = reconciled.filter("cluster_seq is not null")
    seeds = linked.filter("seq = cluster_seq").select("cluster_seq", "cluster_id", "fp.category", "fp.brand", "fp.model_name", "fp.attributes", "fp")
    offers = linked.groupBy("cluster_seq").agg(F.array_sort(F.collect_list(offer)).alias("linked_offers"))
    reviews = reconciled.filter("review_cluster_seq is not null").groupBy(F.col("review_cluster_seq").alias("cluster_seq")).agg(F.array_sort(F.collect_list(offer)).alias("review_candidates"))
    return seeds.join(price_stats(linked, ["cluster_seq"]), "cluster_seq").join(offers, "cluster_seq").join(reviews, "cluster_seq", "left")


def table_view(clusters: DataFrame) -> DataFrame:
    """The clusters of clusters() as texts for a table: names cut to 45 characters, prices in rupees, N/A or - where there is none."""
    capital = lambda c: F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))
    rupees = lambda c: F.concat(F.lit("₹"), F.format_number(c.cast("decimal(20,0)") / 100, 2))
    sources = F.array_join(F.transform("linked_offers", lambda o: capital(o["source"])), ", ")
    return clusters.select(
        "cluster_id", capital(F.col("category")).alias("category"), capital(F.col("brand")).alias("brand"), F.substring("model_name", 1, 45).alias("model"), F.concat(F.size("linked_offers").cast("string"), F.lit(" ("), sources, F.lit(")")).alias("offers"),
        F.coalesce(rupees(F.col("best_price_paise")), F.lit("N/A")).alias("best_price"), F.coalesce(F.when(F.col("best_source") != "", capital(F.col("best_source"))), F.lit("-")).alias("best_source"), F.when(F.col("savings_paise") > 0, rupees(F.col("savings_paise"))).otherwise("-").alias("savings"),
    )


def source_breakdown(reconciled: DataFrame) -> DataFrame:
    """source, collected_count, matched_in_multi_source_cluster, single_source_canonical_count, review_count, rejected_count; by source."""
    multi = reconciled.filter("cluster_seq is not null").groupBy(F.col("cluster_seq").alias("c")).agg((F.count_distinct(F.lower(F.trim("source"))) > 1).alias("multi"))
    r = reconciled.join(multi, F.col("cluster_seq") == F.col("c"), "left")
    n = F.count_if
    return r.groupBy(F.lower(F.trim("source")).alias("source")).agg(
        F.count("*").alias("collected_count"), n(F.col("multi")).alias("matched_in_multi_source_cluster"), n(~F.col("multi")).alias("single_source_canonical_count"),
        n(F.col("review_cluster_seq").isNotNull()).alias("review_count"), n(F.col("quality_status") == "REJECTED").alias("rejected_count"),
    ).orderBy("source")


def report_totals(reconciled: DataFrame) -> DataFrame:
    """One row: total_collected, total_clusters, multi_source_clusters, review_required_count, total_rejected; zeros for no listings."""
    multi = reconciled.filter("cluster_seq is not null").groupBy("cluster_seq").agg((F.count_distinct(F.lower(F.trim("source"))) > 1).alias("multi")).agg(F.count_if("multi").alias("multi_source_clusters"))
    t = reconciled.agg(F.count("*").alias("total_collected"), F.count_if(F.col("seq") == F.col("cluster_seq")).alias("total_clusters"), F.count_if(F.col("review_cluster_seq").isNotNull()).alias("review_required_count"), F.count_if(F.col("quality_status") == "REJECTED").alias("total_rejected"))
    return t.join(multi).select("total_collected", "total_clusters", "multi_source_clusters", "review_required_count", "total_rejected")


