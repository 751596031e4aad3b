"""Queries of discovery, tables, frontier, streams and the whole chain with their SQL, on pages and listings made of the tables' keys."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed, text
from ..operators import cluster, evaluate, ops, store
from ..sources import discovery
from ..sources.labelled_pairs import PAIRS
from .queries import _CANON, _LIFE, query, table
from .sample import columns, field, selects

ALL = (1 << 31) - 1  # a limit that limits nothing


# Units: every row of part, halfway weights too, which round up.
@query("cm_to_inch", "SELECT p_partkey, round((p_size + 13) / 2.54, 1) AS inches, CASE WHEN p_size BETWEEN 1 AND 9 THEN ((p_size * 1000 + p_partkey % 997 + 5) // 10)::DOUBLE / 100 END AS kg FROM part")
def cm_to_inch(spark: SparkSession, d: str) -> DataFrame:
    said = F.concat(F.col("p_size"), F.lit(" kg "), F.col("p_partkey") % 997, F.lit(" g"))
    return table(spark, d, "part").select("p_partkey", text.cm_to_inch(F.col("p_size") + 13, 1).alias("inches"), F.when(F.col("p_size").between(1, 9), text.weight_kg(said)).alias("kg"))


# Discovery.
SITEMAP = {
    "source": field("croma", "amazon", "flipkart"), "word": field("laptop", "MacBook", "phone", "thinkpad-x", "table", step=2), "lastmod": field("2026-01-05", "2026-02-03T10:20:30Z", "2026-13-45", "soon", "", step=3), "freq": field(" daily ", "", "weekly", step=4), "rank": field("0.5", "high", " 1.0 ", step=5),
    "sound": field(1, 1, 1, 1, 1, 1, 0, step=1, shift=2),
}
_URL = """'https://www.' || source || '/' || word || CASE source WHEN 'croma' THEN '/p/' || (300000 + page_id % 600000) WHEN 'amazon' THEN '/dp/B' || lpad((page_id % 1000000000)::VARCHAR, 9, '0') ELSE '/p/itm' || lpad((page_id % 1000000000)::VARCHAR, 13, 'a') END"""


@query("sitemap_parse", f"""WITH p AS (SELECT page_id, {selects(SITEMAP, "page_id")} FROM pages WHERE page_id IS NOT NULL), u AS (SELECT *, {_URL} AS url FROM p WHERE sound = 1)
SELECT url, source, regexp_extract(url, '/(?:p|dp)/(.*)$', 1) AS source_product_id, CASE lastmod WHEN '2026-01-05' THEN epoch(TIMESTAMP '2026-01-05')::BIGINT WHEN '2026-02-03T10:20:30Z' THEN epoch(TIMESTAMP '2026-02-03 10:20:30')::BIGINT END AS lastmod,
  nullif(trim(freq), '') AS changefreq, try_cast(trim(rank) AS DOUBLE) AS priority FROM u WHERE {" OR ".join(f"contains(lower(url), '{w}')" for w in fixed.LAPTOP_URL_WORDS)}""")  # fmt: skip
def sitemap_parse(spark: SparkSession, d: str) -> DataFrame:
    """A sitemap for each page: plain, with an empty or broken time, rank or frequency, or broken as a whole."""
    p = table(spark, d, "pages").filter("page_id is not null").select("page_id", *[c.alias(k) for k, c in columns(SITEMAP, "page_id").items()])
    url = F.expr(_URL.replace("::VARCHAR", "").replace("lpad((page_id % 1000000000)", "lpad(cast(page_id % 1000000000 as string)"))
    tag = lambda k, c: F.concat(F.lit(f"<{k}>"), c, F.lit(f"</{k}>"))
    entry = F.concat(F.lit("<url>"), tag("loc", url), tag("lastmod", F.col("lastmod")), tag("changefreq", F.col("freq")), tag("priority", F.col("rank")), F.lit("</url>"))
    content = F.concat(F.lit('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'), entry, F.when(F.col("sound") == 1, F.lit("</urlset>")).otherwise(F.lit("</url")))
    return discovery.sitemap_items(p.select("source", content.alias("content")), "laptop").withColumn("lastmod", F.unix_timestamp("lastmod"))


@query("sitemap_scan", """WITH p AS (SELECT page_id, CASE WHEN page_id % 10 = 3 THEN 'broken entry' WHEN page_id % 10 = 7 THEN 'no location' END AS reason FROM pages WHERE page_id IS NOT NULL)
SELECT CASE WHEN reason IS NULL THEN 'https://www.croma.com/laptop/p/' || (300000 + page_id % 600000) END AS url, CASE WHEN reason IS NULL THEN (300000 + page_id % 600000)::VARCHAR END AS source_product_id, CASE WHEN reason IS NULL THEN (page_id % 11) / 10.0::DOUBLE END AS priority, reason FROM p""")  # fmt: skip
def sitemap_scan(spark: SparkSession, d: str) -> DataFrame:
    """Sitemap files with an entry for each page, some broken or without a location: what is read and what goes to quarantine are all of them."""
    p = table(spark, d, "pages").filter("page_id is not null")
    k = F.col("page_id")
    loc = F.concat(F.lit("<loc> https://www.croma.com/laptop/p/"), 300_000 + k % 600_000, F.lit(" </loc>"))
    tail = F.concat(F.lit("<priority>"), (k % 11) / 10.0, F.lit("</priority></url>"))
    entry = F.concat(F.lit("<url>"), F.when(k % 10 == 3, F.concat(loc, F.lit("<lastmod>"))).when(k % 10 == 7, F.lit("<loc> </loc>")).otherwise(loc), tail)
    path = cluster.shared_path(spark, "sitemaps")
    p.select(entry.alias("value")).write.option("compression", "gzip").text(path)
    bad = discovery.broken_entries(spark, path, "croma").select(F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("source_product_id"), F.lit(None).cast("double").alias("priority"), "reason")
    return discovery.sitemap_files(spark, path, "croma", "laptop").select("url", "source_product_id", "priority", F.lit(None).cast("string").alias("reason")).unionByName(bad)


def _scan_pages(spark: SparkSession, d: str, host: str, html: str) -> DataFrame:
    return table(spark, d, "pages").filter("page_id is not null").select("page_id", F.lit(f"https://www.{host}/search?q=laptop").alias("url"), F.expr(html).alias("html"))


_ITM = "concat('itm', lpad(cast({n} as string), 13, '0'))"
_ASIN = "concat('B', lpad(cast({n} as string), 9, '0'))"


@query("listing_scan_flipkart", """WITH f AS (SELECT page_id, unnest([0, 2]) AS place, unnest([page_id, page_id // 2]) AS n FROM pages WHERE page_id IS NOT NULL), o AS (SELECT *, row_number() OVER (PARTITION BY n ORDER BY page_id, place) AS r FROM f)
SELECT 'itm' || lpad(n::VARCHAR, 13, '0') AS source_product_id, 'https://flipkart.com/laptop/p/itm' || lpad(n::VARCHAR, 13, '0') || CASE WHEN place = 2 THEN '?pid=X' ELSE '' END AS source_url, place::BIGINT AS place FROM o WHERE r = 1""")  # fmt: skip
def listing_scan_flipkart(spark: SparkSession, d: str) -> DataFrame:
    """Three links a page: a product, an accessory, and a product that other pages have too, with a tracking parameter."""
    link = lambda n, more="": f"""'<a class="x" href="/laptop/p/', {_ITM.format(n=n)}, '{more}">x</a>'"""
    html = f"""concat({link("page_id")}, '<a href="/laptop-sleeve/p/itm9999999999999">y</a>', {link("page_id div 2", "?pid=X&utm_source=z")})"""
    return discovery.listing_scan(_scan_pages(spark, d, "flipkart.com", html), "flipkart", ALL)


@query("listing_scan_amazon", """WITH s AS (SELECT page_id, page_id % 4 = 0 AS by_data, page_id // 3 AS n FROM pages WHERE page_id IS NOT NULL), o AS (SELECT *, row_number() OVER (PARTITION BY n ORDER BY page_id) AS r FROM s),
k AS (SELECT 'B' || lpad(n::VARCHAR, 9, '0') AS source_product_id, 'https://' || CASE WHEN by_data THEN 'www.' ELSE '' END || 'amazon.in/dp/B' || lpad(n::VARCHAR, 9, '0') AS source_url, 0::BIGINT AS place FROM o WHERE r = 1)
SELECT * FROM k UNION ALL SELECT i, NULL, place FROM (VALUES ('BSEED00001', 0::BIGINT), ('BSEED00002', 1::BIGINT)) v(i, place)""")  # fmt: skip
def listing_scan_amazon(spark: SparkSession, d: str) -> DataFrame:
    """Ids in links or in data-asin, some on several pages; seeds at the end."""
    n = _ASIN.format(n="page_id div 3")
    html = f"""case when page_id % 4 = 0 then concat('<div data-asin="', {n}, '"></div>') else concat('<a href="/dp/', {n}, '">x</a>') end"""
    return discovery.listing_scan(_scan_pages(spark, d, "amazon.in", html), "amazon", ALL, seeds=["BSEED00001", "BSEED00002"])


@query("listing_scan_croma", """WITH s AS (SELECT page_id, page_id // 2 AS n FROM pages WHERE page_id IS NOT NULL AND page_id % 5 <> 0), o AS (SELECT *, row_number() OVER (PARTITION BY n ORDER BY page_id) AS r FROM s)
SELECT (300000 + n)::VARCHAR AS source_product_id, 'https://www.croma.com/laptop/p/' || (300000 + n) || '?_price=' || (100 * n) || CASE WHEN page_id % 3 = 0 THEN '&_mrp=' || (200 * n) ELSE '' END AS source_url, 0::BIGINT AS place FROM o WHERE r = 1""")  # fmt: skip
def listing_scan_croma(spark: SparkSession, d: str) -> DataFrame:
    """Products of the page's state, with prices as parameters; state that isn't JSON gives none."""
    n = "(page_id div 2)"
    product = f"""concat('{{"code":"', 300000 + {n}, '","url":"/laptop/p/', 300000 + {n}, '","price":{{"value":', {n}, '}}', case when page_id % 3 = 0 then concat(',"mrp":{{"value":', 2 * {n}, '}}') else ',"mrp":undefined' end, '}}')"""
    html = f"""concat('<script>window.__INITIAL_DATA__={{"plpReducer":{{"plpData":{{"products":[', {product}, case when page_id % 5 = 0 then ']}}}}' else ']}}}}}}' end, ';</script>')"""
    return discovery.listing_scan(_scan_pages(spark, d, "croma.com", html), "croma", ALL)


# Frontier.
def _known(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(a frontier of the even pages, some completed or failed, all pages' URLs)."""
    kind = "canonical_url string, url string, source string, category string, priority int, status string, error_count int, recrawl_after timestamp, seq long"
    urls = lambda p: p.select("url", F.lit("Amazon ").alias("source"), F.lit("laptop").alias("category"), (F.col("page_id") % 3 + 1).cast("int").alias("priority"), F.col("page_id").alias("seq"))
    p = table(spark, d, "pages")
    return ops.enqueue(spark.createDataFrame([], kind), urls(p.filter("page_id % 2 = 0"))), urls(p)


@query("frontier_enqueue", f"SELECT link AS canonical_url, min(page_id % 3 + 1)::INT AS priority, coalesce(arg_min(url, page_id) FILTER (page_id % 2 = 0), arg_min(url, page_id)) AS url FROM {_CANON} JOIN pages USING (page_id) GROUP BY link")
def frontier_enqueue(spark: SparkSession, d: str) -> DataFrame:
    """All pages onto a frontier that has half of them: the first row stays, with the best priority."""
    return ops.enqueue(*_known(spark, d)).select("canonical_url", "priority", "url")


@query("frontier_added", f"SELECT count(*)::BIGINT AS added FROM (SELECT link FROM {_CANON} GROUP BY link HAVING count(*) FILTER (page_id % 2 = 0) = 0)")
def frontier_added(spark: SparkSession, d: str) -> DataFrame:
    return spark.createDataFrame([(ops.added(*_known(spark, d)),)], "added long")


@query("frontier_done", f"""WITH f AS (SELECT link, min(page_id) AS k FROM {_CANON} WHERE page_id % 2 = 0 GROUP BY link)
SELECT link AS canonical_url, CASE WHEN k % 4 = 0 THEN 'completed' ELSE 'failed' END AS status, CASE WHEN k % 4 = 0 THEN 0 ELSE k % 7 + 1 END::INT AS error_count, CASE WHEN k % 4 = 0 THEN 1440 ELSE 30 * 2 ** least(k % 7, 4) END::BIGINT AS minutes FROM f""")
def frontier_done(spark: SparkSession, d: str) -> DataFrame:
    """Crawls that succeed wait a day; those that fail wait longer each time."""
    now = F.lit("2026-01-01").cast("timestamp")
    f = _known(spark, d)[0].withColumn("error_count", (F.col("seq") % 7).cast("int"))
    out = ops.completed(f.filter("seq % 4 = 0"), now).unionByName(ops.failed(f.filter("seq % 4 <> 0"), now))
    return out.select("canonical_url", "status", "error_count", ((F.unix_timestamp("recrawl_after") - F.unix_timestamp(now)) / 60).cast("long").alias("minutes"))


# Tables.
def _offers(spark: SparkSession, d: str, half: int) -> DataFrame:
    k = F.col("p_partkey")
    return table(spark, d, "part").filter(k % 2 == half).select(
        F.concat(F.lit("s"), (k - half) % 3).alias("source"), F.expr("p_partkey div 2").cast("string").alias("source_product_id"), F.concat(F.lit("title "), k).alias("title"), F.concat(F.lit("url "), k).alias("source_url"), (k * 100).alias("price_paise"), (k % 4 != 1).alias("in_stock"),
        F.lit(5).alias("missed_crawls"), F.lit("STALE").alias("lifecycle_status"),
    ).filter((k % 10 != 0) if half == 0 else (k % 14 != 1))


@query("offer_upsert", """WITH o AS (SELECT p_partkey // 2 AS n, * FROM part WHERE p_partkey % 2 = 0 AND p_partkey % 10 <> 0), w AS (SELECT p_partkey // 2 AS n, * FROM part WHERE p_partkey % 2 = 1 AND p_partkey % 14 <> 1)
SELECT 's' || (2 * n % 3) AS source, n::VARCHAR AS source_product_id, 'title ' || coalesce(o.p_partkey, w.p_partkey) AS title, 'url ' || coalesce(o.p_partkey, w.p_partkey) AS source_url, (100 * coalesce(w.p_partkey, o.p_partkey))::BIGINT AS price_paise, coalesce(w.p_partkey, o.p_partkey) % 4 <> 1 AS in_stock,
  CASE WHEN w.n IS NULL THEN 5 ELSE 0 END AS missed_crawls, CASE WHEN w.n IS NULL THEN 'STALE' WHEN w.p_partkey % 4 <> 1 THEN 'ACTIVE' ELSE 'UNAVAILABLE' END AS lifecycle_status FROM o FULL JOIN w USING (n)""")  # fmt: skip
def offer_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Odd parts' offers onto even parts' ones: title and URL stay, the rest is the new offer's."""
    return store.upsert_offers(_offers(spark, d, 0), _offers(spark, d, 1))


@query("upsert_counts", """WITH o AS (SELECT p_partkey // 2 AS n FROM part WHERE p_partkey % 2 = 0 AND p_partkey % 10 <> 0), w AS (SELECT p_partkey // 2 AS n FROM part WHERE p_partkey % 2 = 1 AND p_partkey % 14 <> 1)
SELECT count(*) FILTER (o.n IS NULL)::BIGINT AS inserted, count(*)::BIGINT AS written FROM w LEFT JOIN o USING (n)""")
def upsert_counts(spark: SparkSession, d: str) -> DataFrame:
    return store.upsert_counts(_offers(spark, d, 0), _offers(spark, d, 1), ["source", "source_product_id"])


@query("lifecycle_update", "SELECT 's' || (p_partkey % 3) AS source, (p_partkey // 2)::VARCHAR AS source_product_id, 'title ' || p_partkey AS title, CASE WHEN p_partkey % 6 = 0 THEN 'DISCONTINUED' ELSE 'STALE' END AS lifecycle_status, CASE WHEN p_partkey % 6 = 0 THEN 12 ELSE 5 END AS missed_crawls FROM part WHERE p_partkey % 2 = 0 AND p_partkey % 10 <> 0")
def lifecycle_update(spark: SparkSession, d: str) -> DataFrame:
    """State and count of some offers change, nothing else; changes of unknown offers are no new ones."""
    old = _offers(spark, d, 0)
    some = old.filter(F.col("price_paise") % 600 == 0).select("source", "source_product_id", F.lit("DISCONTINUED").alias("lifecycle_status"), F.lit(12).alias("missed_crawls"))
    unknown = some.withColumn("source", F.lit("nowhere"))
    return store.set_lifecycle(old, some.unionByName(unknown)).select("source", "source_product_id", "title", "lifecycle_status", "missed_crawls")


@query("product_lookup", "SELECT p_partkey AS id, p_name FROM part WHERE p_partkey IN (1, 77, 500)")
def product_lookup(spark: SparkSession, d: str) -> DataFrame:
    """A point lookup, which the Parquet scan takes as a filter."""
    return store.by_id(table(spark, d, "part").select(F.col("p_partkey").alias("id"), "p_name"), [1, 77, 500, -1])


# Streams.
@query("lifecycle_stream", f"{_LIFE}, e AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n, count(*) OVER (PARTITION BY user_id) AS crawls FROM s) SELECT user_id::VARCHAR AS listing, status AS lifecycle_status, missed::INT AS missed_crawls, crawls::BIGINT AS crawls FROM e WHERE n = 1")
def lifecycle_stream(spark: SparkSession, d: str) -> DataFrame:
    """The streaming form of lifecycle_state, run over the events once: the last state of each user, as the stream's last batch wrote it."""
    from ..streaming.pipeline import lifecycle_stream as run

    e = table(spark, d, "events")
    crawls = spark.readStream.schema(e.schema).parquet(f"{d}/events.parquet*").select(
        F.col("user_id").cast("string").alias("listing"), F.col("event_id").alias("crawl_id"), F.col("ts").alias("observed_at"), (F.col("event_type") != "error").alias("ok"), (F.col("event_type") != "click").alias("in_stock"),
    )
    path = cluster.shared_path(spark, f"states-{uuid.uuid4().hex}")

    def write(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/states/batch={n}")  # a batch that comes again writes the same folder

    run(crawls).writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    states = spark.read.schema("listing string, lifecycle_status string, missed_crawls int, crawls long, batch long").parquet(f"{path}/states")
    return store.latest(states, ["listing"], [F.col("batch")]).drop("batch")


# The whole chain.
def _decided(category: str, want: str, a: str) -> str:
    """What the published accuracy implies: phones that ought to match fail on the network, or lack a chip."""
    if category == "mobile" and want == "match":
        return "review" if "iphone" in a.lower() else "no_match"
    return want


_PAIR_ROWS = ", ".join("(" + ", ".join("'" + x.replace("'", "''") + "'" for x in (c, w, a, b, _decided(c, w, a))) + ")" for c, w, a, b in PAIRS)


@query("labelled_pairs", f"SELECT p_partkey AS id, category, expected, left_title, right_title, decision FROM part JOIN (SELECT *, row_number() OVER () - 1 AS n FROM (VALUES {_PAIR_ROWS}) v(category, expected, left_title, right_title, decision)) ON n = p_partkey % {len(PAIRS)}")
def labelled_pairs(spark: SparkSession, d: str) -> DataFrame:
    """The matcher's decisions on labelled pairs of titles, one for each part."""
    names = ("category", "expected", "left_title", "right_title")
    picked = F.element_at(F.array(*[F.struct(*[F.lit(x).alias(n) for n, x in zip(names, p, strict=True)]) for p in PAIRS]), (F.col("p_partkey") % len(PAIRS) + 1).cast("int"))
    pairs = table(spark, d, "part").select(F.col("p_partkey").alias("id"), picked.alias("p")).select("id", "p.*")
    return evaluate.decide(pairs).drop("confidence", "reason")


@query("reconcile_catalog", """WITH o AS (SELECT p_partkey AS seq, 's' || p_partkey % 3 AS source, p_partkey // 5 AS g, 5000000 + 997 * (p_partkey % 1000) AS price, p_partkey % 4 <> 0 AS in_stock FROM part WHERE p_partkey % 11 <> 0),
l AS (SELECT *, count(*) FILTER (in_stock) OVER (PARTITION BY g) AS live FROM o), s AS (SELECT * FROM l WHERE in_stock OR live = 0),
t AS (SELECT g, count(*) AS n, count(DISTINCT source) AS m, min(seq) AS cluster_seq FROM o GROUP BY g),
p AS (SELECT g, min(price) AS lo, max(price) AS hi, count(*) AS k, arg_min(source, (price, seq)) AS best FROM s GROUP BY g)
SELECT cluster_seq, n::BIGINT AS offers, m::BIGINT AS sources, lo::BIGINT AS best_price_paise, best AS best_source, hi::BIGINT AS max_price_paise, (hi - lo)::BIGINT AS price_spread_paise, CASE WHEN k > 1 THEN hi - lo ELSE 0 END::BIGINT AS savings_paise, m > 1 AS multi_source FROM t JOIN p USING (g)""")  # fmt: skip
def reconcile_catalog(spark: SparkSession, d: str) -> DataFrame:
    """Gate, fingerprints, matching, clusters, best prices: five parts share an identifier; each eleventh is an accessory and is rejected."""
    c = cluster.clusters(cluster.reconcile(_catalog(spark, d)))
    return c.select("cluster_seq", "offers", "sources", "best_price_paise", "best_source", "max_price_paise", "price_spread_paise", "savings_paise", "multi_source")


@query("reconcile_increments", """WITH o AS (SELECT p_partkey AS seq, p_partkey // 5 AS g FROM part WHERE p_partkey % 11 <> 0), s AS (SELECT seq, min(seq) OVER (PARTITION BY g) AS cluster_seq FROM o)
SELECT p_partkey AS seq, cluster_seq FROM part LEFT JOIN s ON p_partkey = seq""")  # fmt: skip
def reconcile_increments(spark: SparkSession, d: str) -> DataFrame:
    """The catalog in three batches, each against the seeds stored so far: clusters reach over batches, as in one run over all."""
    listings = cluster.shared_table(_catalog(spark, d), "catalog")
    ends = listings.agg(F.min("seq"), F.max("seq")).first()
    lo, third = ends[0] or 0, ((ends[1] or 0) - (ends[0] or 0)) // 3 + 1
    parts = [listings.filter((F.col("seq") >= lo + k * third) & (F.col("seq") < lo + (k + 1) * third)) for k in range(3)]
    return cluster.reconcile_batches(parts).select("seq", "cluster_seq")


def _catalog(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    group = F.expr("p_partkey div 5")
    title = F.concat(F.element_at(F.array(*[F.lit(x) for x in ("Lenovo ThinkPad", "HP Victus", "Dell Inspiron 3520", "Acer Nitro V 15", "ASUS Zenbook")]), (group % 5 + 1).cast("int")), F.lit(" "), F.element_at(F.array(*[F.lit(x) for x in (8, 16, 24, 32)]), (F.expr("p_partkey div 25") % 4 + 1).cast("int")), F.lit("GB RAM "), F.element_at(F.array(*[F.lit(x) for x in (256, 512, 1024)]), (F.expr("p_partkey div 100") % 3 + 1).cast("int")), F.lit("GB"), F.when(k % 11 == 0, F.lit(" laptop bag")).otherwise(F.lit("")))
    l = table(spark, d, "part").select(k.alias("seq"), F.lit("laptop").alias("category"), F.concat(F.lit("s"), k % 3).alias("source"), F.concat(F.lit("p"), k).alias("source_product_id"), title.alias("title"), (5_000_000 + 997 * (k % 1000)).alias("price_paise"), (k % 4 != 0).alias("in_stock"), F.concat(F.lit("G"), group).alias("gtin"))
    return l.withColumns({"brand": text.title_brand(F.col("title")), "model_name": F.col("title"), "source_url": F.lit(""), "attributes": F.create_map().cast("map<string,string>")})


@query("report_totals", "WITH o AS (SELECT p_partkey // 5 AS g, p_partkey % 3 AS s, p_partkey % 11 = 0 AS bad FROM part), c AS (SELECT g, count(DISTINCT s) > 1 AS multi FROM o WHERE NOT bad GROUP BY g) SELECT (SELECT count(*) FROM o)::BIGINT AS total_collected, count(*)::BIGINT AS total_clusters, count(*) FILTER (multi)::BIGINT AS multi_source_clusters, 0::BIGINT AS review_required_count, (SELECT count(*) FILTER (bad) FROM o)::BIGINT AS total_rejected FROM c")
def report_totals(spark: SparkSession, d: str) -> DataFrame:
    return cluster.report_totals(cluster.reconcile(_catalog(spark, d)))
