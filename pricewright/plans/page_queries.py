"""Queries of page parsing and of the jobs with their SQL: pages are put together of fragments, for each of which it is known what it says."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed, text
from ..functions.spread import spread
from ..operators import cluster, reviews, store
from ..sources import discovery, retail
from . import jobs
from .queries import query, table
from .sample import Field, columns, field, selects
from .table_queries import SITEMAP, _URL, _catalog


def _parts(step: int, *rows: tuple, shift: int = 0) -> tuple[Field, ...]:
    """For rows of (fragment, what it says, ...): a field of each."""
    return tuple(field(*x, step=step, shift=shift) for x in zip(*rows, strict=True))


def _price(tag: str, amount: str) -> str:
    return f'<div class="{tag}">{amount}</div>'


# Amazon: titles, prices, list prices, stock, sellers, ratings, specifications.
A_TITLE = _parts(1, ('<span id="productTitle"> HP  15 Laptop </span>', "HP 15 Laptop", "Hp", None), ('<h1 id="title">Lenovo V15</h1>', "Lenovo V15", "Lenovo", None), ('<meta property="og:title" content="Acer Aspire Lite"/>', "Acer Aspire Lite", "Acer", None), ("<title>Dell 14 : Amazon</title>", "Dell 14", "Dell", None),
                 ('<script type="application/ld+json">{"@type":"Product","name":"ASUS Vivobook","offers":{"price":"45,000"}}</script>', "ASUS Vivobook", "Asus", 4500000), ("", None, None, None))
A_PRICE = _parts(2, ('<span class="a-price"><span class="a-offscreen">₹39,990.00</span></span>', 3999000), ('<input id="priceValue" value="54,990"/>', 5499000), ("<p>Deal ₹12,345.50 only</p>", 1234550), ("", None), ('<span class="a-price"><span class="a-offscreen">8% off</span></span>', None))
A_MRP = _parts(3, ('<span class="basisPrice"><span class="a-offscreen">₹64,990</span></span>', 6499000), ("", None), ("", None))
A_STOCK = _parts(4, ('<div id="availability"><span>In stock</span></div>', 1), ('<div id="availability"><span> Currently unavailable. </span></div>', 0), ("", 1))
A_SELLER = _parts(5, ('<a id="sellerProfileTriggerId">Retail  Net</a>', "Retail Net"), ("", None))
A_RATING = _parts(3, ('<span class="a-icon-alt">4.3 out of 5 stars</span>', 4.3), ("", None), shift=1)
A_REVIEWS = _parts(7, ('<span id="acrCustomerReviewText">1,234 ratings</span>', 1234), ("", None))
_TECH = '<table id="productDetails_techSpec_section_1">{}</table>'
_ROW = "<tr><th>{}</th><td>{}</td></tr>"
A_SPECS = _parts(
    2, (_TECH.format(_ROW.format("RAM", "16 GB") + _ROW.format("Model Name", "X1") + _ROW.format("ASIN", "B0SPEC")), "16", "X1", None, "B0SPEC", 1), (_TECH.format(_ROW.format("RAM Size", "8 GB") + _ROW.format("Brand", "MSI") + _ROW.format("Customer Support Number", "1800 11")), "8", None, "MSI", None, 0), ("", None, None, None, None, 0), shift=1,
)
A_LINK = _parts(3, ("https://www.amazon.in/dp/X?_price=777700", 777700), ("https://www.amazon.in/dp/X", None), shift=2)
AMAZON = {"f_title": A_TITLE[0], "f_price": A_PRICE[0], "f_mrp": A_MRP[0], "f_stock": A_STOCK[0], "f_seller": A_SELLER[0], "f_rating": A_RATING[0], "f_reviews": A_REVIEWS[0], "f_specs": A_SPECS[0]}
AMAZON_SAYS = {"title": A_TITLE[1], "known": A_TITLE[2], "ld": A_TITLE[3], "price": A_PRICE[1], "mrp": A_MRP[1], "stock": A_STOCK[1], "seller": A_SELLER[1], "rating": A_RATING[1], "reviews": A_REVIEWS[1], "ram": A_SPECS[1], "model": A_SPECS[2], "said": A_SPECS[3], "asin": A_SPECS[4], "url": A_LINK[1]}


def _listings(spark: SparkSession, d: str, source: str, fragments: dict[str, Field], link: Field, made: Column | None = None) -> DataFrame:
    p = spread(table(spark, d, "part").select("p_partkey"), "p_partkey").withColumns(columns(fragments) | {"source_url": link.spark("p_partkey")})
    body = F.concat_ws("", *fragments) if made is None else made
    raw = p.select(F.lit(source).alias("source"), F.concat(F.lit("p"), F.col("p_partkey")).alias("source_product_id"), F.lit("laptop").alias("category"), F.lit(None).cast("string").alias("subcategory"), "source_url", F.lit("2026-01-01T00:00:00Z").alias("observed_at"), F.concat(F.lit("<html><body>"), body, F.lit("</body></html>")).alias("html"))
    return retail.parse_listings(raw)


_COMMON = ("source_product_id", "title", "brand", "model_name", "price_paise", "mrp_paise", "in_stock", "seller", "rating", "review_count")


@query("parse_amazon", f"""WITH s AS (SELECT 'p' || p_partkey AS source_product_id, {selects(AMAZON_SAYS)} FROM part), t AS (SELECT *, coalesce(title, nullif(trim(concat_ws(' ', said, model)), ''), 'Amazon Product ' || source_product_id) AS name FROM s)
SELECT source_product_id, name AS title, CASE WHEN said IS NOT NULL THEN 'Msi' WHEN known IS NOT NULL THEN known ELSE string_split(name, ' ')[1] END AS brand, coalesce(model, name) AS model_name, coalesce(price, mrp, ld, url, 0)::BIGINT AS price_paise, mrp::BIGINT AS mrp_paise,
  stock = 1 AS in_stock, seller, rating, reviews AS review_count, ram AS ram_gb, asin, NULL::VARCHAR AS contact FROM t""")  # fmt: skip
def parse_amazon(spark: SparkSession, d: str) -> DataFrame:
    l, a = _listings(spark, d, "amazon", AMAZON, A_LINK[0]), lambda k: F.try_element_at("attributes", F.lit(k))
    return l.select(*_COMMON, a("ram_gb").alias("ram_gb"), a("asin").alias("asin"), a("customer support number").alias("contact"))


F_TITLE = _parts(1, ('<h1 class="VU-ZEz">HP 15s Laptop</h1>', "HP 15s Laptop", "Hp"), ('<span class="B_NuCI">Lenovo V15 Online at Best Price On Flipkart.com</span>', "Lenovo V15", "Lenovo"), ('<meta property="og:title" content="Acer Aspire"/>', "Acer Aspire", "Acer"), ("<title>Dell 14 - Buy | Flipkart</title>", "Dell 14", "Dell"), ("", None, "Flipkart"))
F_PRICE = _parts(2, (_price("Nx9bqj", "₹51,990"), 5199000), (_price("_30jeq3", "₹45,000"), 4500000), ("", None))
F_MRP = _parts(3, ('<div class="yRaY8j">₹<!-- -->60,000</div>', 6000000), (_price("_3I9_wc", "₹46,000"), 4600000), ("", None))
F_STOCK = _parts(4, ('<div class="_16FRp0">Sold Out</div>', 0), ("", 1), ("", 1))
F_SELLER = _parts(5, ('<div id="sellerName"><span><span>RetailNet</span></span></div>', "RetailNet"), ("", None))
F_RATING = _parts(3, (_price("XQDdHH", "4.2"), 4.2), ("", None), shift=2)
F_REVIEWS = _parts(2, ('<span class="Wphh3N"><span>1,200 Ratings &amp; 345 Reviews</span></span>', 345), ("", None), shift=1)
_TR = '<tr class="row"><td>{}</td><td>{}</td></tr>'
F_SPECS = _parts(3, ("<table>" + _TR.format("RAM", "16 GB") + _TR.format("Model Name", "Y7") + "</table>", "16", "Y7"), ("<table>" + _TR.format("System Memory", "32 GB") + "</table>", "32", None), ("", None, None), shift=1)
F_LINK = _parts(4, ("https://www.flipkart.com/p/itm1?_price=888800", 888800), ("https://www.flipkart.com/p/itm1", None), shift=1)
FLIPKART = {"f_title": F_TITLE[0], "f_price": F_PRICE[0], "f_mrp": F_MRP[0], "f_stock": F_STOCK[0], "f_seller": F_SELLER[0], "f_rating": F_RATING[0], "f_reviews": F_REVIEWS[0], "f_specs": F_SPECS[0]}
FLIPKART_SAYS = {"title": F_TITLE[1], "known": F_TITLE[2], "price": F_PRICE[1], "mrp": F_MRP[1], "stock": F_STOCK[1], "seller": F_SELLER[1], "rating": F_RATING[1], "reviews": F_REVIEWS[1], "ram": F_SPECS[1], "model": F_SPECS[2], "url": F_LINK[1]}


@query("parse_flipkart", f"""WITH s AS (SELECT 'p' || p_partkey AS source_product_id, {selects(FLIPKART_SAYS)} FROM part), t AS (SELECT *, coalesce(title, 'Flipkart Product ' || source_product_id) AS name, coalesce(price, url, 0) AS paid FROM s)
SELECT source_product_id, name AS title, known AS brand, coalesce(model, name) AS model_name, paid::BIGINT AS price_paise, CASE WHEN mrp >= paid THEN mrp END::BIGINT AS mrp_paise, stock = 1 AS in_stock, seller, rating, reviews AS review_count, ram AS ram_gb FROM t""")  # fmt: skip
def parse_flipkart(spark: SparkSession, d: str) -> DataFrame:
    return _listings(spark, d, "flipkart", FLIPKART, F_LINK[0]).select(*_COMMON, F.try_element_at("attributes", F.lit("ram_gb")).alias("ram_gb"))


def _state(name: str, price: str, more: str) -> str:
    return f'<script>window.__INITIAL_DATA__={{"pdpReducer":{{"pdpData":{{"name":"{name}","price":{{"value":{price}}},"stock":undefined{more}}}}}}};</script>'


_CLASSES = ',"manufacturer":"HP","mrp":{"value":60000},"finalReviewRating":4.5,"finalReviewRatingCount":12,"ean":"890","classifications":[{"features":[{"name":"RAM ","featureValues":[{"value":"8 GB"}]},{"name":"Model Series","featureValues":[{"value":"Z9"},{"value":""}]}]}]'
#: (fragment, title, brand, price, list price, rating, reviews, ram, model, ean)
C_STATE = _parts(
    1, (_state("HP 15 Laptop", "50000.5", _CLASSES), "HP 15 Laptop", "Hp", 5000050, 6000000, 4.5, 12, "8", "Z9", "890"), (_state("Lenovo V15", "41000", ""), "Lenovo V15", "Lenovo", 4100000, None, None, None, None, None, None),
    ('<script>window.__INITIAL_DATA__={"pdpReducer":{"pdpData":{"name":</script>', None, None, None, None, None, None, None, None, None), ("", None, None, None, None, None, None, None, None, None),
)
C_TITLE = _parts(2, ('<h1 class="pd-title">Buy Acer Aspire Online - Croma</h1>', "Acer Aspire", "Acer"), ("<title>Buy Dell 14 Online - Croma</title>", "Dell 14", "Dell"), ("", None, "Croma"))
C_PRICE = _parts(3, ('<span class="amount">₹38,990</span>', 3899000), ("", None))
C_MRP = _parts(4, ('<span class="old-price">₹48,990</span>', 4899000), ("", None))
C_STOCK = _parts(5, ('<div class="out-of-stock">Out of Stock</div>', 0), ("", 1), ("", 1))
C_LINK = _parts(2, ("https://www.croma.com/p/300001?_price=999900&_mrp=1199900", 999900, 1199900), ("https://www.croma.com/p/300001", None, None), shift=1)
CROMA = {"f_state": C_STATE[0], "f_title": C_TITLE[0], "f_price": C_PRICE[0], "f_mrp": C_MRP[0], "f_stock": C_STOCK[0]}
CROMA_SAYS = dict(zip(("s_title", "s_brand", "s_price", "s_mrp", "rating", "reviews", "ram", "model", "ean"), C_STATE[1:], strict=True)) | {"title": C_TITLE[1], "known": C_TITLE[2], "price": C_PRICE[1], "mrp": C_MRP[1], "stock": C_STOCK[1], "url": C_LINK[1], "url_mrp": C_LINK[2]}


@query("parse_croma", f"""WITH s AS (SELECT 'p' || p_partkey AS source_product_id, {selects(CROMA_SAYS)} FROM part), t AS (SELECT *, coalesce(s_title, title, 'Croma Product ' || source_product_id) AS name FROM s)
SELECT source_product_id, name AS title, coalesce(s_brand, known) AS brand, coalesce(model, name) AS model_name, coalesce(s_price, price, url, 0)::BIGINT AS price_paise, coalesce(s_mrp, mrp, url_mrp)::BIGINT AS mrp_paise, stock = 1 AS in_stock, 'Croma' AS seller, rating, reviews AS review_count, ram AS ram_gb, ean FROM t""")  # fmt: skip
def parse_croma(spark: SparkSession, d: str) -> DataFrame:
    l, a = _listings(spark, d, "croma", CROMA, C_LINK[0]), lambda k: F.try_element_at("attributes", F.lit(k))
    return l.select(*_COMMON, a("ram_gb").alias("ram_gb"), a("ean").alias("ean"))


# Jobs.
RAW = {"source": field("amazon", "croma", None, "nowhere", step=2), "pid": field("a", None, step=97), "category": field("laptop", " Mobile ", "tv", None, step=3), "source_url": field("https://www.amazon.in/dp/1", "http://www.croma.com/p/1", "https://www.croma.com/p/1", None, step=5)}


@query("raw_quarantine", f"""WITH r0 AS (SELECT p_partkey AS seq, {selects(RAW)} FROM part), r AS (SELECT *, CASE WHEN seq % 9 = 0 AND pid IS NOT NULL THEN 'same' ELSE pid || seq END AS source_product_id FROM r0), n AS (SELECT *, count(*) OVER (PARTITION BY source, source_product_id) AS n FROM r)
SELECT seq, CASE WHEN source IS NULL OR source_product_id IS NULL THEN 'missing id' WHEN coalesce(lower(trim(category)), '') NOT IN ('laptop', 'mobile') THEN 'unsupported category'
  WHEN NOT coalesce(source = 'amazon' AND source_url = 'https://www.amazon.in/dp/1' OR source = 'croma' AND source_url = 'https://www.croma.com/p/1', false) THEN 'host not allowed' WHEN n > 1 THEN 'duplicate id' ELSE 'accepted' END AS outcome FROM n""")  # fmt: skip
def raw_quarantine(spark: SparkSession, d: str) -> DataFrame:
    """Every raw record is accepted, or in quarantine with the first reason that applies."""
    p = table(spark, d, "part").select(F.col("p_partkey").alias("seq"), *[c.alias(k) for k, c in columns(RAW).items()])
    pid = F.when((F.col("seq") % 9 == 0) & F.col("pid").isNotNull(), F.lit("same")).otherwise(F.concat("pid", "seq"))
    ok, bad = jobs.accepted(p.withColumn("source_product_id", pid))
    return ok.select("seq", F.lit("accepted").alias("outcome")).unionByName(bad.select("seq", F.col("reason").alias("outcome")))


@query("sitemap_references", f"""WITH p AS (SELECT page_id, {selects(SITEMAP, "page_id")} FROM pages WHERE page_id IS NOT NULL), u AS (SELECT *, {_URL} AS url FROM p WHERE sound = 1),
i AS (SELECT regexp_extract(url, '/(?:p|dp)/(.*)$', 1) AS source_product_id, source, url AS source_url, CASE lastmod WHEN '2026-01-05' THEN 1 WHEN '2026-02-03T10:20:30Z' THEN 2 ELSE 0 END AS t FROM u WHERE {" OR ".join(f"contains(lower(url), '{w}')" for w in fixed.LAPTOP_URL_WORDS)})
SELECT source_product_id, source, source_url FROM i ORDER BY t DESC, source_product_id LIMIT 50""")  # fmt: skip
def sitemap_references(spark: SparkSession, d: str) -> DataFrame:
    """The 50 freshest products of the sitemaps of sitemap_parse (a limit as the feature)."""
    from .table_queries import sitemap_parse

    items = sitemap_parse(spark, d).withColumn("lastmod", F.timestamp_seconds("lastmod"))
    return discovery.references(items, "laptop", 50).select("source_product_id", "source", "source_url")


def _observed(spark: SparkSession, d: str) -> DataFrame:
    return _catalog(spark, d).withColumns({"manufacturer_part_number": F.lit(None).cast("string"), "mrp_paise": F.lit(None).cast("long"), "coupon_price_paise": F.lit(None).cast("long"), "seller": F.lit("S"), "rating": F.lit(4.0), "review_count": F.lit(1), "observed_at": F.lit("2026-01-01").cast("timestamp"), "attributes": F.create_map(F.lit("gtin"), F.col("gtin"))})


def _tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The tables after a run over the catalog of reconcile_catalog, and the same run again."""
    r = cluster.shared_table(cluster.reconcile(_observed(spark, d)), "reconciled")
    once = jobs.next_tables(jobs.empty_tables(spark), r, "2026-01-02")
    return jobs.next_tables({k: once[k] for k in jobs.empty_tables(spark)}, r, "2026-01-02") | {"reconciled": r}


@query("tables_twice", """WITH o AS (SELECT p_partkey // 5 AS g, p_partkey AS seq FROM part WHERE p_partkey % 11 <> 0), p AS (SELECT 'products' AS name, count(DISTINCT g) AS n FROM o)
SELECT * FROM p UNION ALL SELECT 'retailer_products', count(*) FROM o UNION ALL SELECT 'offers', count(*) FROM o UNION ALL SELECT 'product_identifiers', count(DISTINCT g) FROM o WHERE g >= 10 UNION ALL SELECT 'price_observations', count(*) FROM o""")  # fmt: skip
def tables_twice(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the tables after a run and the same run again: as many as after one. Identifiers shorter than three characters don't count."""
    t = _tables(spark, d)
    t["product_identifiers"] = t["product_identifiers"].filter("identifier_type = 'GTIN'")
    out = None
    for k in ("products", "retailer_products", "offers", "product_identifiers", "price_observations"):
        one = t[k].agg(F.lit(k).alias("name"), F.count("*").alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


@query("offers_table", "SELECT 's' || p_partkey % 3 AS source, 'p' || p_partkey AS source_product_id, (5000000 + 997 * (p_partkey % 1000))::BIGINT AS price_paise, p_partkey % 4 <> 0 AS in_stock, CASE WHEN p_partkey % 4 <> 0 THEN 'ACTIVE' ELSE 'UNAVAILABLE' END AS lifecycle_status, 0 AS missed_crawls FROM part WHERE p_partkey % 11 <> 0")
def offers_table(spark: SparkSession, d: str) -> DataFrame:
    """The offers' table after both runs."""
    return _tables(spark, d)["offers"].select("source", "source_product_id", "price_paise", "in_stock", "lifecycle_status", "missed_crawls")


@query("tables_incremental", "SELECT 's' || p_partkey % 3 AS source, 'p' || p_partkey AS source_product_id, (5000000 + 997 * (p_partkey % 1000))::BIGINT AS price_paise, (SELECT count(*) FROM part WHERE p_partkey % 11 <> 0)::BIGINT AS observations, (SELECT count(DISTINCT p_partkey // 5) FROM part WHERE p_partkey % 11 <> 0)::BIGINT AS products FROM part WHERE p_partkey % 11 <> 0")
def tables_incremental(spark: SparkSession, d: str) -> DataFrame:
    """The tables after two batches through the ledger, the first of which comes again: each is compared with the stored seeds only."""
    l = cluster.shared_table(_observed(spark, d), "listings")
    half = l.agg(F.expr("(min(seq) + max(seq)) div 2")).first()[0] or 0
    log = jobs.catalog(spark, cluster.shared_path(spark, "catalog"))
    for n, part in ((0, F.col("seq") <= half), (0, F.col("seq") <= half), (1, F.col("seq") > half)):
        log.apply_once("listings", n, lambda t, part=part: jobs.apply_batch(t, l.filter(part), "2026-01-02"))
    t = log.tables()
    return t["offers"].select("source", "source_product_id", "price_paise", F.lit(t["price_observations"].count()).cast("long").alias("observations"), F.lit(t["products"].count()).cast("long").alias("products"))


# Reviews.
@query("reviews_by_cursor", """WITH RECURSIVE p AS (SELECT p_partkey AS k, p_size AS pages FROM part WHERE p_size IS NOT NULL), g AS (SELECT k, pages, unnest(range(1, pages + 1)) AS page FROM p),
x AS (SELECT k, CASE WHEN page > 1 THEN 'c' || (page * 7919 + k) % 100003 END AS cursor, CASE WHEN page < pages THEN 'c' || ((page + 1) * 7919 + k) % 100003 WHEN k % 5 = 0 AND page > 2 THEN 'c' || (2 * 7919 + k) % 100003 WHEN k % 7 = 0 THEN 'lost' END AS next_cursor, CASE WHEN k % 3 = 0 AND page = 9 THEN 0 ELSE 1 END AS n FROM g),
w(k, pos, cursor, next_cursor, n, seen, reason) AS (SELECT k, 1, cursor, next_cursor, n, []::VARCHAR[], NULL::VARCHAR FROM x WHERE cursor IS NULL
  UNION ALL SELECT x.k, w.pos + 1, x.cursor, x.next_cursor, x.n, list_append(w.seen, x.cursor), NULL FROM w JOIN x ON x.k = w.k AND x.cursor = w.next_cursor WHERE w.n > 0 AND NOT list_contains(w.seen, w.next_cursor)),
e AS (SELECT w.k, w.pos, CASE WHEN w.n = 0 OR w.next_cursor IS NULL THEN NULL WHEN list_contains(w.seen, w.next_cursor) THEN 'repeated cursor' WHEN w.next_cursor = 'lost' THEN 'no such page' END AS reason FROM w)
SELECT k AS product_id, count(*)::BIGINT AS pages, max(reason) AS reason FROM e GROUP BY k""")  # fmt: skip
def reviews_by_cursor(spark: SparkSession, d: str) -> DataFrame:
    """Up to fifty pages a product: chains of cursors that end, come back to an earlier page, or name a page that isn't there."""
    p = spread(table(spark, d, "part").filter("p_size is not null").select(F.col("p_partkey").alias("product_id"), "p_size"), "product_id").select("product_id", "p_size", F.explode(F.sequence(F.lit(1), "p_size")).alias("page"))
    k, page = F.col("product_id"), F.col("page")
    name = lambda n: F.concat(F.lit("c"), (n * 7919 + k) % 100003)
    after = F.when(page < F.col("p_size"), name(page + 1)).when((k % 5 == 0) & (page > 2), name(F.lit(2))).when(k % 7 == 0, F.lit("lost"))
    pages = p.select("product_id", F.when(page > 1, name(page)).alias("cursor"), after.alias("next_cursor"), F.when((k % 3 == 0) & (page == 9), F.array().cast("array<int>")).otherwise(F.array(F.lit(1))).alias("reviews"))
    got = reviews.in_order(pages)
    return got.groupBy("product_id").agg(F.count("*").alias("pages"), F.max("reason").alias("reason"))


@query("reviews_collected", """WITH p AS (SELECT p_partkey AS k, p_size % 4 AS pages FROM part), g AS (SELECT k, unnest(range(1, pages + 1)) AS page FROM p), r AS (SELECT k, page, unnest(range(0, 60)) AS place FROM g WHERE NOT (k % 5 = 0 AND page >= 2) AND NOT (k % 7 = 0 AND page >= 3)),
n AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY page, place) AS n FROM r) SELECT k AS product_id, count(*)::BIGINT AS reviews, max(n)::INT AS last, sum(1000 * page + place)::BIGINT AS sum FROM n WHERE n <= 100 GROUP BY k""")  # fmt: skip
def reviews_collected(spark: SparkSession, d: str) -> DataFrame:
    """Up to three pages of 60 reviews a product, 100 at most; a page whose cursor came before, or with another product's review, ends it."""
    p = spread(table(spark, d, "part").select(F.col("p_partkey").alias("product_id"), "p_size"), "product_id").select("product_id", F.explode(F.expr("sequence(1, 3)")).alias("page_no"), "p_size").filter("page_no <= p_size % 4")
    k, page = F.col("product_id"), F.col("page_no")
    cursor = F.when((k % 5 == 0) & (page == 2), F.lit(1)).otherwise(page).cast("string")
    place = F.transform(F.sequence(F.lit(0), F.lit(59)), lambda i: F.struct(F.when((k % 7 == 0) & (page == 3) & (i == 30), k + 1).otherwise(k).alias("product_id"), (1000 * page + i).alias("at")))
    got = reviews.collect_reviews(p.select("product_id", "page_no", cursor.alias("cursor"), place.alias("reviews")), 100)
    return got.groupBy("product_id").agg(F.count("*").alias("reviews"), F.max("n").alias("last"), F.sum("review.at").cast("long").alias("sum"))


# Ids, views, forms.



@query("cluster_ids", r"""SELECT p_partkey, 'clus_' || substr(sha256('{"attributes": {' || CASE WHEN p_partkey % 3 = 0 THEN '' ELSE '"_x": "a\\b\n", "color": "' || p_type || ' \"q\"", "gr\u00f6\u00dfe": "15\u2033 \ud83d\ude00\u007f"' END || '}, "brand": "' || p_brand || '", "category": "laptop", "model_name": "' || p_name || '"}'), 1, 16) AS cluster_id FROM part""")
def cluster_ids(spark: SparkSession, d: str) -> DataFrame:
    """A seed's identity as the hash of its canonical JSON; attributes in two orders, or none."""
    from ..operators.identity import FINGERPRINT

    kinds = dict(x.split(" ", 1) for x in FINGERPRINT.split(", "))
    pairs = [(F.lit("größe"), F.lit("15\u2033 \U0001f600\x7f")), (F.lit("color"), F.concat("p_type", F.lit(' "q"'))), (F.lit("_x"), F.lit("a\\b\n"))]
    map_of = lambda ps: F.create_map(*[c for p in ps for c in p])
    color = F.when(F.col("p_partkey") % 3 == 0, F.create_map().cast("map<string,string>")).when(F.col("p_partkey") % 2 == 0, map_of(pairs)).otherwise(map_of(pairs[::-1]))
    put = {"category": F.lit("laptop"), "brand": F.col("p_brand"), "model_name": F.col("p_name"), "family": F.col("p_type"), "chip": F.lit("ryzen"), "ram_gb": F.col("p_size"), "screen_size_inches": F.lit(15.6), "attributes": color}
    fp = F.struct(*[put.get(k, F.lit(None)).cast(t).alias(k) for k, t in kinds.items()])
    return table(spark, d, "part").select("p_partkey", fp.alias("fp")).select("p_partkey", cluster.cluster_id(F.col("fp")).alias("cluster_id"))


@query("report_table", """SELECT p_partkey AS id, 'Laptop' AS category, upper(left(p_brand, 1)) || lower(substr(p_brand, 2)) AS brand, left(p_name || ' ' || p_type || ' of a long name that goes on and on', 45) AS model, '2 (S1, Croma)' AS offers, '₹' || format('{:,}', 1000 * p_partkey) || '.50' AS best_price, CASE WHEN p_partkey % 3 = 0 THEN '-' ELSE 'Croma' END AS best_source, CASE WHEN p_partkey % 4 = 0 AND p_partkey > 0 THEN '₹' || format('{:,}', p_partkey) || '.00' ELSE '-' END AS savings FROM part""")
def report_table(spark: SparkSession, d: str) -> DataFrame:
    """Clusters as the texts of a table."""
    k = F.col("p_partkey")
    offers = F.array(F.struct(F.lit("s1").alias("source")), F.struct(F.lit("CROMA").alias("source")))
    c = table(spark, d, "part").select(k.cast("string").alias("cluster_id"), F.lit("laptop").alias("category"), F.col("p_brand").alias("brand"), F.concat_ws(" ", "p_name", "p_type", F.lit("of a long name that goes on and on")).alias("model_name"), offers.alias("linked_offers"), (100_000 * k + 50).alias("best_price_paise"), F.when(k % 3 == 0, F.lit("")).otherwise(F.lit("croma")).alias("best_source"), F.when(k % 4 == 0, 100 * k).otherwise(F.lit(0)).alias("savings_paise"))
    return cluster.table_view(c).withColumn("id", F.col("cluster_id").cast("long")).drop("cluster_id")


FORMS = {"sign": field("₹", "", "Rs. ", "₹ "), "rest": field("", " only", "% off", " off", step=3)}


@query("price_forms", f"""WITH p AS (SELECT p_partkey, {selects(FORMS)} FROM part), s AS (SELECT *, p_partkey * 37 % 4000 AS n FROM p), t AS (SELECT *, CASE WHEN sign = 'Rs. ' THEN 1 ELSE 0 END AS dot FROM s)
SELECT p_partkey, CASE WHEN contains(sign, '₹') OR n + 0.5 >= 50 AND dot = 0 AND NOT contains(rest, 'off') THEN CASE WHEN dot = 0 THEN n * 100 + 50 END END::BIGINT AS paise FROM t""")  # fmt: skip
def price_forms(spark: SparkSession, d: str) -> DataFrame:
    """Amounts with and without the rupee sign, grouped, as badges, or with a second point, which makes no number."""
    p = table(spark, d, "part").select("p_partkey").withColumns(columns(FORMS))
    n = (F.col("p_partkey") * 37) % 4000
    said = F.concat("sign", F.format_number(n, 0), F.lit(".50"), "rest")
    return p.select("p_partkey", text.price_paise(said).alias("paise"))


CAPACITY = {"before": field("", "RAM ", " ", step=2), "amount": field("512", "1", "0.5", "1.2", "0", "2.5", step=1), "unit": field(" GB", "tb", "TB ", "gb DDR4", " MB", "", step=5)}


@query("capacity_forms", f"""WITH p AS (SELECT p_partkey, {selects(CAPACITY)} FROM part), a AS (SELECT *, amount::DECIMAL(18,6) * CASE WHEN contains(lower(unit), 'tb') THEN 1024 WHEN contains(lower(unit), 'gb') THEN 1 END AS gb FROM p)
SELECT p_partkey, CASE WHEN gb > 0 AND gb = floor(gb) AND trim(before) = '' AND NOT contains(unit, 'DDR') THEN gb::BIGINT END AS whole_gb, CASE WHEN gb > 0 AND gb = floor(gb) THEN gb::BIGINT END AS first_gb FROM a""")  # fmt: skip
def capacity_forms(spark: SparkSession, d: str) -> DataFrame:
    from ..operators.attributes import capacity

    said = F.concat("before", "amount", "unit")
    p = table(spark, d, "part").select("p_partkey").withColumns(columns(CAPACITY))
    return p.select("p_partkey", text.capacity_gb(said).alias("whole_gb"), capacity(said).alias("first_gb"))


@query("small_forms", "SELECT p_partkey, '₹' || format('{:,}', p_partkey * 1234) || '.' || lpad((p_partkey % 100)::VARCHAR, 2, '0') AS rupees, coalesce(nullif(CASE WHEN p_partkey % 3 = 0 THEN p_name WHEN p_partkey % 3 = 1 THEN '' END, ''), p_type) AS first, (length(p_name) - length(replace(p_name, 'e', '')))::DOUBLE AS es FROM part")
def small_forms(spark: SparkSession, d: str) -> DataFrame:
    """Amounts in rupees, the first text that isn't empty, how often a mark occurs."""
    k = F.col("p_partkey")
    other = F.when(k % 3 == 0, F.col("p_name")).when(k % 3 == 1, F.lit(""))
    return table(spark, d, "part").select("p_partkey", text.rupees(k * 123_400 + k % 100).alias("rupees"), text.first_of(other, F.col("p_type")).alias("first"), text.count_of(F.col("p_name"), "e").alias("es"))


@query("price_points", "SELECT 's' || p_partkey % 3 || ':p' || p_partkey AS offer_id, (5000000 + 997 * (p_partkey % 1000))::BIGINT AS price_paise, p_partkey % 4 <> 0 AS in_stock FROM part")
def price_points(spark: SparkSession, d: str) -> DataFrame:
    l = _catalog(spark, d).withColumns({k: F.lit(None).cast("long") for k in ("mrp_paise", "coupon_price_paise")} | {"seller": F.lit(None).cast("string"), "observed_at": F.lit(None).cast("timestamp")})
    return store.price_observations(l).select("offer_id", "price_paise", "in_stock")


@query("source_adapter", """SELECT page_id, nullif(trim(replace(replace(replace(replace(regexp_extract(html, '<h1[^>]*>([^<]*)</h1>', 1), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&')), '') AS title, regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang, len(regexp_extract_all(html, '<a href="'))::BIGINT AS links, NULL::VARCHAR AS error_ FROM pages""")
def source_adapter(spark: SparkSession, d: str) -> DataFrame:
    """A source of one's own, registered by name: every page read by its function in a lateral join, called as a table function from SQL."""
    from ..sources import registry

    def read(url: str | None, html: str | None):  # noqa: ANN202
        from pricewright.sources.html import parse, select

        top = parse(html or "")
        title = [n.text().strip() for n in select(top, "h1")]
        yield {"title": (title or [None])[0] or None, "lang": next((n.attrs.get("lang") for n in top.walk() if n.tag == "html"), None), "links": sum("href" in n.attrs for n in top.walk() if n.tag == "a")}

    registry.page_source(spark, "press", ("example.com",), ("news",), read, "title string, lang string, links long")
    table(spark, d, "pages").select("page_id", "url", "html").createOrReplaceTempView("press_pages")
    return spark.sql("SELECT p.page_id, r.* FROM press_pages p, LATERAL parse_press(p.url, p.html) r")


@query("sources_listed", "SELECT p_partkey, CASE WHEN p_partkey % 4 = 3 THEN 'unsupported source: nowhere' ELSE NULL END AS reason FROM part WHERE p_partkey % 4 = 3")
def sources_listed(spark: SparkSession, d: str) -> DataFrame:
    """Rows of sources that nobody registered."""
    from ..sources import registry

    k = F.col("p_partkey")
    rows = table(spark, d, "part").select(k, F.element_at(F.array(*[F.lit(x) for x in ("amazon", " Croma", "flipkart", "nowhere")]), (k % 4 + 1).cast("int")).alias("source"))
    return registry.unknown_sources(rows).select("p_partkey", "reason")
