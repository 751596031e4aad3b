"""Finding product pages: sitemaps, links of listing pages, host lists, content hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.rules import ordered
from ..functions.text import canonical_url, has_any
from ..operators.store import first


def content_hash(data: Column) -> Column:
    return F.sha2(data.cast("binary"), 256)


def product_id(url: Column, source: Column) -> Column:
    """The first of the source's patterns that the URL has."""
    found = lambda p: F.when(url.rlike(p), F.regexp_extract(url, p, 1))
    own = F.lower(F.trim(source))
    return ordered([(own == s, F.coalesce(*[found(p) for p in ps])) for s, ps in fixed.PRODUCT_ID_PATTERNS.items()])


def allowed_host(url: Column, source: Column) -> Column:
    """Whether a URL is https and on a host of its source."""
    host = F.lower(F.try_parse_url(url, F.lit("HOST")))
    ok = ordered([(source == s, host.isin(hosts)) for s, hosts in fixed.RETAILER_HOSTS.items()], F.lit(False))
    return F.coalesce(ok & (F.lower(F.try_parse_url(url, F.lit("PROTOCOL"))) == "https"), F.lit(False))


def iso_time(c: Column) -> Column:
    """A date or an ISO time; null if it is neither."""
    t = F.trim(c)
    return F.coalesce(F.try_to_timestamp(F.when(F.length(t) == 10, t), F.lit("yyyy-MM-dd")), F.when(F.length(t) > 10, t).try_cast("timestamp"))


def wanted(url: Column, category: str) -> Column:
    """Whether a URL may be of the category: by its words for laptops, else by the category's name."""
    return has_any(F.lower(url), fixed.LAPTOP_URL_WORDS if category.lower() == "laptop" else [category.lower()])


def sitemap_items(maps: DataFrame, category: str | None = None) -> DataFrame:
    """maps (source, content: binary, plain or gzip, or string) to url, source, source_product_id, lastmod, changefreq, priority; broken XML gives nothing.

    Files in a folder, plain or gzip, can be read by sitemap_files instead, split by entry.
    """
    import gzip
    import xml.etree.ElementTree as ET

    import pandas as pd

    from ..functions.ship import ship

    ship(maps.sparkSession)

    def run(batches):  # noqa: ANN001, ANN202
        for pdf in batches:
            out = []
            for source, data in zip(pdf["source"], pdf["content"], strict=True):
                data = bytes(data or b"")
                try:
                    data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
                    root = ET.fromstring(data.decode("utf-8", "replace"))
                except (ET.ParseError, OSError, EOFError):
                    continue
                name = lambda e: e.tag.rpartition("}")[2]
                for e in root.iter():
                    if name(e) == "url":
                        f = {name(c): (c.text or "").strip() for c in e}
                        if f.get("loc"):
                            out.append((source, f["loc"], f.get("lastmod"), f.get("changefreq"), f.get("priority")))
            yield pd.DataFrame(out, columns=["source", "url", "lastmod", "changefreq", "priority"])

    rows = maps.select("source", F.col("content").cast("binary").alias("content")).mapInPandas(run, "source string, url string, lastmod string, changefreq string, priority string")
    return _items(rows, category)


def _entries(spark, path: str) -> DataFrame:  # noqa: ANN001
    """The <url> entries of the files under path (gzip by name): Spark splits files at the entries' ends, so that a broken one doesn't harm the others; broken_
    has the text of one that isn't sound."""
    kind = "loc string, lastmod string, changefreq string, priority string, broken_ string"
    entry = F.regexp_extract("value", r"(?s)<url(?:\s[^>]*)?>.*", 0)
    rows = spark.read.option("lineSep", "</url>").text(path).select(entry.alias("entry")).filter("entry <> ''")
    return rows.select(F.from_xml(F.concat("entry", F.lit("</url>")), kind, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken_"}).alias("e")).select("e.*")


def sitemap_files(spark, path: str, source: str, category: str | None = None) -> DataFrame:  # noqa: ANN001
    """Items of sitemap files in a folder; entries that aren't sound are in broken_entries."""
    rows = _entries(spark, path).filter("broken_ is null")
    return _items(rows.select(F.lit(source).alias("source"), F.trim("loc").alias("url"), "lastmod", "changefreq", "priority").filter("url <> ''"), category)


def broken_entries(spark, path: str, source: str) -> DataFrame:  # noqa: ANN001
    """source, entry, reason: what sitemap_files leaves out, for quarantine: entries that aren't sound XML, or have no location."""
    e = _entries(spark, path)
    reason = F.when(F.col("broken_").isNotNull(), "broken entry").when(F.coalesce(F.trim("loc"), F.lit("")) == "", "no location")
    return e.select(F.lit(source).alias("source"), F.coalesce("broken_", F.lit("")).alias("entry"), reason.alias("reason")).filter("reason is not null")


def _items(rows: DataFrame, category: str | None) -> DataFrame:
    rows = rows.filter(wanted(F.col("url"), category)) if category else rows
    return rows.select("url", "source", product_id(F.col("url"), F.col("source")).alias("source_product_id"), iso_time(F.col("lastmod")).alias("lastmod"), F.when(F.trim("changefreq") != "", F.trim("changefreq")).alias("changefreq"), F.trim("priority").try_cast("double").alias("priority"))


def references(items: DataFrame, category: str, limit: int = 100) -> DataFrame:
    """The freshest `limit` products of sitemap items: one for each id (or URL), latest lastmod first."""
    key = F.coalesce("source_product_id", "url")
    one = first(items.withColumn("source_product_id", key), ["source_product_id"], [F.col("lastmod").desc_nulls_last(), F.col("url")])
    return one.orderBy(F.col("lastmod").desc_nulls_last(), "source_product_id").limit(limit).select("source_product_id", F.lit(category).alias("category"), F.lit(None).cast("string").alias("subcategory"), F.col("url").alias("source_url"), "source")


def page_links(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, place, href, link (canonical), accessory: the links of each page in order, relative ones made whole."""
    links = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.posexplode(F.regexp_extract_all(F.coalesce(F.col(html_col), F.lit("")), F.lit(r'<a\s[^>]*?href="([^"]+)"'), F.lit(1))).alias("place", "href"))
    site = F.concat(F.lit("https://"), F.try_parse_url("url", F.lit("HOST")))
    whole = F.when(F.col("href").startswith("/"), F.concat(site, F.col("href"))).otherwise(F.col("href"))
    return links.select("page_id", F.col("place").cast("long").alias("place"), "href", canonical_url(whole).alias("link"), has_any(F.lower("href"), fixed.DISCOVERY_ACCESSORIES).alias("accessory"))


def listing_scan(pages: DataFrame, source: str, limit: int, seeds: list[str] | None = None) -> DataFrame:
    """Products of listing pages (page_id, url, html): source_product_id, source_url, place; first ones first, without accessories, at most `limit`, topped up from seeds.

    Amazon's ids come from data-asin as well; Croma's pages hold prices in their state, which go into the URL as _price and _mrp (in paise).
    """
    spark = pages.sparkSession
    links = page_links(pages).filter(~F.col("accessory"))
    found = links.select("page_id", "place", product_id(F.col("href"), F.lit(source)).alias("source_product_id"), F.col("link").alias("source_url"))
    html = F.coalesce(F.col("html"), F.lit(""))
    if source == "amazon":
        asin = pages.select("page_id", F.posexplode(F.regexp_extract_all(html, F.lit(r'data-asin="([A-Z0-9]{10})"'), F.lit(1))).alias("place", "source_product_id"))
        found = found.unionByName(asin.select("page_id", F.col("place").cast("long").alias("place"), "source_product_id", F.concat(F.lit("https://www.amazon.in/dp/"), "source_product_id").alias("source_url")))
    if source == "croma":
        js = F.regexp_replace(F.regexp_extract(html, r"(?s)window\.__INITIAL_DATA__[^{]*(\{.*?)\s*;?\s*(?:</script>|$)", 1), r":\s*undefined\b", ":null")
        kind = "array<struct<code:string,url:string,price:struct<value:double>,mrp:struct<value:double>>>"
        state = pages.select("page_id", F.posexplode(F.try_variant_get(F.try_parse_json(js), "$.plpReducer.plpData.products", kind)).alias("place", "p"))
        paise = lambda c: (c * 100).cast("long").cast("string")
        url = F.concat(F.lit("https://www.croma.com"), "p.url", F.coalesce(F.concat(F.lit("?_price="), paise(F.col("p.price.value"))), F.lit("")), F.coalesce(F.concat(F.lit("&_mrp="), paise(F.col("p.mrp.value"))), F.lit("")))
        found = state.select("page_id", F.col("place").cast("long").alias("place"), F.col("p.code").alias("source_product_id"), url.alias("source_url")).unionByName(found)
    rank = found.filter("source_product_id is not null").withColumn("tier", F.lit(0))
    if seeds:
        top = spark.createDataFrame([(0, i, s) for i, s in enumerate(seeds)], "page_id long, place long, source_product_id string").withColumns({"source_url": F.lit(None).cast("string"), "tier": F.lit(1)})
        rank = rank.unionByName(top.select(*rank.columns))
    one = first(rank, ["source_product_id"], [F.col("tier"), F.col("page_id"), F.col("place")])
    return one.orderBy("tier", "page_id", "place").limit(limit).select("source_product_id", "source_url", "place")


def json_ld_products(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """pages with product: a VARIANT for each JSON-LD product of a page (object, list or @graph; types in any case); broken JSON is passed over."""
    scripts = F.regexp_extract_all(F.coalesce(F.col(html_col), F.lit("")), F.lit(r"""(?is)<script[^>]*type=["']application/ld\+json["'][^>]*>(.*?)</script>"""), F.lit(1))
    docs = pages.withColumn("s_", F.explode(scripts)).withColumn("v_", F.try_parse_json(F.trim("s_"))).filter("v_ is not null")
    many = "array<variant>"
    items = F.coalesce(F.try_variant_get("v_", "$", many), F.array("v_"))
    docs = docs.withColumn("i_", F.explode(items))
    is_product = lambda v: F.coalesce(F.lower(F.try_variant_get(v, "$['@type']", "string")).isin("product", "individualproduct"), F.lit(False))
    inner = F.coalesce(F.try_variant_get("i_", "$['@graph']", many), F.array().cast(many))
    docs = docs.withColumn("product", F.explode(F.when(is_product(F.col("i_")), F.array("i_")).otherwise(F.filter(inner, is_product))))
    return docs.drop("s_", "v_", "i_")
