"""Listing pages of three retailers to typed listings.

What is picked from a page is data: ordered selectors for each field, and stages of specification rows. One Arrow-batched function reads the pages and
returns the picks, the specifications and the sections; all that follows (prices, brands, fallbacks, attributes) is Column expressions.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.rules import get, ordered
from ..functions.ship import ship
from ..functions.text import first_of, fold, nonblank, price_paise, squeeze, title_brand
from ..operators.attributes import with_attributes
from .html import Node, parse, pick, select


@dataclass(frozen=True)
class Rows:
    """Specification rows: within sections (with a heading) or anywhere; a later stage fills gaps unless it overwrites."""

    row: str
    key: list[str]
    value: list[str]
    section: str | None = None
    heading: list[str] | None = None
    general: str | None = None
    skip: tuple[str, ...] = ()
    overwrite: bool = False


# Where each retailer's pages have what. Text selectors, in order.
PICKS: dict[str, dict[str, list[str]]] = {
    "amazon": {
        "title": ["input#productTitle@value", "input[name=productTitle]@value", "span#productTitle", "h1#title", "meta[name=title]@content", "meta[property='og:title']@content", "h1"],
        "page_title": ["title"], "price_input": ["input#priceValue@value", "input[name=priceValue]@value"],
        "price": ["span.a-price span.a-offscreen", "span.priceToPay span.a-price-whole", "span.a-price span.a-price-whole", "div#corePriceDisplay_desktop_feature_div span.a-price-whole", "span.priceToPay span.a-offscreen", "span.apexPriceToPay span.a-offscreen", "div#corePrice_desktop span.a-offscreen"],
        "mrp": ["span.basisPrice span.a-offscreen", "span.a-text-price span.a-offscreen", "span.a-price[data-a-strike=true] span.a-offscreen", "div#corePrice_desktop span.a-text-price span.a-offscreen"],
        "stock": ["div#availability span"], "seller": ["a#sellerProfileTriggerId", "div#merchant-info a span", "div#merchant-info", "#tabular-buybox-truncate-0 span", "div.tabular-buybox-text[tabular-attribute-name='Sold by'] span"],
        "rating": ["#averageCustomerReviews span.a-size-small.a-color-base", "span.a-icon-alt", "i.a-icon-star span"], "reviews": ["span#acrCustomerReviewText", "#averageCustomerReviews a[href*=customerReviews] span"], "asin": ["input#asin@value", "input[name=asin]@value"],
    },
    "flipkart": {
        "title": ["h1.VU-ZEz", "span.B_NuCI", "h1._6EBuvT", "meta[property='og:title']@content", "meta[name='twitter:title']@content", "h1"], "page_title": ["title"],
        "price": ["div._30jeq3._16J0da", "div.Nx9bqj._4b5DiR", "div._30jeq3", "div.Nx9bqj"], "mrp": ["div.yRaY8j//", "div._3I9_wc//", "span.k3eYh1//"],
        "stock": ["div._16FRp0", "div._16FRp0 span"], "sold": ["button:disabled", "div._1t_v5X"], "seller": ["div#sellerName span span", "div.DByuf4 span", "div._1RLviY span", "div._1RLviY", "div._2mD1Ys span", "span.h8pY3V"],
        "rating": ["div._3LWZlK", "div.XQDdHH"], "reviews": ["span._2_R_DZ//", "span.Wphh3N//"],
    },
    "croma": {
        "title": ["h1.pd-title", "h1.pdp-title", "h1.prod-title", "h1", "meta[property='og:title']@content"], "page_title": ["title"],
        "price": ["span.amount", "span.pdp-price", "span.main-product-price", "span.new-price"], "mrp": ["span.old-price", "span.mrp", "span.strike-price"],
        "stock": [".out-of-stock", ".pdp-out-of-stock", "button.btn-sold-out"], "rating": ["span.rating-text", "div.cp-rating span"], "reviews": ["span.reviews-count", "span.total-reviews"],
    },
}
_FLIP_KEY = ["div.v1zwn21o.v1zwn28", "div.v1zwn28", "div[font=default-fk-font-m]", "div[class*=v1zwn21o]"]
_FLIP_VALUE = ["div.v1zwn21n.v1zwn27", "div.v1zwn21n.v1zwn26", "div.v1zwn27", "div.v1zwn26", "div[font=s]", "div[class*=v1zwn21n]"]
_AMZ_KEY = ["th", "td.a-span3 span", "td.a-span3", "td:first-child span", "td:first-child"]
_AMZ_VALUE = ["td.a-span9 span", "td.a-span9", "td:last-child", "td:last-child span", "td:last-child//"]
STAGES: dict[str, list[Rows]] = {
    "amazon": [
        Rows("table.prodDetTable tr, table.a-keyvalue tr", ["th.prodDetSectionEntry", "th", "td:first-child"], ["td.prodDetAttrValue", "td.prodDetAttrValue//", "td:last-child", "td:last-child//"], "div.a-section-expander-container, .a-section-expander-container", [".a-expander-prompt", ".a-expander-header span", ".a-expander-header"], skip=("feedback", "customer review", "rating", "lower price"), overwrite=True),
        Rows("#productDetails_techSpec_section_1 tr, #productDetails_techSpec_section_2 tr, #prodDetails table.prodDetTable tr, #poExpander tr, #technicalSpecifications_section_1 tr, #productOverview_feature_div tr", _AMZ_KEY, _AMZ_VALUE),
    ],
    "flipkart": [
        Rows("div.grid-formation-dynamic", _FLIP_KEY, _FLIP_VALUE, "div.grid-formation", ["div[font=default-fk-font-l]", "div.v1zwn21n.v1zwn24", "div.v1zwn24"], general="General", overwrite=True),
        Rows("div.grid-formation-dynamic", _FLIP_KEY, _FLIP_VALUE),
        Rows("tr._1s_Smc, tr.row, div._14cfVK tr", ["td._1hKmda", "td:first-child"], ["td._21lJal li", "td._21lJal", "td:last-child"]),
    ],
    "croma": [
        Rows("ul.cp-specification-spec-info", [".cp-specification-spec-title h4", ".cp-specification-spec-title"], [".cp-specification-spec-details//"], "ul.cp-specification-info", ["li h3.title", "h3.title", ".title", "h3"], skip=("company contact", "service promise", "packaged dimensions", "croma service"), overwrite=True),
        Rows("ul.cp-specification-spec-info", [".cp-specification-spec-title h4", ".cp-specification-spec-title"], [".cp-specification-spec-details//"]),
        Rows(".cp-specification li, .spec-body tr, .technical-details tr, table.specifications tr", [".spec-title", "td:first-child", ".key"], [".spec-desc", "td:last-child", ".value"]),
    ],
}
#: Bullets: selectors, and words that route a bullet without a colon to a key.
BULLETS = {"amazon": ["#detailBullets_feature_div li"], "flipkart": ["li._21Ahn-", "div._2418kt li"], "croma": [".cp-keyfeature li", "#panel5 li"]}
ROUTES = [("memory", ["ram", "rom", "storage"]), ("display", ["display", "screen", "inch", "cm ("]), ("camera", ["camera", "mp "]), ("battery", ["battery", "mah"]), ("processor", ["processor", "snapdragon", "dimensity", "helio", "bionic", "unisoc", "octa core", "quad core"]), ("warranty", ["warranty"])]


def _squeezed(s: str | None) -> str:
    return " ".join((s or "").replace("‎", "").replace("‏", "").replace("\xa0", " ").split())


def _ignored(key: str) -> bool:
    k = _squeezed(key).casefold()
    return not 2 <= len(k) <= 60 or k in fixed.IGNORED_KEYS or bool(re.search(r"[₹$]", k)) or bool(re.fullmatch(r"[\d,./_+-]+", k)) or any(p in k for p in fixed.IGNORED_PARTS)


def specifications(source: str, top: Node) -> tuple[dict[str, str], dict[str, dict[str, str]]]:
    """(key to value, section to key to value)."""
    specs: dict[str, str] = {}
    sections: dict[str, dict[str, str]] = {}

    def put(key: str | None, value: str | None, overwrite: bool, section: str | None = None) -> None:
        k, v = _squeezed(key).removesuffix(":").strip(), _squeezed(value)
        if k and v and not _ignored(k):
            if overwrite or k.casefold() not in specs:
                specs[k.casefold()] = v
            if section:
                sections.setdefault(section, {})[k] = v

    for stage in STAGES.get(source, []):
        for block in select(top, stage.section) if stage.section else [top]:
            name = None
            if stage.section:
                name = _squeezed(pick(block, stage.heading or [])) or stage.general
                if not name or any(w in name.casefold() for w in stage.skip) or (stage.general and _ignored(name)):
                    continue
            for row in select(block, stage.row):
                put(pick(row, stage.key), pick(row, stage.value), stage.overwrite, name)
    if source == "croma":
        for t in select(top, ".cp-specification-spec-title"):
            values = [s for s in t.siblings_after() if "cp-specification-spec-details" in s.classes()]
            put(pick(t, ["h4"]) or t.text(), values[0].text() if values else None, False)
        if (overview := pick(top, ["div.cp-overview//"])) is not None:
            sections["Overview"] = {"Description": _squeezed(overview)}
    if source == "flipkart":
        for head in select(top, "div[class*=v1zwn24]"):
            after = [s for s in head.siblings_after() if "v1zwn26" in s.attrs.get("class", "")]
            if after and "v1zwn21n" not in head.attrs.get("class", ""):
                put(next(iter(head.own_texts()), None), next(iter(after[0].own_texts()), None), False, "Warranty")
        for box in select(top, "div[class*=_1psv1zeb9]"):
            own = {k: next((c for c in box.elements() if k in c.attrs.get("class", "")), None) for k in ("v1zwn21o", "v1zwn21n")}
            if own["v1zwn21o"] and own["v1zwn21n"]:
                put(own["v1zwn21o"].text(), own["v1zwn21n"].text(), False, "Manufacturer Info")
    for n, li in enumerate((x for s in BULLETS.get(source, []) for x in select(top, s)), 1):
        text = _squeezed(li.text())
        key, colon, value = text.partition(":")
        section = "Key Features" if source == "croma" else None
        if colon:
            put(key, value, False, section)
        elif source == "flipkart" and not _ignored(text):
            k = next((k for k, words in ROUTES if k not in specs and any(w in text.casefold() for w in words)), None)
            if k:
                specs[k] = text
        elif section and text:
            sections.setdefault(section, {})[f"Feature {n}"] = text
    return specs, sections


def product_of(scripts: list[str]) -> dict[str, Any]:
    """The first JSON-LD product of a page; broken JSON is passed over."""
    for s in scripts:
        try:
            data = json.loads(s)
        except ValueError:
            continue
        for x in data if isinstance(data, list) else [data]:
            if isinstance(x, dict) and (x.get("@type") == "Product" or (x.get("@type") == "ItemPage" and not isinstance(data, list))):
                return x
    return {}


def read_page(source: str, html: str) -> dict[str, Any]:
    top = parse(html)
    specs, sections = specifications(source, top)
    ld = product_of(["".join(n.own_texts()) for n in select(top, "script[type='application/ld+json']")])
    offers = ld.get("offers") if isinstance(ld.get("offers"), dict) else {}
    picks = {k: v for k, s in PICKS.get(source, {}).items() if (v := pick(top, s)) is not None}
    picks |= {k: str(v) for k, v in {"ld_name": ld.get("name"), "ld_price": offers.get("price")}.items() if v}
    return {"picks": list(picks.items()), "specs": list(specs.items()), "sections": json.dumps(sections, ensure_ascii=False) if sections else None}


_PAGE = pa.struct([("picks", pa.map_(pa.string(), pa.string())), ("specs", pa.map_(pa.string(), pa.string())), ("sections", pa.string())])


def read_pages(raw: DataFrame) -> DataFrame:
    """raw with picks, specs (maps) and sections (JSON) of its html, by source; a null or broken html gives empty maps."""
    ship(raw.sparkSession)
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in raw.schema)}, picks map<string,string>, specs map<string,string>, sections string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [read_page((s or "").lower(), h or "") for s, h in zip(b.column("source").to_pylist(), b.column("html").to_pylist(), strict=True)]
            x = pa.array(got, _PAGE)
            yield pa.RecordBatch.from_arrays([*b.columns, *x.flatten()], names=[*b.schema.names, "picks", "specs", "sections"])

    return raw.mapInArrow(run, schema)


def page_state(html: Column) -> Column:
    """The product state that a Croma page embeds, as VARIANT: undefined counts as null, broken state is null."""
    js = F.regexp_extract(html, r"(?s)window\.__INITIAL_DATA__[^{]*(\{.*?)\s*;?\s*(?:</script>|$)", 1)
    return F.try_variant_get(F.try_parse_json(F.regexp_replace(js, r":\s*undefined\b", ":null")), "$.pdpReducer.pdpData", "variant")


def classifications(state: Column) -> Column:
    """Feature name to its values, comma-joined."""
    kind = "array<struct<features:array<struct<name:string,value:string,featureValues:array<struct<value:string>>>>>>"
    groups = F.try_variant_get(state, "$.classifications", kind)
    features = F.filter(F.flatten(F.transform(groups, lambda g: F.coalesce(g["features"], F.array().cast(kind[6:-1].split("features:")[1][:-1])))), lambda f: f["name"].isNotNull())
    value = lambda f: first_of(F.array_join(F.filter(f["featureValues"]["value"], lambda v: v != ""), ", "), f["value"])
    kept = F.filter(F.transform(features, lambda f: F.struct(squeeze(fold(f["name"])).alias("key"), F.trim(value(f)).alias("value"))), lambda e: e["value"] != "")
    distinct = F.aggregate(kept, F.map_from_entries(F.slice(kept, 1, 0)), lambda m, e: F.map_concat(F.map_filter(m, lambda k, _: k != e["key"]), F.create_map(e["key"], e["value"])))
    return F.coalesce(distinct, F.create_map().cast("map<string,string>"))


STOP_PHRASES = r"(?i)\s*(?:online\s+at\s+best\s+price\s+(?:on|in)\s+flipkart(?:\.com)?|online\s+at\s+best\s+price.*|\(includes\s+extra\s+discount[^)]*\))\s*$"


def parse_listings(raw: DataFrame) -> DataFrame:
    """raw records (source, source_product_id, category, subcategory, source_url, observed_at, html; payload map<string,string> or none) to listings.

    Texts come from the page state, the page, JSON-LD, the URL and the payload, in that order; a price that can't be found is 0.
    A column seq is passed on.
    """
    if "payload" not in raw.columns:
        raw = raw.withColumn("payload", F.create_map().cast("map<string,string>"))
    p = read_pages(raw)
    state = F.when(F.col("source") == "croma", page_state(F.col("html")))
    p = p.withColumn("state", state)
    p = p.withColumn("specs", F.when(F.col("state").isNotNull(), F.map_concat(F.map_filter(classifications(F.col("state")), lambda k, _: ~F.map_contains_key(F.col("specs"), k)), "specs")).otherwise(F.col("specs")))
    pk, sp, pay = (lambda k: get(F.col("picks"), k)), (lambda k: get(F.col("specs"), k)), (lambda k: get(F.col("payload"), k))
    st = lambda path: F.try_variant_get("state", f"$.{path}", "string")
    src, html = F.col("source"), F.col("html")
    head = pk("page_title")
    cut = ordered([
        ((src == "amazon") & ~F.lower(head).contains("page not found"), F.regexp_extract(head, r"^[^:|]*", 0)),
        ((src == "flipkart") & ~F.lower(head).contains("buy products online"), F.regexp_extract(head, r"^[^|-]*", 0)),
        ((src == "croma") & F.lower(head).contains("croma"), F.replace(F.replace(F.regexp_extract(head, r"^[^|-]*", 0), F.lit("Buy"), F.lit("")), F.lit("Online"), F.lit(""))),
    ])
    specs_title = F.trim(F.concat_ws(" ", first_of(sp("brand name"), sp("brand")), first_of(sp("model name"), sp("model series"), sp("model number"))))
    named = F.concat(F.initcap(src), F.lit(" Product "), F.col("source_product_id"))
    title = F.coalesce(*[nonblank(x) for x in (st("name"), st("productName"), pk("title"), pk("ld_name"), cut, F.when(src != "flipkart", specs_title), pay("title"), named)])
    title = ordered([(src == "flipkart", F.regexp_replace(title, STOP_PHRASES, "")), (src == "croma", F.regexp_replace(F.regexp_replace(title, "^Buy ", ""), r" Online - Croma| [-|] Croma", ""))], title)
    title = squeeze(F.translate(title, "‎‏ ", "   "))

    money = lambda path: F.coalesce((st(f"{path}.value").try_cast("double") * 100).cast("long"), price_paise(st(f"{path}.formattedValue")), price_paise(st(path)))
    in_html = lambda pattern: price_paise(F.concat(F.lit("₹"), nonblank(F.regexp_extract(html, pattern, 1))))
    url = lambda k: F.try_parse_url(F.col("source_url"), F.lit("QUERY"), F.lit(k)).try_cast("long")
    given = lambda k: F.coalesce(pay(f"{k}_paise").try_cast("long"), price_paise(pay(k)))
    price = F.coalesce(money("price"), price_paise(pk("price_input")), price_paise(pk("price")), F.when(src == "amazon", in_html(r"₹\s*([\d,]+(?:\.\d{2})?)")), price_paise(pk("ld_price")), url("_price"), given("price"), F.lit(0).cast("long"))
    p = p.withColumns({"title": title, "price_paise": price})
    flip_mrp = F.coalesce(price_paise(nonblank(F.regexp_extract(pk("mrp"), r"₹\s*[\d,]{3,}", 0))), in_html(r"(?i)(?:MRP|Maximum Retail Price)[^\d₹]*₹?\s*([\d,]{3,})"))
    mrp = ordered([(src == "flipkart", F.when(flip_mrp >= F.col("price_paise"), flip_mrp))], F.coalesce(money("mrp"), price_paise(pk("mrp")), F.when(src == "amazon", in_html(r"(?i)(?:M\.R\.P\.|MRP)[^\d₹]*₹?\s*([\d,]+(?:\.\d{2})?)")), F.when(src == "croma", url("_mrp"))))
    gone = F.lower(F.concat_ws(" ", pk("stock"), pk("sold"))).rlike("currently unavailable|out of stock|sold out|unavailable") | F.lower(st("stock")).rlike("out|false")
    said = first_of(st("manufacturer"), sp("brand"), sp("brand name"), sp("model brand"), sp("manufacturer"), sp("manufacturer name"))
    model = ordered([(src == "amazon", first_of(sp("model name"), sp("model"), sp("series"))), (src == "flipkart", first_of(sp("model name"), sp("model"), sp("series"), sp("model number")))], first_of(sp("model series"), sp("model number"), sp("model name"), sp("model"), sp("series"), st("summary")))
    count = lambda c: F.regexp_replace(nonblank(F.regexp_extract(c, r"([\d,]+)", 1)), ",", "").try_cast("int")
    flip_reviews = F.regexp_replace(nonblank(F.regexp_extract(pk("reviews"), r"(?i)([\d,]+)\s*Reviews", 1)), ",", "").try_cast("int")
    p = p.withColumns({
        "mrp_paise": F.coalesce(mrp, pay("mrp_paise").try_cast("long")), "coupon_price_paise": F.lit(None).cast("long"), "in_stock": ~F.coalesce(gone, F.lit(False)),
        "seller": F.when(src == "croma", F.coalesce(pay("seller"), F.lit("Croma"))).otherwise(F.coalesce(squeeze(pk("seller")), pay("seller"))),
        "rating": F.coalesce(st("finalReviewRating").try_cast("double"), nonblank(F.regexp_extract(pk("rating"), r"(\d+(?:\.\d+)?)", 1)).try_cast("double")),
        "review_count": F.coalesce(st("finalReviewRatingCount").try_cast("int"), st("numberOfReviews").try_cast("int"), F.when(src == "flipkart", flip_reviews).otherwise(count(pk("reviews")))),
        "brand": title_brand(F.col("title"), said), "model_name": squeeze(F.coalesce(model, F.col("title"))),
        "manufacturer_part_number": F.lit(None).cast("string"), "gtin": F.lit(None).cast("string"),
    })
    p = with_attributes(p)
    ssd = F.exists(F.map_values("specs"), lambda v: F.lower(v).contains("ssd")) | F.lower("title").contains("ssd")
    emmc = F.exists(F.map_values("specs"), lambda v: F.lower(v).contains("emmc")) | F.lower("title").contains("emmc")
    mpn = ordered([(src == "amazon", first_of(sp("manufacturer part number"), sp("part number"), sp("model number"), sp("item model number"))), (src == "croma", first_of(sp("model number"), sp("part number"), st("specialSKU")))])
    ean = F.when(src == "croma", first_of(st("ean"), sp("ean"), sp("gtin")))
    warranty = ordered([(src == "amazon", first_of(sp("warranty description"), sp("warranty"), sp("warranty type"))), (src == "croma", first_of(sp("warranty on main product"), sp("warranty"), sp("standard warranty includes")))])
    extra = {
        "spec_sections": F.col("sections"), "asin": F.when(src == "amazon", first_of(pk("asin"), sp("asin"))), "mpn": mpn, "model_number": F.when(src == "amazon", mpn), "ean": ean, "gtin": ean, "warranty": warranty,
        "storage_type": F.when(src == "croma", F.when(ssd, F.lit("SSD")).when(emmc, F.lit("eMMC"))),
    }
    from ..functions.rules import map_of, overlay

    p = p.withColumn("extra_", map_of(extra)).withColumn("attributes", overlay(F.col("attributes"), F.col("extra_")))
    return p.select("source", "source_product_id", "category", "subcategory", "title", "brand", "model_name", "manufacturer_part_number", "gtin", "price_paise", "mrp_paise", "coupon_price_paise", "in_stock", "seller", "rating", "review_count", "source_url", "attributes", "observed_at", *(["seq"] if "seq" in p.columns else []))
