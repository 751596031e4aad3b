"""The engine's operators on small fixtures."""

import datetime as dt
import gzip
import random

import pytest
from pyspark.sql import functions as F

from pricewright.functions import text
from pricewright.functions.similarity import common_length, token_set_ratio_of
from pricewright.operators import attributes, cluster, evaluate, identity, match, ops, quality, store
from pricewright.plans import jobs
from pricewright.sources import discovery, retail


def one(spark, expr, **cols):
    row = spark.createDataFrame([tuple(cols.values())], ", ".join(f"{k} string" for k in cols)) if cols else spark.range(1)
    return row.select(expr.alias("x")).first().x


def each(spark, f, cases):
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(cases)], "i int, v string")
    got = [r.x for r in df.select("i", f(F.col("v")).alias("x")).orderBy("i").collect()]
    assert got == [w for _, w in cases]


# Scalars.
def test_scalars(spark):
    each(spark, text.capacity_gb, [("512 GB", 512), ("1 TB", 1024), ("0.5tb", 512), ("unknown", None), ("0 GB", None), ("1.2 GB", None), (None, None)])
    each(spark, text.price_paise, [("₹39,990.00", 3999000), ("54,990", 5499000), ("1,15,990.50", 11599050), ("", None), (None, None), ("8% off", None), ("(2)", None), ("₹19.99", 1998), ("...", None)])
    each(spark, text.text_norm, [("  Straße  X\n", "strasse x"), ("", ""), (None, None)])
    each(spark, text.collapse_repeats, [("HP HP Victus victus 15", "HP Victus 15"), ("a b", "a b")])
    each(spark, text.weight_kg, [("1 kg 880 g", 1.88), ("1.6 kg", 1.6), ("20 kg", None), ("880 g", None)])
    each(spark, text.title_brand, [("New hp laptop", "Hp"), ("Foo bar", "Foo"), ("  ", "Generic")])
    each(spark, text.is_ignored_key, [("Customer Care Number", True), ("RAM", False), ("1,299", True), ("", True), (None, True), ("About Us page", True)])
    each(spark, text.canonical_url, [
        ("http://www.Amazon.in/dp/B0/?ref=x&utm_foo=1&a=1&b=#top", "https://amazon.in/dp/B0?a=1"), ("https://x.com/", "https://x.com/"), ("https://x.com/p/?tag=1", "https://x.com/p"), ("", ""), ("https://x.com/a?q=a+b%26c", "https://x.com/a?q=a+b%26c"),
    ])


def test_cm_to_inch_of_every_row(spark, tmp_path):
    from decimal import ROUND_HALF_UP, Decimal

    from pricewright.plans.queries import queries

    rows = [(k, k % 12 + 1) for k in range(1, 1101)]
    spark.createDataFrame(rows, "p_partkey long, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    nearest = lambda x, unit: float(Decimal(repr(x)).quantize(Decimal(unit), ROUND_HALF_UP))
    want = [(k, nearest((z + 13) / 2.54, "0.1"), nearest(z + k % 997 / 1000, "0.01") if z < 10 else None) for k, z in rows]
    assert sum(k % 997 % 10 == 5 and z < 10 for k, z in rows) > 50
    assert sorted(map(tuple, queries()["cm_to_inch"](spark, str(tmp_path)).collect())) == want


def test_token_set_ratio():
    assert token_set_ratio_of("a b c", "c b a") == 100.0
    assert token_set_ratio_of("a b", "a b c") == 100.0
    assert token_set_ratio_of("", "a") == 0.0
    assert token_set_ratio_of("abc", "abd") == pytest.approx(100 * 4 / 6)
    assert token_set_ratio_of("fuzzy was a bear", "fuzzy fuzzy was a bear") == 100.0
    rng = random.Random(1)
    for _ in range(200):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randrange(9))) for _ in range(2))
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert common_length(a, b) == t[-1][-1]


# Identity and matching.
def test_token_set_of_all_pairs(spark, tmp_path):
    from pricewright.plans.queries import queries

    names = ["red widget", "widget red", "blue widget", "hot gear", "gear hot hot", "rod", "hot rod", None, ""]
    spark.createDataFrame([(n,) for n in names], "p_name string").write.parquet(f"{tmp_path}/part.parquet")
    got = sorted(map(tuple, queries()["token_set"](spark, str(tmp_path)).collect()))
    own = [n for n in names if n is not None]
    assert got == sorted((a, b, round(token_set_ratio_of(a, b), 6)) for a in own for b in own)
    assert ("red widget", "widget red", 100.0) in got and ("hot gear", "gear hot hot", 100.0) in got


def test_labelled_pairs(spark):
    m = evaluate.metrics(evaluate.decided_pairs(spark)).first()
    assert (m.total_pairs, m.true_positives, m.false_negatives, m.true_negatives, m.false_positives, m.review_queue_count) == (67, 26, 4, 36, 0, 6)
    assert m.precision == 100.0 and m.false_positive_rate == 0.0 and m.recall >= 86.6 and m.f1_score >= 92.8


def fp(**put):
    base = {"category": "laptop", "brand": "lenovo", "model_name": "thinkbook 14 gen 6", "attributes": {"cpu_model": "ryzen 7 7730u", "gpu_model": "integrated graphics", "ram_gb": "16", "storage_gb": "512"}} | put
    names = [x.split(" ", 1)[0] for x in identity.FINGERPRINT.split(", ")]
    return tuple(base.get(n) for n in names)


def decide(spark, *pairs):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], f"i int, l struct<{identity.FINGERPRINT.replace(' ', ':').replace(',:', ',')}>, r struct<{identity.FINGERPRINT.replace(' ', ':').replace(',:', ',')}>")
    return match.compare(df).orderBy("i").collect()


def test_decisions(spark):
    got = decide(
        spark, (fp(gtin="1"), fp(gtin="1", brand="hp")), (fp(gtin="1"), fp(gtin="2")), (fp(manufacturer_part_number="a"), fp(manufacturer_part_number="a", brand="hp")), (fp(), fp(brand="hp")), (fp(ram_gb=8), fp(ram_gb=16)),
        (fp(), fp()), (fp(), fp(attributes={})), (fp(family="a"), fp(family="b")), (fp(category="mobile", attributes={"network_type": "5g"}), fp(category="mobile", attributes={"network_type": "4g"})), (fp(screen_size_inches=14.0), fp(screen_size_inches=14.8)),
    )
    assert [r.decision for r in got] == ["match", "no_match", "match", "no_match", "no_match", "match", "review", "no_match", "no_match", "no_match"]
    assert got[0].reason == "exact GTIN" and got[3].reason == "different brands" and got[6].confidence == 85.0
    assert got[5].score.total == 20 + 25 + 15 + 15 + 10 + 0 + 2 and got[3].score.total == 0


def test_custom_category(spark):
    identity.register_category(identity.Category("toaster", identity.plain_fingerprint, conflict=lambda x, y: F.when(x["model_name"] != y["model_name"], "different toasters")))
    try:
        rows = spark.createDataFrame([(1, "toaster", "T", "b", "m1"), (2, "toaster", "T", "b", "m2")], "id long, category string, title string, brand string, model_name string")
        n = cluster.shared_table(identity.with_fingerprint(rows).select("id", "fp"), "nodes")
        assert match.compare(match.candidate_pairs(n)).first().reason == "different toasters"
    finally:
        identity._CATEGORIES.pop("toaster")


def test_out_of_bounds_is_plain(spark):
    rows = spark.createDataFrame([("laptop", "HP Victus 500 GB 16GB 512GB 15.6 inch", "HP", "x", {"storage_gb": "9"})], "category string, title string, brand string, model_name string, attributes map<string,string>")
    f = identity.with_fingerprint(rows).first().fp
    assert f.family is None and f.brand == "hp" and f.attributes == {"storage_gb": "9"}


# Gate.
LISTING = "seq long, category string, source string, source_product_id string, title string, brand string, model_name string, price_paise long, in_stock boolean, source_url string, attributes map<string,string>"
TITLE = "Lenovo ThinkBook 14 Gen 6 Laptop (16GB, 512GB SSD)"
SPECS = {"cpu_model": "AMD Ryzen 7 7730U", "gpu_model": "integrated", "ram_gb": "16", "storage_gb": "512"}


def listing(seq, source, price, title=TITLE, model="ThinkBook 14 Gen 6", stock=True, specs=None):
    return (seq, "laptop", source, f"id{seq}", title, "Lenovo", model, price, stock, "https://x", SPECS if specs is None else specs)


def test_quality(spark):
    rows = [listing(1, "a", 5499000), listing(2, "a", 5000, specs={}), listing(3, "a", 100000, title="Laptop bag"), listing(4, "a", None), listing(5, "a", 5499000, title="abc", model="abc", specs={})]
    got = {r.seq: r for r in quality.classify(spark.createDataFrame(rows, LISTING)).collect()}
    assert [(got[i].quality_status, got[i].quality_score) for i in range(1, 6)] == [("VALID", 100), ("SUSPICIOUS", 60), ("REJECTED", 30), ("SUSPICIOUS", 60), ("SUSPICIOUS", 40)]
    assert got[2].quality_flags == ["price ₹50.00 is below minimum sanity threshold ₹10,000.00"] and got[3].quality_flags[0] == "accessory detected via pattern: 'laptop bag'"


# Clusters.
def reconciled(spark, *rows):
    r = cluster.reconcile(spark.createDataFrame(list(rows), LISTING))
    return r, cluster.clusters(r).collect()


def test_reconcile(spark):
    r, c = reconciled(spark, listing(1, "flipkart", 5499000), listing(2, "croma", 5349000), listing(3, "amazon", 5420000), listing(4, "croma", 4000000, stock=False), listing(5, "croma", 5349000, specs=SPECS | {"ram_gb": "8"}), listing(6, "x", 99, title="laptop sleeve"))
    first = next(x for x in c if x.cluster_seq == 1)
    assert len(c) == 2 and [o.seq for o in first.linked_offers] == [1, 2, 3, 4] and first.multi_source
    assert (first.best_price_paise, first.best_source, first.max_price_paise, first.price_spread_paise, first.savings_paise) == (5349000, "croma", 5499000, 150000, 150000)
    t = cluster.report_totals(r).first()
    assert tuple(t) == (6, 2, 1, 0, 1)
    assert {x.source: (x.collected_count, x.matched_in_multi_source_cluster, x.single_source_canonical_count, x.rejected_count) for x in cluster.source_breakdown(r).collect()} == {"flipkart": (1, 1, 0, 0), "croma": (3, 2, 1, 0), "amazon": (1, 1, 0, 0), "x": (1, 0, 0, 1)}


def test_reconcile_empty(spark):
    r = cluster.reconcile(spark.createDataFrame([], LISTING))
    assert tuple(cluster.report_totals(r).first()) == (0, 0, 0, 0, 0)


def test_prices_without_stock(spark):
    rows = [(1, "a", 30, False, 1), (1, "b", 20, False, 2), (2, "a", 5, True, 1)]
    got = cluster.price_stats(spark.createDataFrame(rows, "k int, source string, price_paise long, in_stock boolean, seq long"), ["k"]).orderBy("k").collect()
    assert (got[0].best_price_paise, got[0].best_source, got[0].savings_paise, got[1].savings_paise) == (20, "b", 10, 0)


@pytest.mark.parametrize("seed", range(3))
def test_leader_rounds_equal_the_loop(spark, seed):
    rng = random.Random(seed)
    n = 24
    decisions = {(i, j): rng.choice(["match", "review", "no_match", "no_match", "no_match"]) for i in range(n) for j in range(i + 1, n)}
    rows = spark.createDataFrame([(i, i) for i in range(n)], "seq long, node long")
    links = spark.createDataFrame([(i, j, x) for (i, j), x in decisions.items()], "i long, j long, decision string")
    got = {r.seq: (r.match_seed, r.review_seed) for r in cluster.leader_assign(rows, links).collect()}
    assert [got[i] for i in range(n)] == cluster.leader_reference(decisions, n)


# Tables.
def test_upserts(spark):
    t0, t1 = dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 2)
    kind = "source string, source_product_id string, brand string, source_url string, title string, in_stock boolean, first_seen_at timestamp, last_seen_at timestamp, missed_crawls int, lifecycle_status string"
    old = spark.createDataFrame([("a", "1", "b0", "u0", "t0", True, t0, t0, 4, "UNAVAILABLE"), ("a", "2", "b0", "u0", "t0", True, t0, t0, 0, "ACTIVE")], kind)
    new = spark.createDataFrame([("a", "1", "b1", "u1", "t1", True, t1, t1, 0, ""), ("a", "3", "b1", "u1", "t1", False, t1, t1, 0, "")], kind)
    once = store.upsert_listings(old, new)
    got = {r.source_product_id: r for r in once.collect()}
    assert (got["1"].brand, got["1"].title, got["1"].first_seen_at, got["1"].last_seen_at, got["1"].missed_crawls, got["1"].lifecycle_status) == ("b0", "t1", t0, t1, 0, "ACTIVE")
    assert got["2"].title == "t0" and got["3"].lifecycle_status == "UNAVAILABLE"
    assert sorted(map(tuple, store.upsert_listings(once, new).collect())) == sorted(map(tuple, once.collect()))
    assert {r.lifecycle_status: r.listings for r in store.lifecycle_distribution(once).collect()} == {"ACTIVE": 2, "STALE": 0, "UNAVAILABLE": 1, "DISCONTINUED": 0}
    changed = store.set_lifecycle(once, spark.createDataFrame([("a", "2", "STALE", 1), ("z", "9", "STALE", 1)], "source string, source_product_id string, lifecycle_status string, missed_crawls int"))
    assert {r.source_product_id: r.missed_crawls for r in changed.collect()} == {"1": 0, "2": 1, "3": 0}


def test_identifiers_first_writer(spark):
    o = spark.createDataFrame([("c1", "Amazon", "B0X", {"mpn": "M-1", "gtin": "12"}, 1), ("c2", "croma", "9", {"model number": "M-1", "ean": "4006381333931"}, 2)], "cluster_id string, source string, source_product_id string, attributes map<string,string>, seq long")
    ids = store.identifiers(o)
    assert sorted((r.canonical_product_id, r.identifier_type, r.identifier_value) for r in ids.collect()) == [("c1", "ASIN", "B0X"), ("c1", "MPN", "M-1"), ("c2", "EAN", "4006381333931")]
    assert store.add_identifiers(ids, ids).count() == 3


def test_price_history(spark):
    h = spark.createDataFrame([("p", 1, 10), ("p", 2, 10), ("p", 5, 7), ("q", 3, 1)], "k string, t int, price_paise long")
    assert [(r.k, r.t, r.change_paise) for r in store.price_changes(h, ["k"], ["t"]).collect()] == [("p", 5, -3)]
    asked = spark.createDataFrame([("p", 0), ("p", 4), ("p", 5), ("z", 9)], "k string, at int")
    assert sorted(map(tuple, store.price_as_of(asked, h, ["k"], "at", "t", ["price_paise"], []).collect()), key=str) == sorted([("p", 0, None), ("p", 4, 10), ("p", 5, 7), ("z", 9, None)], key=str)


# Operations.
def test_operations(spark):
    n = spark.range(1, 8).select(ops.backoff_minutes(F.col("id")).alias("m")).collect()
    assert [r.m for r in n] == [30, 60, 120, 240, 480, 480, 480]
    case = spark.createDataFrame([("ACTIVE", False, False, 0), ("ACTIVE", True, True, 0), ("ACTIVE", False, True, 0), ("STALE", True, False, 0), ("DISCONTINUED", False, False, 0), ("ACTIVE", False, False, 2)], "s string, v boolean, w boolean, e int")
    assert [r.m for r in case.select(ops.recrawl_minutes(F.col("s"), F.col("v"), F.col("w"), F.col("e")).alias("m")).collect()] == [240, 30, 1440, 2880, 10080, 60]
    plan = ops.collection_plan(spark.createDataFrame([("a", "laptop", "smoke", 7)], "source string, category string, profile string, available_products int")).first()
    assert (plan.planned_products, plan.maximum_review_records, plan.maximum_total_records) == (5, 25, 30)
    with pytest.raises(Exception, match="unsupported collection profile"):
        ops.collection_plan(spark.createDataFrame([("a", "laptop", "bad", 7)], "source string, category string, profile string, available_products int")).collect()
    bad = ops.unsupported_rows(spark.createDataFrame([("laptop", "gaming_laptop"), ("laptop", "foldable"), ("car", None), ("mobile", None)], "category string, subcategory string"))
    assert sorted(r.reason for r in bad.collect()) == ["unsupported category: car", "unsupported subcategory: foldable"]


def test_frontier(spark):
    empty = spark.createDataFrame([], "canonical_url string, url string, source string, category string, priority int, status string, error_count int, recrawl_after timestamp, seq long")
    urls = spark.createDataFrame([("http://x.com/a?ref=1", "A", "laptop", 3, 1), ("https://www.x.com/a/", "a", "laptop", 1, 2), ("https://x.com/b", "b", "laptop", 2, 3)], "url string, source string, category string, priority int, seq long")
    f = ops.enqueue(empty, urls)
    assert sorted((r.canonical_url, r.priority, r.seq) for r in f.collect()) == [("https://x.com/a", 1, 1), ("https://x.com/b", 2, 3)]
    assert ops.enqueue(f, urls).count() == 2
    now = F.lit("2026-01-01").cast("timestamp")
    assert [r.canonical_url for r in ops.pop(f, 1, now).collect()] == ["https://x.com/a"]
    assert [r.canonical_url for r in ops.pop(f, 9, now, source="B ").collect()] == ["https://x.com/b"]
    later = ops.failed(ops.failed(f, now), now)
    assert {r.error_count for r in later.collect()} == {2} and ops.pop(later, 9, now).count() == 0
    assert tuple(ops.frontier_stats(ops.completed(f, now)).first()) == (2, 0, 0, 2, 0)


def test_lifecycle_batch_and_stream(spark, tmp_path):
    from pricewright.streaming.pipeline import lifecycle_stream, step

    rng = random.Random(4)
    rows = [(f"l{i % 5}", i, dt.datetime(2026, 1, 1) + dt.timedelta(minutes=i), rng.random() < 0.3 if i % 5 else False, rng.random() < 0.8) for i in range(120)]
    kind = "listing string, crawl_id long, observed_at timestamp, ok boolean, in_stock boolean"
    want, missed = {}, {}
    for k, _, _, ok, stock in rows:
        missed[k], want[k] = step(missed.get(k, 0), ok, stock)
    df = spark.createDataFrame(rows, kind)
    batch = store.latest(ops.lifecycle(df, "listing", ["observed_at", "crawl_id"], F.col("ok"), F.col("in_stock")), ["listing"], [F.col("observed_at")])
    assert {r.listing: (r.missed_crawls, r.lifecycle_status) for r in batch.collect()} == {k: (missed[k], want[k]) for k in want}
    assert want["l0"] == "DISCONTINUED"
    for i in range(3):  # three batches
        df.filter((F.col("crawl_id") >= 40 * i) & (F.col("crawl_id") < 40 * (i + 1))).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    q = lifecycle_stream(stream).writeStream.outputMode("update").format("memory").queryName("life_test").trigger(availableNow=True).start()
    q.awaitTermination()
    got = store.latest(spark.table("life_test"), ["listing"], [F.col("crawls")])
    assert {r.listing: (r.missed_crawls, r.lifecycle_status) for r in got.collect()} == {k: (missed[k], want[k]) for k in want}


# Sources.
AMAZON = """<html><body><span id="productTitle"> HP 15s, 12th Gen Intel Core i3-1215U Laptop </span><span class="a-price"><span class="a-offscreen">₹39,990.00</span></span>
<div class="a-section-expander-container"><span class="a-expander-prompt">Memory</span><table class="prodDetTable"><tr><th class="prodDetSectionEntry">RAM Size</th><td class="prodDetAttrValue">16 GB</td></tr>
<tr><th>Item Weight</th><td>1 kg 880 g</td></tr><tr><th>Customer Care Number</th><td>123456</td></tr></table></div>
<table id="productDetails_techSpec_section_1"><tr><th>Brand</th><td>HP</td></tr><tr><th>Hard Drive Size</th><td>512 GB</td></tr></table><div id="availability"><span>Currently unavailable.</span></div></body></html>"""
CROMA = """<script>window.__INITIAL_DATA__={"pdpReducer":{"pdpData":{"name":"Lenovo LOQ Laptop","price":{"value":"79990.5"},"x":undefined,"classifications":[{"features":[{"name":"RAM","featureValues":[{"value":"16 GB"}]},
{"name":"Processor Name","featureValues":[{"value":"Core i7"},{"value":"13650HX"}]}]}]}}};</script><ul class="cp-specification-info"><li><h3 class="title">Storage</h3></li><ul class="cp-specification-spec-info"><li class="cp-specification-spec-title"><h4>SSD Capacity</h4></li><li class="cp-specification-spec-details">512 GB</li></ul></ul>"""
FLIPKART = """<h1>Apple iPhone 16 Pro (128 GB) online at best price on flipkart.com</h1><div class="Nx9bqj">₹1,09,900</div><div class="yRaY8j">₹<!-- -->1,19,900</div><div class="grid-formation"><div font="default-fk-font-l">Display</div>
<div class="grid-formation-dynamic"><div class="v1zwn28">Display Size</div><div class="v1zwn27">16.00 cm (6.3 inch)</div></div></div><li class="_21Ahn-">8 GB RAM | 128 GB ROM</li><div class="_16FRp0">Sold Out</div>"""


def test_parse_listings(spark):
    kind = "source string, source_product_id string, category string, subcategory string, source_url string, observed_at timestamp, html string, payload map<string,string>"
    now = dt.datetime(2026, 1, 1)
    rows = [
        ("amazon", "A", "laptop", None, "https://www.amazon.in/dp/A", now, AMAZON, {}), ("croma", "C", "laptop", None, "https://www.croma.com/p/1", now, CROMA, {}), ("flipkart", "F", "mobile", None, "https://www.flipkart.com/p/f", now, FLIPKART, {}),
        ("croma", "E", "laptop", None, "https://www.croma.com/p/2?_price=9000000&_mrp=9500000", now, None, {}), ("amazon", "P", "laptop", None, "https://x", now, "", {"title": "Given", "price_paise": "123400", "seller": "S"}), ("croma", "Z", "laptop", None, "https://x", now, "", {}),
    ]
    got = {r.source_product_id: r for r in retail.parse_listings(spark.createDataFrame(rows, kind)).collect()}
    a, c, f = got["A"], got["C"], got["F"]
    assert (a.title, a.brand, a.price_paise, a.in_stock) == ("HP 15s, 12th Gen Intel Core i3-1215U Laptop", "Hp", 3999000, False)
    assert {k: a.attributes[k] for k in ("ram_gb", "storage_gb", "weight_kg")} == {"ram_gb": "16", "storage_gb": "512", "weight_kg": "1.88"} and "customer care number" not in a.attributes
    assert (c.title, c.price_paise, c.seller) == ("Lenovo LOQ Laptop", 7999050, "Croma") and c.attributes["storage_gb"] == "512" and c.attributes["cpu_model"] == "Core i7, 13650HX"
    assert (f.title, f.price_paise, f.mrp_paise, f.in_stock) == ("Apple iPhone 16 Pro (128 GB)", 10990000, 11990000, False)
    assert f.attributes["screen_size_inches"] == "6.3" and f.attributes["memory"].startswith("8 GB RAM") and f.attributes["operating_system"] == "iOS"
    assert (got["E"].price_paise, got["E"].mrp_paise) == (9000000, 9500000)
    assert (got["P"].title, got["P"].price_paise, got["P"].seller) == ("Given", 123400, "S")
    assert (got["Z"].title, got["Z"].price_paise) == ("Croma Product Z", 0)


def test_attributes(spark):
    specs = [
        ("laptop", "ASUS Vivobook 15 backlit", {"RAM": "16 GB", "SSD Capacity": "1 TB", "Processor Name": "Core i5 Processor", "Processor Brand": "Intel", "Processor Variant": "1235U", "Screen Size": "39.6 cm", "Wi-Fi Generation": "Wi-Fi 6E", "Battery": "42 Wh", "Screen Resolution": "1920 x 1200", "RAM Type": "LPDDR5"}),
        ("mobile", "Foo 5G 17.22 cm", {"Primary Camera": "50MP + 8MP", "Battery Capacity": "5000 mAh", "Processor Name": "NA", "Processor": "Snapdragon 8 Gen 3 Octa-Core", "Water Resistance": "ip68", "Audio Jack": "No", "Refresh Rate": "120 Hz"}),
        ("tv", "T", {"Foo": " bar "}),
    ]
    df = spark.createDataFrame(specs, "category string, title string, specs map<string,string>")
    laptop, mobile, tv = (r.attributes for r in attributes.with_attributes(df).collect())
    want = {"ram_gb": "16", "storage_gb": "1024", "cpu_model": "Intel Core i5 1235U", "screen_size_inches": "15.6", "wifi_standard": "Wi-Fi 6E", "battery_wh": "42.0", "display_resolution": "WUXGA", "ram_type": "DDR5", "keyboard_backlight": "True", "storage_type": "SSD"}
    assert {k: laptop.get(k) for k in want} == want
    want = {"primary_camera_mp": "50", "battery_mah": "5000", "chipset": "Snapdragon 8 Gen 3", "water_resistance_rating": "IP68", "audio_jack_3_5mm": "False", "refresh_rate_hz": "120", "network_type": "5G", "screen_size_inches": "6.78", "operating_system": "Android"}
    assert {k: mobile.get(k) for k in want} == want
    assert tv == {"foo": "bar"}


def test_sitemaps(spark, tmp_path):
    xml = b'<?xml version="1.0"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><url><loc>https://www.croma.com/laptop/p/300001</loc><lastmod>2026-01-01</lastmod></url><url><loc>https://www.croma.com/laptop/p/300001?x</loc><lastmod>2026-02-01T10:00:00Z</lastmod><priority>0.8</priority></url><url><loc>https://www.croma.com/tv/p/300002</loc></url></urlset>'
    maps = spark.createDataFrame([("croma", bytearray(xml)), ("croma", bytearray(gzip.compress(xml))), ("croma", bytearray(b"<broken")), ("croma", None)], "source string, content binary")
    items = discovery.sitemap_items(maps, "laptop")
    assert items.count() == 4
    refs = discovery.references(items, "laptop", 5).collect()
    assert [(r.source_product_id, r.source_url) for r in refs] == [("300001", "https://www.croma.com/laptop/p/300001?x")]
    (tmp_path / "s.xml.gz").write_bytes(gzip.compress(xml))
    assert discovery.sitemap_files(spark, str(tmp_path), "croma").count() == 3


def test_sitemap_query_has_every_page(spark, tmp_path):
    """Pages whose words are a laptop's and whose sitemap is sound, ids of any length whole."""
    from pricewright.plans.queries import queries
    from pricewright.plans.table_queries import SITEMAP

    ids = [*range(1, 251), 1_234_567, 1_234_568]
    spark.createDataFrame([(i,) for i in ids], "page_id long").write.parquet(f"{tmp_path}/pages.parquet")
    got = queries()["sitemap_parse"](spark, str(tmp_path)).collect()
    value = lambda k, i: SITEMAP[k].values[(i + SITEMAP[k].shift) // SITEMAP[k].step % len(SITEMAP[k].values)]
    want = [i for i in ids if value("sound", i) == 1 and value("word", i) in ("laptop", "MacBook", "thinkpad-x")]
    assert len(got) == len(want) > 100 and len({r.source_product_id for r in got}) == len(want)


def test_discovery(spark):
    html = '<a href="/x/p/itmabc1234567890z">x</a><a class="q" href="/phone-cover/p/itmccc1234567890z">c</a><a href="/y/p/itmabc1234567890z">again</a><a href="/z">z</a>'
    pages = spark.createDataFrame([(1, "https://www.flipkart.com/l", html), (2, "https://www.flipkart.com/l", None)], "page_id long, url string, html string")
    assert [r.source_product_id for r in discovery.listing_scan(pages, "flipkart", 5, seeds=["itmseed", "itmabc1234567890z"]).collect()] == ["itmabc1234567890z", "itmseed"]
    state = '<script>window.__INITIAL_DATA__ = {"plpReducer":{"plpData":{"products":[{"code":"300009","url":"/p/300009","price":{"value":100.5},"mrp":{"value":200}}]}}};</script>'
    pages = spark.createDataFrame([(1, "https://www.croma.com/l", state)], "page_id long, url string, html string")
    assert discovery.listing_scan(pages, "croma", 5).first().source_url == "https://www.croma.com/p/300009?_price=10050&_mrp=20000"
    asin = spark.createDataFrame([(1, "https://www.amazon.in/s", '<div data-asin="B0ABCDEFGH"></div>')], "page_id long, url string, html string")
    assert discovery.listing_scan(asin, "amazon", 5).first().source_product_id == "B0ABCDEFGH"


def test_entry_points_without_the_subpackage(tmp_path):
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    top = Path(__file__).resolve().parent.parent
    shutil.copytree(top / "pricewright", tmp_path / "pricewright", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(top / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'cluster_prices' in q and not any(k.startswith('op') and k[2].isdigit() for k in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)


# Jobs and reviews.
def test_reviews(spark):
    from pricewright.operators import reviews

    kind = "product_id string, page_no int, cursor string, reviews array<struct<product_id:string,stars:int>>"
    rows = [("p", 1, "a", [("p", 5), ("p", 4)]), ("p", 2, "b", [("p", 3)]), ("p", 3, "a", [("p", 1)]), ("p", 4, "c", [("p", 1)]), ("q", 1, None, []), ("q", 2, "z", [("q", 1)]), ("r", 1, "y", [("q", 1)])]
    pages = spark.createDataFrame(rows, kind)
    assert sorted((r.product_id, r.reason) for r in reviews.page_faults(pages).collect()) == [("p", "repeated cursor"), ("r", "reviews of another product")]
    assert sorted((r.product_id, r.n, r.review.stars) for r in reviews.collect_reviews(pages, 2).collect()) == [("p", 1, 5), ("p", 2, 4)]
    assert reviews.collect_reviews(pages, 500).count() == 3
    e = spark.createDataFrame([("laptop", "battery", "positive", 0.9), ("laptop", "camera", "positive", 0.9), ("laptop", "battery", "negative", 2.0)], "category string, aspect string, sentiment string, confidence double")
    assert [(r.aspect, r.mentions, r.positive) for r in reviews.aspect_summary(e, ["category"]).collect()] == [("battery", 1, 1)]


def test_raw_to_tables_twice_is_once(spark):
    from pricewright.plans import jobs

    kind = "seq long, source string, source_product_id string, category string, subcategory string, source_url string, observed_at timestamp, html string, payload map<string,string>"
    now = dt.datetime(2026, 1, 1)
    rows = [(1, "amazon", "B0A", "laptop", None, "https://www.amazon.in/dp/B0A", now, AMAZON, {}), (2, "croma", "C", "laptop", None, "https://www.croma.com/p/1", now, CROMA, {}), (3, "croma", "D", "car", None, "https://www.croma.com/p/2", now, "", {}), (4, "croma", "E", "laptop", None, "http://evil.example/p", now, "", {})]
    good, bad = jobs.accepted(spark.createDataFrame(rows, kind))
    assert sorted((r.source_product_id, r.reason) for r in bad.collect()) == [("D", "unsupported category"), ("E", "host not allowed")]
    r = cluster.shared_table(jobs.reconcile_raw(good), "run")
    once = {k: cluster.shared_table(v, k) for k, v in jobs.next_tables(jobs.empty_tables(spark), r, "2026-01-01").items()}
    assert {k: v.count() for k, v in once.items()} == {"products": 2, "retailer_products": 2, "offers": 2, "product_identifiers": 1, "price_observations": 2}
    twice = jobs.next_tables(once, r, "2026-01-01")
    for k in ("products", "retailer_products", "offers", "product_identifiers"):
        assert sorted(map(str, twice[k].collect())) == sorted(map(str, once[k].collect()))


def test_table_view(spark):
    kind = "cluster_id string, category string, brand string, model_name string, linked_offers array<struct<source:string>>, best_price_paise long, best_source string, savings_paise long"
    rows = [("c1", "laptop", "hp", "x" * 50, [("amazon",), ("croma",)], 123456789, "croma", 150000), ("c2", "mobile", "apple", "iPhone", [("flipkart",)], None, None, 0)]
    got = sorted(map(tuple, cluster.table_view(spark.createDataFrame(rows, kind)).collect()))
    assert got == [("c1", "Laptop", "Hp", "x" * 45, "2 (Amazon, Croma)", "₹1,234,567.89", "Croma", "₹1,500.00"), ("c2", "Mobile", "Apple", "iPhone", "1 (Flipkart)", "N/A", "-", "-")]


def test_newly_added_urls(spark):
    frontier = spark.createDataFrame([("https://x.com/a",)], "canonical_url string")
    urls = spark.createDataFrame([("https://x.com/a",), ("https://www.x.com/b/",), ("https://x.com/b#top",), ("https://x.com/c",)], "url string")
    assert ops.added(frontier, urls) == 2


def test_discover_sitemap(spark):
    from pricewright.plans import jobs

    entry = lambda i: f"<url><loc>https://www.croma.com/laptop/p/30000{i}</loc><lastmod>2026-01-0{i}</lastmod></url>"
    maps = spark.createDataFrame([("croma", "u", "<urlset>" + "".join(map(entry, (1, 3, 2))) + "</urlset>"), ("croma", "v", f"<urlset>{entry(4)}</urlset>")], "source string, sitemap_url string, content string")
    assert jobs.discover_sitemap(maps, "croma", "u", 2) == {"source": "croma", "sitemap_url": "u", "category": "laptop", "discovered_count": 2, "product_ids": ["300003", "300002"]}


def test_keys_that_differ_in_case_or_spaces(spark):
    """The last of such keys counts, in attributes and in fingerprints; nothing fails."""
    ordered = lambda *kv: F.create_map(*[F.lit(x) for x in kv])
    rows = spark.range(1).select(F.lit("laptop").alias("category"), F.lit("HP 15").alias("title"), ordered("RAM", "8 GB", " x", "1", "ram ", "16 GB", "X", "2").alias("specs"), ordered("RAM", "a", "ram ", "b").alias("attributes"))
    got = attributes.with_attributes(rows).first().attributes
    assert got["ram_gb"] == "16" and got["ram"] == "16 GB"
    assert identity.with_fingerprint(rows).first().fp.attributes["ram"] == "b"
    assert identity.with_fingerprint(rows.withColumn("category", F.lit("tv"))).first().fp.attributes["ram"] == "b"


def test_upsert_counts_and_lookup(spark):
    old = spark.createDataFrame([("a", 1), (None, 2)], "id string, v int")
    new = spark.createDataFrame([("a", 3), (None, 4), ("b", 5)], "id string, v int")
    assert tuple(store.upsert_counts(old, new, ["id"]).first()) == (1, 3)
    assert [r.v for r in store.by_id(new, ["b", "zz"]).collect()] == [5]


def test_every_raw_record_is_accepted_or_quarantined(spark):
    url = "https://www.amazon.in/dp/B0ABCDEFGH"
    raw = [("amazon", "a", "laptop", url), ("amazon", "b", "laptop", url), ("amazon", "b", "laptop", url), (None, "c", "laptop", url), ("amazon", None, "laptop", url), (None, None, None, None), ("amazon", "d", None, url), ("amazon", "e", "laptop", None), ("amazon", "f", "laptop", "http://www.amazon.in/x")]
    ok, bad = jobs.accepted(spark.createDataFrame(raw, "source string, source_product_id string, category string, source_url string"))
    assert [r.source_product_id for r in ok.collect()] == ["a"]
    assert sorted(r.reason for r in bad.collect()) == ["duplicate id"] * 2 + ["host not allowed"] * 2 + ["missing id"] * 3 + ["unsupported category"]


def test_categories_without_normalizer_pair_with_heads_only(spark):
    """Listings without numbers meet the first of their brand and those with numbers; clusters are those of all pairs."""
    rng = random.Random(3)
    rows = []
    for i in range(60):
        number = rng.choice([None, None, None, "111", "222"])
        rows.append((i, "tv", rng.choice(["aa", "bb"]), rng.choice(["one two", "two one", "three", "four five six"]), number, rng.choice([None, None, "M1", "M2"]), {"ram_gb": "4", "storage_gb": "8", "chipset": "x"} if i % 3 == 0 else {}))
    l = spark.createDataFrame(rows, "id long, category string, brand string, model_name string, gtin string, manufacturer_part_number string, attributes map<string,string>").withColumn("title", F.col("model_name"))
    nodes = cluster.shared_table(identity.with_fingerprint(l).select("id", "fp"), "nodes")
    a, b = nodes.select(F.col("id").alias("i"), F.col("fp").alias("l")), nodes.select(F.col("id").alias("j"), F.col("fp").alias("r"))
    links = lambda pairs: match.compare(pairs).filter("decision <> 'no_match'").select("i", "j", "decision")
    seeds = lambda e: sorted(map(tuple, cluster.leader_assign(nodes.select(F.col("id").alias("seq"), F.col("id").alias("node")), e.unionByName(nodes.select(F.col("id").alias("i"), F.col("id").alias("j"), F.lit("match").alias("decision")))).select("seq", "match_seed", "review_seed").collect()), key=str)
    some = match.candidate_pairs(nodes)
    every = a.join(b, F.col("i") < F.col("j"))
    assert some.count() < every.filter("l.brand = r.brand OR l.gtin = r.gtin OR l.manufacturer_part_number = r.manufacturer_part_number").count()
    assert seeds(cluster.shared_table(links(some), "some")) == seeds(cluster.shared_table(links(every), "every"))
