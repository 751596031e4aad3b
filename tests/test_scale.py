"""Work that grows with the rows, dealt over tasks."""

import random

import pytest
from pyspark.sql import functions as F

from pricewright.operators import cluster, identity, match
from pricewright.plans import queries as plans

D = "/root/testdata/sf0.001"


def _nodes(spark, rows):
    kind = "id long, category string, brand string, model_name string, gtin string, manufacturer_part_number string, attributes map<string,string>"
    l = spark.createDataFrame(rows, kind).withColumn("title", F.col("model_name"))
    return cluster.shared_table(identity.with_fingerprint(l).select("id", "fp"), "nodes")


def test_numbered_nodes_of_a_block_are_not_paired(spark):
    """Different GTINs settle a pair, so a block of them makes none."""
    name = "Lenovo ThinkPad 8GB RAM 256GB"
    nodes = _nodes(spark, [(i, "laptop", "lenovo", name, f"G{i:04d}", None, {}) for i in range(60)])
    assert match.candidate_pairs(nodes).count() == 0


def test_pairs_lose_no_link(spark):
    rng = random.Random(5)
    names = ["Lenovo ThinkPad 8GB RAM 256GB", "Lenovo ThinkPad 8GB RAM 512GB", "Lenovo ThinkPad", "Lenovo LOQ 8GB RAM 256GB"]
    rows = [(i, "laptop", "lenovo", rng.choice(names), rng.choice([None, "", "G11", "G22", f"G{i:03d}"]), rng.choice([None, "", "M11", f"M{i:03d}"]), {}) for i in range(70)]
    nodes = _nodes(spark, rows)
    links = lambda p: sorted(map(tuple, match.compare(p).filter("decision <> 'no_match'").select("i", "j", "decision").collect()))
    a, b = nodes.select(F.col("id").alias("i"), F.col("fp").alias("l")), nodes.select(F.col("id").alias("j"), F.col("fp").alias("r"))
    some = links(match.candidate_pairs(nodes))
    assert some == links(a.join(b, F.col("i") < F.col("j"))) and len(some) > 20


def test_leader_cluster_links_kinds_only(spark, tmp_path, monkeypatch):
    """Links are of different brands and sizes, however many parts have them; rows without either are seeds."""
    rows = [(k, None if k == 7 else "b", None if k == 9 else 1 + k % 3 * 2) for k in range(300)]
    spark.createDataFrame(rows, "p_partkey long, p_brand string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    seen, real = [], cluster.leader_assign
    monkeypatch.setattr(cluster, "leader_assign", lambda rows, links: seen.append(links.count()) or real(rows, links))
    got = {r.p_partkey: r.seed for r in plans.queries()["leader_cluster"](spark, str(tmp_path)).collect()}
    assert seen == [5]
    # Sizes 1 and 3 are of the seed 0; 5 is beyond it, and of the first part of size 5.
    assert got == {k: k if k in (7, 9) else 2 if k % 3 == 2 else 0 for k in range(300)}


@pytest.mark.parametrize("name", ["laptop_attributes", "mobile_attributes", "laptop_fingerprint", "mobile_fingerprint", "parse_amazon"])
def test_costly_rows_are_dealt_over_tasks(spark, name):
    assert plans.queries()[name](spark, D).rdd.getNumPartitions() >= 4


@pytest.mark.parametrize(("name", "word"), [("price_band", "Repartition"), ("match_decision_mobile", "Repartition"), ("reviews_collected", "Repartition"), ("reviews_by_cursor", None)])
def test_rows_of_a_small_file_are_dealt_over_tasks(spark, monkeypatch, name, word):
    from pricewright.operators import reviews

    seen, real = [], reviews.in_order
    monkeypatch.setattr(reviews, "in_order", lambda p: seen.append(p) or real(p))
    df = plans.queries()[name](spark, D)
    plan = (seen or [df])[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [" in plan and (word is None or word in plan)


def test_reviews_are_not_sorted(spark):
    """Pages are counted before their reviews are taken apart: the window is below the generator."""
    plan = plans.queries()["reviews_collected"](spark, D)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("posexplode") < plan.index("Window [")
    assert "row_number" not in plan


def test_offer_latest_carries_what_it_gives(spark):
    plan = plans.queries()["offer_latest"](spark, D)._jdf.queryExecution().optimizedPlan().toString()
    assert "p_name" not in plan.split("Relation")[0] and "p_type" not in plan.split("Relation")[0]


def test_chains_are_ranked_by_numbers(spark, monkeypatch):
    from pricewright.operators import reviews

    seen, real = [], reviews.shared_table
    monkeypatch.setattr(reviews, "shared_table", lambda df, name: seen.append((name, dict(df.dtypes))) or real(df, name))
    rows = [("p", None, "a", [1]), ("p", "a", "b", [2]), ("p", "b", "a", [3]), ("q", None, "x", [4]), ("r", "z", None, [5])]
    got = reviews.in_order(spark.createDataFrame(rows, "product_id string, cursor string, next_cursor string, reviews array<int>")).collect()
    assert sorted((r.product_id, r.page_no, r.reviews[0], r.reason) for r in got) == [("p", 1, 1, None), ("p", 2, 2, None), ("p", 3, 3, "repeated cursor"), ("q", 1, 4, "no such page")]
    assert all(set(kinds.values()) == {"bigint"} for name, kinds in seen if name in ("jumps", "ranked"))


def test_frontier_state_is_kept_by_bucket(spark, tmp_path):
    """URLs of a bucket share a row of state and a timer; each URL's changes are its own."""
    from pricewright.streaming import frontier

    s = spark.newSession()
    for k, v in frontier.STORE.items():
        s.conf.set(k, v)
    rng, rows = random.Random(3), []
    for n in range(900):
        u, m = f"http://x/{rng.randrange(200)}?\"ü\\", n // 2
        rows.append((u, rng.choice(frontier.KINDS), f"2026-01-01 {m // 60:02d}:{m % 60:02d}:00", n, f"{u}&{n}", rng.choice([None, "s"]), "laptop", rng.choice([None, 1, 2])))
    log = spark.createDataFrame(rows, frontier.FRONTIER_EVENTS.replace("at timestamp", "at string")).withColumn("at", F.col("at").cast("timestamp"))
    for k in range(2):
        log.filter((F.col("seq") >= 450) == bool(k)).coalesce(1).write.mode("append").parquet(f"{tmp_path}/log")
        changes = frontier.frontier_changes(s.readStream.schema(frontier.FRONTIER_EVENTS).parquet(f"{tmp_path}/log"))
        q = frontier.write_changes(changes, f"{tmp_path}/changes", f"{tmp_path}/checkpoint")
        q.awaitTermination()
    # The same with a few buckets: what Spark holds is a row and a timer of each, whatever the number of URLs.
    few = frontier.write_changes(frontier.frontier_changes(s.readStream.schema(frontier.FRONTIER_EVENTS).parquet(f"{tmp_path}/log"), buckets=3), f"{tmp_path}/few", f"{tmp_path}/few_checkpoint")
    few.awaitTermination()
    held = max(p["stateOperators"][0]["numRowsTotal"] for p in few.recentProgress if p["stateOperators"])
    assert held <= 9
    want = {r.canonical_url: r for r in frontier.replay(log).collect()}
    assert len(want) > 100
    for name in ("changes", "few"):
        got = {r.canonical_url: r for r in frontier.frontier_table(spark.read.schema(frontier.CHANGE).parquet(f"{tmp_path}/{name}")).collect()}
        assert set(got) == set(want)
        assert all(got[u][c] == want[u][c] for u in want for c in ("url", "source", "category", "priority", "status", "error_count", "recrawl_after"))


def test_offer_latest_shuffles_rows_once(spark):
    """Where the parts are no small table, the rows lie as the join wants them, and what is latest is found there."""
    s = spark.newSession()
    s.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = plans.queries()["offer_latest"](s, D)._jdf.queryExecution().executedPlan().toString()
    dealt = [line.split("hashpartitioning(")[1] for line in plan.splitlines() if "hashpartitioning(" in line]
    assert dealt and all(x.startswith(("l_partkey#", "p_partkey#", "l_suppkey#")) for x in dealt)
    assert "l_suppkey" in plan and not any(x.startswith("l_partkey#") and "l_suppkey#" in x for x in dealt)


def test_offers_without_a_supplier_are_one(spark, tmp_path):
    import datetime

    import duckdb

    day = lambda k: datetime.datetime(2024, 1, 1 + k)
    rows = [(k, 1 + k % 3, None if k % 2 else k % 4, 1, 2.0, 10.0 + k, 0.1, 0.1, "A", "O" if k % 3 else None, None if k == 8 else day(k)) for k in range(20)]
    kind = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    spark.createDataFrame(rows, kind).coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(k, "n", "b", "t", 1) for k in (1, 2)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    c = duckdb.connect()
    for t in ("lineitem", "part"):
        c.execute(f"create view {t} as select * from '{tmp_path}/{t}.parquet/*.parquet'")
    want = sorted(map(str, c.execute(plans.oracle_sql()["offer_latest"]).fetchall()))
    got = sorted(str(tuple(r)) for r in plans.queries()["offer_latest"](spark, str(tmp_path)).collect())
    assert got == want and sum("(None, None" in x for x in got) == 1
