"""Batches against stored seeds, tiles of large blocks, and the frontier as keyed state."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pricewright.operators import cluster, match
from pricewright.streaming import frontier

LISTING = "seq long, category string, source string, source_product_id string, title string, price_paise long, in_stock boolean, gtin string, brand string, model_name string, source_url string"


def listings(spark, seed, n):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        brand = rng.choice(["Lenovo", "HP"])
        name = rng.choice(["ThinkPad E14", "ThinkPad", "IdeaPad Slim 3"] if brand == "Lenovo" else ["Victus", "Victus 15", "Omen 16"])
        title = f"{brand} {name} {rng.choice(['8GB RAM 512GB', '16GB RAM 512GB', '16GB', '', '8GB RAM 256GB'])} {rng.choice(['Black', 'Silver', ''])}".strip()
        rows.append((i, rng.choice(["laptop", "laptop", "laptop", "camera"]), f"s{i % 3}", f"p{i}", title, 5_000_000 + i, True, rng.choice([None, None, None, "111", "222"]), brand, title, ""))
    return spark.createDataFrame(rows, LISTING).withColumn("attributes", F.create_map().cast("map<string,string>"))


@pytest.mark.parametrize("cuts", [(13, 40)])
def test_batches_give_the_clusters_of_one_run(spark, cuts):
    df = cluster.shared_table(listings(spark, cuts[0], 60), "listings")
    cols = ("seq", "cluster_id", "cluster_seq", "review_cluster_id", "review_cluster_seq")
    whole = {tuple(r[c] for c in cols) for r in cluster.reconcile(df).collect()}
    parts = [df.filter((F.col("seq") >= a) & (F.col("seq") < b)) for a, b in zip((0, *cuts), (*cuts, 60), strict=True)]
    assert {tuple(r[c] for c in cols) for r in cluster.reconcile_batches(parts).collect()} == whole
    assert len({r[2] for r in whole}) > 5 and any(r[4] is not None for r in whole)


@pytest.mark.parametrize("side", [1, 7, 1000])
def test_tiles_give_each_pair_once(spark, side):
    rng = random.Random(side)
    rows = [(i, rng.choice(["a", "b", None]), rng.choice([1, 1, 1, 2])) for i in range(60)]
    n = spark.createDataFrame(rows, "id long, k string, m int")
    got = Counter((r.i, r.j) for r in match.tiled_join(n, n, ["k", "m"], F.col("x.id") < F.col("y.id"), side).select(F.col("x.id").alias("i"), F.col("y.id").alias("j")).collect())
    assert got == Counter((a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and a[1] and a[1:] == b[1:])


def test_one_block_is_dealt_over_tasks(spark):
    """A block of 4,000 rows among small ones: no task has more than twice the median task's pairs."""
    n = spark.range(4200).select("id", F.when(F.col("id") < 4000, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"))
    j = match.tiled_join(n, n, ["k"], F.col("x.id") < F.col("y.id"), 100)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tasks = sorted(r["count"] for r in j.groupBy(F.spark_partition_id().alias("t")).count().collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(tasks) == 4000 * 3999 // 2 + 50 * 6 and len(tasks) == 4 and tasks[-1] <= 2 * tasks[len(tasks) // 2]


def test_candidate_pairs_of_fresh_nodes_only(spark):
    df = cluster.shared_table(cluster.with_fingerprint(cluster.classify(listings(spark, 5, 40))).select(F.col("seq").alias("id"), "fp"), "nodes")
    every = {(r.i, r.j) for r in match.candidate_pairs(df).collect()}
    assert {(r.i, r.j) for r in match.candidate_pairs(df, side=2).collect()} == every
    some = {(r.i, r.j) for r in match.candidate_pairs(df.withColumn("fresh", F.col("id") >= 25)).collect()}
    loose = {r.id for r in df.filter("fp.category = 'camera'").collect()}
    assert {p for p in some if not set(p) <= loose} == {p for p in every if p[1] >= 25 and not set(p) <= loose}


def test_frontier_rules():
    state = frontier.after(None, "fail", 0, ("u", "s", "c", 5), 24, 30)
    assert state is None
    state = frontier.after(None, "enqueue", 0, ("u", "s", "c", 5), 24, 30)
    state = frontier.after(state, "enqueue", 5, ("other", "t", "d", 2), 24, 30)
    assert (state["url"], state["priority"], state["status"]) == ("u", 2, "pending")
    minutes = []
    for k in range(6):
        state = frontier.after(state, "fail", 1000 * k, ("", "", "", 9), 24, 30)
        minutes.append((state["due"] - 1000 * k) // 60_000)
    assert minutes == [30, 60, 120, 240, 480, 480] and state["error_count"] == 6
    state = frontier.after(state, "complete", 0, ("", "", "", 9), 24, 30)
    assert (state["error_count"], state["due"], state["status"]) == (0, 24 * 3_600_000, "completed")


def test_frontier_stream_with_timers_and_restarts(spark, tmp_path):
    """Backoff elapses between events and by the watermark; odd events are dropped; each restart goes on from the checkpoint."""
    s = spark.newSession()
    for k, v in frontier.STORE.items():
        s.conf.set(k, v)
    at = lambda m: f"2026-01-01 {m // 60:02d}:{m % 60:02d}:00"
    log = [
        [("a", "enqueue", 0, 1, 3), ("a", "enqueue", 1, 2, 1), ("a", "fail", 2, 3, 9), ("b", "complete", 2, 4, 9), ("b", "enqueue", 3, 5, None), (None, "enqueue", 3, 6, 1), ("c", "nonsense", 3, 7, 1), ("c", "enqueue", 4, 8, 2)],
        [("a", "start", 40, 9, 9), ("a", "fail", 41, 10, 9), ("c", "fail", 42, 11, 9), ("c", "fail", 43, 12, 9), ("c", "complete", 44, 13, 9), ("b", "start", 45, 14, 9)],
        [("z", "enqueue", 300, 15, 4)],
    ]
    rows = []
    for k, part in enumerate(log):
        new = [(u, kind, at(m), n, f"http://{u}?{n}", "src", "laptop", p) for u, kind, m, n, p in part]
        rows += new
        s.createDataFrame(new, frontier.FRONTIER_EVENTS.replace("at timestamp", "at string")).withColumn("at", F.col("at").cast("timestamp")).coalesce(1).write.parquet(f"{tmp_path}/log/part={k}")
        changes = frontier.frontier_changes(s.readStream.schema(frontier.FRONTIER_EVENTS + ", part int").parquet(f"{tmp_path}/log/*"))
        frontier.write_changes(changes, f"{tmp_path}/changes", f"{tmp_path}/checkpoint").awaitTermination()
    out = spark.read.schema(frontier.CHANGE).parquet(f"{tmp_path}/changes")
    got = {r.canonical_url: r for r in frontier.frontier_table(out).collect()}
    batch = {r.canonical_url: r for r in frontier.replay(spark.createDataFrame(rows, frontier.FRONTIER_EVENTS.replace("at timestamp", "at string")).withColumn("at", F.col("at").cast("timestamp"))).collect()}
    assert set(got) == set(batch) == {"a", "b", "c", "z"}
    for u in got:
        assert all(got[u][c] == batch[u][c] for c in ("url", "source", "category", "priority", "status", "error_count", "recrawl_after")), u
    assert (got["a"].releases, got["b"].releases, got["c"].releases, got["a"].priority, got["b"].priority) == (2, 0, 0, 1, 9)
    assert {r.canonical_url for r in out.filter("change = 'released'").collect()} == {"a"}
