"""Queries of streams with keyed state, with SQL that says the same of the whole log at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cluster
from ..streaming import frontier, ledger
from .queries import query, table

_LOG = """e AS (SELECT 'https://shop.example/p/' || user_id || '-' || event_id % 7 AS canonical_url, CASE event_type WHEN 'view' THEN 'enqueue' WHEN 'click' THEN 'start' WHEN 'purchase' THEN 'complete' ELSE 'fail' END AS kind,
  date_trunc('milliseconds', ts) AS moment, event_id AS seq, 'https://shop.example/p/' || user_id || '-' || event_id % 7 || '?ref=' || event_id AS url, 's' || event_id % 3 AS source, CASE WHEN event_id % 2 = 0 THEN 'laptop' ELSE 'mobile' END AS category, (1 + event_id % 5)::INT AS priority FROM events),
f AS (SELECT canonical_url, min((moment, seq)) FILTER (kind = 'enqueue') AS first, arg_min(url, (moment, seq)) FILTER (kind = 'enqueue') AS url, arg_min(source, (moment, seq)) FILTER (kind = 'enqueue') AS source, arg_min(category, (moment, seq)) FILTER (kind = 'enqueue') AS category, min(priority) FILTER (kind = 'enqueue') AS priority FROM e GROUP BY canonical_url),
k AS (SELECT e.* FROM e JOIN f USING (canonical_url) WHERE (e.moment, e.seq) >= first),
g AS (SELECT *, count(*) FILTER (kind = 'complete') OVER (PARTITION BY canonical_url ORDER BY moment, seq) AS island FROM k),
n AS (SELECT *, count(*) FILTER (kind = 'fail') OVER (PARTITION BY canonical_url, island ORDER BY moment, seq)::INT AS errors FROM g),
d AS (SELECT *, moment + to_minutes(CASE kind WHEN 'complete' THEN 1440 ELSE 30 * 2 ** least(errors - 1, 4) END::INT) AS due FROM n WHERE kind IN ('complete', 'fail')),
r AS (SELECT *, coalesce(lead(moment) OVER (PARTITION BY canonical_url ORDER BY moment, seq), (SELECT max(moment) FROM e)) >= due AS released FROM d),
x AS (SELECT canonical_url, arg_max(errors, (moment, seq)) AS error_count, arg_max(due, (moment, seq)) AS recrawl_after, count(*) FILTER (released) AS releases FROM r GROUP BY canonical_url),
s AS (SELECT canonical_url, arg_max(kind, (moment, seq)) FILTER (kind <> 'enqueue') AS kind FROM k GROUP BY canonical_url)
SELECT canonical_url, url, source, category, priority, CASE kind WHEN 'start' THEN 'in_progress' WHEN 'complete' THEN 'completed' WHEN 'fail' THEN 'failed' ELSE 'pending' END AS status, coalesce(error_count, 0)::INT AS error_count, recrawl_after"""


def _log(spark: SparkSession, d: str) -> DataFrame:
    i, kind = F.col("event_id"), F.col("event_type")
    link = F.concat(F.lit("https://shop.example/p/"), "user_id", F.lit("-"), i % 7)
    return table(spark, d, "events").select(
        link.alias("canonical_url"), F.when(kind == "view", "enqueue").when(kind == "click", "start").when(kind == "purchase", "complete").otherwise("fail").alias("kind"), F.date_trunc("millisecond", "ts").cast("timestamp").alias("at"), i.alias("seq"),
        F.concat(link, F.lit("?ref="), i).alias("url"), F.concat(F.lit("s"), i % 3).alias("source"), F.when(i % 2 == 0, "laptop").otherwise("mobile").alias("category"), (1 + i % 5).cast("int").alias("priority"),
    )


@query("frontier_keyed", f"WITH {_LOG}, coalesce(releases, 0)::BIGINT AS releases FROM f JOIN s USING (canonical_url) LEFT JOIN x USING (canonical_url) WHERE first IS NOT NULL")
def frontier_keyed(spark: SparkSession, d: str) -> DataFrame:
    """The frontier as keyed state with timers: the log comes in three parts, and the stream is started anew from its checkpoint for each."""
    s = spark.newSession()
    for k, v in frontier.STORE.items():
        s.conf.set(k, v)
    path = cluster.shared_path(spark, "frontier")
    log = _log(s, d)
    first, last = log.agg(F.min(F.unix_millis("at")), F.max(F.unix_millis("at"))).first()
    place = F.try_divide(3 * (F.unix_millis("at") - F.lit(first)), F.lit(last) - F.lit(first))
    parts = cluster.shared_table(log.withColumn("part", F.least(F.floor(place), F.lit(2))), "log")
    for k in range(3):
        parts.filter(F.coalesce("part", F.lit(0)) == k).drop("part").write.mode("append").parquet(f"{path}/log")
        changes = frontier.frontier_changes(s.readStream.schema(frontier.FRONTIER_EVENTS).parquet(f"{path}/log"))
        frontier.write_changes(changes, f"{path}/changes", f"{path}/checkpoint").awaitTermination()
    table_ = frontier.frontier_table(spark.read.schema(frontier.CHANGE).parquet(f"{path}/changes"))
    return table_.select("canonical_url", "url", "source", "category", "priority", "status", "error_count", "recrawl_after", "releases")


@query("frontier_replay", f"WITH {_LOG} FROM f JOIN s USING (canonical_url) LEFT JOIN x USING (canonical_url) WHERE first IS NOT NULL")
def frontier_replay(spark: SparkSession, d: str) -> DataFrame:
    """The same log as one batch job."""
    return frontier.replay(_log(spark, d))


@query("ledger_replay", "SELECT user_id, count(*)::BIGINT AS events, sum(round(value * 100)::BIGINT)::BIGINT AS cents, (SELECT count(*) FROM events WHERE event_type = 'error')::BIGINT AS all_errors FROM events GROUP BY user_id")
def ledger_replay(spark: SparkSession, d: str) -> DataFrame:
    """Running sums, which count a batch twice if it is applied twice: three batches through the ledger, the second one again after each, the last also from
    a stream that has lost its checkpoint's commit. Errors are rows that are only added."""
    path = cluster.shared_path(spark, "ledger")
    log = ledger.Ledger(spark, f"{path}/tables", {"sums": "user_id long, events long, cents long", "errors": "event_id long"}, added=("errors",))
    e = table(spark, d, "events").select("user_id", "event_id", "event_type", F.round(F.col("value") * 100).cast("long").alias("cents"))

    def apply(tables: ledger.Tables, batch: DataFrame) -> ledger.Tables:
        new = batch.groupBy("user_id").agg(F.count("*").alias("events"), F.sum("cents").alias("cents"))
        sums = tables["sums"].unionByName(new).groupBy("user_id").agg(F.sum("events").alias("events"), F.sum("cents").alias("cents"))
        return {"sums": sums, "errors": batch.filter("event_type = 'error'").select("event_id")}

    for k in range(3):
        e.filter(F.col("event_id") % 3 == k).write.mode("append").parquet(f"{path}/in")
        for checkpoint in ("a", "b"):  # the second knows of no batch that was done, and sends all of them again, with the same numbers
            if checkpoint == "a" or k == 0:
                log.sink(spark.readStream.schema(e.schema).parquet(f"{path}/in"), "events", apply, f"{path}/{checkpoint}").awaitTermination()
        log.apply_once("events", min(k, 1), lambda t: apply(t, e))
    t = log.tables()
    return t["sums"].withColumn("all_errors", F.lit(t["errors"].count()).cast("long"))
