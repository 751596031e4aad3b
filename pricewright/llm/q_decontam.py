from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .decontam import contamination_report


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_report(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES = {"op9_decontamination": op9_decontamination}

_WORDS = "list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')"

SQL = {
    "op9_decontamination": f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS ws FROM documents),
b AS (SELECT item_id::VARCHAR AS item, {_WORDS} AS ws FROM benchmark),
win AS (SELECT DISTINCT item, m, array_to_string(list_slice(ws, i, i + m - 1), ' ') AS w FROM (SELECT *, unnest(range(1, len(ws) - m + 2)) AS i FROM (SELECT *, least(10, len(ws)) AS m FROM b WHERE len(ws) > 0))),
place AS (SELECT rid, ws, unnest(range(1, len(ws) + 1)) AS i FROM d),
hit AS (SELECT DISTINCT rid, item, i, m FROM (SELECT rid, i, m, array_to_string(list_slice(ws, i, i + m - 1), ' ') AS w FROM place, (SELECT DISTINCT m FROM win) WHERE i + m - 1 <= len(ws)) JOIN win USING (m, w)),
n AS (SELECT rid, count(DISTINCT k) AS n_hit FROM (SELECT rid, unnest(range(i, i + m)) AS k FROM hit) GROUP BY rid),
it AS (SELECT rid, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hit GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (rid) LEFT JOIN it USING (rid)"""
}
