from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .near_dup import near_duplicates


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), threshold=80)


QUERIES = {"op7_near_duplicates": op7_near_duplicates}

# Exact: sets that share a shingle, joined on it; components by repeated minima over the links.
SQL = {
    "op7_near_duplicates": """
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) = 1 THEN ws ELSE list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) END AS own FROM d),
t AS (SELECT doc_id, unnest(own) AS sh FROM s),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM t x JOIN t y ON x.sh = y.sh AND x.doc_id < y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b WHERE 100 * c >= 80 * (len(x.own) + len(y.own) - c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(doc_id, seen) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.seen)
SELECT s.doc_id, len(own)::BIGINT AS n_shingles, min(seen)::BIGINT AS component_id, s.doc_id = min(seen) AS kept FROM s JOIN r USING (doc_id) GROUP BY s.doc_id, own"""
}
