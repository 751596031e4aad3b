from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .license_scan import PHRASES, notice_table, scan_licenses


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op2_license_scan": op2_license_scan}


def _sql() -> str:
    """Each phrase at each word, and each notice's words against each block, without filters."""
    notices = ", ".join(f"({k}, '{family}', '{label}', {size}, {own}, {need})" for k, family, label, size, own, need in notice_table())
    at = " UNION ALL ".join(f"SELECT rid, '{x}' AS label, i - 1 AS place FROM pos WHERE list_slice(ws, i, i + {len(p.split()) - 1}) = {p.split()}" for p, x in PHRASES.items())
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS ws FROM documents),
pos AS (SELECT rid, ws, unnest(range(1, len(ws) + 1)) AS i FROM d WHERE list_has_any(ws, ['gnu', 'apache', 'cc', 'mit'])),
hit AS ({at}),
base AS (SELECT rid, count(*) AS n, min(place) AS a, max(place) AS b, list(DISTINCT label) AS labels FROM hit GROUP BY rid),
notice(k, family, label, size, own, need) AS (VALUES {notices}),
block AS (SELECT rid, size, st // size AS cell, list_distinct(list_slice(ws, st + 1, st + 2 * size)) AS held FROM (SELECT rid, ws, size, unnest(range(0, greatest(len(ws), 1), size)) AS st FROM d, (SELECT DISTINCT size FROM notice))),
near AS (SELECT *, common::DOUBLE / len(own) * 1e6 + len(own) AS weight FROM (SELECT rid, family, size, cell, label, own, need, len(list_intersect(own, held)) AS common FROM block JOIN notice USING (size)) WHERE common >= need),
best AS (SELECT *, max(weight) OVER (PARTITION BY rid, family, size ORDER BY cell RANGE BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS most FROM near),
found AS (SELECT rid, list(DISTINCT label) AS labels, max(common::DOUBLE / len(own)) AS share FROM best WHERE weight = most GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(base.n, 0)::BIGINT AS n_base, base.a::BIGINT AS first_word, base.b::BIGINT AS last_word,
  array_to_string(list_sort(list_distinct(coalesce(base.labels, []))), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(found.labels, [])))), ',') AS labels,
  CASE WHEN base.n > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0)::DOUBLE END AS score
FROM d LEFT JOIN base USING (rid) LEFT JOIN found USING (rid)"""


SQL = {"op2_license_scan": _sql()}
