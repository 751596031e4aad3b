from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .mixing import mix


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op6_mix_sources": op6_mix_sources}

SQL = {
    "op6_mix_sources": """
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
  -ln(((('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':' || coalesce(text, '')), 1, 13))::BIGINT)::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE)
  / (1.0::DOUBLE / (1.0::DOUBLE + 20.0::DOUBLE * (length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g'))) / greatest(length(coalesce(text, '')), 1))) AS key FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
s AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM s0),
r AS (SELECT *, (source_size * 3)::DOUBLE / weight AS ratio FROM s),
c AS (SELECT *, 3 * coalesce(sum(source_size) OVER o, 0) AS capped, coalesce(sum(weight) OVER o, 0) AS gone, row_number() OVER (ORDER BY ratio, source NULLS LAST) AS place FROM r WINDOW o AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, ((SELECT sum(source_size) FROM s) - capped)::DOUBLE / ((SELECT sum(weight) FROM s) - gone)::DOUBLE AS level FROM c),
t AS (SELECT source, source_size, least((source_size * 3)::DOUBLE, (SELECT level FROM l WHERE level <= ratio ORDER BY place LIMIT 1) * weight) AS target FROM l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM t),
f AS (SELECT *, round(target)::BIGINT - epochs * source_size AS rest FROM e),
k AS (SELECT d.*, source_size, target, epochs, rest, coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d JOIN f ON d.source IS NOT DISTINCT FROM f.source)
SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, rest - before)))::BIGINT AS taken FROM k"""
}
