from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .chat import RUN, format_chats


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES = {"op10_chat_format": op10_chat_format}

SQL = {
    "op10_chat_format": f"""
WITH t AS (SELECT DISTINCT conv_id, coalesce(turn, -1) AS turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
k AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS k FROM t),
p AS (SELECT *, string_agg(sha256(turn || '/' || role || '/' || text), '' ) OVER (PARTITION BY conv_id ORDER BY k) AS h, count(*) OVER (PARTITION BY conv_id) AS n FROM k),
w AS (SELECT h, min(conv_id) AS conv_id, n, count(*) AS n_equal FROM p WHERE k = n GROUP BY h, n),
m AS (SELECT * FROM w WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.h = w.h AND p.k < p.n))
SELECT conv_id, ((k - 1) // {RUN})::BIGINT AS run, m.n::BIGINT AS n_turns, n_equal::BIGINT AS n_equal,
  string_agg('<|im_start|>' || replace(role, '<|', '< |') || chr(10) || replace(text, '<|', '< |') || '<|im_end|>' || chr(10), '' ORDER BY k) AS text
FROM m JOIN k USING (conv_id) GROUP BY ALL"""
}
