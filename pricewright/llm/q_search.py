from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .search import build_index, search


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(build_index(spark.read.parquet(f"{sf_dir}/documents.parquet")), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES = {"op13_ranked_search": op13_ranked_search}

_TERMS = "list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')"

# Lower-casing A-Z first leaves the same terms: none of A-Z remains to divide.
SQL = {
    "op13_ranked_search": f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS ws FROM documents),
q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
c AS (SELECT count(*) AS n_docs, sum(len(ws))::BIGINT AS n_terms FROM d WHERE len(ws) > 0),
p AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(ws) AS term FROM d) SEMI JOIN q USING (term) GROUP BY ALL),
t AS (SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM p, c GROUP BY term, n_docs),
m AS (SELECT rid, doc_id, 10 + (90 * len(ws) * n_docs) // n_terms AS m FROM d, c),
s AS (SELECT item_id, rid, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score FROM q JOIN t USING (term) JOIN p USING (term) JOIN m USING (rid) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 10"""
}
