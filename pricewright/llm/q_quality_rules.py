from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .quality_rules import MEASURES, MIN_GROUP, SPREAD, quality_rules, surely


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op5_quality_rules": op5_quality_rules}


def _sql() -> str:
    split = "list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"
    least = lambda b: f"(({b} - greatest({b} // 32 - 1, 0) * 32)::BIGINT << greatest({b} // 32 - 1, 0)::INT)"
    tail = "CASE measure " + " ".join(f"WHEN '{m}' THEN {t}" for m, (t, _) in MEASURES.items()) + " END"
    levels = {0: ["lang", "source"], 1: ["lang"], 2: []}
    ctes, joins = [], ""
    for i, keys in levels.items():
        k = ", ".join([*keys, "measure"])
        reach = f"{SPREAD} * (q3 - q1)"
        fence = ", ".join(f"max(CASE WHEN measure = '{m}' THEN greatest(q3 + {reach}, high) END) AS {m}_hi, " + (f"max(CASE WHEN measure = '{m}' THEN least(q1 - {reach}, low) END)" if both else "NULL::BIGINT") + f" AS {m}_lo" for m, (_, both) in MEASURES.items())
        ctes.append(f"""
m{i} AS (SELECT {k}, bucket, sum(n) AS n FROM sk GROUP BY ALL),
u{i} AS (SELECT *, sum(n) OVER (PARTITION BY {k} ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY {k}) AS docs FROM m{i}),
b{i} AS (SELECT {k}, max(docs) AS docs, min(CASE WHEN 100 * upto >= 25 * docs THEN bucket END) AS b1, min(CASE WHEN 100 * upto >= 75 * docs THEN bucket END) AS b3,
  min(CASE WHEN 100 * upto >= {tail} * docs THEN bucket END) AS bl, min(CASE WHEN 100 * upto >= (100 - {tail}) * docs THEN bucket END) AS bh FROM u{i} GROUP BY ALL),
q{i} AS (SELECT *, {least("b1")} AS q1, {least("b3")} AS q3, {least("bl")} AS low, {least("(bh + 1)")} - 1 AS high FROM b{i}),
f{i} AS (SELECT {"".join(x + ", " for x in keys)}max(docs) AS docs, {fence} FROM q{i} {"GROUP BY " + ", ".join(keys) if keys else ""})""")
        joins += f" LEFT JOIN f{i} ON " + (" AND ".join(f"r.{x} IS NOT DISTINCT FROM f{i}.{x}" for x in keys) or "true")
    pick = lambda c: f"CASE WHEN f0.docs >= {MIN_GROUP} THEN f0.{c} WHEN f1.docs >= {MIN_GROUP} THEN f1.{c} ELSE f2.{c} END"
    beyond = ", ".join(f"CASE WHEN {surely(m)} > {pick(m + '_hi')}" + (f" OR coalesce({surely(m, 1)} < {pick(m + '_lo')}, false)" if both else "") + f" THEN '{m}' END" for m, (_, both) in MEASURES.items())
    melt = " UNION ALL ".join(f"SELECT lang, source, '{m}' AS measure, {m} AS v FROM r WHERE NOT base_failed" for m in MEASURES)
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text, {split} AS ws FROM documents),
ln AS (SELECT rid, line, count(*) AS n FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY ALL),
dl AS (SELECT rid, sum(n) AS n_lines, sum(n - 1) AS n_dup_lines FROM ln GROUP BY rid),
wi AS (SELECT rid, i, array_to_string(list_slice(ws, i, i + 7), ' ') AS w FROM (SELECT rid, ws, unnest(range(1, len(ws) - 6)) AS i FROM d)),
rw AS (SELECT rid, count(DISTINCT k) AS n_repeat_words FROM (SELECT rid, unnest(range(i, i + 8)) AS k FROM (SELECT *, count(*) OVER (PARTITION BY rid, w) AS c FROM wi) WHERE c > 1) GROUP BY rid),
a AS (SELECT d.rid, doc_id, lang, source, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars, (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
  coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(n_lines, 0)::BIGINT AS n_lines, (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')))::BIGINT AS n_upper,
  len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1]))::BIGINT AS n_again FROM d LEFT JOIN dl USING (rid) LEFT JOIN rw USING (rid)),
r AS (SELECT *, 10000 * n_symbols // greatest(word_chars, 1) AS symbols, 10000 * n_dup_lines // greatest(n_lines, 1) AS dup_lines, 10000 * n_repeat_words // greatest(n_words, 1) AS repeats, 10000 * n_again // greatest(n_words, 1) AS stutter,
  10000 * n_upper // greatest(word_chars, 1) AS upper, 100 * word_chars // greatest(n_words, 1) AS word_length, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM a),
mt AS ({melt}),
sk AS (SELECT lang, source, measure, greatest(length(bin(v)) - 6, 0) * 32 + (v >> greatest(length(bin(v)) - 6, 0)::INT) AS bucket, count(*) AS n FROM mt GROUP BY ALL),{",".join(ctes)},
o AS (SELECT r.*, CASE WHEN base_failed THEN 'base' ELSE array_to_string(list_filter([{beyond}], lambda x: x IS NOT NULL), ',') END AS failed FROM r{joins})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, failed = '' AS kept, failed FROM o"""


SQL = {"op5_quality_rules": _sql()}
