from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .repair import repair_conversations


def op12_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES = {"op12_structure_repair": op12_structure_repair}

# crc32 bit by bit over the key, which is ASCII: a byte comes in, then eight shifts (-1).
_KEY = "coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"
_BITS = f"flatten(list_transform(range(1, length({_KEY}) + 1), lambda i: list_concat([ascii(({_KEY})[i])::BIGINT], [-1::BIGINT, -1, -1, -1, -1, -1, -1, -1])))"
_CRC = f"xor(list_reduce(list_concat([4294967295::BIGINT], {_BITS}), lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END), 4294967295)"


def _to(state: str, letter: str, cost: str, line: str) -> str:
    """A state's best (cost, audit, repaired lines) with one more edit."""
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 'r': {state}.r || {line}}}"


_FAR, _STAYS, _MORE = "{'c': 1000000000, 'a': '', 'r': ''}", "f.fault IN (0, 3)", "(CASE f.fault WHEN 3 THEN 3 ELSE 0 END)"
_OWN, _USER, _ASSISTANT = "f.role || ':' || f.text || chr(10)", "'user:' || chr(10)", "'assistant:' || chr(10)"


def _role(state: str, initial: str, role: str) -> str:
    kept, new = _to(state, "K", _MORE, _OWN), _to(state, "R", f"3 + {_MORE}", f"'{role}:' || f.text || chr(10)")
    return f"CASE WHEN {_STAYS} AND f.c = '{initial}' THEN {kept} WHEN {_STAYS} THEN {new} ELSE {_FAR} END"


# Eight shifts a byte need eight -1; the list above has them. States as in the operator; inserts after each row.
SQL = {
    "op12_structure_repair": f"""
WITH RECURSIVE src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, ({_CRC}) % 20 AS h FROM conversations),
dam AS (SELECT conv_id, turn, CASE h WHEN 4 THEN 'user' ELSE role END AS role, CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE h WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM src),
o AS (SELECT *, sha256(strlen(role) || ':' || role || text) AS dg, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS ink FROM dam),
t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, dg, copy) AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, dg, copy) AS seen FROM o),
f AS (SELECT conv_id, i, turn, role, text, left(role, 1) AS c, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before, CASE WHEN ink = '' THEN 1 WHEN seen > 1 THEN 2 WHEN right(ink, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault FROM t),
n AS (SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
  count(*) FILTER (i > 1 AND before || c NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id),
p(conv_id, i, s0, s1, s2, s3) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, {{'c': 0, 'a': '', 'r': ''}}, {_FAR}, {{'c': 3, 'a': 'I', 'r': {_USER}}}, {{'c': 6, 'a': 'II', 'r': {_USER} || {_ASSISTANT}}} FROM conversations
  UNION ALL
  SELECT conv_id, i, m0, m1, m2, least(m3, {_to("m2", "I", "3", _ASSISTANT)}) FROM (
    SELECT conv_id, i, m0, m1, m3, least(m2, {_to("m0", "I", "3", _USER)}, {_to("m1", "I", "3", _USER)}, {_to("m3", "I", "3", _USER)}) AS m2 FROM (
      SELECT p.conv_id, f.i, {_to("s0", "D", "4", "''")} AS m0,
        least({_to("s1", "D", "4", "''")}, CASE WHEN {_STAYS} AND f.c = 's' THEN {_to("s0", "K", _MORE, _OWN)} ELSE {_FAR} END) AS m1,
        least({_to("s2", "D", "4", "''")}, {_role("s0", "u", "user")}, {_role("s1", "u", "user")}, {_role("s3", "u", "user")}) AS m2,
        least({_to("s3", "D", "4", "''")}, {_role("s2", "a", "assistant")}) AS m3
      FROM p JOIN f ON p.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = p.i + 1))),
e AS (SELECT p.conv_id, n.*, least(s0, s3) AS b FROM p LEFT JOIN n ON p.conv_id IS NOT DISTINCT FROM n.conv_id WHERE p.i = coalesce(n.n, 0))
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal,
  b.c::BIGINT AS cost, b.a AS audit, sha256(CASE WHEN b.r = '' THEN '' ELSE left(b.r, length(b.r) - 1) END) AS repaired_sha256 FROM e"""
}
