"""Canonical JSON against a plain writer; chains of cursors in any order."""

import json
import random

from pyspark.sql import functions as F

from pricewright.functions.canonical import json_map, json_object, json_string
from pricewright.operators import reviews


def test_canonical_json(spark):
    maps = [{}, None, {"b": "x", "a": 'q"\\/\n\r\t\b\f\x00\x1f\x7f', "ß": "Ünï ″ 😀", "😀": "", "Z": "plain", "": "empty key"}, {"k": None}]
    rows = spark.createDataFrame([(i, s, m) for i, (s, m) in enumerate(zip(["plain", None, 'a"b\\', "é"], maps, strict=True))], "id int, s string, m map<string,string>")
    got = {r.id: r for r in rows.select("id", json_string(F.col("s")).alias("s"), json_map(F.col("m")).alias("m"), json_object({"z": json_string(F.col("s")), "a": F.lit("1")}).alias("o")).collect()}
    for i, (s, m) in enumerate(zip(["plain", None, 'a"b\\', "é"], maps, strict=True)):
        assert got[i].s == json.dumps(s) and got[i].m == json.dumps(m or {}, sort_keys=True) and got[i].o == json.dumps({"a": 1, "z": s}, sort_keys=True)


def test_a_long_chain_in_no_order(spark):
    """10,000 pages are ranked in rounds that double; odd pages don't harm."""
    names = list(range(10_000))
    random.Random(1).shuffle(names)
    rows = [("p", None, f"x{names[0]}", [1])] + [("p", f"x{a}", f"x{b}", [1]) for a, b in zip(names[:-1], names[1:], strict=True)] + [("p", f"x{names[-1]}", None, [1])]
    rows += [("p", "island", "x1", [1]), (None, None, "x1", [1]), ("empty", None, "x1", []), ("self", None, "a", [1]), ("self", "a", "a", [1]), ("self", "a", "a", [1]), ("gone", None, "b", [1]), ("nohead", "a", "b", [1]), ("blank", None, "", [1]), ("blank", "", None, None)]
    random.Random(2).shuffle(rows)
    got = reviews.in_order(spark.createDataFrame(rows, "product_id string, cursor string, next_cursor string, reviews array<int>")).collect()
    assert [r.cursor for r in sorted((r for r in got if r.product_id == "p"), key=lambda r: r.page_no)] == [None, *[f"x{n}" for n in names]]
    assert sorted((r.product_id, r.page_no, r.reason or "") for r in got if r.product_id != "p") == [("blank", 1, ""), ("blank", 2, ""), ("empty", 1, ""), ("gone", 1, "no such page"), ("self", 1, ""), ("self", 2, "repeated cursor")]
    assert all(r.reason is None for r in got if r.product_id == "p")
