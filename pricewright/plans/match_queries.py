"""Queries of the matcher with their SQL: token-set similarity, repeated words, decisions with their points."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..functions.spread import spread
from ..operators import identity, match
from .queries import query, table
from .sample import Field, cases, columns, field, group, selects

# Token-set similarity. LCS row by row: each row is the running maximum of what its character adds to the row before.
RATIO = """words AS (SELECT *, list_sort(list_distinct(list_filter(regexp_split_to_array(a, '\\s+'), lambda x: x <> ''))) AS x, list_sort(list_distinct(list_filter(regexp_split_to_array(b, '\\s+'), lambda x: x <> ''))) AS y FROM named),
parts AS (SELECT a, b, len(x) AS nx, len(y) AS ny, array_to_string(list_filter(x, lambda w: list_contains(y, w)), ' ') AS both_, array_to_string(list_filter(x, lambda w: NOT list_contains(y, w)), ' ') AS l, array_to_string(list_filter(y, lambda w: NOT list_contains(x, w)), ' ') AS r FROM words),
lcs(a, b, l, r, i, q) AS (SELECT a, b, l, r, 0, list_transform(range(0, length(r) + 1), lambda j: 0::BIGINT) FROM parts UNION ALL
  SELECT a, b, l, r, i + 1, list_transform(range(1, length(r) + 2), lambda j: list_max(list_transform(range(1, j + 1), lambda c: CASE WHEN c > 1 AND substr(l, i + 1, 1) = substr(r, c - 1, 1) THEN q[c - 1] + 1 ELSE q[c] END))) FROM lcs WHERE i < length(l)),
sized AS (SELECT p.*, q[len(q)] AS common, CASE WHEN both_ <> '' THEN 1 ELSE 0 END AS space FROM parts p JOIN lcs ON p.a = lcs.a AND p.b = lcs.b AND lcs.i = length(p.l)),
lengths AS (SELECT *, length(both_) + space + length(l) AS n, length(both_) + space + length(r) AS m FROM sized),
ratio AS (SELECT a, b, CASE WHEN nx = 0 OR ny = 0 THEN 0.0 WHEN both_ <> '' AND (l = '' OR r = '') THEN 100.0 ELSE 100.0 * greatest(1 - (length(l) + length(r) - 2 * common)::DOUBLE / (n + m),
  CASE WHEN both_ <> '' THEN 1 - (space + length(l))::DOUBLE / (length(both_) + n) ELSE 0 END, CASE WHEN both_ <> '' THEN 1 - (space + length(r))::DOUBLE / (length(both_) + m) ELSE 0 END) END AS alike FROM lengths)"""


def _token_sql() -> str:
    return f"WITH RECURSIVE names AS (SELECT DISTINCT p_name AS a FROM part WHERE p_name IS NOT NULL), named AS (SELECT x.a, y.a AS b FROM names x, names y), {RATIO} SELECT a, b, round(alike, 6) AS ratio FROM ratio"


@query("token_set", _token_sql())
def token_set(spark: SparkSession, d: str) -> DataFrame:
    """All pairs of part's different names (a few dozen whatever the table's size); names without a common word can be alike too."""
    from ..functions.similarity import token_set_ratio

    names = table(spark, d, "part").select(F.col("p_name").alias("a")).filter("a is not null").distinct()
    pairs = names.crossJoin(names.withColumnRenamed("a", "b"))
    return pairs.select("a", "b", F.round(token_set_ratio(F.col("a"), F.col("b")), 6).alias("ratio"))


@query("token_set_join", f"WITH RECURSIVE names AS (SELECT DISTINCT p_name || ' ' || lower(p_type) AS a FROM part WHERE p_name IS NOT NULL AND p_type IS NOT NULL), named AS (SELECT x.a, y.a AS b FROM names x JOIN names y ON x.a < y.a), {RATIO} SELECT a, b, round(alike, 6) AS ratio FROM ratio WHERE alike >= 75")
def token_set_join(spark: SparkSession, d: str) -> DataFrame:
    """Names of parts with their types that are at least 75 alike: a similarity join, where token_set compares all with all."""
    from ..operators.names import similar_names

    rows = table(spark, d, "part").select(F.concat("p_name", F.lit(" "), F.lower("p_type")).alias("id")).filter("id is not null").distinct().withColumn("name", F.col("id"))
    return similar_names(rows).select(F.col("i").alias("a"), F.col("j").alias("b"), F.round("ratio", 6).alias("ratio"))


@query("price_band", "SELECT x.p_partkey AS i, y.p_partkey AS j FROM part x JOIN part y ON x.p_brand = y.p_brand AND x.p_partkey < y.p_partkey AND x.p_partkey // 1000 = y.p_partkey // 1000 AND abs(x.p_retailprice - y.p_retailprice) < 0.7")
def price_band(spark: SparkSession, d: str) -> DataFrame:
    """Parts of a brand, of 1,000 neighbours each, whose prices differ by less than 0.7."""
    from ..operators.names import band_join

    rows = spread(table(spark, d, "part"), "p_partkey").select(F.col("p_partkey").alias("id"), "p_brand", F.expr("p_partkey div 1000").alias("slot"), "p_retailprice")
    return band_join(rows, ["p_brand", "slot"], "p_retailprice", 0.7).select(F.col("x.id").alias("i"), F.col("y.id").alias("j"))


REPEATS = {f"w{i}": Field(("Air", "air", "Pro", "15", "AIR"), 5**i) for i in range(6)}


@query("dup_word_collapse", f"""WITH p AS (SELECT p_partkey, {selects(REPEATS)} FROM part), u AS (SELECT p_partkey, unnest(range(1, 7)) AS i, unnest([w0, w1, w2, w3, w4, w5]) AS w FROM p),
b AS (SELECT *, CASE WHEN lower(w) = lag(lower(w)) OVER (PARTITION BY p_partkey ORDER BY i) THEN 0 ELSE 1 END AS fresh FROM u),
r AS (SELECT *, sum(fresh) OVER (PARTITION BY p_partkey ORDER BY i) AS run FROM b), n AS (SELECT *, row_number() OVER (PARTITION BY p_partkey, run ORDER BY i) AS nth FROM r)
SELECT p_partkey, string_agg(w, ' ' ORDER BY i) AS name FROM n WHERE nth % 2 = 1 GROUP BY p_partkey""")  # fmt: skip
def dup_word_collapse(spark: SparkSession, d: str) -> DataFrame:
    """Six words a row with runs of equal ones: each pair of neighbours becomes its first word."""
    p = table(spark, d, "part").select("p_partkey", *[c.alias(k) for k, c in columns(REPEATS).items()])
    return p.select("p_partkey", text.collapse_repeats(F.concat_ws(" ", *REPEATS)).alias("name"))


# Decisions: fields of fingerprints that neighbours often share, so that every rule has pairs that it decides.
SHARED: dict[str, Field] = {
    "brand": field("hp", "hp", "hp", "dell", step=40), "family": field("victus", "victus", "omen", None, step=9),
    "model_name": field("thinkpad e14 gen 6", "gen 6 thinkpad e14", "victus 15 gaming", "victus gaming 15 laptop", "aspire lite", "aspire lite 15", "vivobook", "", step=2),
    "ram_gb": field(16, 16, 16, 8, None, step=11), "storage_gb": field(512, 512, 1024, None, step=13),
    "manufacturer_part_number": field(None, None, None, None, None, None, "AB-1", "ab-1", "CD-2", step=3), "gtin": field(None, None, None, None, None, None, None, "111", "222", step=4),
    "color": field("Black", "black", "Red", None, step=3),
}
LAPTOP = SHARED | {
    "chip": field("m3", "m3 pro", "core ultra 7 155h", "core ultra 5 125u", "i5-1235u", "core i51235u", "i7-13620h", "i5", "ryzen 5 7520u", "ryzen 5 5500u", "ryzen 7 7840h", "celeron n4500", None, step=2, shift=1),
    "generation": field("12th", "12th", "13th", None, step=5), "screen_size_inches": field(14.0, 14.5, 15.6, None, step=7), "gpu_model": field("nvidia rtx 4050", "nvidia rtx 3050", "integrated graphics", None, step=6),
}
MOBILE = SHARED | {"chip": field("a16 bionic", "a17 pro", "snapdragon 8 gen 2", "snapdragon 8 gen 3", "dimensity 9300", None, step=3, shift=1), "network_type": field("5G", "5G", "4G", None, step=8)}
PRESENT = field(1, 1, 1, 0, step=5, shift=2)  # whether the identity attributes are there
STEPS = (1, 2, 3, 8, 21, 55)
IDENTITY = {"laptop": ("cpu_model", "gpu_model", "ram_gb", "storage_gb"), "mobile": ("chipset", "ram_gb", "storage_gb", "color")}


def _pairs(spark: SparkSession, d: str, code: str, fields: dict[str, Field]) -> DataFrame:
    """Parts with the one so many keys further on, as fingerprints of fields made of their keys."""
    p = spread(table(spark, d, "part").select("p_partkey"), "p_partkey").withColumns(columns(fields) | {"present": PRESENT.spark("p_partkey")})
    kinds = dict(x.split(" ", 1) for x in identity.FINGERPRINT.split(", "))
    there = {"cpu_model": "chip", "chipset": "chip"}
    entries = [F.struct(F.lit(k).alias("key"), F.coalesce(F.col(there.get(k, k)).cast("string"), F.lit("?")).alias("value")) for k in IDENTITY[code]]
    typed = [F.when(F.col(k).isNotNull() & (F.col("present") == 0 if k in IDENTITY[code] else F.lit(True)), F.struct(F.lit(k).alias("key"), F.col(k).alias("value"))) for k in ("color", "network_type") if k in fields]
    attributes = F.map_from_entries(F.array_compact(F.concat(F.when(F.col("present") == 1, F.array(*entries)).otherwise(F.array().cast("array<struct<key:string,value:string>>")), F.array(*typed))))
    put = {k: F.col(k) for k in fields if k in kinds} | {"category": F.lit(code), "attributes": attributes}
    fp = F.struct(*[put.get(k, F.lit(None)).cast(t).alias(k) for k, t in kinds.items()])
    n = p.select("p_partkey", fp.alias("fp"))
    a = n.select(F.col("p_partkey").alias("i"), F.col("fp").alias("l")).withColumn("j", F.explode(F.array(*[F.col("i") + s for s in STEPS])))
    return a.join(n.select(F.col("p_partkey").alias("j"), F.col("fp").alias("r")), "j")


def _decision(spark: SparkSession, d: str, code: str, fields: dict[str, Field]) -> DataFrame:
    r = match.compare(_pairs(spark, d, code, fields))
    return r.select("i", "j", "decision", F.round("confidence", 4).alias("confidence"), "reason", F.col("score.total").alias("total"), F.col("score.tier").alias("tier"))


def _decision_sql(code: str, fields: dict[str, Field]) -> str:
    """The rules in order, over columns of both sides: x_ and y_."""
    both = lambda k: f"(coalesce(x_{k}, '') <> '' AND coalesce(y_{k}, '') <> '')"
    differ = lambda a, b: f"coalesce({a} <> {b}, false)"
    found = lambda p, clean=False: differ(*[f"replace({g}, '-', '')" if clean else g for g in (group("x_chip", p, 0), group("y_chip", p, 0))])
    said = lambda what, k: f"'{what}: ''' || x_{k} || ''' vs ''' || y_{k} || ''''"
    rules = [(both("gtin") + " AND x_gtin = y_gtin", "'exact GTIN'"), (both("gtin"), "'different GTINs'"), (both("manufacturer_part_number") + " AND x_manufacturer_part_number = y_manufacturer_part_number", "'exact manufacturer part number'"), (both("manufacturer_part_number"), "'different manufacturer part numbers'"), ("x_brand <> y_brand", "'different brands'")]
    family = (differ("x_family", "y_family"), said("different product families", "family"))
    if code == "laptop":
        rules += [(differ(f"x_{k}", f"y_{k}"), f"'different identity attribute: {k}'") for k in ("ram_gb", "storage_gb")] + [family]
        rules += [("contains(x_gpu_model, 'nvidia') AND contains(y_gpu_model, 'nvidia') AND x_gpu_model <> y_gpu_model", said("different dedicated GPU model", "gpu_model"))]
        chips, other = said("different processor/chip generation", "chip"), differ(*(f"coalesce({c}_chip, CASE WHEN {c}_present = 1 THEN '?' END)" for c in "xy"))
        for test in (found(r"\bm[1-5](?:\s+(?:pro|max|ultra))?\b"), "contains(x_chip, 'ultra') AND contains(y_chip, 'ultra')", found(r"\bi[3579]-?[0-9]{4,5}[a-z]{0,2}\b", True), found(r"\bi[3579]\b"), found(r"\bryzen\s+[3579]\s+[0-9]{4}[a-z]{0,2}\b")):
            rules.append((f"{other} AND {test}", chips))
        rules += [(f"{other} AND {differ('x_generation', 'y_generation')}", "'different processor/chip generation: ' || x_generation || ' vs ' || y_generation"), (f"{other} AND {found(chr(92) + 'bryzen' + chr(92) + 's+[3579]' + chr(92) + 'b')}", chips)]
        rules += [("abs(x_screen_size_inches - y_screen_size_inches) >= 0.7", "'different screen size: ' || x_screen_size_inches || '\" vs ' || y_screen_size_inches || '\"'")]
    else:
        rules += [(differ(f"x_{k}", f"y_{k}"), f"'different identity attribute: {k}: ' || x_{k} || 'GB vs ' || y_{k} || 'GB'") for k in ("ram_gb", "storage_gb")] + [family]
        chips = "'different mobile chipset: ' || x_chip || ' vs ' || y_chip"
        rules += [(found(r"\ba\d{2}(?:\s+pro)?\b"), chips), (found(r"8\s+gen\s+[1-4]"), chips), (differ("x_network_type", "y_network_type"), "'different network generation (4G vs 5G)'")]
    number = f"({both('gtin')} AND x_gtin = y_gtin OR {both('manufacturer_part_number')} AND lower(x_manufacturer_part_number) = lower(y_manufacturer_part_number))"
    size = lambda k: f"CASE WHEN x_{k} = y_{k} THEN 15 WHEN x_{k} IS NULL AND y_{k} IS NULL AND NOT (x_present = 1 OR y_present = 1) THEN 8 WHEN coalesce(x_{k}::VARCHAR, CASE WHEN x_present = 1 THEN '?' END) = coalesce(y_{k}::VARCHAR, CASE WHEN y_present = 1 THEN '?' END) THEN 15 ELSE 0 END"
    chip = lambda s: f"coalesce({s}_chip, CASE WHEN {s}_present = 1 THEN '?' END, '')"
    a, b = chip("x"), chip("y")
    # The attribute, which only listings with identity attributes have where the field isn't given otherwise.
    attr = {"color": lambda s: f"CASE WHEN {s}_present = 1 THEN coalesce({s}_color, '?') ELSE {s}_color END" if code == "mobile" else f"{s}_color", "gpu_model": lambda s: f"CASE WHEN {s}_present = 1 THEN coalesce({s}_gpu_model, '?') END"}
    alike = lambda k, n: f"CASE WHEN lower({attr[k]('x')}) = lower({attr[k]('y')}) THEN {n} ELSE 0 END"
    spec = alike("color", 3) + (" + " + alike("gpu_model", 2) if code == "laptop" else "")
    total = f"""CASE WHEN {number} AND x_brand = y_brand THEN 100 ELSE CASE WHEN x_brand = y_brand THEN 20 ELSE 0 END
      + CASE WHEN coalesce(x_family = y_family, false) OR x_model_name = y_model_name THEN 25 WHEN contains(x_model_name, y_model_name) OR contains(y_model_name, x_model_name) THEN 18 ELSE 0 END + {size("ram_gb")} + {size("storage_gb")}
      + CASE WHEN {a} = '' AND {b} = '' THEN 5 WHEN {a} = '' OR {b} = '' THEN 0 WHEN {a} = {b} THEN 10 WHEN contains({a}, {b}) OR contains({b}, {a}) THEN 7 ELSE 0 END + CASE WHEN {number} THEN 10 ELSE 0 END + {spec} END"""
    # With equal identifiers all parts are full, but those of other brands.
    miss = "list_filter([" + ", ".join(f"CASE WHEN NOT (x_has_{k} AND y_has_{k}) THEN '{k}' END" for k in IDENTITY[code]) + "], lambda k: k IS NOT NULL)"
    has = ", ".join(f"present = 1{' OR color IS NOT NULL' if k == 'color' else ''} AS has_{k}" for k in IDENTITY[code])
    part = lambda k, n, one, none: f"CASE WHEN x_{k} IS NOT NULL AND y_{k} IS NOT NULL THEN CASE WHEN x_{k} = y_{k} THEN 1.0 ELSE {one} END WHEN x_{k} IS NOT NULL OR y_{k} IS NOT NULL THEN 0.80 ELSE {none} END::DOUBLE * {n}"
    names = [*fields, "present", *(f"has_{k}" for k in IDENTITY[code])]
    cols = lambda s: ", ".join(f"{s}.{k} AS {s}_{k}" for k in names)
    values = sorted({v for v in fields["model_name"].values})
    return f"""WITH RECURSIVE p0 AS (SELECT p_partkey, {selects(fields)}, {PRESENT.sql("p_partkey")} AS present FROM part), p AS (SELECT *, {has} FROM p0),
pairs AS (SELECT x.p_partkey AS i, y.p_partkey AS j, {cols("x")}, {cols("y")} FROM p x JOIN p y ON y.p_partkey - x.p_partkey IN {STEPS}),
names AS (SELECT unnest([{", ".join(f"'{v}'" for v in values)}]) AS a), named AS (SELECT x.a, y.a AS b FROM names x, names y), {RATIO},
s AS (SELECT *, {cases(rules)} AS settled, ({total})::INT AS points, {miss} AS missing, {part("family", 30.0, "0.0", "0.85")} + {part("chip", 25.0, "0.85", "0.85")} + 25.0 + alike / 100.0 * 20.0 AS whole FROM pairs JOIN ratio ON a = x_model_name AND b = y_model_name),
t AS (SELECT *, CASE WHEN points >= 90 THEN 'match' WHEN points >= 75 THEN 'strong_match' WHEN points >= 60 THEN 'review' ELSE 'no_match' END AS tier,
  settled IS NOT NULL AND NOT starts_with(settled, 'exact ') AND settled NOT IN ('different GTINs', 'different manufacturer part numbers') AS clash FROM s),
u AS (SELECT *, whole >= 88 AND alike >= 75 AND tier IN ('match', 'strong_match') AS sure, whole >= 65 OR tier = 'review' AS maybe FROM t)
SELECT i, j, CASE WHEN settled IS NOT NULL THEN CASE WHEN starts_with(settled, 'exact ') THEN 'match' ELSE 'no_match' END WHEN len(missing) > 0 THEN 'review' WHEN sure THEN 'match' WHEN maybe THEN 'review' ELSE 'no_match' END AS decision,
  round(CASE WHEN settled IS NOT NULL THEN 100.0 WHEN len(missing) > 0 THEN least(alike, 85.0) ELSE round(whole, 2) END, 4)::DOUBLE AS confidence,
  CASE WHEN settled IS NOT NULL THEN settled WHEN len(missing) > 0 THEN 'missing identity attributes: ' || array_to_string(missing, ', ') WHEN sure THEN 'canonical product identity attributes match' WHEN maybe THEN 'same category identity attributes; model name evaluated' ELSE 'insufficient attribute similarity' END AS reason,
  CASE WHEN clash THEN 0 ELSE points END AS total, CASE WHEN clash THEN 'no_match' ELSE tier END AS tier FROM u"""


@query("match_decision", _decision_sql("laptop", LAPTOP))
def match_decision(spark: SparkSession, d: str) -> DataFrame:
    """Laptops: identifiers, every conflict rule, missing attributes, thresholds, points."""
    return _decision(spark, d, "laptop", LAPTOP)


@query("match_decision_mobile", _decision_sql("mobile", MOBILE))
def match_decision_mobile(spark: SparkSession, d: str) -> DataFrame:
    """Phones, likewise."""
    return _decision(spark, d, "mobile", MOBILE)
