"""Pairwise matching of fingerprints: identifiers, hard conflicts, a 100-point score, name similarity.

A pair frame has the columns l and r (fingerprint structs). Decisions that identifiers or conflicts settle are made by Catalyst alone; the
name similarity, an Arrow-batched function, only sees the pairs that remain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.rules import built, ordered
from ..functions.ship import ship
from ..functions.similarity import token_set_ratio
from ..functions.text import fold, group
from . import identity

MATCH, REVIEW, NO_MATCH = "match", "review", "no_match"


def _both(a: Column, b: Column) -> Column:
    return F.coalesce((a != "") & (b != ""), F.lit(False))


def _differ(a: Column, b: Column) -> Column:
    """Both are there and differ."""
    return F.coalesce(a != b, F.lit(False))


def _attr(f: Column, k: str) -> Column:
    return F.try_element_at(f["attributes"], F.lit(k))


def _quoted(reason: str, a: Column, b: Column) -> Column:
    return F.concat(F.lit(f"{reason}: '"), a, F.lit("' vs '"), b, F.lit("'"))


def _numbers(x: Column, y: Column) -> list[tuple[Column, Column]]:
    return [
        (_both(x["gtin"], y["gtin"]) & _differ(x["gtin"], y["gtin"]), F.lit("different GTINs")),
        (_both(x["manufacturer_part_number"], y["manufacturer_part_number"]) & _differ(x["manufacturer_part_number"], y["manufacturer_part_number"]), F.lit("different manufacturer part numbers")),
    ]


#: What conflicts look for in a chip's name: (pattern, whether hyphens don't matter).
CHIP_PARTS = {
    "m": (r"\bm[1-5](?:\s+(?:pro|max|ultra))?\b", False), "i_sku": (r"\bi[3579]-?[0-9]{4,5}[a-z]{0,2}\b", True), "i_tier": (r"\bi[3579]\b", False), "ryzen_sku": (r"\bryzen\s+[3579]\s+[0-9]{4}[a-z]{0,2}\b", False),
    "ryzen_tier": (r"\bryzen\s+[3579]\b", False), "a": (r"\ba\d{2}(?:\s+pro)?\b", False), "gen_8": (r"8\s+gen\s+[1-4]", False),
}


def facts(f: Column) -> Column:
    """What conflicts compare, of one fingerprint: made once a listing, not once a pair."""
    laptop, mobile = (F.trim(F.coalesce(f["chip"], _attr(f, k))) for k in ("cpu_model", "chipset"))
    chip = F.when(f["category"] == "mobile", mobile).otherwise(laptop)
    part = lambda p, bare: F.replace(group(chip, p, 0), F.lit("-"), F.lit("")) if bare else group(chip, p, 0)
    return F.struct(
        chip.alias("chip"), F.trim(F.coalesce(f["gpu_model"], _attr(f, "gpu_model"))).alias("gpu"), F.coalesce(f["generation"], _attr(f, "generation")).alias("generation"), F.coalesce(f["screen_size_inches"], _attr(f, "screen_size_inches").try_cast("double")).alias("screen"),
        *[F.coalesce(f[k].cast("long"), _attr(f, k).try_cast("long")).alias(k) for k in ("ram_gb", "storage_gb")], _attr(f, "network_type").alias("network"), *[part(*v).alias(k) for k, v in CHIP_PARTS.items()],
    )


def laptop_conflict(x: Column, y: Column, fx: Column | None = None, fy: Column | None = None) -> Column:
    fx, fy = facts(x) if fx is None else fx, facts(y) if fy is None else fy
    a, b = fx["chip"], fy["chip"]
    chips = _quoted("different processor/chip generation", a, b)
    other = _both(a, b) & (a != b)
    differ = lambda k: _differ(fx[k], fy[k])
    return ordered([
        *_numbers(x, y),
        *[(differ(k), F.lit(f"different identity attribute: {k}")) for k in ("ram_gb", "storage_gb")],
        (_differ(x["family"], y["family"]), _quoted("different product families", x["family"], y["family"])),
        (fx["gpu"].contains("nvidia") & fy["gpu"].contains("nvidia") & (fx["gpu"] != fy["gpu"]), _quoted("different dedicated GPU model", fx["gpu"], fy["gpu"])),
        (other & (differ("m") | (a.contains("ultra") & b.contains("ultra")) | differ("i_sku") | differ("i_tier") | differ("ryzen_sku")), chips),
        (other & differ("generation"), F.concat(F.lit("different processor/chip generation: "), fx["generation"], F.lit(" vs "), fy["generation"])),
        (other & differ("ryzen_tier"), chips),
        (F.abs(fx["screen"] - fy["screen"]) >= 0.7, F.concat(F.lit("different screen size: "), fx["screen"].cast("string"), F.lit('" vs '), fy["screen"].cast("string"), F.lit('"'))),
    ])


def mobile_conflict(x: Column, y: Column, fx: Column | None = None, fy: Column | None = None) -> Column:
    fx, fy = facts(x) if fx is None else fx, facts(y) if fy is None else fy
    chips = F.concat(F.lit("different mobile chipset: "), fx["chip"], F.lit(" vs "), fy["chip"])
    gb = lambda k: F.concat(F.lit(f"different identity attribute: {k}: "), x[k], F.lit("GB vs "), y[k], F.lit("GB"))
    return ordered([
        *_numbers(x, y),
        *[(_differ(x[k], y[k]), gb(k)) for k in ("ram_gb", "storage_gb")],
        (_differ(x["family"], y["family"]), _quoted("different product families", x["family"], y["family"])),
        (_differ(fx["a"], fy["a"]) | _differ(fx["gen_8"], fy["gen_8"]), chips),
        (_differ(fx["network"], fy["network"]), F.lit("different network generation (4G vs 5G)")),
    ])


def _weighted(weights: dict[str, float], alike: dict[str, Column]) -> Column:
    total = F.lit(0.0)
    for k, w in weights.items():
        total = total + F.when(F.coalesce(alike[k], F.lit(False)), F.lit(w)).otherwise(0.0)
    return F.round(total, 4)


def laptop_similarity(x: Column, y: Column) -> Column:
    same = {k: (x[k] == y[k]) for k in ("brand", "chip", "ram_gb", "storage_gb", "gpu_model")} | {"screen_size_inches": F.abs(x["screen_size_inches"] - y["screen_size_inches"]) < 0.1}
    return _weighted({"brand": 0.25, "chip": 0.25, "ram_gb": 0.15, "storage_gb": 0.15, "gpu_model": 0.10, "screen_size_inches": 0.10}, same)


def mobile_similarity(x: Column, y: Column) -> Column:
    weights = {"brand": 0.30, "chip": 0.25, "storage_gb": 0.25, "ram_gb": 0.15, "family": 0.05}
    return _weighted(weights, {k: (x[k] == y[k]) for k in weights})


identity.register_category(identity.Category("laptop", identity.laptop_fingerprint, laptop_conflict, laptop_similarity, tuple(fixed.TAXONOMY["laptop"]["identity"])))
identity.register_category(identity.Category("mobile", identity.mobile_fingerprint, mobile_conflict, mobile_similarity, tuple(fixed.TAXONOMY["mobile"]["identity"])))


def conflict(x: Column, y: Column, fx: Column | None = None, fy: Column | None = None) -> Column:
    """Why two fingerprints can't be one product, or null; fx and fy are their facts(), if they are at hand."""

    def of(c: identity.Category) -> Column:
        if c.conflict in (None, laptop_conflict, mobile_conflict):
            return (c.conflict or laptop_conflict)(x, y, fx, fy)
        return c.conflict(x, y)

    own = [(x["category"] == code, of(c)) for code, c in identity.categories().items()]
    return ordered([(x["category"] != y["category"], F.lit("different categories")), (x["brand"] != y["brand"], F.lit("different brands"))], ordered(own))


POINTS = ("brand_points", "model_points", "ram_points", "storage_points", "chip_points", "identifier_points", "spec_points")


def points(x: Column, y: Column) -> Column:
    """The 100-point identity score by part, with total and tier."""
    same_gtin = _both(x["gtin"], y["gtin"]) & (x["gtin"] == y["gtin"])
    same_mpn = _both(x["manufacturer_part_number"], y["manufacturer_part_number"]) & (fold(x["manufacturer_part_number"]) == fold(y["manufacturer_part_number"]))
    number = same_gtin | same_mpn
    brand = x["brand"] == y["brand"]
    model = ordered([
        (F.coalesce(x["family"] == y["family"], F.lit(False)) | (x["model_name"] == y["model_name"]), F.lit(25)),
        (x["model_name"].contains(y["model_name"]) | y["model_name"].contains(x["model_name"]), F.lit(18)),
    ], F.lit(0))

    def size(k: str) -> Column:
        a, b = (F.coalesce(f[k].cast("string"), _attr(f, k)) for f in (x, y))
        return ordered([(a == b, F.lit(15)), (a.isNull() & b.isNull(), F.lit(8))], F.lit(0))

    chip = lambda f: F.trim(F.coalesce(f["chip"], _attr(f, "cpu_model"), _attr(f, "chipset"), F.lit("")))
    a, b = chip(x), chip(y)
    chips = ordered([((a == "") & (b == ""), F.lit(5)), ((a == "") | (b == ""), F.lit(0)), (a == b, F.lit(10)), (a.contains(b) | b.contains(a), F.lit(7))], F.lit(0))
    alike = lambda k, n: F.when(F.coalesce((_attr(x, k) != "") & (fold(_attr(x, k)) == fold(_attr(y, k))), F.lit(False)), F.lit(n)).otherwise(0)
    all_of = number & brand
    parts = {
        "brand_points": F.when(brand, 20).otherwise(0), "model_points": model, "ram_points": size("ram_gb"), "storage_points": size("storage_gb"),
        "chip_points": chips, "identifier_points": F.when(number, 10).otherwise(0), "spec_points": alike("color", 3) + alike("gpu_model", 2),
    }
    full = dict(zip(POINTS, (20, 25, 15, 15, 10, 10, 5), strict=True))
    live = x["category"] == y["category"]
    cols = {k: F.when(live, F.when(all_of, F.lit(full[k])).otherwise(c)).otherwise(0).cast("int") for k, c in parts.items()}
    total = sum((cols[k] for k in POINTS[1:]), cols[POINTS[0]])
    tier = ordered([(total >= 90, F.lit("match")), (total >= 75, F.lit("strong_match")), (total >= 60, F.lit("review"))], F.lit("no_match"))
    return F.struct(*[c.alias(k) for k, c in cols.items()], total.alias("total"), F.when(live, tier).otherwise(F.lit("no_match")).alias("tier"))


def missing_attributes(x: Column, y: Column) -> Column:
    """The category's identity attributes that either side lacks, in order."""
    own = ordered([(x["category"] == code, F.array(*[F.lit(k) for k in c.identity]).cast("array<string>")) for code, c in identity.categories().items()], F.array().cast("array<string>"))
    return F.filter(own, lambda k: ~(F.map_contains_key(x["attributes"], k) & F.map_contains_key(y["attributes"], k)))


def compare(pairs: DataFrame) -> DataFrame:
    """pairs with decision, confidence, reason and score (the points). Pairs may bring their sides' facts() as lf_ and rf_."""
    ship(pairs.sparkSession)
    x, y = F.col("l"), F.col("r")
    if "lf_" not in pairs.columns:
        pairs = pairs.withColumns(built(lambda: {"lf_": facts(x), "rf_": facts(y)}, "facts"))
    named = lambda k, what: (_both(x[k], y[k]), F.when(x[k] == y[k], F.lit(f"exact {what}")).otherwise(F.lit(f"different {what}s")))
    settled = ordered([named("gtin", "GTIN"), named("manufacturer_part_number", "manufacturer part number")])
    known = ", ".join(f"{k}={id(c)}" for k, c in identity.categories().items())
    p = pairs.withColumns(built(lambda: {"reason": F.coalesce(settled, conflict(x, y, F.col("lf_"), F.col("rf_")))}, "conflict", known)).drop("lf_", "rf_").withColumns(built(lambda: {"score": points(x, y)}, "points"))
    clash = ~F.col("reason").startswith("exact ") & ~F.col("reason").isin("different GTINs", "different manufacturer part numbers")
    nothing = F.struct(*[F.lit(0).alias(k) for k in POINTS], F.lit(0).alias("total"), F.lit("no_match").alias("tier"))
    done = p.filter(F.col("reason").isNotNull()).withColumns({
        "decision": F.when(F.col("reason").startswith("exact "), F.lit(MATCH)).otherwise(F.lit(NO_MATCH)), "confidence": F.lit(100.0),
        "score": F.when(clash & ~_both(x["gtin"], y["gtin"]), nothing).otherwise(F.col("score")),
    })

    rest = p.filter(F.col("reason").isNull()).drop("reason").withColumns({"missing": missing_attributes(x, y), "alike": token_set_ratio(x["model_name"], y["model_name"])})
    part = lambda k, one, none: F.when(x[k].isNotNull() & y[k].isNotNull(), F.when(x[k] == y[k], F.lit(1.0)).otherwise(one)).when(x[k].isNotNull() | y[k].isNotNull(), F.lit(0.80)).otherwise(none)
    whole = part("family", 0.0, 0.85) * 30.0 + part("chip", 0.85, 0.85) * 25.0 + F.lit(25.0) + F.col("alike") / 100.0 * 20.0
    rest = rest.withColumn("whole", whole)
    lacking = F.size("missing") > 0
    sure = (F.col("whole") >= 88) & (F.col("alike") >= 75) & F.col("score.tier").isin("match", "strong_match")
    maybe = (F.col("whole") >= 65) | (F.col("score.tier") == "review")
    rest = rest.withColumns({
        "decision": ordered([(lacking, F.lit(REVIEW)), (sure, F.lit(MATCH)), (maybe, F.lit(REVIEW))], F.lit(NO_MATCH)),
        "confidence": F.when(lacking, F.least(F.col("alike"), F.lit(85.0))).otherwise(F.round("whole", 2)),
        "reason": ordered([(lacking, F.concat(F.lit("missing identity attributes: "), F.array_join("missing", ", "))), (sure, F.lit("canonical product identity attributes match")), (maybe, F.lit("same category identity attributes; model name evaluated"))], F.lit("insufficient attribute similarity")),
    })
    return done.unionByName(rest.drop("missing", "alike", "whole"))


#: Rows of each side that meet in one tile of a block.
SIDE = 2_000


def tiled_join(x: DataFrame, y: DataFrame, keys: list[str], condition: Column, side: int = SIDE) -> DataFrame:
    """x and y (id and keys at least; aliases "x" and "y") joined on keys and the condition, however many rows share a key.

    The pairs of a key with more than side * side of them are dealt over tiles, each of about `side` rows of x and of y by a hash of their
    ids; every row goes to the tiles of its row or column. So the largest task is a few tiles, not a block, and rows are copied as often as
    their block has tiles along the other side.
    """
    n = x.groupBy(*keys).agg(F.count("*").cast("double").alias("nx")).join(y.groupBy(*keys).agg(F.count("*").cast("double").alias("ny")), keys)
    large = n.filter(F.col("nx") * F.col("ny") > float(side) * side).select(*keys, *[F.ceil(F.col(c) / side).cast("int").alias(m) for c, m in (("nx", "mx_"), ("ny", "my_"))])
    tiles = lambda m: F.explode(F.sequence(F.lit(0), F.coalesce(F.col(m), F.lit(1)) - 1))
    tile = lambda m: F.pmod(F.xxhash64("id"), F.coalesce(F.col(m), F.lit(1))).cast("int")
    xt = x.join(large, keys, "left").withColumn("tx_", tile("mx_")).withColumn("ty_", tiles("my_")).drop("mx_", "my_")
    yt = y.join(large, keys, "left").withColumn("ty_", tile("my_")).withColumn("tx_", tiles("mx_")).drop("mx_", "my_")
    on = condition
    for k in (*keys, "tx_", "ty_"):
        on = on & (F.col(f"x.{k}") == F.col(f"y.{k}"))
    return xt.alias("x").join(yt.alias("y"), on)


#: Ids in an array of group_pairs: the pairs of two arrays are in a task's memory at a time.
PIECE = 200


def group_pairs(rows: DataFrame, keys: list[str], alike: list[str], made: dict[str, Column], side: int = SIDE) -> DataFrame:
    """Groups of rows (id, keys and the columns alike) joined on keys, aliases "x" and "y": keys, alike, what is made of these, and ids, a sorted array.
    Rows i < j that share the keys are in one pair of groups, i in x's and j in y's; a pair may hold others, with i >= j (expanded leaves them out).

    What two rows' columns alike decide is decided once for all such rows. Blocks are dealt over tiles as in tiled_join; groups are
    made within a tile's side and cut into arrays of PIECE ids, however many rows are alike. Pairs outnumber the rows, so that the
    shuffle's size says nothing about the work: its partitions aren't put together.
    """
    n = rows.groupBy(*keys).agg(F.count("*").alias("n_")).filter(F.col("n_") > side).select(*keys, F.ceil(F.col("n_") / side).cast("int").alias("m_"))
    m = F.coalesce(F.col("m_"), F.lit(1))
    own = rows.filter("id is not null").join(n, keys, "left").groupBy(*keys, *alike, m.alias("m_"), F.pmod(F.xxhash64("id"), m).cast("int").alias("t_")).agg(F.sort_array(F.collect_list("id")).alias("ids"))
    own = own.withColumn("ids", F.explode(F.transform(F.sequence(F.lit(1), F.size("ids"), F.lit(PIECE)), lambda k: F.slice("ids", k, PIECE)))).withColumns(made)
    other, parts = F.explode(F.sequence(F.lit(0), F.col("m_") - 1)), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    x = own.withColumns({"tx_": F.col("t_"), "ty_": other}).drop("t_", "m_").repartition(parts, *keys, "tx_", "ty_")
    y = own.withColumns({"ty_": F.col("t_"), "tx_": other}).drop("t_", "m_").repartition(parts, *keys, "tx_", "ty_")
    on = F.element_at("x.ids", 1) < F.element_at("y.ids", -1)
    for k in (*keys, "tx_", "ty_"):
        on = on & (F.col(f"x.{k}") == F.col(f"y.{k}"))
    return x.alias("x").join(y.alias("y").hint("merge"), on)


def expanded(groups: DataFrame) -> DataFrame:
    """Pairs i < j of the ids in the arrays i and j, with the other columns."""
    rest = [c for c in groups.columns if c not in ("i", "j")]
    one = groups.select(F.explode("i").alias("i"), "j", *rest)
    return one.select("i", F.explode("j").alias("j"), *rest).filter("i < j")


def candidate_pairs(nodes: DataFrame, side: int = SIDE) -> DataFrame:
    """Pairs (i < j by id) of nodes (id, fp) that aren't surely different: the same category, brand and no clash of family, RAM or storage, or a
    common GTIN or part number. Columns i, j, l, r, and the sides' facts lf_ and rf_.

    Two nodes that both have a GTIN, or both have a part number, are decided by those alone, so they come together by an equal number only: in
    blocks a node meets those whose numbers aren't of its kinds. However many listings with numbers share a block, none are compared in it.

    Nodes that have family, RAM and storage join each other on all of them; only those that lack one are paired within their brand, where what
    both have must agree. So the pairs are exact, and a brand's listings aren't all paired with each other.

    Nodes of a category without a normalizer that have no GTIN or part number are paired with the first such node of their brand and with
    those that have a number, not with each other: compare() puts any two of them at least to review, so that only the first of them
    can ever be the seed of a cluster, and pairs of the others decide nothing.

    If nodes have a column fresh, pairs of two that aren't are left out. Large blocks are dealt over tiles (tiled_join).
    """
    if "fresh" not in nodes.columns:
        nodes = nodes.withColumn("fresh", F.lit(True))
    keys = ["family", "ram_gb", "storage_gb"]
    n = nodes.select("id", "fp", "fresh", *[F.col(f"fp.{k}").alias(k) for k in ("category", "brand", *keys, "gtin", "manufacturer_part_number")])
    n = n.withColumn("whole", F.col("family").isNotNull() & F.col("ram_gb").isNotNull() & F.col("storage_gb").isNotNull())
    numberless = ~F.coalesce(F.col("gtin") != "", F.lit(False)) & ~F.coalesce(F.col("manufacturer_part_number") != "", F.lit(False))
    loose = ~F.col("category").isin(list(identity.categories())) & numberless
    heads = n.filter(loose).groupBy("category", "brand").agg(F.min("id").alias("head")).select("head")
    n = n.join(heads, F.col("id") == F.col("head"), "left").withColumn("follows", loose & F.col("head").isNull()).drop("head")
    n = n.drop("fp")
    # kind: 1 for a GTIN, 2 for a part number, 3 for both; a node meets kinds that it has nothing in common with.
    has = lambda k: F.coalesce(F.col(k) != "", F.lit(False))
    n = n.withColumn("kind", F.when(has("gtin"), 1).otherwise(0) + F.when(has("manufacturer_part_number"), 2).otherwise(0))
    meets = F.array(*[F.array(*[F.lit(b) for b in range(4) if not a & b]) for a in range(4)])
    met = n.withColumn("kind", F.explode(meets[F.col("kind")]))
    ids = [F.least("x.id", "y.id").alias("i"), F.greatest("x.id", "y.id").alias("j")]
    some = F.col("x.fresh") | F.col("y.fresh")
    agree = (F.col("x.id") != F.col("y.id")) & some
    for k in keys:
        agree = agree & (F.col(f"x.{k}").isNull() | F.col(f"y.{k}").isNull() | (F.col(f"x.{k}") == F.col(f"y.{k}")))
    out = tiled_join(n.filter("whole"), met.filter("whole"), ["category", "brand", *keys, "kind"], (F.col("x.id") < F.col("y.id")) & some, side).select(*ids)
    lacking = tiled_join(n.filter("not whole and not follows"), met, ["category", "brand", "kind"], agree, side).select(*ids)
    return _numbered(n.drop("kind"), out.union(lacking), nodes, side)


def _numbered(n: DataFrame, pairs: DataFrame, nodes: DataFrame, side: int) -> DataFrame:
    for k in ("gtin", "manufacturer_part_number"):
        own = n.filter(F.col(k) != "").select("id", k, "fresh")
        pairs = pairs.union(tiled_join(own, own, [k], (F.col("x.id") < F.col("y.id")) & (F.col("x.fresh") | F.col("y.fresh")), side).select(F.col("x.id"), F.col("y.id")))
    pairs = pairs.distinct()
    fp = lambda i, f: nodes.select(F.col("id").alias(i), F.col("fp").alias(f), facts(F.col("fp")).alias(f"{f}f_"))
    return pairs.join(fp("i", "l"), "i").join(fp("j", "r"), "j")
