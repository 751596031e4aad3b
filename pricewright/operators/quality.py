"""Quality gate of listings: accessories, price bands, completeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.rules import ordered
from ..functions.text import fold, rupees, whole_match


#: All patterns in one, as each of them stands between word boundaries: one pass over a title tells most listings from accessories.
_ANY_ACCESSORY = r"\b(?:" + "|".join(p.removeprefix(r"\b").removesuffix(r"\b") for p in fixed.ACCESSORIES) + r")\b"


def accessory(title: Column, url: Column | None = None) -> Column:
    """Why a listing is an accessory (what the first pattern found), or null. The patterns are tried in turn only where one of them is found."""
    text = fold(F.concat_ws(" ", title, *([url] if url is not None else [])))
    found = F.coalesce(*[F.concat(F.lit("accessory detected via pattern: '"), whole_match(text, p), F.lit("'")) for p in fixed.ACCESSORIES])
    return F.when(text.rlike(_ANY_ACCESSORY), found)


def price_fault(category: Column, paise: Column) -> Column:
    """Why a price isn't plausible, or null; categories without a band take any positive price."""
    cases = [(paise.isNull() | (paise <= 0), F.lit("missing or non-positive price"))]
    own = fold(F.trim(category))
    for code, (low, high) in fixed.PRICE_BANDS.items():
        cases += [
            ((own == code) & (paise < low), F.concat(F.lit("price "), rupees(paise), F.lit(" is below minimum sanity threshold "), rupees(F.lit(low)))),
            ((own == code) & (paise > high), F.concat(F.lit("price "), rupees(paise), F.lit(" exceeds maximum sanity threshold "), rupees(F.lit(high)))),
        ]
    return ordered(cases)


def completeness(title: Column, brand: Column, model: Column, paise: Column, attributes: Column) -> Column:
    """How much of a listing is there, from 0 to 100."""
    pts = lambda c, n: F.when(F.coalesce(c, F.lit(False)), n).otherwise(0)
    has = lambda *ks: F.arrays_overlap(F.map_keys(attributes), F.array(*[F.lit(k) for k in ks]))
    return (
        pts(F.length(F.trim(title)) > 5, 20) + pts((brand != "") & ~fold(brand).isin("unknown", "generic"), 20) + pts(paise > 0, 20) + pts((model != "") & (model != title), 15)
        + pts(has("ram_gb", "ram"), 10) + pts(has("storage_gb", "storage", "ssd capacity", "hdd capacity"), 10) + pts(has("cpu_model", "chipset", "processor", "processor type", "chip"), 5)
    )


def classify(listings: DataFrame) -> DataFrame:
    """listings with quality_status, quality_score, quality_flags, is_accessory, price_sanity_passed, completeness_score."""
    q = listings.withColumns({
        "acc_": accessory(F.col("title"), F.col("source_url").cast("string")), "price_": price_fault(F.col("category"), F.col("price_paise")),
        "completeness_score": completeness(F.col("title"), F.col("brand"), F.col("model_name"), F.col("price_paise"), F.col("attributes")),
    })
    acc, bad, c = F.col("acc_").isNotNull(), F.col("price_").isNotNull(), F.col("completeness_score")
    low = ~acc & ~bad & (c < 50)
    return q.withColumns({
        "quality_status": ordered([(acc, F.lit("REJECTED")), (bad | low, F.lit("SUSPICIOUS"))], F.lit("VALID")),
        "quality_score": ordered([(acc, F.least(F.floor(c / 3).cast("int"), F.lit(30))), (bad, F.least(c, F.lit(60)))], c),
        "quality_flags": F.array_compact(F.array("acc_", "price_", F.when(low, F.concat(F.lit("low completeness score: "), c, F.lit("/100"))))),
        "is_accessory": acc, "price_sanity_passed": ~bad,
    }).drop("acc_", "price_")
