"""Joins on what is near, not equal: names by token-set similarity, numbers by a band. Both are equi-joins on keys that near rows must share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ship import ship
from ..functions.similarity import token_set_ratio
from .match import SIDE, tiled_join


def _words(rows: DataFrame) -> DataFrame:
    """rows (id, name) that have a word, with words (sorted, each once), s (joined by spaces) and n (its length)."""
    words = F.array_sort(F.array_distinct(F.filter(F.split("name", r"(?U)\s+"), lambda w: w != "")))
    return rows.select("id", "name", words.alias("words")).filter(F.size("words") > 0).withColumn("s", F.array_join("words", " ")).withColumn("n", F.length("s"))


def _letters(w: DataFrame, t: float) -> DataFrame:
    """id, n, key (a letter and how often it came before), place: each name's rarest letters, so many that names alike share one."""
    chars = w.select("id", "n", F.posexplode(F.split("s", "")).alias("at", "c")).filter("c <> ''")
    nth = F.row_number().over(Window.partitionBy("id", "c").orderBy("at"))
    keys = chars.select("id", "n", F.concat("c", nth.cast("string")).alias("key"))
    often = keys.groupBy("key").agg(F.count("*").alias("often"))
    place = F.row_number().over(Window.partitionBy("id").orderBy("often", "key"))
    return keys.join(often, "key").withColumn("place", place).filter(F.col("place") <= F.col("n") - F.ceil(F.col("n") * t / (2 - t) - 1e-9) + 1).drop("often")


def _rare_words(w: DataFrame, t: float) -> DataFrame:
    """id and key (a word): the rarest words of each name, of more letters than may be missing from what it shares with another."""
    keys = w.select("id", "n", F.explode("words").alias("key"))
    often = keys.groupBy("key").agg(F.count("*").alias("often"))
    by = Window.partitionBy("id").orderBy("often", "key").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.length("key") + 1).over(by), F.lit(0))
    return keys.join(often, "key").withColumn("before", before).filter(F.col("before") <= F.col("n") + 1 - F.col("n") * t / (2 - t) + 1e-9).select("id", "key")


def candidates(rows: DataFrame, least: float, side: int = SIDE) -> DataFrame:
    """Pairs i < j of rows (id, name) among which all are that reach `least` (over 0, of 100); see similar_names."""
    t = least / 100
    w = _words(rows)
    letters, words = _letters(w, t), _rare_words(w, t)
    nx, ny = F.col("x.n"), F.col("y.n")
    need = F.ceil(t * (nx + ny) / 2 - 1e-9)
    fits = (2 * F.least(nx, ny) >= t * (nx + ny) - 1e-9) & (F.least(nx - F.col("x.place"), ny - F.col("y.place")) + 1 >= need)
    pair = [F.least("x.id", "y.id").alias("i"), F.greatest("x.id", "y.id").alias("j")]
    by_letters = tiled_join(letters, letters, ["key"], (F.col("x.id") < F.col("y.id")) & fits, side).select(*pair)
    all_words = w.select("id", F.explode("words").alias("key"))
    by_words = tiled_join(words, all_words, ["key"], F.col("x.id") != F.col("y.id"), side).select(*pair)
    return by_letters.unionByName(by_words).distinct()


def similar_names(rows: DataFrame, least: float = 75.0, side: int = SIDE) -> DataFrame:
    """i, j, ratio: the pairs (i < j by id) of rows (id, name) whose token-set ratio is at least `least`; exact, without comparing all with all.

    The ratio is the best of three, over names as sorted words. One compares them letter by letter: to reach the threshold t they need t of
    their letters in common (with repeats), so they share one of their first letters in an order from the rarest, with enough left after it, and
    their lengths agree. The others compare what is common with one name: to reach t its words must cover t / (2 - t) of that name, so
    one of the name's rarest words is in the other one. Both are equi-joins, dealt over tiles where a letter or word is common.
    Null names and those without a word are like nothing; rows of equal names pair by their ids.
    """
    ship(rows.sparkSession)
    rows = rows.select("id", "name").filter("name is not null")
    p = candidates(rows, least, side)
    side_ = lambda i, n: rows.select(F.col("id").alias(i), F.col("name").alias(n))
    p = p.join(side_("i", "a"), "i").join(side_("j", "b"), "j").withColumn("ratio", token_set_ratio(F.col("a"), F.col("b")))
    return p.filter(F.col("ratio") >= least).select("i", "j", "ratio")


def band_join(rows: DataFrame, keys: list[str], value: str, width: float, side: int = SIDE, also: Column | None = None) -> DataFrame:
    """Pairs of rows (id, keys, value; aliases "x" and "y", x.id < y.id) that agree in keys and differ by less than width in value.

    Values are cut into bins of that width; a row meets those of its own bin and of the two beside it in an equi-join. Null values and keys meet nothing.
    """
    b = rows.withColumn("bin_", F.floor(F.col(value) / width))
    near = b.withColumn("bin_", F.explode(F.array(F.col("bin_") - 1, F.col("bin_"), F.col("bin_") + 1)))
    on = (F.col("x.id") < F.col("y.id")) & (F.abs(F.col(f"x.{value}") - F.col(f"y.{value}")) < width)
    return tiled_join(b, near, [*keys, "bin_"], on if also is None else on & also, side)
