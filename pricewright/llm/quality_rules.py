"""Quality rules with adaptive thresholds, from mergeable quantile sketches for each language and source.

One pass over the texts measures each document; the measures (a few numbers a row) go to the shared folder. Documents that
pass the base rules feed sketches: counts of values in buckets of about 3 % width (the high bits of an integer), which add up
exactly in any order, so sketches of sources merge into one of a language, and of all. From each sketch come quartiles
and a tail quantile, and from these alone the fences: a document is dropped where a measure lies beyond both the group's tail
quantile (so each measure drops at most its TAIL per cent of a group) and SPREAD interquartile ranges from a quartile (so a group
without outliers loses nothing). Nothing of a fence is fixed: where most documents of a source have symbols, many are
let pass; where next to none has, few are. A document is only beyond a fence if it is by more than chance: what is held against the fence is the
lower limit of its share, CHANCE standard deviations below it (of a count among so many characters, lines or words). So a single mark in a long text
fails nowhere, not even where the fence is 0 as nearly no document has any, and a short text needs more of them than a long one. Groups of fewer than MIN_GROUP documents
use their language's sketch, and languages of fewer use that of all. Thresholds join the documents on (lang, source);
Spark splits that join where one source holds much of the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACED_CASED, coded, materialize, ship, slices, split_bytes, text_bytes

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MIN_GROUP = 50
#: A fence lies SPREAD interquartile ranges beyond a quartile at least.
SPREAD = 3
#: Measures as whole numbers: shares in ten-thousandths, word length in hundredths. For each: TAIL, the per cent of a group's documents that may
#: lie beyond its fence (less for what good texts have as well: repeated lines and passages), and whether small values fail as well.
MEASURES = {"symbols": (10, False), "dup_lines": (1, False), "repeats": (1, False), "stutter": (5, False), "upper": (5, False), "word_length": (10, True)}
#: Standard deviations of chance that a document must be beyond a fence.
CHANCE = 2
#: What each share is a share of.
PARTS = {"symbols": ("n_symbols", "word_chars"), "dup_lines": ("n_dup_lines", "n_lines"), "repeats": ("n_repeat_words", "n_words"), "stutter": ("n_again", "n_words"), "upper": ("n_upper", "word_chars")}
_SUB = 32

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True

_COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_again")


def _per_text(marks: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])[bounds[1:]] - np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])[bounds[:-1]]


def _repeated_words(codes: np.ndarray, n_codes: int, bounds: np.ndarray) -> np.ndarray:
    """Words of each text in windows that it has twice or more. Windows are numbered exactly, by pairs of pairs of pairs."""
    n = len(codes)
    if n < WINDOW:
        return np.zeros(len(bounds) - 1, np.int64)
    c, k, step = codes, n_codes, 1
    while step < WINDOW:
        c, different = pd.factorize(c[:-step] * k + c[step:])
        c, k, step = c.astype(np.int64), len(different), 2 * step
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[: len(c)]
    within = np.flatnonzero(np.arange(len(c)) + WINDOW <= bounds[1:][text])
    key, different = pd.factorize(text[within] * k + c[within])
    again = within[np.bincount(key, minlength=len(different))[key] > 1]
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + WINDOW, -1)
    return _per_text(np.cumsum(edge[:-1]) > 0, bounds)


def _lines(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lines with a word, those of them equal to an earlier line) of each text."""
    n = len(offsets) - 1
    newline = raw == 10
    before = np.concatenate([[0], np.cumsum(~newline)])
    ends = np.sort(np.concatenate([np.flatnonzero(newline).astype(np.int64) * 2, offsets[1:].astype(np.int64) * 2 - 1]))
    ends = before[(ends + 1) // 2]  # of each line, among the bytes without line ends
    text = np.repeat(np.arange(n), _per_text(newline, offsets) + 1)
    bare = raw[~newline]
    bounds = np.concatenate([[0], ends]).astype(np.int32)
    has_word = _per_text(~_SPACE[bare], bounds) > 0
    lines = pa.StringArray.from_buffers(len(ends), pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(bare)))
    codes, different = coded(lines)
    key = np.unique((text * max(1, len(different)) + codes)[has_word])
    full = np.bincount(text[has_word], minlength=n)
    return full, full - np.bincount(key // max(1, len(different)), minlength=n)


def measure_texts(texts: pa.Array) -> list[np.ndarray]:
    """The numbers named in _COLUMNS, for each text."""
    raw, offsets = text_bytes(texts)
    words, bounds = split_bytes(SPACED_CASED[raw], offsets)
    codes, different = coded(words)
    chars = pc.utf8_length(different).to_numpy(zero_copy_only=False).astype(np.int64)
    n_lines, n_dup = _lines(raw, offsets)
    again = np.r_[False, codes[1:] == codes[:-1]][: len(codes)]  # equals the word before it
    again[bounds[:-1][bounds[:-1] < len(codes)]] = False
    return [np.diff(bounds), _per_text(chars[codes], bounds), _per_text(_SYMBOL[raw], offsets), n_dup, _repeated_words(codes, len(different), bounds), n_lines, _per_text(_UPPER[raw], offsets), _per_text(again, bounds)]


def measure(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """doc_id, lang, source and the numbers named in _COLUMNS, for each row of docs; a null text has none of anything."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, "text", 4 << 20):
                got = [pa.array(x.astype(np.int64)) for x in measure_texts(b.column("text"))]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("lang"), b.column("source"), *got], names=["doc_id", "lang", "source", *_COLUMNS])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, lang string, source string, " + ", ".join(f"{c} long" for c in _COLUMNS))


def _share(part: str, whole: str, by: int = 10_000) -> Column:
    return F.expr(f"{by} * {part} div greatest({whole}, 1)")


def derived(measures: DataFrame) -> DataFrame:
    """With the columns of MEASURES and base_failed."""
    return measures.withColumns({
        **{m: _share(*p) for m, p in PARTS.items()}, "word_length": _share("word_chars", "n_words", 100),
        "base_failed": (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
    })


def surely(measure: str, sign: int = -1) -> str:
    """SQL, in Spark's words and others', of the value that a document's measure has at least (sign -1) or at most (1), but for chance."""
    if measure == "word_length":  # words' lengths deviate by about half their mean
        return f"word_length * (1 + {sign * CHANCE / 2} / sqrt(greatest(n_words, 1)))"
    part, whole = PARTS[measure]
    return f"floor(10000 * greatest({part} + {sign * CHANCE} * sqrt({part} * (1 - {part} / CAST(greatest({whole}, 1) AS DOUBLE))), 0) / greatest({whole}, 1))"


def bucket(v: Column) -> Column:
    """The bucket of a whole number of 0 or more: the number itself below 64, then 32 for each power of two."""
    e = F.greatest(F.length(F.bin(v)) - 6, F.lit(0))
    return e * _SUB + F.call_function("shiftright", v, e)


def least_of_bucket(b: Column) -> Column:
    e = F.greatest(F.floor(b / _SUB).cast("int") - 1, F.lit(0))
    return F.call_function("shiftleft", (b - e * _SUB).cast("long"), e)


def sketch(rows: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """keys, measure, bucket, n."""
    melted = rows.select(*keys, F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), bucket(F.col(m)).alias("bucket")) for m in measures])).alias("x"))
    return melted.groupBy(*keys, "x.measure", "x.bucket").agg(F.count("*").alias("n"))


def merge(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of fewer keys, from those of more."""
    return sketches.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))


def fences(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """keys, docs, and for each measure the fences <measure>_lo (or null) and <measure>_hi."""
    w = Window.partitionBy(*keys, "measure")
    s = sketches.withColumns({"upto": F.sum("n").over(w.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)), "docs": F.sum("n").over(w)})
    tail = F.coalesce(*[F.when(F.col("measure") == m, F.lit(t)) for m, (t, _) in MEASURES.items()])
    reached = lambda percent: F.min(F.when(100 * F.col("upto") >= percent * F.col("docs"), F.col("bucket")))
    q = s.groupBy(*keys, "measure").agg(F.max("docs").alias("docs"), reached(F.lit(25)).alias("b1"), reached(F.lit(75)).alias("b3"), reached(tail).alias("bl"), reached(100 - tail).alias("bh"))
    q = q.withColumns({"q1": least_of_bucket(F.col("b1")), "q3": least_of_bucket(F.col("b3")), "low": least_of_bucket(F.col("bl")), "high": least_of_bucket(F.col("bh") + 1) - 1})
    reach, out = SPREAD * (F.col("q3") - F.col("q1")), []
    for m, (_, both) in MEASURES.items():
        own = F.col("measure") == m
        low = F.least(F.col("q1") - reach, F.col("low")) if both else F.lit(None).cast("long")
        out += [F.max(F.when(own, low)).alias(f"{m}_lo"), F.max(F.when(own, F.greatest(F.col("q3") + reach, F.col("high")))).alias(f"{m}_hi")]
    return q.groupBy(*keys).agg(F.max("docs").alias("docs"), *out)


def thresholds(sketches: DataFrame, groups: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """For each (lang, source) of groups: the fences of its own sketch, its language's or that of all, by how many documents each has."""
    sketches = sketches.withColumn("one", F.lit(1))
    names = [f"{m}_{side}" for m in MEASURES for side in ("lo", "hi")]
    levels = [fences(merge(sketches, k), k) for k in (["lang", "source"], ["lang"], ["one"])]
    out = groups.withColumn("one", F.lit(1))
    for i, (level, keys) in enumerate(zip(levels, (["lang", "source"], ["lang"], ["one"]), strict=True)):
        own = level.select(*[F.col(k).alias(f"{k}_{i}") for k in keys], F.col("docs").alias(f"docs_{i}"), *[F.col(c).alias(f"{c}_{i}") for c in names])
        on = F.lit(True)
        for k in keys:
            on = on & out[k].eqNullSafe(own[f"{k}_{i}"])
        out = out.join(own, on, "left")
    pick = lambda c: F.when(F.col("docs_0") >= min_group, F.col(f"{c}_0")).when(F.col("docs_1") >= min_group, F.col(f"{c}_1")).otherwise(F.col(f"{c}_2"))
    return out.select(F.col("lang").alias("t_lang"), F.col("source").alias("t_source"), *[pick(c).alias(c) for c in names])


def quality_rules(docs: DataFrame, *, min_group: int = MIN_GROUP, **cols: str) -> DataFrame:
    """A row for each row of docs: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, failed.

    kept is false beyond a fence, too, if that is more than chance. failed names the base rules' failure ("base") or the measures beyond their fences, comma-joined. Null languages and sources are groups of
    their own. Null, empty and one-word texts fail the base rules. Rows that repeat an id are judged each by its own text. An empty table gives none. Other columns are
    ignored, whatever their names. A group whose documents all fail the base rules takes its language's fences, or all documents' ones.
    """
    rows = derived(materialize(measure(docs, **cols), "measures"))
    sketches = materialize(sketch(rows.filter(~F.col("base_failed")), ["lang", "source"], list(MEASURES)), "sketches")
    limits = materialize(thresholds(sketches, rows.select("lang", "source").distinct(), min_group), "thresholds")
    out = rows.join(limits, rows["lang"].eqNullSafe(limits["t_lang"]) & rows["source"].eqNullSafe(limits["t_source"]), "left")
    above = lambda m: F.expr(surely(m)) > F.col(f"{m}_hi")
    below = lambda m: F.coalesce(F.expr(surely(m, 1)) < F.col(f"{m}_lo"), F.lit(False))
    beyond = [F.when(above(m) | below(m) if both else above(m), F.lit(m)) for m, (_, both) in MEASURES.items()]
    failed = F.when(F.col("base_failed"), F.lit("base")).otherwise(F.array_join(F.array_compact(F.array(*beyond)), ","))
    return out.withColumn("failed", failed).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (F.col("failed") == "").alias("kept"), "failed")
