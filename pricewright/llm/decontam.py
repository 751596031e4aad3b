"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the benchmark items' windows of `window` consecutive words (an item of fewer words is one window). For each
pattern length m there is a shift table over blocks of B = min(2, m) words: how far the search may move when a block ends
at its place, m - B + 1 for blocks that are in no pattern. Where the shift is 0 the block ends patterns: those in its
bucket that begin with the same block are compared directly, word by word. All tables are arrays, of about 120 bytes for each word
of the benchmark. Documents are searched in Arrow batches, without a shuffle.

A benchmark of more than BLOCK_BYTES of text is searched block by block, each in a pass of its own over the documents whose tables go before
the next one's are made; a pass writes only the rows with occurrences, and at the end these are merged by id and text and joined
with the documents. So memory is bounded whatever the benchmark's size, and time grows with the number of blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ALNUM, coded, materialize, ranges, ship, slices, tidied, unpacked, whole_row, with_text, words_of

#: Benchmark text that one search's tables are made of.
BLOCK_BYTES = 8 << 20
WINDOW = 10


class WuManber:
    """Tables for patterns of one length: rows of word numbers from 1 (0 is any other word), each with the number of its item."""

    def __init__(self, patterns: np.ndarray, items: np.ndarray, n_words: int):
        self.m = patterns.shape[1]
        self.b = min(2, self.m)
        self.base = n_words + 1
        self.far = self.m - self.b + 1
        keys, shifts = np.zeros(0, np.int64), np.zeros(0, np.int8 if self.m < 128 else np.int32)
        for end in range(self.m, self.b - 1, -1):  # the smallest shift of a block counts
            new = np.setdiff1d(self._blocks(patterns, end), keys)
            at = np.searchsorted(keys, new)
            keys, shifts = np.insert(keys, at, new), np.insert(shifts, at, self.m - end)
        self.keys, self.shifts = keys, shifts
        self.last, last = np.unique(self._blocks(patterns, self.m), return_inverse=True)
        self.first, first = np.unique(self._blocks(patterns, self.b), return_inverse=True)
        bucket = last * len(self.first) + first
        order = np.argsort(bucket, kind="stable")
        self.buckets, self.patterns, self.items = bucket[order], patterns[order], items[order]

    def _blocks(self, rows: np.ndarray, end: int) -> np.ndarray:
        """The blocks of each row that end before the place."""
        last = rows[:, end - 1].astype(np.int64)
        return last if self.b == 1 else rows[:, end - 2].astype(np.int64) * self.base + last

    def search(self, seq: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """(text, place of the first word in seq, items) of each occurrence; bounds: where each text begins in seq."""
        m, b = self.m, self.b
        if len(seq) < m:
            return
        block = seq.astype(np.int64)  # of the block that ends here
        if b == 2:
            block[1:] += seq[:-1].astype(np.int64) * self.base
            places = np.flatnonzero((seq[:-1] > 0) & (seq[1:] > 0)) + 1
        else:
            places = np.flatnonzero(seq > 0)
        shift = np.full(len(seq), self.far, np.int32)
        at, known = _find(self.keys, block[places])
        shift[places[known]] = self.shifts[at[known]]
        # Buckets of the places where a block ends patterns.
        ends = np.flatnonzero(shift == 0)
        ends = ends[ends >= m - 1]
        last, _ = _find(self.last, block[ends])
        first, known = _find(self.first, block[ends - m + b])
        ends, bucket = ends[known], last[known] * len(self.first) + first[known]
        lo, hi = np.searchsorted(self.buckets, bucket), np.searchsorted(self.buckets, bucket, side="right")
        ends, lo, hi = ends[hi > lo], lo[hi > lo].tolist(), hi[hi > lo].tolist()
        bucket_of = dict(zip(ends.tolist(), zip(lo, hi, strict=True), strict=True))
        # A text without such a place is skipped as a whole.
        for t in np.unique(np.searchsorted(bounds, ends, side="right") - 1).tolist():
            start, stop = int(bounds[t]), int(bounds[t + 1])
            s, p = shift[start:stop].tolist(), m - 1
            while p < stop - start:
                if s[p]:
                    p += s[p]
                    continue
                if (range_ := bucket_of.get(start + p)) is not None:
                    same = (self.patterns[range_[0] : range_[1]] == seq[start + p - m + 1 : start + p + 1]).all(axis=1)
                    if same.any():
                        yield t, start + p - m + 1, self.items[range_[0] : range_[1]][same]
                p += 1


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place among the sorted keys, whether it is there) of each of the wanted numbers."""
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


class Searcher:
    """All tables of a block of items: word lists and the ids to report."""

    def __init__(self, ids: list[str], texts: list[str | None], window: int):
        words, bounds = words_of(pa.array(texts, pa.string()), ALNUM)
        codes, self.vocabulary = coded(words)
        seq, size = (codes + 1).astype(np.int32), np.diff(bounds)
        self.names = sorted(set(ids))
        number = {i: k for k, i in enumerate(self.names)}
        item = np.fromiter((number[i] for i in ids), np.int32, len(ids))
        self.tables = []
        for m in np.unique(np.minimum(size[size > 0], window)).tolist():
            own = np.flatnonzero(np.minimum(size, window) == m)
            n = size[own] - m + 1
            starts = ranges(bounds[:-1][own], n)
            self.tables.append(WuManber(seq[starts[:, None] + np.arange(m)], np.repeat(item[own], n), len(self.vocabulary)))

    def find(self, texts: pa.Array) -> tuple[np.ndarray, dict[int, tuple[list[tuple[int, int]], set[str]]]]:
        """(words of each text, {text: (spans [first, end) of words, items)})."""
        words, bounds = words_of(texts, ALNUM)
        codes, different = coded(words)
        number = pc.fill_null(pc.index_in(different, value_set=self.vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int32) + 1
        seq = number[codes] if len(codes) else np.zeros(0, np.int32)
        found: dict[int, tuple[list[tuple[int, int]], set[str]]] = {}
        for table in self.tables:
            for t, start, items in table.search(seq, bounds):
                spans, names = found.setdefault(t, ([], set()))
                start -= int(bounds[t])
                spans.append((start, start + table.m))
                names.update(self.names[i] for i in items.tolist())
        return np.diff(bounds), found


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_FOUND = {"spans": "array<struct<first:int,end:int>>", "items": "array<string>"}


def find_contamination(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", with_row: bool = False) -> DataFrame:
    """A row for each row of docs: doc_id, n_words, spans (merged [first, end) of words within occurrences), items (sorted as
    strings), and with_row the whole row as a struct, row.

    A null or empty text has no words and no spans; items without words have no windows. Rows that repeat a doc_id, or have none, are searched
    each by its own text, whole; items that repeat an item_id add their windows to that id; a null item_id reports as 'null'. Other columns are
    ignored, whatever their names.
    """
    spark = docs.sparkSession
    ship(spark)
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("i"), F.col(item_text_col).cast("string").alias("t"))
    size = items.agg(F.sum(F.octet_length("t")).alias("n")).first().n or 0
    blocks = max(1, -(-int(size) // block_bytes))
    empty = {c: F.lit(None).cast(kind).alias(c) for c, kind in _FOUND.items()}
    text = F.col(text_col).cast("string")
    if blocks == 1:
        out = docs.select(F.col(id_col).alias("doc_id"), F.lit(0).cast("long").alias("n_words"), *empty.values(), whole_row(docs).alias("row") if with_row else text.alias("text"))
        return _searched(out, _searcher(spark, items, window), text_col if with_row else None)
    rows = docs.select(F.col(id_col).alias("doc_id"), *([whole_row(docs).alias("row")] if with_row else []), F.xxhash64(text).alias("text_hash"), text.alias("text"))

    hits = None
    for k in range(blocks):
        searcher = _searcher(spark, items.filter(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == k), window)
        some = _searched(rows.drop("row").select("*", F.lit(0).cast("long").alias("n_words"), *empty.values()), searcher)
        some = materialize(some.filter(F.size("spans") > 0).select("doc_id", "text_hash", "spans", "items").distinct(), "hits")
        searcher.destroy()
        hits = some if hits is None else hits.unionByName(some)
    merged_ = hits.groupBy(F.col("doc_id").alias("of"), F.col("text_hash").alias("of_hash")).agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    out = rows.withColumn("n_words", F.lit(0).cast("long")).join(materialize(merged_, "merged"), F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_hash") == F.col("of_hash")), "left")
    return _searched(out.select(*rows.columns, "n_words", "spans", "items"), None).drop("text_hash")


def _searcher(spark: SparkSession, items: DataFrame, window: int) -> Broadcast:
    rows = items.collect()  # of BLOCK_BYTES, about
    return spark.sparkContext.broadcast(Searcher([r.i for r in rows], [r.t for r in rows], window))


def _searched(rows: DataFrame, searcher: Broadcast | None, text_col: str | None = None) -> DataFrame:
    """rows, less the text, with n_words, and with what the searcher finds added to spans and items; both are put in order.

    With text_col, the text is that field of the struct row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(with_text(batch, "row", text_col) if text_col else batch, "text"):
                if searcher is not None:
                    n, found = searcher.value.find(b.column("text"))
                else:
                    n, found = np.diff(words_of(b.column("text"), ALNUM)[1]), {}
                spans, items = b.column("spans").to_pylist(), b.column("items").to_pylist()
                for t in set(found) | {t for t, x in enumerate(spans) if x}:
                    new, names = found.get(t, ([], set()))
                    spans[t] = [{"first": x, "end": y} for x, y in merged([(p["first"], p["end"]) for p in spans[t] or ()] + new)]
                    items[t] = sorted(names | set(items[t] or ()))
                put = {"n_words": pa.array(n, pa.int64()), "spans": pa.array([x or [] for x in spans], b.schema.field("spans").type), "items": pa.array([x or [] for x in items], b.schema.field("items").type)}
                sent = [c for c in b.schema.names if c != "text"]
                yield pa.RecordBatch.from_arrays([put.get(c, b.column(c)) for c in sent], names=sent)

    return rows.mapInArrow(tidied(run), T.StructType([T.StructField(f.name, f.dataType, True) for f in rows.schema.fields if f.name != "text"]))


def contamination_report(docs: DataFrame, benchmark: DataFrame, **kw) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated; see find_contamination."""
    r = find_contamination(docs, benchmark, **kw)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["first"]))
    return r.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **kw) -> DataFrame:
    """The rows of docs that hold no occurrence, with all their columns."""
    return unpacked(find_contamination(docs, benchmark, with_row=True, **kw).filter(F.size("spans") == 0), "row", docs.columns)


EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
