"""Ranked lexical search: document-at-a-time merging of compressed postings.

build_index() cuts the documents into shards where they lie (about SHARD_BYTES of text, no shuffle) and writes, for each shard, a row
for each term with its postings and one row for the shard's documents. A shard's documents are numbered in the order of doc_id; a
posting list holds the gaps of these numbers and the term frequencies as variable-length bytes.

search() takes queries in blocks of BLOCK_BYTES. The block's terms select their postings, which meet by shard. There each query is
answered document at a time: a heap of the lists' next documents is merged k ways, and the best documents are kept in a heap bounded
by k, keyed by score, then doc_id. Lists whose largest contributions together can't reach that heap's smallest score leave the merge;
they are only looked up for documents that the others find, so no document is lost. The shards' bests are merged by score and doc_id.

Weights need counts over all documents, which the index has: N and L come from the shards' document rows, df from the selected terms.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ALNUM, coded, materialize, ship, slices, tidied, tidy, words_of

#: Text of a shard; a longer document is a shard of its own.
SHARD_BYTES = 16 << 20
#: Text of the queries that are answered in one pass over the index.
BLOCK_BYTES = 4 << 20
TOP = 10
#: Tasks that answer a block of queries, if there are so many shards.
MOST_TASKS = 20_000

INDEX = "shard long, term string, df long, n_terms long, postings binary, ids array<long>, lengths array<long>"
_INDEX = pa.schema([("shard", pa.int64()), ("term", pa.string()), ("df", pa.int64()), ("n_terms", pa.int64()), ("postings", pa.binary()), ("ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64()))])


def packed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers from 0 as bytes of 7 bits, the lowest first, the top bit set on all but the last; and where each number ends."""
    v = values.astype(np.uint64)
    n = np.ones(len(v), np.int64)
    for bits in range(7, 64, 7):
        n += v >= np.uint64(1 << bits)
    ends = np.cumsum(n)
    out = np.zeros(int(ends[-1]) if len(v) else 0, np.uint8)
    for k in range(int(n.max(initial=0))):
        has = n > k
        part = (v[has] >> np.uint64(7 * k)).astype(np.uint8) & np.uint8(127)
        out[(ends - n)[has] + k] = part | np.where(n[has] > k + 1, np.uint8(128), np.uint8(0))
    return out, ends


def unpacked_numbers(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    if not len(raw):
        return np.zeros(0, np.int64)
    starts = np.r_[0, np.flatnonzero(raw < 128)[:-1] + 1]
    place = np.arange(len(raw)) - np.repeat(starts, np.diff(np.r_[starts, len(raw)]))
    return np.add.reduceat((raw & 127).astype(np.int64) << (7 * place), starts)


def shard_rows(shard: int, ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
    """The index rows of a shard: its documents' (without a term), then its terms'. Null ids come last."""
    order = pc.sort_indices(ids, null_placement="at_end").to_numpy()
    words, bounds = words_of(texts, ALNUM)
    codes, terms = coded(words)
    size, docs = np.diff(bounds), len(ids)
    number = np.empty(docs, np.int64)
    number[order] = np.arange(docs)
    key, tf = np.unique(codes * docs + np.repeat(number, size), return_counts=True)
    term, doc = key // max(docs, 1), key % max(docs, 1)
    first = np.r_[True, term[1:] != term[:-1]] if len(term) else np.zeros(0, bool)
    gaps = np.where(first, doc, np.diff(doc, prepend=0))
    data, ends = packed(np.stack([gaps, tf], 1).ravel())
    starts = np.flatnonzero(first)
    df = np.diff(np.r_[starts, len(term)])
    offsets = np.r_[0, ends[2 * np.r_[starts[1:], len(term)] - 1]].astype(np.int32) if len(term) else np.zeros(1, np.int32)
    blobs = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    rows = len(starts) + 1
    one = lambda x: pa.ListArray.from_arrays(pa.array([0] + [len(x)] * rows, pa.int32()), x, mask=pa.array(np.arange(rows) > 0))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(rows, shard)), pa.concat_arrays([pa.array([None], pa.string()), terms.take(pa.array(term[starts]))]), pa.array(np.r_[(size > 0).sum(), df]),
            pa.array(np.r_[size.sum(), np.add.reduceat(tf, starts) if len(starts) else starts]), pa.concat_arrays([pa.array([None], pa.binary()), blobs]), one(ids.take(pa.array(order))), one(pa.array(size[order])),
        ],
        schema=_INDEX,
    )


def build_index(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The index of all rows of docs, as a table in the shared folder: INDEX's columns.

    A null text has no terms. Ids are cast to long; rows that repeat an id, or have none, are documents each. Other columns are ignored.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, n = TaskContext.get().partitionId() << 32, 0
        have: list[pa.RecordBatch] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal n, held
            t = pa.Table.from_batches(have).combine_chunks()
            have.clear()
            rows = shard_rows(base + n, t.column("doc_id").combine_chunks(), t.column("text").combine_chunks())
            n, held = n + 1, 0
            for at in range(0, rows.num_rows, 20_000):
                yield rows.slice(at, 20_000)

        for batch in batches:
            for b in slices(batch, "text", shard_bytes):
                size = pc.sum(pc.binary_length(b.column("text"))).as_py() or 0
                if have and held + size > shard_bytes:
                    yield from flush()
                have.append(b)
                held += size
        if have:
            yield from flush()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return materialize(rows.mapInArrow(tidied(run), INDEX), "index")


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def contributions(w: int, tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a term adds to the score of documents of n terms where it stands tf times."""
    if int(n.max(initial=0)) * 90 * n_docs < 1 << 62:
        m = 10 + (90 * n_docs * n) // n_terms
    else:
        m = np.array([10 + 90 * n_docs * x // n_terms for x in n.tolist()], np.int64)
    return w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def best_documents(lists: list[tuple[list[int], list[int], int]], k: int) -> list[tuple[int, int]]:
    """(score, document) of the k best, from lists of (documents in order, what they add, the most that one adds); any order.

    Documents come in order, so one that only equals the heap's smallest score comes after it and isn't taken.
    """
    lists = sorted((x for x in lists if x[2] > 0), key=lambda x: x[2])
    most = [0]
    for x in lists:
        most.append(most[-1] + x[2])
    docs, adds, at = [x[0] for x in lists], [x[1] for x in lists], [0] * len(lists)
    first, least = 0, 0  # lists from first on are merged; scores must exceed least
    best: list[tuple[int, int]] = []  # (score, -document)
    heap = [(d[0], j) for j, d in enumerate(docs)]
    heapq.heapify(heap)
    while heap:
        doc, score = heap[0][0], 0
        while heap and heap[0][0] == doc:
            j = heap[0][1]
            i = at[j]
            score += adds[j][i]
            at[j] = i = i + 1
            if i < len(docs[j]):
                heapq.heapreplace(heap, (docs[j][i], j))
            else:
                heapq.heappop(heap)
        j = first
        while j and score + most[j] > least:
            j -= 1
            own = docs[j]
            at[j] = i = bisect_left(own, doc, at[j])
            if i < len(own) and own[i] == doc:
                score += adds[j][i]
        if j or score <= least:
            continue
        if len(best) < k:
            heapq.heappush(best, (score, -doc))
        else:
            heapq.heapreplace(best, (score, -doc))
        if len(best) == k and best[0][0] > least:
            least, before = best[0][0], first
            while first < len(lists) and most[first + 1] <= least:
                first += 1
            if first > before:
                heap = [x for x in heap if x[1] >= first]
                heapq.heapify(heap)
    return [(s, -d) for s, d in best]


_FOUND = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])


def _answers(items: list[list[str]], df: dict[str, int], n_docs: int, n_terms: int, k: int):
    """A function from a shard's rows to the k best of its documents for each item."""

    def run(table: pa.Table) -> pa.Table:
        with tidy():
            return answer(table)

    def answer(table: pa.Table) -> pa.Table:
        t = table.to_pydict()
        own = t["term"].index(None)
        ids, size = t["ids"][own], np.array(t["lengths"][own], np.int64)
        lists = {}
        for term, blob in zip(t["term"], t["postings"], strict=True):
            if term is not None:
                pairs = unpacked_numbers(blob).reshape(-1, 2)
                doc = np.cumsum(pairs[:, 0])
                add = contributions(weight(n_docs, df[term]), pairs[:, 1], size[doc], n_docs, n_terms)
                some = add > 0
                lists[term] = (doc[some].tolist(), add[some].tolist(), int(add.max()))
        out = [(i, ids[d], s) for i, terms in enumerate(items) for s, d in best_documents([lists[x] for x in terms if x in lists], k)]
        return pa.Table.from_arrays([pa.array([x[c] for x in out], f.type) for c, f in enumerate(_FOUND)], schema=_FOUND)

    return run


def query_terms(queries: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item (the id as a string) and term, each pair once."""
    ship(queries.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, "text"):
                words, bounds = words_of(b.column("text"), ALNUM)
                yield pa.RecordBatch.from_arrays([b.column("item").take(pa.array(np.repeat(np.arange(b.num_rows), np.diff(bounds)))), words], names=["item", "term"])

    rows = queries.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(tidied(run), "item string, term string").distinct()


def search(index: DataFrame, queries: DataFrame, *, k: int = TOP, item_col: str = "item_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the k documents of the highest positive score for each item, equal scores by doc_id.

    Rows that repeat an item_id are one query of all their terms; a null item_id is an item, too. Items and documents without terms
    find nothing. Documents with a null id come after others of their score; rows that repeat an id have a rank each.
    """
    spark, kind = queries.sparkSession, queries.schema[item_col].dataType
    terms = materialize(query_terms(queries, item_col, text_col), "queries")
    blocks = max(1, -(-int(terms.agg(F.sum(F.octet_length("term") + 1)).first()[0] or 0) // block_bytes))
    whole = index.filter(F.col("term").isNull())
    total = whole.agg(F.sum("df"), F.sum("n_terms"), F.count("*")).first()
    n_docs, n_terms = total[0] or 0, total[1] or 0
    found = None
    for b in range(blocks):
        block = terms.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b)
        rows = block.groupBy("item").agg(F.collect_list("term").alias("terms")).collect()  # of block_bytes, about
        wanted = F.broadcast(spark.createDataFrame([(x,) for x in {x for r in rows for x in r.terms}], "term string"))
        hits = materialize(index.join(wanted, "term", "left_semi").select(*index.columns), "hits")
        df = {r.term: r.df for r in hits.groupBy("term").agg(F.sum("df").alias("df")).collect()}  # of the block's terms
        answers = _answers([sorted(r.terms) for r in rows], df, n_docs, n_terms, k)
        shards = whole.join(hits.select("shard").distinct(), "shard", "left_semi").select(*index.columns).unionByName(hits)
        # Few bytes a shard but much work: tasks by shards, not by bytes.
        got = shards.repartition(max(1, min(total[2], MOST_TASKS)), "shard").groupBy("shard").applyInArrow(answers, "item int, doc_id long, score long")
        names = F.broadcast(spark.createDataFrame([(i, r.item) for i, r in enumerate(rows)], "item int, name string"))
        got = got.join(names, "item").select(F.col("name").cast(kind).alias("item_id"), "doc_id", "score")
        rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last()))
        got = got.withColumn("rank", rank).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
        got = materialize(got, "found") if blocks > 1 else got
        found = got if found is None else found.unionByName(got)
    return found
