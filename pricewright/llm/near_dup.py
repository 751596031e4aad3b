"""Near-duplicate documents: b-bit MinHash with band candidates, confirmed on full shingle sets.

A document's set is its distinct 2-word shingles (the whole sequence if it has fewer words), as 64-bit hashes. Steps:

1. A pass over the texts gives each row its set's digest, K minima packed as 4 bits each, and BANDS keys of ROWS minima.
   With 32 bands of 5 rows, a pair of similarity 0.8 shares no band with probability 3e-6.
2. Rows of equal sets become one node, so copies are never paired. Everything from here on is about nodes.
3. Candidates: in each band bucket all nodes are paired with the bucket's smallest and largest node only.
4. The similarity of a pair is estimated from the packed minima by bit counts, corrected for lanes that agree by
   chance; pairs well below the threshold (6 standard deviations) go. The others are confirmed on their full sets.
5. Linked nodes form components (large-star, small-star). Buckets that still hold several components get an exact second
   step: their nodes outside the bucket's largest component against all others of such buckets, by an inverted list of the
   rarest shingles of each set with size and place filters, and confirmed on full sets. So each candidate pair either lies
   within a component, or was compared, or can't reach the threshold; large groups aren't expanded into all pairs.

Links and components stay in tables in the shared folder; nothing of them comes to the driver but counts.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACED, coded, materialize, mix64, ship, slices, tidied, words_of

BANDS, ROWS = 32, 5
K = BANDS * ROWS
BITS = 4
LANES = 64 // BITS
#: Estimates this far below the threshold are dropped: 6 standard deviations at K minima.
MARGIN = 0.2
#: Tasks that a component's members are dealt over when they learn its smallest id.
SALTS = 32
_SEED = 0x9E3779B97F4A7C15

_MULTIPLIERS = (mix64(np.arange(1, K + 1, dtype=np.uint64) * np.uint64(_SEED >> 1)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_ADDENDS = (mix64(np.arange(1, K + 1, dtype=np.uint64) * np.uint64(_SEED >> 3)) >> np.uint64(32)).astype(np.uint32)


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words, bounds = words_of(texts, SPACED)
    codes, different = coded(words)
    h = np.fromiter((xxhash.xxh64_intdigest(w) for w in different.to_pylist()), np.uint64, len(different))
    h = mix64(h)[codes] if len(codes) else np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        pairs = mix64(h[:-1] * np.uint64(3) + mix64(h[1:] ^ np.uint64(_SEED)))
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        out.append(np.unique(pairs[a : b - 1]) if b - a > 1 else mix64(h[a:b] + np.uint64(7)))
    return out


def minima(own: np.ndarray) -> np.ndarray:
    """The K minima (uint32) of a set that isn't empty."""
    h = (own >> np.uint64(32)).astype(np.uint32)
    best = np.full(K, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(h), 1024):
        x = h[i : i + 1024, None] * _MULTIPLIERS
        x += _ADDENDS
        np.minimum(best, x.min(axis=0), out=best)
    return best


def packed(m: np.ndarray) -> np.ndarray:
    """Rows of minima to their low bits, LANES in a 64-bit number."""
    low = (m & np.uint32((1 << BITS) - 1)).astype(np.uint64).reshape(len(m), -1, LANES)
    return np.bitwise_or.reduce(low << (np.arange(LANES, dtype=np.uint64) * np.uint64(BITS)), axis=2)


def band_keys(m: np.ndarray) -> np.ndarray:
    parts = m.astype(np.uint64).reshape(len(m), BANDS, ROWS)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(m), BANDS))
    with np.errstate(over="ignore"):
        for r in range(ROWS):
            key = mix64(key * np.uint64(_SEED) + parts[:, :, r])
    return key


_PRINTS = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_shingles", pa.int64()), ("nid", pa.int64()), ("low", pa.list_(pa.int64())), ("bands", pa.list_(pa.int64()))])


def _nid(own: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(own.tobytes(), digest_size=8).digest(), "little", signed=True)


def _lists(x: np.ndarray, full: np.ndarray) -> pa.Array:
    """x's rows, in order, as the lists of the rows marked full; the others get null."""
    width = x.shape[1] if x.ndim == 2 else 1
    at = np.concatenate([[0], np.cumsum(full) * width]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(x.view(np.int64).ravel()), mask=pa.array(~full))


def fingerprints(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text_hash, n_shingles, nid (the set's digest; null for an empty set), low (packed minima), bands."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, "text", 1 << 20):
                sets = shingle_sets(b.column("text"))
                n = np.array([len(s) for s in sets], np.int64)
                full = n > 0
                m = np.array([minima(s) for s in sets if len(s)], np.uint32).reshape(-1, K)
                nid = pa.array([_nid(s) if len(s) else None for s in sets], pa.int64())
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_hash"), pa.array(n), nid, _lists(packed(m), full), _lists(band_keys(m), full)], schema=_PRINTS)

    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    return rows.mapInArrow(tidied(run), "doc_id long, text_hash long, n_shingles long, nid long, low array<long>, bands array<long>")


_SETS = pa.schema([("nid", pa.int64()), ("own", pa.list_(pa.int64()))])


def _sets(texts: DataFrame) -> DataFrame:
    """nid and the full set, for rows of text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, "text", 1 << 20):
                sets = shingle_sets(b.column("text"))
                at = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                own = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array([_nid(s) if len(s) else None for s in sets], pa.int64()), own], schema=_SETS)

    return texts.select("text").mapInArrow(tidied(run), "nid long, own array<long>")


def estimate(a: Column, b: Column) -> Column:
    """Similarity of two packed signatures: lanes that agree, less those expected to agree by chance."""
    differ = F.lit(0)
    for i in range(K // LANES):
        x = a[i].bitwiseXOR(b[i])
        for step in (2, 1):  # any bit of a lane to the lane's lowest bit
            x = x.bitwiseOR(F.shiftrightunsigned(x, step))
        differ = differ + F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))
    chance = 1.0 / (1 << BITS)
    return ((1 - differ / F.lit(float(K))) - chance) / (1 - chance)


def connected(edges: DataFrame) -> DataFrame:
    """nid and comp, the smallest nid that edges (a, b) lead to; for nodes with edges. Nothing is broadcast, since all of it grows with the edges."""
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    before = None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low.hint("merge"), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low.hint("merge"), "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        e = materialize(small, "components")
        now = e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 30)))).first()
        if now == before:
            break
        before = now
    star = e.select(F.col("u").alias("nid"), F.col("v").alias("comp"))
    return star.union(e.select(F.col("v").alias("nid"), F.col("v").alias("comp")).distinct())


def _pairs(x: DataFrame) -> DataFrame:
    return x.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).filter("a <> b").distinct()


class _Confirm:
    """Confirms candidate pairs of nodes: by estimate, then on full sets."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, threshold: int, id_col: str, text_col: str):
        self.nodes, self.t = nodes, threshold
        self.docs = docs.select(F.col(id_col).cast("long").alias("first_id"), F.col(text_col).cast("string").alias("text"))

    def sets(self, nids: DataFrame) -> DataFrame:
        """nid and own (the full set), from a row's text for each node: that of its first document.

        Rows with that id and another text fall away by their nid.
        """
        need = self.nodes.join(nids, "nid", "left_semi").select(F.col("first_id").alias("of")).distinct()
        sets = _sets(self.docs.join(need, F.col("first_id").eqNullSafe(F.col("of")), "left_semi"))
        return materialize(sets.join(nids, "nid", "left_semi").dropDuplicates(["nid"]), "sets", texts=True)

    def likely(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose sizes and estimate don't rule out the threshold."""
        n, t = self.nodes, self.t
        near = pairs.join(n.select(F.col("nid").alias("a"), F.col("low").alias("la"), F.col("n_shingles").alias("na")), "a").join(n.select(F.col("nid").alias("b"), F.col("low").alias("lb"), F.col("n_shingles").alias("nb")), "b")
        near = near.filter((F.lit(100) * F.least("na", "nb") >= F.lit(t) * F.greatest("na", "nb")) & (estimate(F.col("la"), F.col("lb")) >= t / 100 - MARGIN))
        return materialize(near.select("a", "b"), "candidates")

    def on_sets(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        both = pairs.join(sets.select(F.col("nid").alias("a"), F.col("own").alias("sa")), "a").join(sets.select(F.col("nid").alias("b"), F.col("own").alias("sb")), "b")
        common = F.size(F.array_intersect("sa", "sb")).cast("long")
        return both.filter(100 * common >= self.t * (F.size("sa") + F.size("sb") - common)).select("a", "b")

    def prefix_pairs(self, x: DataFrame, y: DataFrame, sets: DataFrame) -> DataFrame:
        """Pairs of a node of x and one of y (both: nid, comp) of other components that can reach the threshold; exact.

        Shingles are put in one order, from the rarest. Sets that reach it share one of their first n - ceil(t n / 100) + 1 shingles, and
        from the first common one on both have enough left; for a set with many shingles of its own, neither holds with anything.
        Pairs are joined on (shingle, size class), where sizes that differ too much never meet; of a shingle that is frequent in
        one class Spark's skew join splits the rows, since the pairs are dealt anew afterwards.
        """
        t = self.t
        all_ = sets.select("nid", F.size("own").cast("long").alias("n"), F.explode("own").alias("s"))
        often = all_.groupBy("s").agg(F.count("*").alias("often"))
        place = F.row_number().over(Window.partitionBy("nid").orderBy("often", "s"))
        first = all_.join(often, "s").withColumn("place", place).filter(F.col("place") <= F.col("n") - F.ceil(F.col("n") * t / 100) + 1)
        first = materialize(first.select("nid", "n", "s", "place"), "prefixes")
        class_ = F.floor(F.log("n") / math.log(100 / t) + 1e-9) if t < 100 else F.col("n")  # sizes that fit are in classes next to each other
        side = lambda own, k: own.join(first, "nid").select(F.col("nid").alias(f"{k}"), F.col("comp").alias(f"c{k}"), F.col("n").alias(f"n{k}"), F.col("place").alias(f"p{k}"), F.col("s").alias(f"s{k}"), class_.alias(f"g{k}"))
        left = F.least(F.col("nx") - F.col("px"), F.col("ny") - F.col("py")) + 1
        fits = (100 * F.least("nx", "ny") >= t * F.greatest("nx", "ny")) & ((100 + t) * left >= t * (F.col("nx") + F.col("ny")))
        near = side(y, "y").withColumn("gy", F.explode(F.array(F.col("gy") - 1, F.col("gy"), F.col("gy") + 1)))
        p = side(x, "x").join(near, (F.col("sx") == F.col("sy")) & (F.col("gx") == F.col("gy")) & (F.col("cx") != F.col("cy")) & fits)
        return _pairs(p)


def near_duplicates(docs: DataFrame, *, threshold: int = 80, id_col: str = "doc_id", text_col: str = "text", with_group: bool = False) -> DataFrame:
    """A row for each row of docs: doc_id, n_shingles, component_id, kept (doc_id = component_id); with_group also
    group (the component's label, null for an empty set) and text_hash (xxhash64 of the text).

    Documents whose sets have 100 * intersection >= threshold * union are linked; component_id is the smallest doc_id
    that links lead to. A null text or one without words has the empty set, is linked with nothing and is kept. Rows that
    repeat an id with different texts are linked each by its own text; rows with a null id count as copies but never name a component
    (component_id is null if all ids of it are null; such rows are kept). Ids are cast to long: one that isn't a whole number fails
    under ANSI mode. Other columns are ignored, whatever their names.
    """
    prints = materialize(fingerprints(docs, id_col, text_col), "prints", texts=True)
    full = prints.filter(F.col("nid").isNotNull())
    nodes = materialize(full.groupBy("nid").agg(F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n_shingles"), F.first("low").alias("low"), F.first("bands").alias("bands")), "nodes")
    confirm = _Confirm(docs, nodes, threshold, id_col, text_col)

    members = nodes.select("nid", F.explode("bands").alias("key"))
    shared = materialize(members.groupBy("key").agg(F.min("nid").alias("lo"), F.max("nid").alias("hi")).filter("lo <> hi"), "buckets")
    shared_members = materialize(members.join(shared, "key"), "members")
    star = confirm.likely(_pairs(shared_members.select(F.col("nid").alias("x"), F.explode(F.array("lo", "hi")).alias("y"))))
    ends = star.select(F.col("a").alias("nid")).union(star.select(F.col("b").alias("nid"))).distinct()
    edges = materialize(confirm.on_sets(star, confirm.sets(ends)), "edges")
    comps = materialize(connected(edges), "labels")

    # Buckets with several components: nodes outside the largest one against all nodes of such buckets that are in another one.
    labelled = shared_members.select("key", "nid").join(comps, "nid", "left").select("key", "nid", F.coalesce("comp", "nid").alias("comp"))
    labelled = materialize(labelled, "labelled")
    several = labelled.groupBy("key", "comp").agg(F.count("*").alias("n")).groupBy("key").agg(F.max_by("comp", F.struct("n", "comp")).alias("major"), F.count("*").alias("comps")).filter("comps > 1")
    mixed = materialize(labelled.join(several.select("key", "major"), "key").groupBy("nid", "comp").agg(F.max(F.col("comp") != F.col("major")).alias("minor")), "mixed")
    sets = confirm.sets(mixed.select("nid"))
    rest = materialize(confirm.prefix_pairs(mixed.filter("minor").select("nid", "comp"), mixed.select("nid", "comp"), sets).join(star, ["a", "b"], "left_anti"), "pairs")
    more = materialize(confirm.on_sets(rest, sets), "edges")
    if not more.isEmpty():
        comps = materialize(connected(edges.union(more)), "labels")

    named = materialize(nodes.select("nid", "first_id").join(comps, "nid", "left"), "named")
    # Members of a large component are dealt over SALTS tasks; nodes without links, and rows without a set, need no join.
    own = named.filter(F.col("comp").isNotNull()).withColumn("salt", F.pmod("nid", F.lit(SALTS)))
    least = own.groupBy("comp").agg(F.min("first_id").alias("component_id")).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    of = own.join(least, ["comp", "salt"]).select("nid", F.col("comp").alias("group"), "component_id")
    of = materialize(of.unionByName(named.filter(F.col("comp").isNull()).select("nid", F.col("nid").alias("group"), F.col("first_id").alias("component_id"))), "of")
    out = prints.filter(F.col("nid").isNotNull()).select("doc_id", "text_hash", "n_shingles", "nid").join(of, "nid").drop("nid")
    none = prints.filter(F.col("nid").isNull()).select("doc_id", "text_hash", "n_shingles", F.lit(None).cast("long").alias("group"), F.col("doc_id").alias("component_id"))
    out = out.unionByName(none).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))
    return out.select("doc_id", "n_shingles", "component_id", "kept", *(["group", "text_hash"] if with_group else []))
