"""SimHash near-duplicates by pigeonring filtering.

A document's fingerprint has 64 bits, each the majority over its 4-word shingles' XXH64. Fingerprints that differ in at most TAU bits
are linked. Everything after the first pass over the texts is about different fingerprints, so copies are never paired.

The bits are cut into PARTS segments that stand in a ring. If two fingerprints differ in at most TAU bits, then from some
segment on every chain of consecutive segments differs in at most its proportional share, TAU * length / PARTS (rounded down): 0, 1, 2, 3
and 4 bits for chains of 1 to 5. Candidates come from an equi-join on (start, the chain's first segments): each fingerprint as it is, against
the variants of the others that the chain's budgets allow; then longer chains are tested one by one, and at last all bits.

A bucket of more than CROWD fingerprints would pair too many. Those in such buckets are linked in another way, without pairs: two of them
differ in at most TAU bits if and only if some number is at most TAU / 2 bits from each, so all that reach such a midpoint are linked with the
smallest one that does. A link has its candidate bucket either crowded or not, so none is lost, and work grows with the number of fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACED, materialize, ship, slices, text_bytes, tidied, words_of
from .near_dup import SALTS, connected

TAU = 4
SHINGLE = 4
SEED = 42
#: Where the ring's segments begin, and their bits: 13, 13, 13, 13, 12.
PARTS = 5
STARTS = [k * 64 // PARTS + (k * 64 % PARTS > 0) for k in range(PARTS)]
#: Fingerprints that a bucket may pair with each of its variants.
CROWD = 64
#: Up to so many fingerprints, two segments (26 bits) tell buckets apart; beyond, three (39 bits).
FEW = 1 << 27
#: Shingles hashed at a time.
_RUN = 1 << 17


def bit_sums(h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each run of hashes that begins at one of starts (none is empty), how many have each bit (the lowest first)."""
    bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.add.reduceat(bits, starts, axis=0, dtype=np.int64)


def fingerprints_of(texts: pa.Array) -> np.ndarray:
    """The fingerprint of each text (null counts as empty), unsigned."""
    words, bounds = words_of(texts, SPACED)
    size = np.diff(bounds)
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), words), " ")
    raw, at = text_bytes(joined)
    data = raw.tobytes()
    # Where each word begins and ends in data: words of a text stand one space apart.
    length = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    text = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(length)) - bounds[:-1][text]
    before = np.r_[0, np.cumsum(length)]
    begin = at[:-1].astype(np.int64)[text] + before[:-1] - before[bounds[:-1]][text] + place
    end = begin + length
    last = np.minimum(place + SHINGLE, size[text]) - place  # words of the shingle that begins here
    own = np.flatnonzero((last == SHINGLE) | (place == 0))
    stop = end[own + last[own] - 1] if len(own) else own
    begin, text = begin[own], text[own]
    sums, n = np.zeros((len(size), 64), np.int64), np.bincount(text, minlength=len(size))
    for i in range(0, len(own), _RUN):
        run = slice(i, i + _RUN)
        h = np.fromiter((xxhash.xxh64_intdigest(data[a:b], SEED) for a, b in zip(begin[run].tolist(), stop[run].tolist(), strict=True)), np.uint64, len(own[run]))
        of = text[run]
        first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        sums[of[first]] += bit_sums(h, first)
    major = (2 * sums > n[:, None]).astype(np.uint8)
    return np.packbits(major, axis=1, bitorder="little").view("<u8").ravel()


_PRINTS = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])


def simhashes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fp (the fingerprint's bits as a signed number) of each row."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, "text", 2 << 20):
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fingerprints_of(b.column("text")).view(np.int64))], schema=_PRINTS)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(tidied(run), "doc_id long, fp long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def segment_bits(start: int, parts: int) -> list[int]:
    """The bits of so many consecutive segments of the ring."""
    ends = [*STARTS[1:], 64]
    return [b for k in range(start, start + parts) for b in range(STARTS[k % PARTS], ends[k % PARTS])]


def mask(start: int, parts: int) -> int:
    return _signed(sum(1 << b for b in segment_bits(start, parts)))


def budget(parts: int) -> int:
    return TAU * parts // PARTS


def flips(start: int, parts: int) -> list[int]:
    """What a fingerprint's first segments of a chain may be exclusive-ored with: every chain of them keeps its budget."""
    out = [(0, 0)]  # (bits that differ, how many)
    for k in range(1, parts + 1):
        new = [(x, n) for x, n in out]
        reach = out
        for _ in range(budget(k)):
            more = {}
            for x, n in reach:
                for b in segment_bits(start + k - 1, 1):
                    if not x >> b & 1 and n < budget(k):
                        more[x | 1 << b] = n + 1
            reach = list(more.items())
            new += reach
        out = list(dict(new).items())
    return [_signed(x) for x, _ in out]


def _bits(x: Column | str, parts: int, start: int) -> Column:
    return F.bit_count((F.col(x) if isinstance(x, str) else x).bitwiseAND(F.lit(mask(start, parts))))


def near_links(prints: DataFrame, *, chain: int | None = None, crowd: int = CROWD) -> DataFrame:
    """Links a, b between different fingerprints (fp) that differ in at most TAU bits; whatever is within TAU is connected by them.

    No table here is broadcast: each grows with prints, and Spark sizes what explode() made as if it had made one row of each.
    """
    if chain is None:
        chain = 2 if prints.count() <= FEW else 3
    exact = prints.select("fp", F.explode(F.array(*[F.struct(F.lit(i).alias("start"), F.col("fp").bitwiseAND(F.lit(mask(i, chain))).alias("key")) for i in range(PARTS)])).alias("x")).select("fp", "x.start", "x.key")
    sizes = materialize(exact.groupBy("start", "key").agg(F.count("*").alias("n")).filter(F.col("n") > crowd).select("start", "key"), "crowds")
    own = exact.join(sizes.hint("merge"), ["start", "key"], "left_anti")
    masks = F.create_map(*[c for i in range(PARTS) for c in (F.lit(i), F.lit(flips(i, chain)))])
    other = prints.select("fp", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("start")).withColumn("flip", F.explode(masks[F.col("start")]))
    firsts = F.create_map(*[c for i in range(PARTS) for c in (F.lit(i), F.lit(mask(i, chain)))])
    other = other.select(F.col("fp").alias("b"), F.col("start").alias("at"), F.col("fp").bitwiseXOR(F.col("flip")).bitwiseAND(firsts[F.col("start")]).alias("of"))
    differ = F.col("fp").bitwiseXOR(F.col("b"))
    fits = (F.col("start") == F.col("at")) & (F.col("key") == F.col("of")) & (F.col("fp") < F.col("b"))
    for parts in range(chain + 1, PARTS):
        longer = F.create_map(*[c for i in range(PARTS) for c in (F.lit(i), F.lit(mask(i, parts)))])
        fits = fits & (F.bit_count(differ.bitwiseAND(longer[F.col("start")])) <= budget(parts))
    links = own.join(other.hint("merge"), fits & (F.bit_count(differ) <= TAU)).select(F.col("fp").alias("a"), "b").distinct()
    # Crowded buckets: every fingerprint that is in one, or has a variant that is, through midpoints. Its own key is a variant of the crowded one then.
    around = sizes.withColumn("flip", F.explode(masks[F.col("start")])).select("start", F.col("key").bitwiseXOR(F.col("flip")).alias("key"))
    dense = exact.join(around.hint("merge"), ["start", "key"], "left_semi").select("fp").distinct()
    dense = materialize(dense, "dense")
    if dense.isEmpty():
        return links
    near = [0] + [_signed(1 << i | 1 << j) for i in range(64) for j in range(i, 64)]
    assert TAU // 2 == 2
    middle = dense.select("fp", F.explode(F.lit(near)).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("mid"))
    met = middle.withColumn("a", F.min("fp").over(Window.partitionBy("mid"))).filter("fp <> a").select("a", F.col("fp").alias("b")).distinct()
    return links.unionByName(met)


def simhash_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", chain: int | None = None, crowd: int = CROWD) -> DataFrame:
    """A row for each row of docs: doc_id, fingerprint (16 hex digits), component_id, kept (doc_id = component_id).

    Fingerprints that differ in at most TAU bits are linked; component_id is the smallest doc_id that links lead to. Null texts and
    those without words have fingerprint zero and are linked as any other. Rows that repeat an id count each by its own text; rows with a null id
    link but never name a component (component_id is null, and kept true, if all ids of it are null). Ids are cast to long. Other
    columns are ignored, whatever their names.
    """
    # Tables that grow with the documents are merged, not broadcast: a broadcast comes together in the driver.
    prints = materialize(simhashes(docs, id_col=id_col, text_col=text_col), "simhashes", texts=True)
    nodes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "nodes")
    comps = connected(materialize(near_links(nodes.select("fp"), chain=chain, crowd=crowd), "links"))
    named = materialize(nodes.join(comps.withColumnRenamed("nid", "fp").hint("merge"), "fp", "left"), "named")
    # As in near_dup: members of a large component are dealt over SALTS tasks.
    own = named.filter(F.col("comp").isNotNull()).withColumn("salt", F.pmod("fp", F.lit(SALTS)))
    least = own.groupBy("comp").agg(F.min("first_id").alias("component_id")).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    of = own.join(least.hint("merge"), ["comp", "salt"]).select("fp", "component_id")
    of = materialize(of.unionByName(named.filter(F.col("comp").isNull()).select("fp", F.col("first_id").alias("component_id"))), "of")
    out = prints.join(of.hint("merge"), "fp")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"))
