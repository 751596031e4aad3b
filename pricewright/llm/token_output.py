"""Token ids as binary shards whose document boundaries are Elias-Fano encoded.

A shard file holds, little-endian and in this order: a head of eight unsigned 64-bit numbers (MAGIC, documents n, ids m,
bytes of an id: 2 or 4, low bits l, bytes of the low part, bytes of the high part, select samples), the n document ids
(int64), the low part (n + 1 boundaries, l bits each), the high part (a bit for each boundary and each bucket), the
select samples (uint64: the place of every SAMPLE-th one), and the concatenated ids. The boundaries, from 0 to m, take
about 2 + log2(m / n) bits each, without a table of 64-bit offsets; boundary(i) is found with a sample and a short scan.
Reading a shard selects each document's offsets so, one after the other.

Documents are dealt by ranges of (doc_id, hash of the text, a number that deals out equal rows) and sorted within each, so an id that many rows
share is no task of its own; there are at least as many ranges as the input has PART_BYTES; a task writes its shards one after the other, each of at
most about SHARD_IDS ids (or one document), so its memory is bounded by a shard and a slice of text. Files get names of
their own on each try and only those in the manifest (a Parquet table in the same folder) count, so a lost executor's
tasks can run again. Shards go through pyarrow.fs to the shared folder's URI.
"""

from __future__ import annotations

import itertools
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import KEPT, coded, ranges, shared_dir, ship, slices, split_bytes, text_bytes, tidy

MAGIC = 0x314B4F5445444957
SAMPLE = 256
SHARD_IDS = 4_000_000
#: Input bytes (as Spark estimates them) of a range of documents; spark.sql.shuffle.partitions is the least number of ranges.
PART_BYTES = 256 << 20
#: Different words whose ids a worker keeps; then it starts anew.
CACHE_WORDS = 300_000


def ef_encode(values: np.ndarray, universe: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """(low bits, low part, high part, samples) of numbers that don't fall, each of at most `universe`."""
    v = np.asarray(values, np.uint64)
    n = max(1, len(v))
    low = max(0, int(universe // n).bit_length() - 1)
    bits = ((v[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8) if low else np.zeros((len(v), 0), np.uint8)
    ones = (v >> np.uint64(low)).astype(np.int64) + np.arange(len(v))
    high = np.zeros((universe >> low) + len(v) + 1, np.uint8)
    high[ones] = 1
    return low, np.packbits(bits.ravel(), bitorder="little"), np.packbits(high, bitorder="little"), ones[::SAMPLE].astype(np.uint64)


def ef_select(i: int, low: int, lows: np.ndarray, highs: np.ndarray, samples: np.ndarray) -> int:
    """The i-th number: from the nearest sample on, ones are counted byte by byte."""
    at, left = int(samples[i // SAMPLE]), i % SAMPLE
    byte, word = at // 8, int(highs[at // 8]) >> (at % 8) << (at % 8)
    while (ones := word.bit_count()) <= left:
        left, byte = left - ones, byte + 1
        word = int(highs[byte])
    for _ in range(left):
        word &= word - 1
    place = byte * 8 + (word & -word).bit_length() - 1
    first, last = i * low, (i + 1) * low
    bits = int.from_bytes(lows[first // 8 : -(-last // 8)].tobytes(), "little") >> (first % 8)
    return ((place - i) << low) | (bits & ((1 << low) - 1))


def shard_bytes(doc_ids: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    bounds = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    low, lows, highs, samples = ef_encode(bounds, int(bounds[-1]))
    head = np.array([MAGIC, len(doc_ids), bounds[-1], ids.dtype.itemsize, low, len(lows), len(highs), len(samples)], "<u8")
    return b"".join([head.tobytes(), doc_ids.astype("<i8").tobytes(), lows.tobytes(), highs.tobytes(), samples.astype("<u8").tobytes(), ids.astype(f"<u{ids.dtype.itemsize}").tobytes()])


class Shard:
    """A shard's parts, as views of its bytes."""

    def __init__(self, data: bytes):
        head = np.frombuffer(data, "<u8", 8)
        if int(head[0]) != MAGIC:
            raise ValueError("not a token shard")
        n, self.n_ids, width, self.low, a, b, s = (int(x) for x in head[1:])
        at = 64
        self.doc_ids = np.frombuffer(data, "<i8", n, at)
        self.lows = np.frombuffer(data, np.uint8, a, at := at + 8 * n)
        self.highs = np.frombuffer(data, np.uint8, b, at := at + a)
        self.samples = np.frombuffer(data, "<u8", s, at := at + b)
        self.ids = np.frombuffer(data, f"<u{width}", self.n_ids, at + 8 * s)

    def boundary(self, i: int) -> int:
        """How many ids stand before document i."""
        return ef_select(i, self.low, self.lows, self.highs, self.samples)

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.boundary(i) : self.boundary(i + 1)]


class WordEncoder:
    """Encodes texts with the tokenizers library, each different run between ASCII white space once.

    Exact for tokenizers that drop white space and never join across it, as word_bpe_49k.json: NFC, lower case and its
    pattern all work within such runs. A run of ASCII punctuation after a letter and before white space is a piece of its
    own for its pattern (unless an apostrophe begins it), so it is taken off before the look-up; A-Z go to lower case. Both are
    left out where a batch has "<|", with which the tokenizer's special tokens begin. New runs of letters are encoded many
    at once: each is one word for the tokenizer, whose last piece ends with the word-end mark.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[k for w, k in vocabulary.items() if w.endswith("</w>")]] = True
        self._forget()

    @classmethod
    def of(cls, path: str) -> WordEncoder:
        """This worker's encoder of the file."""
        kept = KEPT.setdefault("words", {})
        if path not in kept:
            kept[path] = cls(path)
        return kept[path]

    def _forget(self) -> None:
        """Keep the runs seen in two batches or more, as long as they take half of the room at most."""
        known: dict[str, int] = getattr(self, "known", {})
        old, times = list(known), self.times[: len(known)] if known else np.zeros(0, np.int64)
        least = 2
        while (times >= least).sum() > CACHE_WORDS // 2:
            least += 1
        kept = np.flatnonzero(times >= least)
        sizes = (self.bounds[kept + 1] - self.bounds[kept]) if len(kept) else np.zeros(0, np.int64)
        flat = self.flat[ranges(self.bounds[kept], sizes)] if len(kept) else np.zeros(0, np.uint32)
        self.known = {old[k]: i for i, k in enumerate(kept.tolist())}
        self.times = np.zeros(2 * CACHE_WORDS, np.int64)
        self.times[: len(kept)] = 1
        self.flat, self.long = np.concatenate([flat, np.zeros(1 << 16, np.uint32)]), len(flat)
        self.bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)

    def _ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, got), np.int64, len(got))
        return np.fromiter((i for x in got for i in x), np.uint32, int(sizes.sum())), sizes

    def _learn(self, words: list[str]) -> None:
        plain = [w for w in words if w.isalpha() and w.islower() and max(w) < "\u0180"]
        ids, _ = self._ids([" ".join(plain[i : i + 256]) for i in range(0, len(plain), 256)])
        upto = np.flatnonzero(self.ends[ids]) + 1
        if len(upto) == len(plain):
            had = set(plain)
            other, sizes = [w for w in words if w not in had], np.diff(upto, prepend=0)
        else:
            plain, other, ids, sizes = [], words, ids[:0], np.zeros(0, np.int64)
        more, more_sizes = self._ids(other)
        for w in plain + other:
            self.known[w] = len(self.known)
        new, sizes = np.concatenate([ids, more]), np.concatenate([sizes, more_sizes])
        while self.long + len(new) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.long : self.long + len(new)] = new
        self.bounds = np.concatenate([self.bounds, self.long + np.cumsum(sizes)])
        self.long += len(new)
        if len(self.known) > len(self.times):
            self.times = np.concatenate([self.times, np.zeros(len(self.known), np.int64)])

    def _numbers(self, words: list[str]) -> np.ndarray:
        """The words' numbers, -1 for those that aren't known."""
        return np.fromiter(map(self.known.get, words, itertools.repeat(-1)), np.int64, len(words))

    def encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """(all ids one after the other, how many each text has), with the end id after each text."""
        raw, offsets = text_bytes(texts)
        words, bounds = split_bytes(*_apart(raw, offsets))
        codes, different = coded(words)
        codes = codes.astype(np.int32)
        del words, raw
        listed = different.to_pylist()
        k = self._numbers(listed)
        new = np.flatnonzero(k < 0)
        if len(new) and len(self.known) + len(new) > CACHE_WORDS:
            self._forget()
            k = self._numbers(listed)
            new = np.flatnonzero(k < 0)
        if len(new):
            fresh = [listed[i] for i in new.tolist()]
            for i in range(0, len(fresh), 20_000):
                self._learn(fresh[i : i + 20_000])
            k[new] = self._numbers(fresh)
        self.times[k] += 1
        starts, sizes = self.bounds[k], self.bounds[k + 1] - self.bounds[k]
        of_word = sizes[codes]
        upto = np.concatenate([[0], np.cumsum(of_word)])[bounds]
        lengths = np.diff(upto) + 1
        ids = np.full(int(lengths.sum()), end, np.uint32)
        keep = np.ones(len(ids), bool)
        keep[np.cumsum(lengths) - 1] = False
        ids[keep] = self.flat[ranges(starts[codes], of_word)]
        return ids, lengths


def _apart(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower case for A-Z, and a space before each run of ASCII punctuation between a letter and white space (or the end)."""
    if len(raw) < 2 or bool(((raw[:-1] == 60) & (raw[1:] == 124)).any()):
        return raw, offsets
    raw = np.where((raw >= 65) & (raw <= 90), raw | 32, raw)
    mark_of = np.zeros(256, bool)
    mark_of[[b for b in range(33, 127) if not chr(b).isalnum()]] = True
    space = np.zeros(256, bool)
    space[[9, 10, 11, 12, 13, 32]] = True
    punct = mark_of[raw]
    edge = np.zeros(len(raw) + 1, bool)  # a text begins here
    edge[offsets] = True
    begins = punct & (edge[:-1] | ~np.r_[False, punct[:-1]])
    ends = punct & (edge[1:] | ~np.r_[punct[1:], False])
    a, b = np.flatnonzero(begins), np.flatnonzero(ends)
    to_space = edge[b + 1] | space[raw[np.minimum(b + 1, len(raw) - 1)]]
    p = np.maximum(a - 1, 0)
    q = np.maximum(a - 2, 0)
    ascii_letter = (raw[p] >= 97) & (raw[p] <= 122)
    latin_letter = (raw[q] == 0xC3) & (raw[p] >= 0x80) & (raw[p] <= 0xBF) & (raw[p] != 0x97) & (raw[p] != 0xB7)
    mark = np.zeros(len(raw), bool)
    mark[a[to_space & ~edge[a] & (raw[a] != 39) & (ascii_letter | latin_letter)]] = True
    before = np.concatenate([[0], np.cumsum(mark)])
    out = np.full(len(raw) + int(before[-1]), 32, np.uint8)
    out[np.arange(len(raw)) + before[1:]] = raw
    return out, (offsets + before[offsets]).astype(np.int32)


def _write(uri: str, data: bytes) -> None:
    fs, path = pafs.FileSystem.from_uri(uri)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    with fs.open_output_stream(path) as f:
        f.write(data)


def _read(uri: str) -> bytes:
    fs, path = pafs.FileSystem.from_uri(uri)
    with fs.open_input_stream(path) as f:
        return f.read()


def write_shards(docs: DataFrame, path: str, tokenizer: str, *, end_id: int = 2, shard_ids: int = SHARD_IDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write all documents' ids, in ascending order of doc_id (null first), to shards under the path (a URI).

    Returns the manifest, which stays in the same folder: file, seq_part, seq_file, n_docs, n_ids, first_id (the ids before the shard).
    A null text counts as empty: its ids are the end id alone. Rows that repeat an id stand one after the other.
    A null doc_id is written as the least number there is, and read back as null. Ids are cast to long: one that isn't a whole number fails under ANSI mode.
    A very long text makes a shard of its own. Other columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    ship(spark)
    parts = _parts(docs)
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumns({"hash": F.xxhash64("text"), "nth": F.monotonically_increasing_id() % 1024})
    rows = rows.repartitionByRange(parts, "doc_id", "hash", "nth").sortWithinPartitions("doc_id", "hash").select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tidy("words"):
            yield from encode(batches)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, part, number = WordEncoder.of(tokenizer), TaskContext.get().partitionId(), 0
        width = np.uint16 if encoder.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            nonlocal held, size, number
            ids, lengths, of = (np.concatenate([h[k] for h in held]) for k in range(3))
            file = f"{path}/shard-{part:06d}-{number:06d}-{uuid.uuid4().hex}.bin"
            _write(file, shard_bytes(of, lengths, ids))
            out = pa.record_batch([[file], [part], [number], [len(of)], [len(ids)]], names=["file", "seq_part", "seq_file", "n_docs", "n_ids"])
            held, size, number = [], 0, number + 1
            return out.cast(_MANIFEST)

        for batch in batches:
            for b in slices(batch, "text", 1 << 20):
                ids, lengths = encoder.encode(b.column("text"), end_id)
                if held and size + len(ids) > shard_ids:
                    yield flush()
                held.append((ids.astype(width), lengths, b.column("doc_id").to_numpy(zero_copy_only=False)))
                size += len(ids)
        if held:
            yield flush()

    rows.mapInArrow(run, "file string, seq_part long, seq_file long, n_docs long, n_ids long").write.parquet(f"{path}/manifest")
    manifest = spark.read.parquet(f"{path}/manifest")
    # A row for each shard: few against the documents.
    return manifest.withColumn("first_id", F.coalesce(F.sum("n_ids").over(Window.orderBy("seq_part", "seq_file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long")))


def _parts(docs: DataFrame) -> int:
    size = docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    least = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return max(least, min(100_000, int(str(size)) // PART_BYTES))


NULL_ID = -(1 << 63)
_MANIFEST = pa.schema([("file", pa.string()), ("seq_part", pa.int64()), ("seq_file", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])
_READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def read_shards(manifest: DataFrame) -> DataFrame:
    """From the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (of the ids as little-endian uint32)."""
    ship(manifest.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                s = Shard(_read(row["file"]))
                bounds = np.fromiter(map(s.boundary, range(len(s.doc_ids) + 1)), np.int64, len(s.doc_ids) + 1)
                ids = s.ids.astype("<u4")
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                null = pa.array(s.doc_ids == NULL_ID)
                out = [pa.array(s.doc_ids), pa.array(bounds[:-1] + row["first_id"]), pa.array(np.diff(bounds)), pa.array(crc, pa.int64())]
                out[0] = pa.compute.if_else(null, pa.scalar(None, pa.int64()), out[0])
                yield pa.RecordBatch.from_arrays(out, schema=_READ)

    parts = max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return manifest.select("file", "first_id").repartition(parts).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def tokens_round_trip(docs: DataFrame, tokenizer: str, *, end_id: int = 2, **kw) -> DataFrame:
    """Write docs to shards in the shared folder, and read them back."""
    return read_shards(write_shards(docs, shared_dir(docs.sparkSession, "tokens"), tokenizer, end_id=end_id, **kw))
