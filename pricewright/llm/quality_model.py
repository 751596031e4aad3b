"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network with calibrated probabilities.

Every word has two tokens: the word itself and its shape (runs of capitals, small letters, digits and marks, and whether it
repeats the word before it). Each word of the vocabulary has a vector of its own. The vocabulary is drawn with the training sample:
the words that MIN_DOCS or more of its documents have, so its size is bounded by SAMPLE_DOCS documents and not by the corpus; shapes have SHAPE_BUCKETS, and
words outside the vocabulary TAIL_BUCKETS vectors, which they share by hash. As the sample is drawn at random, the share of
a corpus's words outside the vocabulary doesn't grow with the corpus. A token's index vector has a few random +1 and -1
(from a hash, never stored); its word vector is the sum of the index vectors of the tokens
within two places, counted over all documents: each task sums its own tables, and one aggregation by token adds them up.
A document's features are the means of its tokens' unit vectors, their lengths, and the tokens' mean logarithmic frequency.

The network (one hidden layer) is fitted with numpy on the bounded sample: about SAMPLE_DOCS labelled documents that aren't held out, drawn by a
hash of id and text; a fifth of them sets the temperature of its probabilities. All documents are then scored whole, in Arrow batches, each
different word of a batch looked up once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACED, coded, drawn, held_out, materialize, mix64, ship, slices, split_bytes, text_bytes, tidied

TAIL_BUCKETS, SHAPE_BUCKETS = 4096, 1024
MIN_DOCS = 3
DIMENSIONS = 32
ONES = 2
REACH = 2
SAMPLE_DOCS = 8_000
HIDDEN = 24
THRESHOLD = 0.3
#: Tokens whose vectors are gathered at once.
GATHER = 1 << 15

_SHAPE = np.full(256, ord("x"), np.uint8)
for _b in range(128):
    _c = chr(_b)
    _SHAPE[_b] = 32 if _c in " \t\n\v\f\r" else ord("X") if _c.isupper() else ord("x") if _c.islower() else ord("9") if _c.isdigit() else _b if _b > 32 else ord("?")


class Vocabulary:
    """Numbers of tokens: first the shapes, then the words outside the vocabulary by hash, then the vocabulary's words."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.sort(np.asarray(hashes, np.uint64))
        self.words_from = SHAPE_BUCKETS
        self.n = SHAPE_BUCKETS + TAIL_BUCKETS + len(self.hashes)

    def words(self, words: list[str]) -> np.ndarray:
        h = hashes(words)
        out = (np.uint64(SHAPE_BUCKETS) + h % np.uint64(TAIL_BUCKETS)).astype(np.int32)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            own = self.hashes[at] == h
            out[own] = SHAPE_BUCKETS + TAIL_BUCKETS + at[own]
        return out

    def shapes(self, shapes: list[str]) -> np.ndarray:
        return (hashes(shapes) % np.uint64(SHAPE_BUCKETS)).astype(np.int32)

    def index_vectors(self) -> tuple[np.ndarray, np.ndarray]:
        """(dimensions, signs) of the ONES entries of each token's index vector: by the word's own hash, or by the bucket's number."""
        own = np.concatenate([np.arange(SHAPE_BUCKETS + TAIL_BUCKETS, dtype=np.uint64), self.hashes])
        with np.errstate(over="ignore"):
            h = mix64(own[:, None] * np.uint64(2 * ONES + 1) + np.arange(ONES, dtype=np.uint64) + np.uint64(0x51ED27))
        return (h % np.uint64(DIMENSIONS)).astype(np.int64), np.where((h >> np.uint64(40)) & np.uint64(1), 1.0, -1.0)


def hashes(words: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))


def split_texts(texts: pa.Array) -> tuple[tuple[np.ndarray, list[str]], tuple[np.ndarray, list[str]], np.ndarray]:
    """((code of each word, different words), (code of each word's shape, different shapes), where each text begins)."""
    raw, offsets = text_bytes(texts)
    words, bounds = split_bytes(SPACED[raw], offsets)
    codes, different = coded(words)
    shape = _SHAPE[raw]
    first = np.zeros(len(raw) + 1, bool)
    first[offsets] = True
    keep = first[:-1] | (shape != np.r_[np.uint8(0), shape[:-1]]) | (shape == 32) if len(raw) else np.zeros(0, bool)
    shapes, _ = split_bytes(shape[keep], np.concatenate([[0], np.cumsum(keep)])[offsets].astype(np.int32))
    shape_codes, shape_words = coded(shapes)
    again = np.zeros(len(codes), bool)
    again[1:] = codes[1:] == codes[:-1]
    again[bounds[:-1][bounds[:-1] < len(codes)]] = False
    shape_words = shape_words.to_pylist()
    return (codes, different.to_pylist()), (shape_codes + again * len(shape_words), shape_words + [f"{x} again" for x in shape_words]), bounds


def tokens(texts: pa.Array, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word token and shape token of each word, where each text begins)."""
    (codes, words), (shape_codes, shapes), bounds = split_texts(texts)
    if not len(codes):
        return np.zeros(0, np.int32), np.zeros(0, np.int32), bounds
    return vocabulary.words(words)[codes], vocabulary.shapes(shapes)[shape_codes], bounds


def _add_contexts(table: np.ndarray, seq: np.ndarray, text: np.ndarray, dims: np.ndarray, signs: np.ndarray) -> None:
    for off in range(1, REACH + 1):
        same = text[off:] == text[:-off]
        a, b = seq[:-off][same], seq[off:][same]
        for x, y in ((a, b), (b, a)):
            at = x.astype(np.int64) * DIMENSIONS
            for j in range(ONES):
                table += np.bincount(at + dims[y, j], weights=signs[y, j], minlength=table.size)


def word_vectors(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text") -> np.ndarray:
    """A unit vector (or zeros) for each token, and as last column its logarithmic share of all words, as float32."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        dims, signs = vocabulary.index_vectors()
        table, times = np.zeros(vocabulary.n * DIMENSIONS), np.zeros(vocabulary.n)
        for batch in batches:
            for b in slices(batch, "text", 4 << 20):
                words, shapes, bounds = tokens(b.column("text"), vocabulary)
                text = np.repeat(np.arange(b.num_rows), np.diff(bounds))
                for seq in (words, shapes):
                    if len(seq):
                        _add_contexts(table, seq, text, dims, signs)
                        times += np.bincount(seq, minlength=vocabulary.n)
        own = np.flatnonzero(times)
        for some in np.array_split(own, max(1, len(own) // 10_000)):
            sums = np.concatenate([table.reshape(-1, DIMENSIONS)[some], times[some, None]], axis=1).astype(np.int64)
            at = np.arange(0, sums.size + 1, DIMENSIONS + 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.ListArray.from_arrays(pa.array(at), pa.array(sums.ravel()))], names=["token", "v"])

    parts = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(tidied(run), "token long, v array<long>")
    summed = parts.groupBy("token").agg(*[F.sum(F.col("v")[i]).alias(f"v{i}") for i in range(DIMENSIONS + 1)]).toArrow()  # a row for each token
    table = np.zeros((vocabulary.n, DIMENSIONS + 1))
    at = summed["token"].to_numpy()
    for i in range(DIMENSIONS + 1):
        table[at, i] = summed[f"v{i}"].to_numpy()
    times = table[:, -1]
    vectors = table[:, :-1] / np.maximum(times, 1)[:, None]
    for part in (slice(0, vocabulary.words_from), slice(vocabulary.words_from, None)):  # what all contexts share says nothing
        vectors[part] -= (vectors[part] * times[part, None]).sum(axis=0) / max(1.0, times[part].sum())
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    vectors[times == 0] = 0
    share = np.log(times / max(1.0, times[vocabulary.words_from :].sum()) + 1e-7) / 16
    return np.concatenate([vectors, share[:, None]], axis=1).astype(np.float32)


def pooled(seq: np.ndarray, bounds: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """The sum of each text's tokens' rows; texts are added up in parts, so that a part's rows fit in a cache."""
    out = np.zeros((len(bounds) - 1, vectors.shape[1]))
    cuts = np.union1d(bounds, np.arange(0, len(seq), GATHER))
    text = np.searchsorted(bounds, cuts[:-1], side="right") - 1
    rows = np.searchsorted(cuts, np.arange(0, len(seq) + GATHER, GATHER))
    for a, b in zip(rows[:-1].tolist(), rows[1:].tolist(), strict=True):
        if b > a:
            first, stop = cuts[a], cuts[b] if b < len(cuts) else len(seq)
            sums = np.add.reduceat(vectors[seq[first:stop]], cuts[a:b][cuts[a:b] < len(seq)] - first, axis=0)
            np.add.at(out, text[a : a + len(sums)], sums)
    return out


def features(texts: pa.Array, vocabulary: Vocabulary, vectors: np.ndarray) -> np.ndarray:
    """Per text, for words and shapes: mean vector, mean logarithmic share, the mean vector's length; and the logarithm of the words' number."""
    words, shapes, bounds = tokens(texts, vocabulary)
    n = np.diff(bounds)
    out = []
    for seq in (words, shapes):
        mean = pooled(seq, bounds, vectors) / np.maximum(n, 1)[:, None]
        out += [mean, np.linalg.norm(mean[:, :-1], axis=1)[:, None]]
    return np.concatenate([*out, np.log1p(n)[:, None] / 8], axis=1)


class Network:
    """Features to a probability: standardised, one hidden tanh layer, a logistic output with a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, hidden: int = HIDDEN, epochs: int = 60, seed: int = 7):
        rng = np.random.default_rng(seed)
        order = rng.permutation(len(x))
        fit, held = order[len(x) // 5 :], order[: len(x) // 5]
        self.mean, self.sd = x[fit].mean(axis=0), x[fit].std(axis=0) + 1e-6
        z = self._z(x)
        self.p = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden), rng.normal(0, 1 / np.sqrt(hidden), hidden), np.zeros(1)]
        m, v, t = [np.zeros_like(a) for a in self.p], [np.zeros_like(a) for a in self.p], 0
        for _ in range(epochs):
            for b in np.array_split(rng.permutation(fit), max(1, len(fit) // 128)):
                h = np.tanh(z[b] @ self.p[0] + self.p[1])
                d = (_logistic(h @ self.p[2] + self.p[3]) - y[b]) / len(b)
                dh = d[:, None] * self.p[2] * (1 - h * h)
                grads = [z[b].T @ dh + 1e-4 * self.p[0], dh.sum(axis=0), h.T @ d + 1e-4 * self.p[2], d.sum(keepdims=True)]
                t += 1
                for i, g in enumerate(grads):
                    m[i] = 0.9 * m[i] + 0.1 * g
                    v[i] = 0.999 * v[i] + 0.001 * g * g
                    self.p[i] = self.p[i] - 0.003 * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
        self.temperature = 1.0
        if len(held):
            raw, own = self.raw(x[held]), y[held]
            loss = lambda temp: -np.mean(np.log(np.where(own > 0, _logistic(raw / temp), 1 - _logistic(raw / temp)) + 1e-12))
            self.temperature = float(min(np.geomspace(0.25, 8, 61), key=loss))

    def _z(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.sd, -8, 8)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(self._z(x) @ self.p[0] + self.p[1]) @ self.p[2] + self.p[3]

    def score(self, x: np.ndarray) -> np.ndarray:
        return _logistic(self.raw(x) / self.temperature)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _usable(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    own = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    return own.groupBy(F.col(id_col).cast("long").alias("of")).agg(F.max(F.col(label_col).cast("double")).alias("y"))


def draw_sample(docs: DataFrame, labels: DataFrame, *, sample_docs: int = SAMPLE_DOCS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """of, y, text: about sample_docs labelled documents, in a table in the shared folder.

    Null labels, labels of ids that documents haven't, and held-out ids are left out; of several labels of an id the largest counts. Rows that
    repeat id and text count once; of an id with many texts each may be drawn, but no more than sample_docs rows are, about.
    """
    own = materialize(_usable(labels, id_col, label_col), "labels")
    total = own.count()
    some = own.filter(drawn(F.xxhash64("of", F.lit(4)), F.lit(total), sample_docs))
    if total <= sample_docs or some.count() <= 2 * sample_docs:  # about sample_docs rows of two numbers
        some = F.broadcast(some)
    rows = docs.select(F.col(id_col).cast("long").alias("of"), F.col(text_col).cast("string").alias("text")).join(some, "of")
    rows = rows.withColumn("key", F.xxhash64("of", "text", F.lit(5))).dropDuplicates(["of", "key"])
    rows = materialize(rows, "sample")
    n = rows.count()
    if n > 2 * sample_docs:  # ids that many texts repeat
        rows = rows.filter(drawn(F.col("key"), F.lit(n), sample_docs))
    return rows.select("of", "y", "text")


def draw_vocabulary(sample: DataFrame, min_docs: int = MIN_DOCS) -> Vocabulary:
    """The words that min_docs or more texts of the sample have."""
    ship(sample.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, "text", 4 << 20):
                (codes, words), _, bounds = split_texts(b.column("text"))
                text = np.repeat(np.arange(b.num_rows), np.diff(bounds))
                of = np.unique(text * max(1, len(words)) + codes) % max(1, len(words))
                times = np.bincount(of, minlength=len(words))
                yield pa.RecordBatch.from_arrays([pa.array(hashes(words).view(np.int64)), pa.array(times.astype(np.int64))], names=["h", "n"])

    counted = sample.select("text").mapInArrow(tidied(run), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    return Vocabulary(counted.filter(F.col("n") >= min_docs).select("h").toArrow()["h"].to_numpy().view(np.uint64))


def train(sample: DataFrame, vocabulary: Vocabulary, vectors: np.ndarray) -> Network | None:
    """The network, or None if the sample is empty."""
    shared = sample.sparkSession.sparkContext.broadcast((vocabulary, vectors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, "text", 4 << 20):
                x = features(b.column("text"), *shared.value)
                at = np.arange(0, x.size + 1, x.shape[1]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([b.column("of"), b.column("y"), pa.ListArray.from_arrays(pa.array(at), pa.array(x.ravel()))], names=["of", "y", "x"])

    got = sample.mapInArrow(tidied(run), "of long, y double, x array<double>").toArrow()  # a row for each document of the sample
    if not got.num_rows:
        return None
    x = got["x"].combine_chunks().values.to_numpy().reshape(got.num_rows, -1)
    order = np.lexsort((*x.T[:3], got["of"].to_numpy()))
    return Network(x[order], got["y"].to_numpy()[order])


def score_quality(docs: DataFrame, labels: DataFrame, *, sample_docs: int = SAMPLE_DOCS, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """A row for each row of docs: doc_id, held_out, score (of label 1), predicted (1 if score >= threshold).

    Null and empty texts are scored as texts without words. Without any label to learn from, all scores are 0.5. Columns other than
    the id and the text are never read, whatever their names. Rows that repeat an id, or have none, are scored each by its own text, whole.
    """
    spark = docs.sparkSession
    ship(spark)
    sample = draw_sample(docs, labels, sample_docs=sample_docs, id_col=id_col, text_col=text_col, label_col=label_col)
    vocabulary = draw_vocabulary(sample)
    vectors = word_vectors(docs, vocabulary, text_col)
    network = train(sample, vocabulary, vectors)
    shared = spark.sparkContext.broadcast((vocabulary, vectors, network))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, vectors, network = shared.value
        for batch in batches:
            for b in slices(batch, "text", 4 << 20):
                score = network.score(features(b.column("text"), vocabulary, vectors)) if network else np.full(b.num_rows, 0.5)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(score)], names=["doc_id", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    out = rows.mapInArrow(tidied(run), f"doc_id {kind}, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
