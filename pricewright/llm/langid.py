"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary (letters-only pieces of a sentencepiece
model, whatever their length). A word's probability is the sum, over all ways to cut it into pieces, of the products of their
probabilities: a forward pass over its characters, in logarithms, so that no word is too long or too unlikely.
A text's score in a language is the sum of its words' logarithms. Probabilities are learned by
expectation-maximisation (forward-backward over the same cuts) from a bounded sample of labelled documents: about
SAMPLE_DOCS of each language, drawn by a hash from the different ones that can be used, whatever their length. Languages don't depend
on each other, so each is fitted by a task of its own, from its own words only. At most MOST_LANGUAGES are learned, those of the most
usable documents, so that what a wrong lang column holds doesn't count; the model has a row of numbers for each piece and a column for each
language, whatever the corpus's size. Texts are scored whole, in Arrow batches, each different word of a batch once; lattices and slices
shrink as languages grow. The only shuffles are those of keys, to count and draw documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import KEPT, LETTERS, coded, drawn, held_out, materialize, ship, slices, tidied, tidy, whole_row, with_text, words_of

SAMPLE_DOCS = 300
SAMPLE_TOTAL = 100_000
#: Languages of a model at most: those with the most usable documents, then by name.
MOST_LANGUAGES = 256
#: Characters of words that one lattice is made of, for up to FEW languages; a longer word has a lattice of its own.
LATTICE_CHARS = 50_000
FEW = 8
#: Bytes of text that are scored at a time, for up to FEW languages.
SCORE_BYTES = 4 << 20
UNKNOWN = 1e-7
ROUNDS = 4
#: Up to so many drawn keys are broadcast; more are joined by a shuffle.
BROADCAST_IDS = 500_000
_B = 0x9E3779B97F4A7C15 | 1
_B_INVERSE = pow(_B, -1, 1 << 64)
_WORD_START = 0x2581  # the mark before a word


def vocabulary(model_path: str) -> list[str]:
    """The model's pieces of letters (after the mark before a word, or that mark alone), in lower case."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    pieces = {sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))}
    mark = chr(_WORD_START)
    return sorted(p for p in pieces if p == p.lower() and (p == mark or p.removeprefix(mark).isalpha()))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out)


class Pieces:
    """The vocabulary as hashes, and the edges of words' cuts."""

    def __init__(self, pieces: list[str]):
        self.n = len(pieces)
        own = np.array([self._hash(p) for p in pieces], np.uint64)
        order = np.argsort(own)
        self.hashes, self.number = own[order], order.astype(np.int32)
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(own >> np.uint64(44)).astype(np.int64)] = True
        self.longest = max(map(len, pieces), default=1)

    @staticmethod
    def _hash(p: str) -> int:
        return sum((ord(c) + 1) * pow(_B, i, 1 << 64) for i, c in enumerate(p)) % (1 << 64)

    def lattices(self, words: list[str], languages: int = 1) -> Iterator[tuple[int, Lattice]]:
        """(number of the first word, lattice) of runs of words of about LATTICE_CHARS, fewer for many languages."""
        if not words:
            return
        run = np.cumsum(np.fromiter((len(w) + 1 for w in words), np.int64, len(words))) // max(1, LATTICE_CHARS * FEW // max(FEW, languages))
        starts = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
        for a, b in zip(starts.tolist(), np.r_[starts[1:], len(words)].tolist(), strict=True):
            yield a, Lattice(self, words[a:b])


class Edges:
    """Edges in an order in which they are worked off: by steps, and within a step by the boundary that they add to."""

    def __init__(self, step: np.ndarray, target: np.ndarray):
        self.order = np.lexsort((target, step))
        s, t = step[self.order], target[self.order]
        heads = np.flatnonzero(np.r_[True, t[1:] != t[:-1]]) if len(t) else np.zeros(0, np.int64)
        self.target, self.heads, self.sizes = t[heads], heads, np.diff(np.r_[heads, len(t)])
        cut = np.flatnonzero(np.r_[True, s[heads][1:] != s[heads][:-1]]) if len(t) else heads
        self.steps = list(zip(cut.tolist(), np.r_[cut[1:], len(heads)].tolist(), strict=True))
        self.n = len(t)

    def run(self, value: np.ndarray, source: np.ndarray, weight: np.ndarray, ids: np.ndarray) -> None:
        """value at each target: the logarithm of the sum over its edges of exp(value at the source + weight of the id)."""
        source, ids = source[self.order], ids[self.order]
        for a, b in self.steps:
            first, stop = int(self.heads[a]), int(self.heads[b]) if b < len(self.heads) else self.n
            x = value[source[first:stop]] + weight[ids[first:stop]]
            heads = self.heads[a:b] - first
            top = np.maximum.reduceat(x, heads, axis=0)
            x -= np.repeat(top, self.sizes[a:b], axis=0)
            value[self.target[a:b]] = top + np.log(np.add.reduceat(np.exp(x, out=x), heads, axis=0))


class Lattice:
    """Words' boundaries, and each place where a piece may stand between two of them."""

    def __init__(self, pieces: Pieces, words: list[str]):
        mark = chr(_WORD_START)
        cps = np.frombuffer("".join(mark + w for w in words).encode("utf-32-le", "surrogatepass"), np.uint32)
        size = np.fromiter((len(w) + 1 for w in words), np.int64, len(words))
        starts = np.cumsum(size) - size
        word = np.repeat(np.arange(len(words)), size)
        place = np.arange(len(cps)) - starts[word]
        left = size[word] - place
        self.first = starts + np.arange(len(words))  # of each word's boundaries
        self.last = self.first + size
        self.n_bounds = len(cps) + len(words)
        with np.errstate(over="ignore"):
            sums = np.concatenate([[np.uint64(0)], np.cumsum((cps.astype(np.uint64) + np.uint64(1)) * _powers(_B, len(cps))[: len(cps)])])
            back = _powers(_B_INVERSE, len(cps))
        at, lengths, ids = [], [], []
        for n in range(1, pieces.longest + 1):
            c = np.flatnonzero(left >= n)
            with np.errstate(over="ignore"):
                h = (sums[c + n] - sums[c]) * back[c]
            if n > 1:
                maybe = pieces.seen[(h >> np.uint64(44)).astype(np.int64)]
                c, h = c[maybe], h[maybe]
            i = np.minimum(np.searchsorted(pieces.hashes, h), max(0, pieces.n - 1))
            known = pieces.hashes[i] == h if pieces.n else np.zeros(len(h), bool)
            piece = np.full(len(c), pieces.n, np.int32)
            piece[known] = pieces.number[i[known]]
            if n > 1:
                c, piece = c[known], piece[known]
            at.append(c)
            lengths.append(np.full(len(c), n, np.int32))
            ids.append(piece)
        at, lengths, self.ids = (np.concatenate(x) for x in (at, lengths, ids))
        self.word, self.start = word[at], place[at]
        self.at = at + self.word
        self.to = self.at + lengths
        self.forth = Edges(self.start + lengths, self.to)

    def forward(self, logp: np.ndarray) -> np.ndarray:
        alpha = np.zeros((self.n_bounds, logp.shape[1]))
        self.forth.run(alpha, self.at, logp, self.ids)
        return alpha

    def log_likelihood(self, logp: np.ndarray) -> np.ndarray:
        """For each word and language."""
        return self.forward(logp)[self.last]

    def expected(self, logp: np.ndarray, times: np.ndarray) -> np.ndarray:
        """How often each piece is used, for words that occur so many times in each language."""
        alpha, beta = self.forward(logp), np.zeros((self.n_bounds, logp.shape[1]))
        Edges(-self.start, self.at).run(beta, self.to, logp, self.ids)
        used = np.zeros_like(logp)
        for k in range(logp.shape[1]):
            share = np.exp(alpha[self.at, k] + logp[self.ids, k] + beta[self.to, k] - alpha[self.last, k][self.word])
            used[:, k] = np.bincount(self.ids, weights=share * times[self.word, k], minlength=len(used))
        return used


def log_scores(texts: pa.Array, table: Pieces, logp: np.ndarray) -> np.ndarray:
    """The logarithm of each text's probability in each language; one lattice's words are in memory at a time."""
    codes, words, bounds = words_and_counts(texts)
    n, total = len(texts), np.zeros((len(texts), logp.shape[1]))
    key, times = np.unique(codes * n + np.repeat(np.arange(n), np.diff(bounds)), return_counts=True)
    word, text = key // max(n, 1), key % max(n, 1)
    for a, lattice in table.lattices(words, logp.shape[1]):
        first, stop = np.searchsorted(word, [a, a + len(lattice.last)])
        order = first + np.argsort(text[first:stop], kind="stable")
        likely = lattice.log_likelihood(logp)
        for i in range(0, len(order), max(1, LATTICE_CHARS * FEW // logp.shape[1])):
            some = order[i : i + max(1, LATTICE_CHARS * FEW // logp.shape[1])]
            heads = np.flatnonzero(np.r_[True, text[some][1:] != text[some][:-1]])
            total[text[some][heads]] += np.add.reduceat(likely[word[some] - a] * times[some][:, None], heads, axis=0)
    return total


def words_and_counts(texts: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray]:
    """(number of each word in the texts, the different words, where each text begins)."""
    words, bounds = words_of(texts, LETTERS)
    codes, different = coded(words)
    return codes, pc.utf8_lower(different).to_pylist(), bounds


def fit(words: list[str], times: np.ndarray, pieces: list[str], rounds: int = ROUNDS, table: Pieces | None = None) -> np.ndarray:
    """Probabilities by piece and language (the last row is an unknown character's), from how often each word occurs in each language."""
    table, n = table or Pieces(pieces), times.shape[1]
    p = np.full((len(pieces) + 1, n), 1 / (len(pieces) + 1))
    p[-1] = UNKNOWN
    for _ in range(rounds):
        used, logp = np.zeros_like(p), np.log(p)
        for a, lattice in table.lattices(words, n):
            used += lattice.expected(logp, times[a : a + len(lattice.last)])
        p = (used + 0.02) / (used[:-1].sum(axis=0) + 0.02 * len(pieces))
        p[-1] = UNKNOWN
    return p


def fit_languages(counted: DataFrame, pieces: list[str]) -> tuple[list[str], np.ndarray]:
    """(languages, probabilities) from lang, word, n: each language in a task of its own, from its own words.

    The driver gets the pieces that a language uses and one number for all others.
    """
    shared = counted.sparkSession.sparkContext.broadcast(pieces)

    def one(t: pa.Table) -> pa.Table:
        with tidy("pieces"):
            if "pieces" not in KEPT:
                KEPT["pieces"] = Pieces(shared.value)
            t = t.sort_by("word")
            p = fit(t["word"].to_pylist(), t["n"].to_numpy().astype(float)[:, None], shared.value, table=KEPT["pieces"])[:-1, 0]
            least = p.min(initial=1.0)
            own = np.flatnonzero(p > least)
            n = len(own) + 1
            return pa.table({"lang": t["lang"].slice(0, 1).take(pa.array(np.zeros(n, np.int64))), "piece": pa.array(np.r_[-1, own], pa.int32()), "p": np.r_[least, p[own]]})

    t = counted.groupBy("lang").applyInArrow(one, "lang string, piece int, p double").toArrow().combine_chunks()
    names = sorted(set(t["lang"].to_pylist()))
    lang, piece, own = pc.index_in(t["lang"], pa.array(names, pa.string())).to_numpy(), t["piece"].to_numpy(), t["p"].to_numpy()
    rest = piece < 0
    p = np.empty((len(pieces) + 1, len(names)))
    p[:, lang[rest]] = own[rest]
    p[piece[~rest], lang[~rest]] = own[~rest]
    p[-1] = UNKNOWN
    return names, p


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, text to lang, word, n: how often each word occurs in each language."""
    for batch in batches:
        for b in slices(batch, "text", 4 << 20):
            codes, words, bounds = words_and_counts(b.column("text"))
            lang, langs = coded(b.column("lang"))
            key, n = np.unique(np.repeat(lang, np.diff(bounds)) * max(1, len(words)) + codes, return_counts=True)
            word = pa.array(words, pa.string()).take(pa.array(key % max(1, len(words))))
            yield pa.RecordBatch.from_arrays([langs.take(pa.array(key // max(1, len(words)))), word, pa.array(n.astype(np.int64))], names=["lang", "word", "n"])


def train(docs: DataFrame, model_path: str, *, sample_docs: int = SAMPLE_DOCS, sample_total: int = SAMPLE_TOTAL, most_languages: int = MOST_LANGUAGES, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], list[str], np.ndarray]:
    """(languages, pieces, probabilities), from documents that aren't held out, have a language and a letter.

    Rows that repeat an id, language and text count once. The most_languages languages of the most rows are learned; of each about sample_docs
    rows are drawn, of all about sample_total, but one row of each at least. A null id can be drawn. Columns other than the three named are ignored.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    rows = rows.filter(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")) & F.col("text").rlike(r"\p{L}")).select("lang", "text", F.xxhash64("doc_id", "text", F.lit(8)).alias("key"))
    # Keys are drawn without their texts; then the few drawn go to the texts, not the texts to a shuffle.
    usable = materialize(rows.select("lang", "key").distinct(), "usable")
    counts = materialize(usable.groupBy("lang").agg(F.count("*").alias("n"), F.min(F.pmod("key", F.lit(1 << 30))).alias("least")), "languages")
    counts = counts.orderBy(F.col("n").desc(), "lang").limit(most_languages)
    quota = max(1, min(sample_docs, sample_total // max(1, counts.count())))
    draw = drawn(F.col("key"), F.col("n"), quota) | (F.pmod("key", F.lit(1 << 30)) == F.col("least"))  # so each language has a row at least
    chosen = materialize(usable.join(F.broadcast(counts), "lang").filter(draw).select("lang", "key"), "drawn")
    if chosen.count() <= BROADCAST_IDS:
        chosen = F.broadcast(chosen)
    sample = rows.join(chosen, ["lang", "key"]).dropDuplicates(["lang", "key"]).select("lang", "text")
    counted = sample.mapInArrow(tidied(_count_words), "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    pieces = vocabulary(model_path)
    names, p = fit_languages(counted, pieces)
    return names, pieces, p


def identify(docs: DataFrame, model: tuple[list[str], list[str], np.ndarray], *, id_col: str = "doc_id", text_col: str = "text", with_row: bool = False) -> DataFrame:
    """A row for each row of docs: doc_id, lang_pred, score (the language's probability, 0 for und), and with_row the whole row as a struct, row.

    und if the text is null or has no letter, or if the model has no language. Ties go to the first language by name. Rows that repeat
    an id are told each by its own text, null ids as others. Other columns are ignored, whatever their names. A text is scored
    whole; one of many megabytes without a space takes about 20 seconds for each million letters.
    """
    spark = docs.sparkSession
    ship(spark)
    names, pieces, p = model
    shared = spark.sparkContext.broadcast((names, Pieces(pieces), np.log(p)))
    text = F.col(text_col).cast("string")
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("letters"), F.lit(None).cast("string").alias("lang_pred"), F.lit(0.0).alias("score"),
        whole_row(docs).alias("row") if with_row else text.alias("text"),
    )
    # The text goes to Python once, and within the row only is it sent back.
    out_schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in rows.schema.fields if f.name != "text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, table, logp = shared.value
        labels = np.array([*names, "und"], object)
        for batch in batches:
            for b in slices(with_text(batch, "row", text_col) if with_row else batch, "text", SCORE_BYTES * FEW // max(FEW, len(names))):
                best, score = np.full(b.num_rows, len(names)), np.zeros(b.num_rows)
                if names:
                    total = log_scores(b.column("text"), table, logp)
                    share = np.exp(total - total.max(axis=1, keepdims=True))
                    share /= share.sum(axis=1, keepdims=True)
                    letters = b.column("letters").to_numpy(zero_copy_only=False).astype(bool)
                    best[letters] = share.argmax(axis=1)[letters]
                    score[letters] = share.max(axis=1)[letters]
                put = {"lang_pred": pa.array(labels[best].tolist(), pa.string()), "score": pa.array(score)}
                sent = b.schema.names[:-1]
                yield pa.RecordBatch.from_arrays([put.get(c, b.column(c)) for c in sent], names=sent)

    return rows.mapInArrow(tidied(run), out_schema).drop("letters")


def language_report(docs: DataFrame, model_path: str, **kw) -> DataFrame:
    """doc_id, held_out, lang_pred, score; the model is learned from docs' own labelled rows that aren't held out."""
    return identify(docs, train(docs, model_path, **kw)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
