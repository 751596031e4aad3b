"""What the operators share: the shared folder, shipping this package to executors, and Arrow text helpers."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: Bytes of text that one step of a Python task works on; longer single texts are a step of their own.
SLICE_BYTES = 8 << 20

_shipped: set[str] = set()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder's path under spark.checkpoint.dir, which all executors share; the folder isn't made.

    Only a local session that names no such folder gets one of its own (as in tests); a cluster must name it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        if spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must be set for local-cluster")
        base = os.environ.setdefault("PRICEWRIGHT_SHARED", "file://" + tempfile.mkdtemp(prefix="pricewright-"))
    return f"{base.rstrip('/')}/pricewright/{name}-{uuid.uuid4().hex}"


#: Rows that go to a Python worker at a time where they hold whole texts; Spark's own default of 10,000 makes batches of 50 MB and more.
TEXT_ROWS = 500


@contextlib.contextmanager
def text_batches(spark: SparkSession) -> Iterator[None]:
    """Within, jobs send TEXT_ROWS rows at a time to Python workers, unless the session already sends fewer."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if 0 < int(before) <= TEXT_ROWS:
        yield
        return
    spark.conf.set(key, TEXT_ROWS)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def materialize(df: DataFrame, name: str, texts: bool = False) -> DataFrame:
    """Write df as Parquet in the shared folder and read it again: its lineage ends there, and lost executors cost nothing.

    texts: whether whole texts go through Python workers on the way.
    """
    spark, path = df.sparkSession, shared_dir(df.sparkSession, name)
    with text_batches(spark) if texts else contextlib.nullcontext():
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers wherever they run; once for each application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    to = os.path.join(tempfile.mkdtemp(), "pricewright_code.zip")
    with zipfile.ZipFile(to, "w") as z:
        for folder, _, names in os.walk(top):
            for n in names:
                if n.endswith(".py"):
                    p = os.path.join(folder, n)
                    z.write(p, os.path.relpath(p, os.path.dirname(top)))
    spark.sparkContext.addPyFile(to)
    _shipped.add(app)


#: What a Python worker keeps from one task to the next, by the operator's name.
KEPT: dict[str, object] = {}


@contextlib.contextmanager
def tidy(keep: str | None = None) -> Iterator[None]:
    """Around a task's work in a Python worker, which later serves other operators: drops what those have kept, and gives free memory back."""

    def trim() -> None:
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):
            ctypes.CDLL(None).malloc_trim(0)

    if others := [k for k in KEPT if k != keep]:
        for k in others:
            del KEPT[k]
        trim()
    try:
        yield
    finally:
        trim()


def tidied(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run for mapInArrow, within tidy()."""

    def tidily(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tidy():
            yield from run(batches)

    return tidily


def whole_row(df: DataFrame) -> Column:
    """All of df's columns as one struct, so that none of their names meets an operator's own."""
    return F.struct(*[df[f"`{c}`"] for c in df.columns])


def unpacked(df: DataFrame, row: str, names: list[str]) -> DataFrame:
    """The columns that whole_row() put into the struct."""
    return df.select(*[F.col(row).getField(c).alias(c) for c in names])


def with_text(batch: pa.RecordBatch, row: str, text_col: str) -> pa.RecordBatch:
    """batch with the struct's text as the last column, "text", without a copy."""
    return pa.RecordBatch.from_arrays([*batch.columns, batch.column(row).field(text_col)], names=[*batch.schema.names, "text"])


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, UPPER, LOWER)


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves no rest by 5; a null id isn't held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def drawn(key: Column, of: Column, wanted: int) -> Column:
    """Whether a row is drawn, about `wanted` of `of` rows, by the low bits of its key; in doubles, so that no count is too large."""
    return F.pmod(key, F.lit(1 << 30)).cast("double") < F.lit(float(wanted) * (1 << 30)) / F.greatest(of.cast("double"), F.lit(1.0))


def byte_table(words: str, lower: bool = True) -> np.ndarray:
    """Maps bytes so that white space divides words.

    words "space": only the six ASCII white-space characters divide words.
    words "alnum": every ASCII character but letters and digits does.
    words "letters": every ASCII character but letters does.
    """
    t = np.arange(256, dtype=np.uint8)
    if words != "space":
        for b in range(128):
            c = chr(b)
            if not (c.isalpha() or (c.isdigit() and words == "alnum")):
                t[b] = 32
    if lower:
        t[65:91] = np.arange(97, 123)
    return t


SPACED = byte_table("space")
SPACED_CASED = byte_table("space", lower=False)
ALNUM = byte_table("alnum")
LETTERS = byte_table("letters")


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about so many bytes of the column."""
    if not batch.num_rows:
        return
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    run = (np.cumsum(size) - size) // limit
    starts = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
    for a, b in zip(starts, np.r_[starts[1:], batch.num_rows], strict=True):
        yield batch.slice(a, b - a)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after the other, and where each begins (one more at the end); null counts as empty."""
    if not pa.types.is_string(texts.type):
        texts = texts.cast(pa.string())
    texts = pc.fill_null(texts, "")
    _, at, data = texts.buffers()
    n = len(texts)
    offsets = np.frombuffer(at, np.int32)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, np.int32)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and n else np.zeros(0, np.uint8)
    return raw, (offsets - offsets[0]).astype(np.int32)


def words_of(texts: pa.Array, table: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in one array, and where those of each text begin (one more at the end)."""
    raw, offsets = text_bytes(texts)
    return split_bytes(table[raw], offsets)


def split_bytes(raw: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    n = len(offsets) - 1
    mapped = pa.StringArray.from_buffers(n, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(raw)))
    lists = pc.ascii_split_whitespace(mapped)
    values = lists.values
    at = np.asarray(lists.offsets).astype(np.int64)
    full = pc.greater(pc.binary_length(values), 0)
    kept = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False).astype(np.int64))])
    return values.filter(full), kept[at]


def coded(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """A number for each word, and the different words in the order of their numbers."""
    d = words.dictionary_encode()
    return d.indices.to_numpy(zero_copy_only=False).astype(np.int64), d.dictionary


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers of the ranges [start, start + length), one range after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)
