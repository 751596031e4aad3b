"""From documents to token shards, in five stages; each stage's result is written as Parquet and read again by the next one.

Stages carry whole rows as one struct, so that columns beyond those of documents pass through all but the last one whatever their
names. An empty table gives an empty one. Texts of any length are worked on whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewright.llm.common import materialize, unpacked, whole_row
from pricewright.llm.decontam import decontaminate
from pricewright.llm.langid import identify, train
from pricewright.llm.mixing import copies, mix
from pricewright.llm.near_dup import near_duplicates
from pricewright.llm.q_tokens import tokenizer_path
from pricewright.llm.token_output import tokens_round_trip

#: Documents whose language is less likely than this go, as do those without a letter.
LEAST_LANG_SCORE = 0.5


def _keyed(docs: DataFrame) -> DataFrame:
    """id_, hash_ (of the text) and row_ (all columns)."""
    return docs.select(F.col("doc_id").alias("id_"), F.xxhash64(F.col("text").cast("string")).alias("hash_"), whole_row(docs).alias("row_"))


def _same(a: DataFrame, b: DataFrame) -> Column:
    return a["id_"].eqNullSafe(b["of_id"]) & (a["hash_"] == b["of_hash"])


def _picked(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of docs whose id and text are among rows (of_id, of_hash, n, times), as id_, hash_, row_ and times.

    Rows that agree in both (n of them) come as one, with the columns of any of them; few do after near-duplicate removal, and only
    these cross another shuffle, merged before it.
    """
    rows, got = materialize(rows, "picked"), _keyed(docs)
    got = got.join(rows, _same(got, rows)).select("id_", "hash_", "row_", "n", "times")
    if rows.filter("n > 1").isEmpty():
        return got
    again = got.filter("n > 1").groupBy("id_", "hash_").agg(F.first("row_").alias("row_"), F.first("n").alias("n"), F.first("times").alias("times"))
    return got.filter("n = 1").unionByName(again)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model knows, learned from docs' own labelled rows.

    Null texts and those without a letter go, whatever their columns say; null ids stay. Rows that repeat an id are judged each by its own text. If no
    document has a language to learn from, none is kept.
    """
    told = identify(docs, train(docs, tokenizer_path("piece_bpe_32k.model")), with_row=True)
    return unpacked(told.filter((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_LANG_SCORE)), "row", docs.columns)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id; one row of those that repeat it exactly.

    Rows of the smallest id with other texts stay if they belong to groups of their own, or if they are near copies of each other:
    then they share that id and the smallest hash of the text decides. Documents without words stay (rows that repeat id and text as
    one). Rows with a null id go if they are copies of one that has an id; of copies that all have a null id, one stays.
    """
    found = near_duplicates(docs, threshold=80, with_group=True).filter("kept").groupBy("doc_id", "group", "text_hash").agg(F.count("*").alias("n"))
    found = materialize(found, "kept")
    # A group has one row here, but where an id is repeated with texts that are near copies, or is null.
    least = found.groupBy("group").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"), F.count("*").alias("rows"))
    several = materialize(least.filter(F.col("group").isNotNull() & (F.col("rows") > 1)), "several")
    one = found.join(several.select(F.col("group").alias("of"), "first"), F.col("group") == F.col("of"), "left")
    one = one.filter(F.col("of").isNull() | F.struct("doc_id", "text_hash").eqNullSafe(F.col("first")))
    one = one.select(F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_hash"), "n", F.lit(1).alias("times"))
    return unpacked(_picked(docs, one), "row_", docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an occurrence of a benchmark window. Null and empty texts stay, as do null ids; rows that repeat an id are judged each by its own text."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; one that is taken in part counts if at least half of it is.

    Documents without words aren't taken. Rows that repeat an id are mixed each by its own text; those that repeat both are mixed
    together: as many copies as the mix takes of all of them come with the columns of one. The null source is a source of its own.
    """
    taken = mix(docs, with_hash=True).groupBy("doc_id", "text_hash").agg(F.count("*").alias("n"), F.sum(copies(F.col("taken"), F.col("size"))).alias("times"))
    taken = taken.select(F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_hash"), "n", "times").filter("times > 0")
    mixed = _picked(docs, taken).select("row_", F.explode(F.sequence(F.lit(1).cast("long"), "times")))
    return unpacked(mixed, "row_", docs.columns)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shards' documents, as read back; null texts have the end id alone, rows that repeat an id stand one after the other."""
    return tokens_round_trip(docs, tokenizer_path(), end_id=2)


STAGES = [
    ("language_id", language_stage),
    ("near_duplicates", dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("token_output", token_stage),
]

#: Language identification can't be said in SQL; the stages are tested against plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, name)
    return docs
