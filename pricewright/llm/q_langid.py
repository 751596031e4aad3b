from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .langid import language_report
from .q_tokens import tokenizer_path


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_report(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer_path("piece_bpe_32k.model"))


QUERIES = {"op8_language_id": op8_language_id}
SQL: dict[str, str] = {}
