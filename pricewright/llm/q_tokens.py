from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .token_output import tokens_round_trip


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens_round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer_path(), end_id=2)


QUERIES = {"op3_token_output": op3_token_output}
SQL: dict[str, str] = {}
