from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .simhash import simhash_duplicates


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op11_simhash": op11_simhash}
SQL: dict[str, str] = {}
