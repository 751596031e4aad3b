from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .quality_model import score_quality


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES = {"op4_quality_classifier": op4_quality_classifier}
SQL: dict[str, str] = {}
