"""Dealing rows over tasks before work that costs far more than the rows' bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """df dealt over tasks by its keys: as many as shuffles have, and four a core at least. A small file is one task otherwise, however much its rows cost."""
    spark = df.sparkSession
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    return df.repartition(tasks, *keys)
