"""The subpackage's queries and their SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Modules of this subpackage with QUERIES and SQL, by operator.
_MODULES = ["q_warc", "q_license", "q_tokens", "q_quality_model", "q_quality_rules", "q_mixing", "q_near_dup", "q_langid", "q_decontam", "q_chat", "q_simhash", "q_repair", "q_search"]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for m in _MODULES:
        out |= importlib.import_module(f"{__package__}.{m}").QUERIES
    return out


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _MODULES:
        out |= importlib.import_module(f"{__package__}.{m}").SQL
    return out
