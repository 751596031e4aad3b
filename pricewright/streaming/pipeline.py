"""Incremental operation: lifecycle and frontier as keyed state, listings to tables batch by batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.ship import ship

LIFECYCLE_OUT = "listing string, lifecycle_status string, missed_crawls int, crawls long"
LIFECYCLE_STATE = "missed int, status string, crawls long"


def step(missed: int, ok: bool, in_stock: bool) -> tuple[int, str]:
    """A listing's missed crawls and state after one crawl."""
    if ok:
        return 0, "ACTIVE" if in_stock else "UNAVAILABLE"
    missed += 1
    return missed, "DISCONTINUED" if missed >= 10 else "UNAVAILABLE" if missed >= 3 else "STALE"


def _lifecycle(key: tuple[Any, ...], batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    missed, status, crawls = state.get if state.exists else (0, "ACTIVE", 0)
    rows = pd.concat(list(batches)).sort_values(["observed_at", "crawl_id"])
    for ok, stock in zip(rows["ok"], rows["in_stock"], strict=True):
        missed, status = step(missed, bool(ok), bool(stock))
        crawls += 1
    state.update((missed, status, crawls))
    yield pd.DataFrame({"listing": [key[0]], "lifecycle_status": [status], "missed_crawls": [missed], "crawls": [crawls]})


def lifecycle_stream(crawls: DataFrame) -> DataFrame:
    """A stream of crawls (listing, crawl_id, observed_at, ok, in_stock) to the listings' states; only a few numbers a listing are kept."""
    ship(crawls.sparkSession)
    return crawls.groupBy("listing").applyInPandasWithState(_lifecycle, LIFECYCLE_OUT, LIFECYCLE_STATE, "update", GroupStateTimeout.NoTimeout)


def first_seen(urls: DataFrame, watermark: str = "7 days") -> DataFrame:
    """A stream of URLs (canonical_url, discovered_at) without those seen within the watermark."""
    return urls.withWatermark("discovered_at", watermark).dropDuplicatesWithinWatermark(["canonical_url"])


def to_tables(listings: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Run apply(batch, number) for each batch of listings; apply must give the same tables if a batch comes again."""
    return listings.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
