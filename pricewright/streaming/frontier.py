"""The crawl frontier as keyed state with timers: what happens to a URL comes as a stream, and each URL that may be crawled again is released by a timer.

Events (FRONTIER_EVENTS) are of four kinds: enqueue, start (it is being crawled), complete and fail. A URL's state is a few numbers and the fields that it
was first found with. Completing schedules it again after a number of hours, failing after a delay that doubles with each failure; a timer at that
time releases it, unless another event comes first. The changes that come out are numbered by URL, so that a table of the latest one is the
frontier, and a batch that is written twice changes nothing.

The rules of one event are those of ops.enqueue, ops.completed and ops.failed; replay() gives the state of a whole log as a batch job.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from ..functions.ship import ship
from ..operators.ops import backoff_minutes

FRONTIER_EVENTS = "canonical_url string, kind string, at timestamp, seq long, url string, source string, category string, priority int"
CHANGE = "canonical_url string, version long, change string, at timestamp, url string, source string, category string, priority int, status string, error_count int, recrawl_after timestamp, releases long"
_STATE = "version long, url string, source string, category string, priority int, status string, error_count int, due long, waits boolean, releases long"
#: The state store that timers and typed state need.
STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
KINDS = ("enqueue", "start", "complete", "fail")


def delay(errors: int, base: int) -> int:
    """Minutes until a URL that failed so often in a row is tried again."""
    return base * 2 ** min(errors - 1, 4)


def after(state: dict[str, Any] | None, kind: str, at: int, fields: tuple[Any, ...], hours: int, base: int) -> dict[str, Any] | None:
    """A URL's state after an event, at in milliseconds; None while it isn't known: only enqueue makes it so."""
    if state is None:
        if kind != "enqueue":
            return None
        url, source, category, priority = fields
        return {"version": 0, "url": url, "source": source, "category": category, "priority": priority, "status": "pending", "error_count": 0, "due": None, "waits": False, "releases": 0}
    if kind == "enqueue":
        return state | {"priority": min(state["priority"], fields[3])}
    if kind == "start":
        return state | {"status": "in_progress"}
    errors = 0 if kind == "complete" else state["error_count"] + 1
    minutes = hours * 60 if kind == "complete" else delay(errors, base)
    return state | {"status": "completed" if kind == "complete" else "failed", "error_count": errors, "due": at + minutes * 60_000, "waits": True}


#: Events and changes pass between Spark and Python as one text each, times in milliseconds.
_EVENT = ("seq", "kind", "url", "source", "category", "priority")
_TEXT = CHANGE.replace("timestamp", "long")
_FIELDS = [f.split()[0] for f in _STATE.split(", ")]
_WAITS, _DUE = _FIELDS.index("waits"), _FIELDS.index("due")
#: URLs share their state's reads, writes and timers with those of their bucket: each of these is a call back to Spark, which costs more than many URLs.
#: A micro-batch writes the buckets that it has events for. A checkpoint goes on only with the number it was begun with.
BUCKETS = 4096


def _events(texts: list[str]) -> list[dict[str, Any]]:
    """In order of time and number, those without a number first."""
    return sorted((json.loads(t) for t in sorted(texts)), key=lambda e: (e["at"], e["seq"] is not None, e["seq"] or 0, e["kind"]))


def _change(url: str, state: dict[str, Any], change: str, at: int) -> str:
    given = {k: v for k, v in state.items() if k not in ("due", "waits")}
    return json.dumps(given | {"canonical_url": url, "change": change, "at": at, "recrawl_after": state["due"]})


def _next(urls: dict[str, list[Any]]) -> int | None:
    """When the first of the URLs that wait is due."""
    return min((v[_DUE] for v in urls.values() if v[_WAITS]), default=None)


class FrontierProcessor(StatefulProcessor):
    """State of a bucket's URLs, and one timer, at the time when the first of them is due."""

    def __init__(self, hours: int = 24, base: int = 30, live: bool = False):
        self.hours, self.base, self.live = hours, base, live

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("bucket", "urls string")

    def _read(self) -> dict[str, list[Any]]:
        found = self.state.get()
        return json.loads(found[0]) if found else {}

    def _write(self, urls: dict[str, list[Any]], timer: int | None) -> None:
        """timer: the one that stands."""
        self.state.update((json.dumps(urls),))
        due = _next(urls)
        if timer is not None and timer != due:
            self.handle.deleteTimer(timer)
        if due is not None and timer != due:
            self.handle.registerTimer(due)

    def handleInputRows(self, key: tuple[Any, ...], rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        """Each URL's events in order of time and number; a due time that passes between two of them counts as a release."""
        of: dict[str, list[str]] = {}
        for part in rows:
            for u, text in zip(part["canonical_url"], part["event"], strict=True):
                of.setdefault(u, []).append(text)
        urls, out = self._read(), []
        timer = _next(urls)
        for u, texts in of.items():
            state = before = dict(zip(_FIELDS, urls[u], strict=True)) if u in urls else None
            for e in (events := _events(texts)):
                if state is not None and state["waits"] and state["due"] <= e["at"]:
                    state = state | {"waits": False, "releases": state["releases"] + 1}
                state = after(state, e["kind"], e["at"], (e["url"], e["source"], e["category"], e["priority"]), self.hours, self.base)
            if state is not None:
                state = state | {"version": state["version"] + 1}
                urls[u] = [state[k] for k in _FIELDS]
                out.append(_change(u, state, "added" if before is None else "changed", events[-1]["at"]))
        if out:
            self._write(urls, timer)
            yield pd.DataFrame({"change": out})

    def handleExpiredTimer(self, key: tuple[Any, ...], timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        """All URLs that are due by now; Spark deletes the timer that has expired."""
        now = timerValues.getCurrentProcessingTimeInMs() if self.live else timerValues.getCurrentWatermarkInMs()
        urls, out = self._read(), []
        for u, v in urls.items():
            if v[_WAITS] and v[_DUE] <= now:
                state = dict(zip(_FIELDS, v, strict=True))
                state = state | {"waits": False, "releases": state["releases"] + 1, "version": state["version"] + 1}
                urls[u] = [state[k] for k in _FIELDS]
                out.append(_change(u, state, "released", state["due"]))
        if out:
            self._write(urls, None)
            yield pd.DataFrame({"change": out})

    def close(self) -> None:
        pass


def frontier_changes(events: DataFrame, *, hours: int = 24, base: int = 30, late: str = "0 seconds", live: bool = False, buckets: int = BUCKETS) -> DataFrame:
    """A stream of FRONTIER_EVENTS to CHANGE rows. live: timers go by the clock, else by the events' own time, so that a log can be replayed.

    Events that are later than `late` behind the newest ones are dropped unless live. A URL's events of one micro-batch are put in order by
    time and seq. Events without a URL, a known kind or a time are dropped; a null priority counts as 9. buckets: see BUCKETS; more of them for
    more than some hundred million URLs.
    """
    ship(events.sparkSession)
    known = events.filter(F.col("canonical_url").isNotNull() & F.col("kind").isin(*KINDS) & F.col("at").isNotNull()).withColumn("priority", F.coalesce("priority", F.lit(9)))
    known = known if live else known.withWatermark("at", late)
    event = F.to_json(F.struct(F.unix_millis("at").alias("at"), *_EVENT), {"ignoreNullFields": "false"})
    dealt = known.select(F.pmod(F.xxhash64("canonical_url"), F.lit(buckets)).alias("bucket"), "canonical_url", "at", event.alias("event"))
    texts = dealt.groupBy("bucket").transformWithStateInPandas(FrontierProcessor(hours, base, live), "change string", "update", "ProcessingTime" if live else "EventTime")
    c = texts.select(F.from_json("change", _TEXT).alias("c"))
    times = ("at", "recrawl_after")
    return c.select(*[(F.timestamp_millis(f"c.{k}") if k in times else F.col(f"c.{k}")).alias(k) for k in (f.split()[0] for f in CHANGE.split(", "))])


def write_changes(changes: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Run what is there; each micro-batch's changes go to a folder of its number, which a repeated batch writes again."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return changes.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def frontier_table(changes: DataFrame) -> DataFrame:
    """The frontier: the latest change of each URL."""
    rest = [f.split()[0] for f in CHANGE.split(", ")][1:]
    return changes.groupBy("canonical_url").agg(F.max_by(F.struct(*rest), "version").alias("c")).select("canonical_url", *[f"c.{k}" for k in rest])


def replay(events: DataFrame, *, hours: int = 24, base: int = 30) -> DataFrame:
    """The frontier after a whole log, as a batch job: canonical_url, url, source, category, priority, status, error_count, recrawl_after."""
    e = events.filter(F.col("canonical_url").isNotNull() & F.col("kind").isin(*KINDS) & F.col("at").isNotNull()).withColumn("priority", F.coalesce("priority", F.lit(9)))
    when: Column = F.struct("at", "seq")
    known = e.groupBy("canonical_url").agg(F.min(F.when(F.col("kind") == "enqueue", F.struct("at", "seq", "url", "source", "category"))).alias("first"), F.min(F.when(F.col("kind") == "enqueue", F.col("priority"))).alias("best"))
    e = e.join(known.filter("first is not null"), "canonical_url").filter(when >= F.struct("first.at", "first.seq"))
    mark = lambda *kinds: F.max(F.when(F.col("kind").isin(*kinds), when))
    e = e.withColumn("done", mark("complete").over(Window.partitionBy("canonical_url")))
    fails = F.count_if((F.col("kind") == "fail") & (F.col("done").isNull() | (when > F.col("done"))))
    s = e.groupBy("canonical_url").agg(F.first("first").alias("first"), F.first("best").alias("priority"), mark("start", "complete", "fail").alias("last"), F.max_by("kind", F.when(F.col("kind") != "enqueue", when)).alias("kind"), mark("complete", "fail").alias("ended"), fails.cast("int").alias("error_count"))
    status = F.when(F.col("last").isNull(), "pending").when(F.col("kind") == "start", "in_progress").when(F.col("kind") == "complete", "completed").otherwise("failed")
    minutes = F.when(F.col("error_count") == 0, F.lit(hours * 60)).otherwise(backoff_minutes(F.col("error_count"), base))
    due = F.col("ended.at") + F.make_dt_interval(mins=minutes)
    return s.select("canonical_url", "first.url", "first.source", "first.category", "priority", status.alias("status"), "error_count", due.alias("recrawl_after"))
