"""Sources by name: what hosts and categories each has, and how its pages are read.

The built-in retailers are there from the start. A user's own source is a function of one page (its URL and HTML) to rows; it is registered as a
table function, parse_<name>, that SQL can call as well, and pages are read by it in a lateral join, page by page within Spark's tasks.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed
from ..functions.ship import ship

Read = Callable[[str | None, str | None], Iterator[dict[str, object]]]


@dataclass(frozen=True)
class Source:
    """parse: pages (with source_url and html at least) to rows; None for the built-in retailers, which retail.parse_listings reads together."""

    name: str
    hosts: tuple[str, ...]
    categories: tuple[str, ...]
    parse: Callable[[DataFrame], DataFrame] | None = None


_SOURCES: dict[str, Source] = {n: Source(n, tuple(h), tuple(fixed.RETAILER_CATEGORIES[n])) for n, h in fixed.RETAILER_HOSTS.items()}


def register(source: Source) -> None:
    _SOURCES[source.name.strip().lower()] = source


def source(name: str) -> Source:
    """The source of that name; one that isn't registered fails, with the names that are."""
    try:
        return _SOURCES[name.strip().lower()]
    except KeyError:
        raise ValueError(f"unsupported source: {name!r}; registered: {', '.join(sorted(_SOURCES))}") from None


def listing(spark: SparkSession) -> DataFrame:
    """source, host, category: a row for each combination that is registered."""
    rows = [(n, h, c) for n, s in sorted(_SOURCES.items()) for h in s.hosts for c in s.categories]
    return spark.createDataFrame(rows, "source string, host string, category string")


def page_source(spark: SparkSession, name: str, hosts: tuple[str, ...], categories: tuple[str, ...], read: Read, columns: str) -> Source:
    """Register read(url, html), which yields rows as dicts of columns (a schema), as a source and as the SQL table function parse_<name>(url, html).

    Columns that a row lacks are null. A page that read() fails on gives no rows but one with error_ set: a broken page doesn't end the job.
    """
    if not re.fullmatch(r"[a-z][a-z0-9_]*", name):
        raise ValueError(f"a source's name is of a-z, 0-9 and _: {name!r}")
    ship(spark)
    kind = T.StructType([*spark.createDataFrame([], columns).schema.fields, T.StructField("error_", T.StringType())])
    names = [f.name for f in kind.fields]

    class Pages:
        def eval(self, url: str | None, html: str | None) -> Iterator[tuple[object, ...]]:
            try:
                rows = [tuple(r.get(c) for c in names) for r in read(url, html)]
            except Exception as e:  # noqa: BLE001  whatever a user's parser raises is the page's error
                rows = [(*[None] * (len(names) - 1), f"{type(e).__name__}: {e}")]
            yield from rows

    function = F.udtf(Pages, returnType=kind)
    spark.udtf.register(f"parse_{name}", function)

    def parse(pages: DataFrame) -> DataFrame:
        return pages.alias("p").lateralJoin(function(F.col("p.source_url").outer(), F.col("p.html").outer()).alias("r")).select("p.*", *[f"r.`{c}`" for c in names])

    own = Source(name, hosts, categories, parse)
    register(own)
    return own


def unknown_sources(raw: DataFrame) -> DataFrame:
    """Rows whose source isn't registered (or is null), with the reason."""
    bad = F.coalesce(~F.lower(F.trim("source")).isin(list(_SOURCES)), F.lit(True))
    return raw.filter(bad).withColumn("reason", F.concat(F.lit("unsupported source: "), F.coalesce("source", F.lit("none"))))
