"""Rule tables, compiled to Column expressions: ordered patterns, ordered keys, bounds."""

from __future__ import annotations

from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

Parse = Callable[[Column], Column]

T = TypeVar("T")
_BUILT: dict[tuple[str, ...], object] = {}


def built(make: Callable[[], T], *name: str) -> T:
    """What make() gives, made once for each application and name: trees of Columns that refer to columns by name only fit any frame, and
    making them costs far more calls to the JVM than using them."""
    key = (SparkSession.active().sparkContext.applicationId, *name)
    if key not in _BUILT:
        _BUILT[key] = make()
    return _BUILT[key]  # type: ignore[return-value]


def ordered(cases: list[tuple[Column, Column]], default: Column | None = None) -> Column:
    """The value of the first case that holds."""
    out = None
    for condition, value in cases:
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return out if default is None else out.otherwise(default)


def first_pattern(text: Column, rules: list[tuple[str, str]]) -> Column:
    """The label of the first pattern that is found in the text."""
    return ordered([(text.rlike(p), F.lit(label)) for p, label in rules])


def first_words(text: Column, rules: list[tuple[list[str], str]]) -> Column:
    """The label of the first rule with a word that the text contains."""
    from .text import has_any

    return ordered([(has_any(text, words), F.lit(label)) for words, label in rules])


def refold(specs: Column, key: Parse, value: Parse = lambda v: v) -> Column:
    """specs with each key and value put through a function; of keys that become equal, or null, the last value counts."""
    entries = F.transform(F.map_entries(specs), lambda e: F.struct(F.coalesce(key(e["key"]), F.lit("")).alias("key"), value(e["value"]).alias("value")))
    last = lambda a: F.filter(a, lambda e, i: ~F.exists(F.slice(a, i + 2, F.size(a)), lambda later: later["key"] == e["key"]))
    return F.map_from_entries(F.transform(F.array(entries), last)[0])


class Keyed:
    """Stands for a map of which each key that is asked for is a column of its own: then a value is looked up once, however often rules refer to it."""

    def __init__(self, prefix: str):
        self.prefix = prefix
        self.names: dict[str, str] = {}

    def column(self, key: str) -> Column:
        return F.col(self.names.setdefault(key, f"{self.prefix}{len(self.names)}"))

    def values(self, specs: Column) -> dict[str, Column]:
        """The columns, by name, from the map itself."""
        return {name: F.try_element_at(specs, F.lit(key)) for key, name in self.names.items()}


def get(specs: Column | Keyed, key: str) -> Column:
    return specs.column(key) if isinstance(specs, Keyed) else F.try_element_at(specs, F.lit(key))


def first_key(specs: Column, keys: list[str], parse: Parse = lambda c: c) -> Column:
    """The first key's value that can be parsed."""
    return F.coalesce(*[parse(get(specs, k)) for k in keys])


def first_present(specs: Column, keys: list[str], parse: Parse = lambda c: c) -> Column:
    """The parsed value of the first key that there is, whether it can be parsed or not."""
    return ordered([(get(specs, k).isNotNull(), parse(get(specs, k))) for k in keys])


def all_within(values: dict[str, Column], bounds: dict[str, tuple[float, float]]) -> Column:
    """Whether every value that is there lies within its bounds."""
    out = F.lit(True)
    for name, c in values.items():
        if name in bounds:
            out = out & F.coalesce(c.between(*bounds[name]), F.lit(True))
    return out


def map_of(values: dict[str, Column]) -> Column:
    """A map of the values that are there, as text."""
    entries = F.array(*[F.when(c.isNotNull(), F.struct(F.lit(k).alias("key"), c.cast("string").alias("value"))) for k, c in values.items()])
    return F.map_from_entries(F.array_compact(entries))


def overlay(*maps: Column) -> Column:
    """The maps' entries; later maps win."""
    def over(old: Column, new: Column) -> Column:
        keys = F.map_keys(new)
        return F.map_concat(F.map_filter(old, lambda k, _: ~F.array_contains(keys, k)), new)

    out = maps[0]
    for m in maps[1:]:
        out = over(out, m)
    return out
