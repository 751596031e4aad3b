"""Canonical JSON in Catalyst: one text for equal contents, whatever the order of a map's keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters with an escape of their own, the backslash first.
_SHORT = {"\\": "\\\\", '"': '\\"', "\n": "\\n", "\r": "\\r", "\t": "\\t", "\b": "\\b", "\f": "\\f"}
_OTHER = r"[^\x20-\x7E]"


def json_string(s: Column) -> Column:
    """s as a JSON string of printable ASCII: other characters by their UTF-16 units in lower-case hex. null for null."""
    e = s
    for c, escaped in _SHORT.items():
        e = F.replace(e, F.lit(c), F.lit(escaped))
    units = lambda c: F.regexp_replace(F.lower(F.hex(F.encode(c, "UTF-16BE"))), "(.{4})", r"\\u$1")
    each = F.array_join(F.transform(F.split(e, ""), lambda c: F.when(c.rlike(_OTHER), units(c)).otherwise(c)), "")
    return F.coalesce(F.concat(F.lit('"'), F.when(e.rlike(_OTHER), each).otherwise(e), F.lit('"')), F.lit("null"))


def json_object(fields: dict[str, Column]) -> Column:
    """An object of values that are JSON already, its keys in order."""
    parts: list[Column] = []
    for k in sorted(fields):
        parts += [F.lit(("{" if not parts else ", ") + f'"{k}": '), fields[k]]
    return F.concat(*parts, F.lit("}")) if parts else F.lit("{}")


def json_map(m: Column) -> Column:
    """A map of texts as an object, its keys in the order of their code points; an empty one for null."""
    entry = lambda k: F.concat(json_string(k), F.lit(": "), json_string(F.try_element_at(m, k)))
    return F.concat(F.lit("{"), F.coalesce(F.array_join(F.transform(F.array_sort(F.map_keys(m)), entry), ", "), F.lit("")), F.lit("}"))
