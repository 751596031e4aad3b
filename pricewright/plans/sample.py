"""Rows made of part's keys, by expressions that Spark and the oracle's engine both read: each field steps through a list of its own."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def _literal(v: str | int | float | None) -> str:
    if v is None:
        return "NULL"
    return f"'{v}'" if isinstance(v, str) else repr(v)


@dataclass(frozen=True)
class Field:
    """The value at place (key + shift) / step, modulo the list's length."""

    values: tuple[str | int | float | None, ...]
    step: int = 1
    shift: int = 0

    def place(self, key: str, div: str) -> str:
        return f"CAST((({key} + {self.shift}) {div} {self.step}) % {len(self.values)} + 1 AS INT)"

    def kind(self) -> type:
        return next(type(v) for v in self.values if v is not None)

    def spark(self, key: str) -> Column:
        kind = {str: "string", int: "int", float: "double"}[self.kind()]
        return F.expr(f"CAST(element_at(array({', '.join(map(_literal, self.values))}), {self.place(key, 'div')}) AS {kind})")

    def sql(self, key: str) -> str:
        kind = {str: "VARCHAR", int: "INT", float: "DOUBLE"}[self.kind()]
        return f"list_extract([{', '.join(map(_literal, self.values))}], {self.place(key, '//')})::{kind}"


def field(*values: str | int | float | None, step: int = 1, shift: int = 0) -> Field:
    return Field(values, step, shift)


def columns(fields: dict[str, Field], key: str = "p_partkey") -> dict[str, Column]:
    return {k: f.spark(key) for k, f in fields.items()}


def selects(fields: dict[str, Field], key: str = "p_partkey") -> str:
    return ", ".join(f'{f.sql(key)} AS "{k}"' for k, f in fields.items())


def group(text: str, pattern: str, index: int = 1) -> str:
    """SQL of a group of the first match, null without one."""
    return f"nullif(regexp_extract({text}, '{pattern}', {index}), '')"


def fold(text: str) -> str:
    return f"replace(lower({text}), 'ß', 'ss')"


def norm(text: str) -> str:
    return f"trim(regexp_replace({fold(text)}, '\\s+', ' ', 'g'))"


def cases(rows: list[tuple[str, str]], default: str = "NULL") -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in rows) + f" ELSE {default} END"


def first_label(text: str, rules: list[tuple[str, str]]) -> str:
    return cases([(f"regexp_matches({text}, '{p}')", f"'{x}'") for p, x in rules])


def first_words(text: str, rules: list[tuple[list[str], str]]) -> str:
    return cases([(" OR ".join(f"contains({text}, '{w}')" for w in words), f"'{x}'") for words, x in rules])
