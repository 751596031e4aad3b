"""Scalar functions on text and numbers, as Column expressions."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed


def fold(c: Column) -> Column:
    """Lower case, with sharp s as ss."""
    return F.replace(F.lower(c), F.lit("ß"), F.lit("ss"))


def squeeze(c: Column) -> Column:
    """White space of any kind to single spaces, none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def text_norm(c: Column) -> Column:
    return squeeze(fold(c))


def nonblank(c: Column) -> Column:
    """The text, or null where there is nothing but white space."""
    return F.when(F.trim(c) != "", c)


def first_of(*cs: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[F.when(c != "", c) for c in cs])


def group(c: Column, pattern: str, index: int = 1) -> Column:
    """A group of the pattern's first match, null without a match or with an empty group."""
    g = F.regexp_extract(c, pattern, index)
    return F.when(g != "", g)


def whole_match(c: Column, pattern: str) -> Column:
    return group(c, pattern, 0)


def has_any(c: Column, words: list[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | c.contains(w)
    return F.coalesce(out, F.lit(False))


def any_word(words: list[str]) -> str:
    return r"\b(?:" + "|".join(re.escape(w) for w in words) + r")\b"


def capacity_gb(c: Column) -> Column:
    """'1 TB' is 1024: a positive amount in GB or TB that is a whole number of GB; else null."""
    p = r"(?i)^\s*(\d+(?:\.\d+)?)\s*(tb|gb)\s*$"
    amount = group(c, p).try_cast("decimal(18,6)") * F.when(F.lower(group(c, p, 2)) == "tb", 1024).otherwise(1)
    return F.when((amount > 0) & (amount == F.floor(amount)), amount.cast("long"))


def first_capacity(c: Column) -> Column:
    """The first capacity in the text, else the text."""
    return F.coalesce(whole_match(c, r"(?i)\d+(?:\.\d+)?\s*(?:tb|gb)"), c)


def price_paise(c: Column) -> Column:
    """Rupees in a text as paise, cut off, not rounded. Percentages, offers and small numbers count only with a rupee sign."""
    rupee = c.contains("₹")
    amount = nonblank(F.regexp_replace(c, r"[^0-9.]", "")).try_cast("double")
    badge = (c.contains("%") | F.lower(c).contains("off")) & ~rupee
    return F.when(~badge & (rupee | (amount >= 50)), (amount * 100).cast("long"))


def title_brand(title: Column, said: Column | None = None) -> Column:
    """The brand said, else the first known one within the title, else its first word, else Generic."""
    found = F.lit(None).cast("string")
    for b in reversed(fixed.TITLE_BRANDS):
        found = F.when(fold(title).contains(b), F.initcap(F.lit(b))).otherwise(found)
    word = nonblank(F.element_at(F.split(F.trim(title), r"\s+"), 1))
    own = [F.initcap(F.trim(nonblank(said)))] if said is not None else []
    return F.coalesce(*own, found, word, F.lit("Generic"))


def let(c: Column, then: Callable[[Column], Column]) -> Column:
    """then(c), with c evaluated once."""
    return F.transform(F.array(c), then)[0]


_IGNORED = "|".join(re.escape(p) for p in fixed.IGNORED_PARTS)


def is_ignored_key(key: Column) -> Column:
    """Whether a specification's key is a contact, a legal note, a price or a number."""
    bad = lambda k: (F.length(k) < 2) | (F.length(k) > 60) | k.isin(fixed.IGNORED_KEYS) | k.rlike(rf"₹|\$|^[\d,./_+-]+$|{_IGNORED}")
    return F.coalesce(let(text_norm(key), bad), F.lit(True))


def collapse_repeats(c: Column) -> Column:
    """A word that stands twice in a row, once."""
    return F.trim(F.regexp_replace(c, r"(?i)\b(\w+)\s+\1\b", "$1"))


def cm_to_inch(cm: Column, digits: int) -> Column:
    return F.round(cm / 2.54, digits)


def weight_kg(c: Column) -> Column:
    """'1 kg 880 g' or '1.88 kg' as kg, from 0.5 to 10; of grams, five round up."""
    t = F.lower(c)
    both = r"(\d+)\s*kg\s*(\d+)\s*g"
    split = F.floor((group(t, both).try_cast("long") * 1000 + group(t, both, 2).try_cast("long") + 5) / 10) / 100
    plain = group(t, r"(\d+(?:\.\d+)?)\s*kg").try_cast("double")
    return F.coalesce(within(split, 0.5, 10.0), within(plain, 0.5, 10.0))


def within(c: Column, low: float, high: float) -> Column:
    return F.when(c.between(low, high), c)


def count_of(c: Column, mark: str) -> Column:
    return (F.length(c) - F.length(F.replace(c, F.lit(mark), F.lit("")))) / len(mark)


def rupees(paise: Column) -> Column:
    return F.concat(F.lit("₹"), F.format_number(paise / 100, 2))


def canonical_url(c: Column) -> Column:
    """https, host in lower case without www., no fragment, no tracking parameters, no blank values, no slash at the end."""
    u = F.trim(c)
    rest = F.regexp_replace(F.regexp_replace(u, r"#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*:", "")
    # "//host" up to the path or the query; without it there is no host.
    has_host = rest.startswith("//")
    host = F.when(has_host, F.regexp_replace(F.lower(F.regexp_extract(rest, r"^//([^/?]*)", 1)), r"^www\.", "")).otherwise(F.lit(""))
    tail = F.when(has_host, F.regexp_replace(rest, r"^//[^/?]*", "")).otherwise(rest)
    path = F.regexp_replace(F.regexp_extract(tail, r"^([^?]*)", 1), r";[^/]*$", "")
    path = F.when((F.length(path) > 1) & path.endswith("/"), F.substring(path, 1, F.length(path) - 1)).otherwise(path)
    pairs = F.split(F.regexp_replace(tail, r"^[^?]*\??", ""), "&")
    name = lambda p: F.lower(F.try_url_decode(F.substring_index(p, "=", 1)))
    value = lambda p: F.when(F.instr(p, "=") > 0, F.regexp_replace(p, r"^[^=]*=", ""))
    kept = F.filter(pairs, lambda p: (F.coalesce(value(p), F.lit("")) != "") & ~name(p).isin(fixed.TRACKING_PARAMETERS) & ~F.coalesce(name(p).startswith("utm_"), F.lit(False)))
    again = F.transform(kept, lambda p: F.concat(F.url_encode(F.try_url_decode(F.substring_index(p, "=", 1))), F.lit("="), F.url_encode(F.try_url_decode(value(p)))))
    query = F.array_join(again, "&")
    out = F.concat(F.lit("https:"), F.when(host != "", F.concat(F.lit("//"), host)).otherwise(F.lit("")), path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))
    return F.when(u == "", F.lit("")).otherwise(F.coalesce(out, u))
