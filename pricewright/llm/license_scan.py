"""License scans: fixed phrases, and an exact set-similarity join of text blocks with license notices.

The join: a document's words (n in number) are cut into blocks of 2*S words, one every S words, for sizes S that grow with the
notices (12 words, then 64, 256 and so on by fours), so any run of up to S words lies whole in a block. A notice is found in a block when the
block holds at least `threshold` of the notice's different words. Words are put in one global order, from the rarest
(by the number of documents that have them, counted over all documents) to the most frequent. Then:

- prefix filter: a block that holds enough of a notice's n words holds one of its first n - need + 1;
- length filter: the block has at least `need` different words;
- positional filter: from the first common word on, both sides must have enough words left.

Pairs that remain are confirmed on the full sets, so the join is exact. Licenses of one family differ by a word or a clause, so their notices
are often found together: of those of one family and size in a block and the two that overlap it, only the one with the largest share counts, and of equal
shares that of more words ("cc by nc" holds all of "cc by", but not the other way round). Only words of notices matter, so the broadcast
side (one row for each notice and prefix word) is bounded by NOTICES, not by the data. No Python runs on executors,
and nothing larger than a count for each of the notices' words comes to the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lower_ascii

#: ASCII characters that divide words, once A-Z are in lower case.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Phrases whose words must stand one after the other, and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: The two clauses that BSD licenses share, with what stands before and after them.
_BSD_HEAD = "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"
_BSD_NAMES = "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"
_BSD_TAIL = "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"
_GPL = "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version {v} of the license or at your option any later version"
_MIT = "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies"
_MIT_REST = "of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"

#: Fixed values: (family, label, notice). The public notices that licenses ask to be put in files, short forms of them, and whole short licenses.
NOTICES = [
    ("gpl", "gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "gpl-2", "this work is licensed under the gnu general public license version 2"),
    ("gpl", "gpl-3", _GPL.format(v=3)),
    ("gpl", "gpl-2", _GPL.format(v=2)),
    ("apache", "apache", "licensed under the apache license version 2 0"),
    ("apache", "apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("mit", "mit", "released under the mit license"),
    ("mit", "mit", _MIT),
    ("mit", "mit", f"{_MIT} {_MIT_REST}"),
    ("cc", "cc-by", "licensed under cc by 4 0"),
    ("cc", "cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc", "cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc", "cc-by-nc-sa", "licensed under cc by nc sa 4 0"),
    ("cc", "cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc", "cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc", "cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("bsd", "bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "bsd-2", f"{_BSD_HEAD} {_BSD_TAIL}"),
    ("bsd", "bsd-3", f"{_BSD_HEAD} {_BSD_NAMES} {_BSD_TAIL}"),
    ("mpl", "mpl", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("isc", "isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("unlicense", "unlicense", "this is free and unencumbered software released into the public domain"),
]

#: The smallest S, and the next one; then each is four times the one before.
SIZES = (12, 64)
THRESHOLD = 0.85


def size_of(n_words: int) -> int:
    """The S of a notice of so many words."""
    size = SIZES[0] if n_words <= SIZES[0] else SIZES[1]
    while size < n_words:
        size *= 4
    return size


def notice_table(notices: list[tuple[str, str, str]] = NOTICES) -> list[tuple[int, str, str, int, list[str], int]]:
    """(number, family, label, S, different words, words that a block must hold) of each notice."""
    out = []
    for k, (family, label, text) in enumerate(notices):
        words = text.split(" ")
        own = sorted(set(words))
        out.append((k, family, label, size_of(len(words)), own, math.ceil(THRESHOLD * len(own) - 1e-9)))
    return out


def spaced(text: Column) -> Column:
    """All words with a space before and after each; a single space if there is none."""
    t = F.trim(F.regexp_replace(lower_ascii(F.coalesce(text, F.lit(""))), NOT_WORD, " "))
    return F.when(t == "", F.lit(" ")).otherwise(F.concat(F.lit(" "), t, F.lit(" ")))


def _spaces(s: Column) -> Column:
    return F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))


def _list(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def scan_licenses(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", notices: list[tuple[str, str, str]] = NOTICES) -> DataFrame:
    """A row for each row of docs: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    notices: (family, label, words in lower case, one space apart), of any length, whole license texts too. score is the greatest share
    of a notice's words found in a block (1 where a phrase stands), else 0. A null or
    empty text has no words, counts 0, null first_word and last_word, '' labels and score 0. Rows that repeat an id
    are scanned each by its own text. Other columns are ignored, whatever their names.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).select("doc_id", F.xxhash64("text").alias("text_hash"), spaced(F.col("text")).alias("s"))
    table_ = notice_table(notices)
    vocabulary = sorted({w for n in table_ for w in n[4]})

    # In how many documents each of the notices' words is: a row for each at most.
    seen = {r.w: r.n for r in base.select(F.explode(F.array_intersect(F.split("s", " "), _list(vocabulary))).alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()}
    order = {w: k for k, w in enumerate(sorted(vocabulary, key=lambda w: (seen.get(w, 0), w)))}
    ranked = [(k, family, label, size, sorted(own, key=order.get), need) for k, family, label, size, own, need in table_]
    spark = docs.sparkSession
    rows_of = [(k, family, label, size, own[i], i, len(own), need, own) for k, family, label, size, own, need in ranked for i in range(len(own) - need + 1)]
    table = spark.createDataFrame(rows_of, "notice int, family string, label string, size int, word string, at int, n int, need int, own array<string>")
    sizes = sorted({r[3] for r in ranked})
    # Only the words of a size's own notices are looked for in its blocks.
    by_order = F.coalesce(*[F.when(F.col("size") == z, _list(sorted({w for r in ranked if r[3] == z for w in r[4]}, key=order.get))) for z in sizes])

    pieces = {p: F.split("s", f" {p}(?= )") for p in PHRASES}
    places = {p: F.when(F.col("s").contains(f" {p} "), F.size(pieces[p]) - 1).otherwise(0) for p in PHRASES}
    first = [F.when(F.col("s").contains(f" {p} "), _spaces(F.element_at(pieces[p], 1))) for p in PHRASES]
    last = [F.when(F.col("s").contains(f" {p} "), F.col("n_words") - (_spaces(F.element_at(pieces[p], -1)) - 1) - len(p.split())) for p in PHRASES]
    rows = base.withColumn("n_words", F.greatest(_spaces(F.col("s")) - 1, F.lit(0)))
    rows = rows.select(
        "doc_id", "text_hash", F.col("n_words").cast("long").alias("n_words"), sum(places.values()).cast("long").alias("n_base"),
        F.least(*first).cast("long").alias("first_word"), F.greatest(*last).cast("long").alias("last_word"),
        F.array_compact(F.array(*[F.when(F.col("s").contains(f" {p} "), F.lit(x)) for p, x in PHRASES.items()])).alias("base"),
    )

    # Documents with a prefix word, by blocks.
    some = base.select("doc_id", "text_hash", F.split(F.substring("s", 2, 2147483647), " ").alias("words"))
    some = some.filter(F.arrays_overlap("words", _list(sorted({r[4] for r in rows_of}))))
    some = some.withColumn("n", F.size("words") - 1)  # after the last space there is an empty word
    blocks = some.select("doc_id", "text_hash", "words", "n", F.explode(F.array(*[F.lit(z) for z in sizes])).alias("size"))
    blocks = blocks.select("doc_id", "text_hash", "words", "size", F.explode(F.sequence(F.lit(0), F.greatest(F.col("n") - 1, F.lit(0)), F.col("size"))).alias("start"))
    blocks = blocks.select("doc_id", "text_hash", "size", "start", F.array_intersect(by_order, F.slice("words", F.col("start") + 1, 2 * F.col("size"))).alias("held"))
    pairs = blocks.filter(F.size("held") > 0).select("*", F.posexplode("held").alias("place", "word"))
    pairs = pairs.join(F.broadcast(table), ["size", "word"]).filter((F.size("held") >= F.col("need")) & (F.least(F.size("held") - F.col("place"), F.col("n") - F.col("at")) >= F.col("need") - F.col("at")))
    found = pairs.withColumn("common", F.size(F.array_intersect("own", "held"))).filter(F.col("common") >= F.col("need"))
    # Of a family's notices in overlapping blocks, the one with the largest share, then with more words.
    around = Window.partitionBy("doc_id", "text_hash", "family", "size").orderBy(F.expr("start div size")).rangeBetween(-1, 1)
    found = found.withColumn("weight", F.col("common") / F.col("n") * 1e6 + F.col("n"))
    found = found.withColumn("best", F.max("weight").over(around)).filter(F.col("weight") == F.col("best"))
    found = found.groupBy("doc_id", "text_hash").agg(F.collect_set("label").alias("more"), F.max(F.col("common") / F.col("n")).alias("share"))
    found = found.select(F.col("doc_id").alias("id_"), F.col("text_hash").alias("hash_"), "more", "share")

    out = rows.join(found, F.col("doc_id").eqNullSafe(F.col("id_")) & (F.col("text_hash") == F.col("hash_")), "left")
    joined = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    return out.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", joined(F.col("base")).alias("base_labels"),
        joined(F.concat("base", F.coalesce("more", F.array().cast("array<string>")))).alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )
