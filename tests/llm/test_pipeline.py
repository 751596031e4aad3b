"""The pipeline's stages, each against a plain version on its own input."""

import random

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_pipeline(spark, tmp_path):
    rng = random.Random(2)
    en, de = ["the", "house", "window", "water", "green", "street", "little", "garden"], ["der", "haus", "fenster", "wasser", "strasse", "garten", "kleine", "und"]
    rows = []
    for i in range(60):
        lang, w = ("en", en) if i % 2 else ("de", de)
        rows.append((i, " ".join(rng.choice(w) + str(rng.randrange(3) or "") for _ in range(50)), lang, f"s{i % 3}", 1))
    rows += [(100, rows[4][1], "de", "s1", 1), (101, "12345 !!", "en", "s1", 1), (102, None, "en", "s1", 0), (103, "before one two three four five six seven eight nine ten after", "en", "s2", 1)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    from pricewright.llm.common import materialize

    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, str(tmp_path)), name)
        seen[name] = [r.doc_id for r in docs.select("doc_id").collect()]
        assert name == "token_output" or docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(seen["language_id"]) == sorted(r[0] for r in rows if r[0] not in (101, 102))
    assert set(seen["language_id"]) - set(seen["near_duplicates"]) == {100}
    assert set(seen["near_duplicates"]) - set(seen["decontamination"]) == {103}
    assert set(seen["mixing"]) <= set(seen["decontamination"]) and max(map(seen["mixing"].count, seen["mixing"])) <= 3
    assert sorted(seen["token_output"]) == sorted(seen["mixing"])


CLASH = ["letters", "lang_pred", "score", "kept_id", "times", "copy", "row", "row_", "id_", "hash_", "of_id", "of_hash", "text_hash", "group", "first", "several", "key", "n", "size", "taken", "range", "source_size", "nid", "comp", "spans", "items", "n_words", "mixed_id"]


@pytest.fixture(scope="module")
def odd_rows():
    rng = random.Random(5)
    en = ["the", "house", "window", "water", "green", "street", "little", "garden", "where", "night"]
    say = lambda n, mark: " ".join(rng.choice(en) + mark for _ in range(n))
    same, near = say(60, "a"), say(60, "b").split()
    rows = [(i, say(50, "c" + "abcdefghij"[i % 10]), "en", f"s{i % 2}") for i in range(30)]
    rows += [(40, same, "en", "s0")] * 3 + [(41, same, "en", "s1"), (None, same, "en", "s0")]  # one group: 40 once
    rows += [(None, say(50, "d"), "en", None), (None, say(50, "e"), "en", "s1")]  # two null ids of their own
    rows += [(None, " ".join(near), "en", "s1"), (None, " ".join([*near[:-1], "other"]), "en", "s1")]  # near copies without an id: one stays
    rows += [(50, say(50, "f"), "en", "s0"), (50, say(50, "g"), "en", "s0")]  # an id with two texts of their own
    rows += [(60, None, "en", "s0"), (61, "", "en", "s0"), (62, "12 34", None, "s0"), (70, say(900_000, "h"), "en", "s1")]
    return [(i, t, lang, source, len(t or "")) for i, t, lang, source in rows]


def _odd(spark, rows):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(rows, DOCS)
    return docs.select("*", *[F.concat(F.lit(c), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).alias(c) for c in CLASH])


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage_on_odd_rows(spark, tmp_path, odd_rows, name):
    """Clashing extra columns pass through; null and repeated ids, null, empty and very long texts, and empty tables have their defined results."""
    from collections import Counter

    stage = dict(corpus_pipeline.STAGES)[name]
    spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = _odd(spark, odd_rows)
    empty = stage(spark, docs.limit(0), str(tmp_path))
    assert empty.count() == 0
    out = stage(spark, docs, str(tmp_path))
    if name == "token_output":
        assert Counter(r.doc_id for r in out.collect()) == Counter(r[0] for r in odd_rows)
        return
    assert out.columns == docs.columns
    rows = out.collect()
    for r in rows:
        assert all(r[c] == f"{c}{'null' if r.doc_id is None else r.doc_id}" for c in CLASH)
    got, all_ = Counter((r.doc_id, r.text) for r in rows), Counter((r[0], r[1]) for r in odd_rows)
    if name == "language_id":
        assert got == Counter({k: n for k, n in all_.items() if k[0] not in (60, 61, 62)})
    if name == "near_duplicates":
        assert max(got.values()) == 1 and (41, odd_rows[30][1]) not in got
        ids = Counter(i for i, _ in got)
        assert ids[40] == 1 and ids[50] == 2 and ids[None] == 3 and {60, 61, 62, 70} <= set(ids)
    if name == "decontamination":
        assert got == all_
    if name == "mixing":
        assert not {60, 61} & {i for i, _ in got} and all(n <= 3 * all_[k] for k, n in got.items())
