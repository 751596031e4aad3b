"""Similarity and band joins against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from pricewright.functions.similarity import token_set_ratio_of
from pricewright.operators import names

WORDS = ["hp", "victus", "victus15", "gaming", "laptop", "15", "16", "gb", "ryzen", "i5-1235u", "thinkpad", "think", "pad", "e14", "gen", "6", "é", "aspire"]


@pytest.mark.parametrize(("seed", "least", "side"), [(1, 75.0, 2000), (2, 60.0, 5), (3, 90.0, 3)])
def test_similar_names_are_exact(spark, seed, least, side):
    rng = random.Random(seed)
    own = [" ".join(rng.choice(WORDS) for _ in range(rng.randrange(0, 7))) for _ in range(70)] + ["", "  ", None, "thinkpade14", "hp  hp victus"]
    own += ["".join(c for c in rng.choice(own[:70]) if rng.random() < 0.9) for _ in range(20)]
    rows = spark.createDataFrame(list(enumerate(own)), "id long, name string").withColumn("n", F.lit("clash"))
    got = {(r.i, r.j): r.ratio for r in names.similar_names(rows, least, side).collect()}
    want = {(i, j): token_set_ratio_of(own[i], own[j]) for i in range(len(own)) for j in range(i + 1, len(own)) if own[i] is not None and own[j] is not None}
    assert got == {p: pytest.approx(x) for p, x in want.items() if x >= least}
    n = names.candidates(rows.filter("name is not null"), least, side).count()
    assert len(got) <= n < len(want) * (0.5 if least >= 75 else 0.8)


def test_similar_names_plan_has_no_cross_join(spark):
    rows = spark.createDataFrame([(1, "a b")], "id long, name string")
    plan = names.similar_names(rows)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert names.similar_names(rows.limit(0)).count() == 0


@pytest.mark.parametrize("side", [2, 2000])
def test_band_join(spark, side):
    rng = random.Random(side)
    rows = [(i, rng.choice(["a", "b", None]), rng.choice([None, round(rng.uniform(-3, 15), 1)])) for i in range(80)]
    df = spark.createDataFrame(rows, "id long, k string, v double")
    j = names.band_join(df, ["k"], "v", 0.7, side).select(F.col("x.id").alias("i"), F.col("y.id").alias("j"))
    want = {(a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and a[1] and a[1] == b[1] and None not in (a[2], b[2]) and abs(a[2] - b[2]) < 0.7}
    got = [tuple(r) for r in j.collect()]
    assert len(got) == len(want) and set(got) == want
    assert "NestedLoop" not in j._jdf.queryExecution().executedPlan().toString()
