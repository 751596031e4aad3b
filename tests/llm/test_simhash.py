"""SimHash: fingerprints and components against plain versions; odd inputs."""

import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from pricewright.llm import simhash
from tests.llm.test_operators import ODD, empty, odd  # noqa: F401


def plain_print(text):
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in text or "").translate(dict.fromkeys(range(9, 14), " ")).split(" ") if w]
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(prints):
    """prints: (doc_id, fingerprint); component of each row by comparing all with all."""
    label = {f: f for _, f in prints}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    fps = sorted(label)
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 4 and root(a) != root(b):
                label[root(a)] = root(b)
    least = {}
    for d, f in prints:
        r = root(f)
        if d is not None:
            least[r] = min(d, least.get(r, d))
        least.setdefault(r, None)
    return sorted(((d, f"{f:016x}", least[root(f)]) for d, f in prints), key=repr)


def test_fingerprints():
    rng = random.Random(5)
    texts = [None, "", " \t\n", "One", "a b", "a b c", "a b c d", "É ß x  y\tz\x0bq É", "same " * 3000] + [" ".join(rng.choice("abcdeABC") for _ in range(rng.randrange(300))) for _ in range(40)]
    assert [int(x) for x in simhash.fingerprints_of(pa.array(texts))] == [plain_print(t) for t in texts]
    assert len(simhash.fingerprints_of(pa.array([], pa.string()))) == 0


def test_long_texts_are_hashed_in_runs(monkeypatch):
    text = " ".join(f"w{i % 91}" for i in range(5000))
    monkeypatch.setattr(simhash, "_RUN", 7)
    assert [int(x) for x in simhash.fingerprints_of(pa.array(["q r s t u", text, None, "x"]))] == [plain_print(t) for t in ("q r s t u", text, None, "x")]


@pytest.mark.parametrize(("chain", "crowd"), [(2, 64), (3, 64), (2, 3), (2, 0), (3, 2)])
def test_components_are_exact(spark, chain, crowd):
    """Groups of fingerprints at all distances, with and without crowded buckets."""
    rng = random.Random(chain * 100 + crowd)
    prints = []
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 5, 30])):
            x = base
            for b in rng.sample(range(64), rng.randrange(8)):
                x ^= 1 << b
            prints.append(x)
    prints = list(dict.fromkeys([*prints, 0, 0xF, 0x1F << 59, (1 << 64) - 1]))
    nodes = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in prints], "fp long")
    links = [(a % (1 << 64), b % (1 << 64)) for a, b in simhash.near_links(nodes, chain=chain, crowd=crowd).collect()]
    assert all(0 < (a ^ b).bit_count() <= 4 for a, b in links)
    label = {x: x for x in prints}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in links:
        label[root(a)] = root(b)
    want = plain_components(list(enumerate(prints)))
    ids = {x: i for i, x in enumerate(prints)}
    least = {}
    for x, i in ids.items():
        least[root(x)] = min(i, least.get(root(x), i))
    assert sorted(((i, f"{x:016x}", least[root(x)]) for x, i in ids.items()), key=repr) == want


def test_every_near_pair_has_a_start(spark):
    """The variants of a chain's first segments hold all that the budgets allow, and some start fits each pair within TAU."""
    rng = random.Random(1)
    for _ in range(3000):
        d = sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 5)))
        for chain in (2, 3):
            assert any(all((d & simhash.mask(i, k) % (1 << 64)).bit_count() <= simhash.budget(k) for k in range(1, 6)) and simhash._signed(d & simhash.mask(i, chain) % (1 << 64)) in set(simhash.flips(i, chain)) for i in range(5))


def test_simhash_odd(spark, odd, empty):  # noqa: F811
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash.simhash_duplicates(odd).collect()), key=repr)
    assert got == plain_components([(r[0], plain_print(r[1])) for r in ODD])
    assert simhash.simhash_duplicates(empty).count() == 0
    only_null = spark.createDataFrame([(None, "a"), (None, "a")], "doc_id long, text string").withColumn("fp", F.lit(1))
    assert [(r.component_id, r.kept) for r in simhash.simhash_duplicates(only_null).collect()] == [(None, True)] * 2


@pytest.mark.parametrize("crowd", [64, 1])
def test_simhash_query_against_a_plain_version(spark, crowd):
    rng = random.Random(crowd)
    docs = []
    for i in range(150):
        if docs and rng.random() < 0.6:
            words = rng.choice(docs)[1].split()
            if rng.random() < 0.5:
                words[rng.randrange(len(words))] = "other"
            docs.append((i, " ".join(words)))
        else:
            docs.append((i, " ".join(f"w{rng.randrange(5000)}" for _ in range(200))))
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash.simhash_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), crowd=crowd).collect()), key=repr)
    assert got == plain_components([(i, plain_print(t)) for i, t in docs])
    assert len({r[2] for r in got}) < 100


def test_tables_that_grow_are_not_broadcast(spark):
    from pyspark.sql import functions as F

    from pricewright.llm.simhash import simhash_duplicates

    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.concat(F.lit("some words that stand here "), F.col("id")).alias("text"))
    plan = simhash_duplicates(docs)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def _plans(monkeypatch, module):
    """The plans of all that the module writes, as far as Spark lays them out before they run."""
    plans, write = [], module.materialize

    def noted(df, name, *rest, **named):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return write(df, name, *rest, **named)

    monkeypatch.setattr(module, "materialize", noted)
    return plans


@pytest.mark.parametrize("crowd", [64, 1])
def test_links_broadcast_nothing(spark, monkeypatch, crowd):
    """Tables that explode() makes 14 to 2,081 times as long are small in Spark's eyes."""
    plans = _plans(monkeypatch, simhash)
    links = simhash.near_links(spark.range(200).select(F.col("id").alias("fp")), chain=2, crowd=crowd)
    plans.append(("links", links._jdf.queryExecution().executedPlan().toString()))
    assert [n for n, _ in plans] == ["crowds", "dense", "links"]
    assert not [n for n, p in plans if "Broadcast" in p]


def test_components_broadcast_nothing(spark, monkeypatch):
    from pricewright.llm import near_dup

    plans = _plans(monkeypatch, near_dup)
    edges = spark.range(50).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert near_dup.connected(edges).select("comp").distinct().count() == 1
    assert plans and not [n for n, p in plans if "Broadcast" in p]
