"""Ranked search against scoring of every document; odd inputs."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pricewright.llm import search
from tests.llm.test_operators import DOCS, ODD, empty, odd, random_docs  # noqa: F401

ITEMS = "item_id long, text string"


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def plain(docs, items, k=10):
    own = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in own), sum(sum(c.values()) for _, c in own)
    df = Counter(x for _, c in own for x in c)
    queries = {}
    for i, t in items:
        queries.setdefault(i, set()).update(terms(t))
    out = {}
    for item, q in queries.items():
        got = []
        for i, c in own:
            m = 10 + 90 * sum(c.values()) * n_docs // n_terms if n_terms else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * (10**9 * c[x] // (1000 * c[x] + 8 * m)) for x in q if c[x])
            if s > 0:
                got.append((-s, i is None, i or 0, i))
        for r, x in enumerate(sorted(got)[:k]):
            out[item, r + 1] = (x[3], -x[0])
    return out


def as_rows(df):
    return {(r.item_id, r["rank"]): (r.doc_id, r.score) for r in df.collect()}


@pytest.mark.parametrize(("seed", "shard", "block", "k"), [(1, 16 << 20, 4 << 20, 10), (2, 400, 60, 3), (3, 50, 4 << 20, 1)])
def test_search_is_exact(spark, seed, shard, block, k):
    docs = [(i, t) for i, t, *_ in random_docs(seed, 200)]
    rng = random.Random(seed)
    items = [(i, " ".join(rng.choice(["w1", "W3!", "gnu", "licensé", "cc", f"w{i}", f"w{i + 20}", "nowhere"]) for _ in range(rng.randrange(7)))) for i in range(30)]
    index = search.build_index(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), shard_bytes=shard)
    got = search.search(index, spark.createDataFrame(items, ITEMS), k=k, block_bytes=block)
    assert as_rows(got) == plain(docs, items, k)
    assert index.filter("term is null").count() >= (1 if shard > 1000 else 6)


def test_search_odd(spark, odd, empty):  # noqa: F811
    """Nulls, repeats, a long text, no rows; a null item and a repeated one."""
    items = [(1, "same text"), (1, "same x"), (None, "null"), (2, None), (3, "..."), (4, "x")]
    q = spark.createDataFrame(items, ITEMS).selectExpr("*", "1 as term", "2 as shard", "3 as score")
    got = search.search(search.build_index(odd), q)
    assert sorted(map(repr, as_rows(got).items())) == sorted(map(repr, plain([(r[0], r[1]) for r in ODD], items).items()))
    assert search.search(search.build_index(empty), q).count() == 0
    assert search.search(search.build_index(odd), q.limit(0)).count() == 0


def test_equal_scores_rank_by_id(spark):
    docs = spark.createDataFrame([(i, "a b") for i in (9, 3, 7, 12, 1)] + [(50, "c")], "doc_id long, text string").repartition(4)
    got = as_rows(search.search(search.build_index(docs), spark.createDataFrame([("q", "b")], "item_id string, text string"), k=3))
    assert [got["q", r][0] for r in (1, 2, 3)] == [1, 3, 7]


@given(st.lists(st.dictionaries(st.integers(0, 40), st.integers(1, 9), min_size=1), max_size=8), st.integers(1, 5))
@settings(max_examples=300, deadline=None)
def test_merge_finds_the_best(lists, k):
    total = Counter()
    for x in lists:
        total.update(x)
    got = search.best_documents([([d for d, _ in sorted(x.items())], [a for _, a in sorted(x.items())], max(x.values())) for x in lists], k)
    assert sorted(got, key=lambda x: (-x[0], x[1])) == sorted(((s, d) for d, s in total.items()), key=lambda x: (-x[0], x[1]))[:k]


@given(st.lists(st.integers(0, 2**62)))
@settings(max_examples=100, deadline=None)
def test_packed_numbers_come_back(values):
    data, ends = search.packed(np.array(values, np.int64))
    assert search.unpacked_numbers(data.tobytes()).tolist() == values and len(ends) == len(values)


def test_shard_of_no_documents():
    assert search.shard_rows(0, pa.array([], pa.int64()), pa.array([], pa.string())).num_rows == 1
