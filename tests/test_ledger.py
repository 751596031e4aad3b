"""Batches through the ledger: once each, whatever fails or comes again."""

import pytest

from pricewright.streaming.ledger import Ledger

KINDS = {"sums": "k string, n long", "log": "n long"}


def test_batches_count_once(spark, tmp_path):
    led = Ledger(spark, str(tmp_path / "t"), KINDS, added=("log",), keep=1)
    assert led.tables()["sums"].count() == 0 and led.done("q") == -1

    def add(n, fail=False):
        def apply(t):
            if fail:
                raise RuntimeError("lost")
            sums = t["sums"].unionByName(spark.createDataFrame([("a", n)], KINDS["sums"])).groupBy("k").agg({"n": "sum"}).toDF("k", "n")
            return {"sums": sums, "log": spark.createDataFrame([(n,)], KINDS["log"])}

        return apply

    assert led.apply_once("q", 0, add(1))
    with pytest.raises(RuntimeError):
        led.apply_once("q", 1, add(10, fail=True))
    assert led.done("q") == 0
    assert led.apply_once("q", 1, add(10)) and not led.apply_once("q", 1, add(10)) and not led.apply_once("q", 0, add(1))
    assert led.apply_once("other", 0, add(100))
    t = Ledger(spark, str(tmp_path / "t"), KINDS, added=("log",)).tables()
    assert [tuple(r) for r in t["sums"].collect()] == [("a", 111)] and sorted(r.n for r in t["log"].collect()) == [1, 10, 100]
    assert len(list((tmp_path / "t" / "tables").iterdir())) == 1
    assert [(r.version, r["query"], r.batch) for r in led.entries().orderBy("version").collect()] == [(1, "q", 0), (2, "q", 1), (3, "other", 0)]


def test_half_written_batches_and_other_writers(spark, tmp_path):
    """A version without its ledger row isn't there; a version's number can be entered once."""
    led = Ledger(spark, str(tmp_path / "t"), {"log": "n long"})
    put = lambda n: lambda t: {"log": spark.createDataFrame([(n,)], "n long")}
    led.apply_once("q", 0, put(1))
    spark.createDataFrame([(9,)], "n long").write.parquet(str(tmp_path / "t" / "tables" / "0000000002-lost" / "log"))
    assert [r.n for r in led.tables()["log"].collect()] == [1]

    def meanwhile(t):
        Ledger(spark, str(tmp_path / "t"), {"log": "n long"}).apply_once("q2", 0, put(5))
        return put(6)(t)

    with pytest.raises(Exception, match="already exists"):
        led.apply_once("q", 1, meanwhile)
    assert [r.n for r in led.tables()["log"].collect()] == [5]
    assert led.apply_once("q", 1, put(6)) and [r.n for r in led.tables()["log"].collect()] == [6]
