"""A fourth source, registered by name and called from SQL."""

import pytest

from pricewright.sources import registry


def test_a_source_of_ones_own(spark):
    def read(url, html):
        if html == "broken":
            raise ValueError("no page")
        for k, word in enumerate((html or "").split()):
            yield {"place": k, "word": word, "more": "ignored"}

    own = registry.page_source(spark, "corner_shop", ("shop.example",), ("laptop",), read, "place int, word string")
    assert registry.source(" Corner_Shop ") is own
    pages = spark.createDataFrame([(1, "u", "a b"), (2, "v", "broken"), (3, None, None)], "id int, source_url string, html string")
    got = sorted((r.id, r.place, r.word, r.error_) for r in own.parse(pages).collect() if r.error_ is None)
    assert got == [(1, 0, "a", None), (1, 1, "b", None)]
    assert [(r.id, r.error_) for r in own.parse(pages).filter("error_ is not null").collect()] == [(2, "ValueError: no page")]
    assert [tuple(r) for r in spark.sql("SELECT word FROM parse_corner_shop('u', 'x y') ORDER BY place").collect()] == [("x",), ("y",)]
    assert {("corner_shop", "shop.example", "laptop"), ("croma", "croma.com", "mobile")} <= {tuple(r) for r in registry.listing(spark).collect()}
    raw = spark.createDataFrame([("corner_shop",), ("elsewhere",), (None,)], "source string")
    assert sorted(r.reason for r in registry.unknown_sources(raw).collect()) == ["unsupported source: elsewhere", "unsupported source: none"]
    with pytest.raises(ValueError, match="unsupported source: 'elsewhere'; registered: .*croma"):
        registry.source("elsewhere")
    with pytest.raises(ValueError, match="a source's name"):
        registry.page_source(spark, "x; drop", (), (), read, "a int")
