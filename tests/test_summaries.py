"""Stored summaries follow loads and merge to what a recount gives."""

from __future__ import annotations

import random
import statistics

import pytest
from pyspark.sql import functions as F

from conftest import REGION_CODES, REGION_NAMES, rows
from lumbung.plans import analytics, marts, refresh, summaries
from test_refresh import dimensions, economic, files, house, load  # noqa: F401


def same(found, expected, tolerance=1e-9):
    assert found.columns == expected.columns
    found, expected = (sorted(rows(frame), key=str) for frame in (found, expected))
    assert len(found) == len(expected)
    for one, two in zip(found, expected):
        for left, right in zip(one, two):
            if isinstance(right, float):
                assert left == pytest.approx(right, rel=tolerance)
            else:
                assert left == right


def check(house):
    star = house.economic_star()
    same(summaries.long_term_trend(house), analytics.long_term_trend(star))
    same(summaries.volatility(house), analytics.volatility(star))
    same(summaries.economic_overview(house), marts.economic_overview(star))
    spans = marts.dated(star.fact, star.dim_date).join(star.dim_region, "region_key", "left_semi")
    for first, last in ((None, None), (2017, 2019), (None, 2000)):
        inside = spans.where(F.col("year").between(first or 0, last or 9999))
        expected = inside.groupBy("indicator_key").agg(F.count_distinct("region_key").alias("region_count"))
        same(summaries.reporting_regions(house, first, last), expected)


def test_summaries_follow_loads(spark, house):  # noqa: F811
    """Corrections, values that go, late years, NULLs, a region outside the dimension that enters it later."""
    rng = random.Random(3)
    dimensions(spark, house)
    cells = [(y, r, i) for y in range(2016, 2022) for r in [*REGION_CODES, "9900"] for i in "abc" if rng.random() < 0.6]
    load(house, economic(spark, [(*c, rng.choice([None, 0, rng.randint(-99, 99)])) for c in cells]))
    refresh.build_marts(house)
    assert not summaries.exist(house)
    summaries.build(house)
    before = files(house, summaries.MOMENTS)
    load(house, economic(spark, [(2018, "1100", "a", 5), (2018, "1200", "b", None), (2023, "1300", "c", 7)], 20240102))
    refresh.refresh_marts(house)
    check(house)
    after = files(house, summaries.MOMENTS)
    assert {year for year in after if before.get(year) != after[year]} == {"2018", "2023"}
    numbers = dict(rows(house.table(*summaries.NUMBERS), "region_key", "number"))
    house.upsert(spark.createDataFrame([("9900", "9900", "ISLET")], "region_key string, region_code string, region_name string"), "dim_region")
    refresh.refresh_marts(house)
    check(house)
    grown = dict(rows(house.table(*summaries.NUMBERS), "region_key", "number"))
    assert grown.keys() - numbers.keys() == {"9900"} and len(set(grown.values())) == len(grown)
    assert {key: grown[key] for key in numbers} == numbers
    refresh.build_marts(house)
    check(house)


def test_summaries_of_nothing(spark, house):  # noqa: F811
    summaries.build(house)
    assert summaries.long_term_trend(house).count() == summaries.economic_overview(house).count() == 0
    assert summaries.reporting_regions(house).count() == 0


def test_moments_keep_digits_of_large_values(spark):
    """Parts of any size, NULL keys, single values; deviations tiny against the mean."""
    rng = random.Random(5)
    data = {key: [1e9 + rng.random() for _ in range(n)] for key, n in ((None, 40), ("x", 1), ("y", 300))}
    parts = []
    for key, values in data.items():
        at = 0
        while at < len(values):
            own = values[at : at + rng.randint(1, 9)]
            at += len(own)
            mean = sum(own) / len(own)
            parts.append((key, len(own) + 1, len(own), None, mean, sum((v - mean) ** 2 for v in own), None, None))
    parts.append(("none", 2, 0, None, None, None, None, None))
    schema = "k string, observed long, n long, total decimal(30,6), mean double, m2 double, lowest decimal(20,6), highest decimal(20,6)"
    merged = summaries.merged_moments(spark.createDataFrame(parts, schema), ["k"])
    found = dict(rows(merged.select("k", summaries.spread().alias("s"))))
    assert found.keys() == {None, "x", "y", "none"} and found["x"] is found["none"] is None
    for key in (None, "y"):
        assert found[key] == pytest.approx(statistics.stdev(data[key]), rel=1e-6)


def test_bitmaps_of_many_buckets(spark):
    """Region numbers far apart stand in buckets of their own and are counted once."""
    numbers = spark.createDataFrame([(str(i), n) for i, n in enumerate((1, 2, 32768, 32769, 1 << 33))], "region_key string, number long")
    star = marts.EconomicStar(
        spark.createDataFrame([(y * 10000 + 101, str(r), "a", y) for y in (2000, 2001) for r in range(5) if r % 2 or y == 2000] * 2, "date_key int, region_key string, indicator_key string, year int"),
        spark.createDataFrame([(y * 10000 + 101, y) for y in (2000, 2001)], "date_key int, year int"), None, None,
    )
    bitmaps = summaries.region_bitmaps(star, numbers)
    assert dict(rows(summaries.region_counts(bitmaps, ["year"]))) == {2000: 5, 2001: 2}
    assert rows(summaries.region_counts(bitmaps, ["indicator_key"])) == [("a", 5)]
