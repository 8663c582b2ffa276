"""Marts that follow loads: equal to a whole rebuild, and only where something changed."""

from __future__ import annotations

import datetime as dt
import itertools
import json
import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import REGION_CODES, REGION_NAMES, rows, wide_response
from lumbung.operators.load import Warehouse
from lumbung.plans import lineage, pipeline, refresh
from lumbung.sources import landing
from lumbung.streaming import ingest

_ids = itertools.count()
FACT = "date_key int, region_key string, indicator_key string, value decimal(20,6), year int, source_day int, source_key long"
TRADE_FACT = (
    "date_key int, product_key string, country_key string, port_key string, trade_type string, "
    "value_usd decimal(20,2), net_weight_kg decimal(20,2), year int, source_day int, source_key long"
)


@pytest.fixture
def house(spark, tmp_path):
    made = Warehouse(spark, str(tmp_path / "w"), f"ref{next(_ids)}_")
    made.create_tables()
    yield made
    made.drop_schemas()


def contents(house):
    """Every mart as sorted rows."""
    return {
        name: sorted(map(repr, rows(house.table("mart", name).select(*sorted(house.table("mart", name).columns)))))
        for name in refresh.ALL_MARTS
    }


def files(house, mart):
    """Files of the stored mart by year partition."""
    found = {}
    for path in house.table("mart", mart).inputFiles():
        year = path.split("year=")[1].split("/")[0]
        found.setdefault(year, set()).add(os.path.basename(path))
    return found


def dimensions(spark, house):
    house.upsert(spark.range(2015, 2031).selectExpr(
        "CAST(id * 10000 + 101 AS INT) AS date_key", "make_date(CAST(id AS INT), 1, 1) AS full_date", "CAST(id AS INT) AS year"
    ), "dim_date")
    house.upsert(spark.createDataFrame([(c, c, REGION_NAMES[c]) for c in REGION_CODES], "region_key string, region_code string, region_name string"), "dim_region")
    house.upsert(spark.createDataFrame([(i, i, f"name {i}") for i in "abc"], "indicator_key string, indicator_code string, indicator_name string"), "dim_indicator")
    house.upsert(spark.createDataFrame([(p, p, f"product {p}") for p in "xyz"], "product_key string, product_code string, product_name string"), "dim_product")
    house.upsert(spark.createDataFrame([(c, c, f"country {c}") for c in "mn"], "country_key string, country_code string, country_name string"), "dim_country")
    house.upsert(spark.createDataFrame([("ekspor", "Ekspor"), ("impor", "Impor")], "trade_flow string, flow_name string"), "dim_trade_flow")


def economic(spark, data, day=20240101):
    made = [(y * 10000 + 101, r, i, None if v is None else Decimal(v), y, day, 1) for y, r, i, v in data]
    return spark.createDataFrame(made, FACT)


def trade(spark, data, day=20240101):
    made = [(y * 10000 + 101, p, c, "port", f, None if v is None else Decimal(v), None, y, day, 1) for y, p, c, f, v in data]
    return spark.createDataFrame(made, TRADE_FACT)


def load(house, economic_rows=None, trade_rows=None):
    if economic_rows is not None:
        house.upsert(economic_rows, "fact_economic", update=["value", "source_key"], ordinal="source_day")
    if trade_rows is not None:
        house.upsert(trade_rows, "fact_trade", update=["value_usd", "net_weight_kg", "source_key"], ordinal="source_day")


def test_refreshed_marts_equal_a_whole_rebuild(spark, house):
    """Random series with gaps; batches of corrections, late years, new regions of old years, NULLs."""
    rng = random.Random(8)
    dimensions(spark, house)
    cells = [(y, r, i) for y in range(2016, 2024) for r in REGION_CODES for i in "abc" if rng.random() < 0.6]
    load(
        house, economic(spark, [(*c, rng.randint(1, 99)) for c in cells]),
        trade(spark, [(y, p, c, f, rng.randint(1, 9)) for y in range(2018, 2022) for p in "xyz" for c in "mn" for f in ("ekspor", "impor") if rng.random() < 0.7]),
    )
    refresh.build_marts(house)
    for step in range(2):
        batch = [(rng.randint(2015, 2025), rng.choice(REGION_CODES), rng.choice("ab"), rng.choice([None, rng.randint(1, 99)])) for _ in range(4)]
        batch = list({b[:3]: b for b in batch}.values())
        load(
            house, economic(spark, batch, 20240102 + step),
            trade(spark, [(2017 + 3 * step, "x", "m", "ekspor", 5), (2019, "z", "n", "impor", None)], 20240102 + step) if step else None,
        )
        done = refresh.refresh_marts(house)
        assert {b[0] for b in batch} <= set(done["indicator_trend"])
        found = contents(house)
        refresh.build_marts(house)
        assert found == contents(house), batch


def test_only_years_that_depend_on_a_change_are_rewritten(spark, house):
    dimensions(spark, house)
    # Region 1100 is not observed in 2019, so its next year after 2018 is 2020; 1200 is.
    cells = [(y, r, i) for y in range(2016, 2023) for r in REGION_CODES for i in "ab" if (y, r) != (2019, "1100")]
    load(house, economic(spark, [(*c, 10 + c[0] - 2000) for c in cells]), trade(spark, [(y, "x", "m", "ekspor", 5) for y in (2019, 2020, 2021)]))
    refresh.build_marts(house)
    before = {name: files(house, name) for name in refresh.ALL_MARTS}
    load(house, economic(spark, [(2018, "1100", "a", 77)], 20240102))
    done = refresh.refresh_marts(house)
    assert done["regional_performance"] == [2018, 2019, 2020] and done["economic_summary"] == [2018]
    for name, years in done.items():
        after = files(house, name)
        assert {y for y in after if after[y] != before[name].get(y)} == set(map(str, years)), name
    assert all(files(house, name) == before[name] for name in refresh.TRADE_MARTS)
    # Nothing changed since: nothing is written, not even by loading the same dimension rows again.
    dimensions(spark, house)
    before = {name: files(house, name) for name in refresh.ALL_MARTS}
    assert refresh.refresh_marts(house) == {}
    assert {name: files(house, name) for name in refresh.ALL_MARTS} == before
    # A year of trade, and a name that changes.
    load(house, trade_rows=trade(spark, [(2020, "y", "n", "impor", 8)], 20240102))
    assert refresh.refresh_marts(house) == {name: [2020] for name in refresh.TRADE_MARTS}
    house.upsert(spark.createDataFrame([("b", "b", "other name")], "indicator_key string, indicator_code string, indicator_name string"), "dim_indicator")
    assert refresh.refresh_marts(house)["indicator_trend"] == list(range(2016, 2023))
    found = contents(house)
    refresh.build_marts(house)
    assert found == contents(house)


def test_a_run_that_breaks_off_before_the_marts_is_made_up_for(spark, house):
    dimensions(spark, house)
    load(house, economic(spark, [(2020, "1100", "a", 1), (2021, "1100", "a", 2)]))
    refresh.build_marts(house)
    house.upsert(spark.createDataFrame([("1100", "1100", "NEW NAME")], "region_key string, region_code string, region_name string"), "dim_region")
    # Stopped here; the same load again finds the name in place, the marts still follow.
    house.upsert(spark.createDataFrame([("1100", "1100", "NEW NAME")], "region_key string, region_code string, region_name string"), "dim_region")
    refresh.refresh_marts(house)
    assert set(rows(house.table("mart", "regional_performance"), "region_name")) == {("NEW NAME",)}


def test_an_existing_row_gives_way_only_to_a_later_day(spark, house):
    def value(region="1100", year=2020):
        found = house.table("warehouse", "fact_economic").where((F.col("region_key") == region) & (F.col("year") == year))
        return rows(found, "value", "source_day")[0]

    load(house, economic(spark, [(2020, "1100", "a", 7), (2020, "1200", "a", 1)], 20240107))
    load(house, economic(spark, [(2020, "1100", "a", 6), (2021, "1100", "a", 5)], 20240106))
    assert value() == (7, 20240107) and value(year=2021) == (5, 20240106)
    load(house, economic(spark, [(2020, "1100", "a", 8)], 20240107))  # the same day again corrects
    assert value() == (8, 20240107)
    load(house, economic(spark, [(2020, "1100", "a", None)], None))  # no day gives way to any
    assert value() == (8, 20240107)
    load(house, economic(spark, [(2022, "1100", "a", 1)], None))
    load(house, economic(spark, [(2022, "1100", "a", 2)], None))
    assert value(year=2022) == (2, None)
    load(house, economic(spark, [(2022, "1100", "a", None)], 20200101))
    assert value(year=2022) == (None, 20200101)
    # Equal values of a later day count as seen that day.
    load(house, economic(spark, [(2020, "1200", "a", 1)], 20240109))
    load(house, economic(spark, [(2020, "1200", "a", 3)], 20240108))
    assert value("1200") == (1, 20240109)
    names = "product_key string, product_code string, product_name string, source_day int"
    for name, day in (("later", 20240109), ("earlier", 20240108), ("later", 20240110), ("between", 20240109)):
        house.upsert(spark.createDataFrame([("x", "x", name, day)], names), "dim_product")
    assert rows(house.table("warehouse", "dim_product"), "product_name", "source_day") == [("later", 20240110)]


def test_dimensions_that_do_not_change_are_not_written(spark, house):
    dimensions(spark, house)
    before = house.table("warehouse", "dim_indicator").inputFiles()
    dimensions(spark, house)
    empty = spark.createDataFrame([], "indicator_key string, indicator_code string, indicator_name string")
    assert house.upsert(empty, "dim_indicator") == 0
    assert house.table("warehouse", "dim_indicator").inputFiles() == before


# The whole flow


def provinces():
    return json.dumps({"data": [{"page": 1}, [{"domain_id": c, "domain_name": REGION_NAMES[c]} for c in REGION_CODES]]})


TRADE_NAMES = ("jenis", "kode_barang", "nama_barang", "kode_negara", "nama_negara", "kode_pelabuhan", "periode", "nilai", "berat_bersih")


def trades(*records):
    return json.dumps({"data": [dict(zip(TRADE_NAMES, r)) for r in records]})


def land(spark, base, items, day):
    data = [(source, dataset, day, body) for source, dataset, body in items]
    landing.land_responses(spark.createDataFrame(data, "source string, dataset string, landed_on date, body string"), base)


DAYS = [dt.date(2024, 1, 1), dt.date(2024, 1, 8)]
FIRST = [
    ("dynamic_data", "out put#1", wide_response()), ("domain", "prov", provinces()),
    ("glossary", "all", json.dumps({"data": [{"id": "G", "nama_indikator": "output", "konsep": "first"}]})),
    ("simdasi", "all", json.dumps({"data": [{"id": "D", "judul": "one"}]})),
    ("foreign_trade", "a", trades(("ekspor", "1", "Zinc", "AA", "Aland", "P", "2021", "10.5", "3"), ("impor", "2", "Tin", "BB", "Beland", "Q", "2022-03", "4", "x"))),
]
SECOND = [
    ("dynamic_data", "out put#1", wide_response(datacontent=[["2022", "1"], ["2024", "5", "6", "7", "8"]])),
    ("glossary", "all", json.dumps({"data": [{"id": "G", "nama_indikator": "output", "konsep": "second"}, {"id": "H"}]})),
    ("simdasi", "more", json.dumps({"data": [{"id": "D", "judul": "two"}, {"id": "E", "judul": "three"}]})),
    ("foreign_trade", "a", trades(("ekspor", "1", "Zinc ore", "AA", "Aland", "P", "2021", "11", "3"), ("ekspor", "1", "Zinc ore", "AA", "Aland", "P", "2023", "2", "1"))),
]


def check_lineage(house):
    """Mart rows traced to facts and files."""
    known = pipeline.loaded_files(house)

    def traced(mart, wanted):
        found = lineage.trace_mart(house, mart, known, wanted)
        return sorted((r.role, float(r.amount), r.doc.split("day=")[1].split("/")[0], r.doc.split("source=")[1].split("/")[0]) for r in found.collect())

    own = (F.col("year") == 2022) & (F.col("region_key") == "1100")
    assert traced("regional_performance", own) == [("current", 1.0, "8", "dynamic_data"), ("previous", 44.0, "1", "dynamic_data")]
    whole = traced("indicator_trend", F.col("year") == 2022)
    assert [r[0] for r in whole] == ["current"] * 4 + ["previous"] * 4 and {r[2] for r in whole if r[0] == "current"} == {"1", "8"}
    assert len(traced("growth_divergence", F.col("year") == 2024)) == 8
    assert [r[0] for r in traced("economic_summary", F.col("year") == 2020)] == ["current"] * 4
    assert traced("trade_trend", F.col("year") == 2021) == [("current", 11.0, "8", "foreign_trade")]
    assert traced("trade_commodity", F.col("product_code") == "2") == [("current", 4.0, "1", "foreign_trade")]
    assert traced("trade_partner", F.col("year") == 2023) == traced("trade_regional", F.col("year") == 2023)
    bridge = traced("economic_trade_bridge", F.col("year") == 2021)
    assert [r[0] for r in bridge] == ["economic"] * 4 + ["previous"] * 4 + ["trade"]
    assert traced("economic_trade_bridge", F.col("year").isNull()) == [("trade", 2.0, "8", "foreign_trade")]
    for mart in refresh.ALL_MARTS:
        everything = lineage.trace_mart(house, mart, known)
        assert everything.where("doc IS NULL").count() == 0 and everything.count() > 0, mart
    with pytest.raises(ValueError, match="unknown mart"):
        lineage.trace_mart(house, "rejected", known)


def test_the_stream_takes_all_sources_and_equals_the_pipeline(spark, tmp_path, house):
    base = str(tmp_path / "landing")
    other = Warehouse(spark, str(tmp_path / "w2"), f"ref{next(_ids)}_")
    try:
        for at, items in enumerate((FIRST, SECOND)):
            land(spark, base, items, DAYS[at])
            ingest.ingest_available(spark, base, house, str(tmp_path / "checkpoint"))
        pipeline.run_pipeline(spark, base, other)
        for table in ("dim_date", "dim_region", "dim_indicator", "dim_dataset", "dim_glossary", "dim_product", "dim_country", "dim_trade_flow", "fact_economic", "fact_trade"):
            columns = [c for c in other.table("warehouse", table).columns if c != "loaded_at"]
            assert sorted(map(repr, rows(house.table("warehouse", table), *columns))) == sorted(
                map(repr, rows(other.table("warehouse", table), *columns))
            ), table
        assert contents(house) == contents(other)
        assert rows(house.table("mart", "economic_overview").where("year = 2024"), "concept") == [("second",)]
        check_lineage(other)
    finally:
        other.drop_schemas()


def test_the_stream_keeps_trade_that_fails_the_gate_apart(spark, tmp_path, house):
    base = str(tmp_path / "landing")
    good = ("ekspor", "1", "Zinc", "AA", "Aland", "P", "2021", "10", "3")
    land(spark, base, [
        ("foreign_trade", "a", trades(good, (None, *good[1:]), (*good[:6], "20/21", "1", "1"))),
        ("simdasi", "a", json.dumps({"status": "200"})), ("glossary", "a", "no json"),
    ], DAYS[0])
    for _ in range(2):
        ingest.ingest_available(spark, base, house, str(tmp_path / "checkpoint"))
    assert house.row_count("warehouse", "fact_trade") == 1 and house.row_count("staging", "rejected_trade") == 2
    assert sorted(rows(house.table("staging", "rejected_responses"), "source", "reason")) == [
        ("glossary", "no JSON"), ("simdasi", "no data"),
    ]


def plain(base, source, dataset, day, body):
    place = os.path.join(base, "bps", source, dataset, day)
    os.makedirs(place, exist_ok=True)
    with open(os.path.join(place, "response.json"), "w") as out:
        out.write(body)
    return os.path.join(place, "response.json")


def test_a_file_landed_anew_loads_again_and_an_unchanged_one_does_not(spark, tmp_path, house):
    base = str(tmp_path / "tree")
    path = plain(base, "dynamic_data", "out", "2024/01/07", wide_response())
    plain(base, "domain", "prov", "2024/01/07", provinces())
    run = lambda: pipeline.run_pipeline(spark, base, house, plain_tree=True)
    value = lambda: rows(house.table("mart", "regional_performance").where("year = 2022 AND region_key = '1100'"), "value")
    assert run().staged_rows == 12
    before = {name: house.table("mart", name).inputFiles() for name in refresh.ALL_MARTS}
    assert run().staged_rows == 0
    os.utime(path, (2_000_000_000, 2_000_000_000))  # written again as it was
    assert run().staged_rows == 0 and run().loaded == {}
    assert {name: house.table("mart", name).inputFiles() for name in refresh.ALL_MARTS} == before
    plain(base, "dynamic_data", "out", "2024/01/07", wide_response(datacontent=[["2022", "99.99", "1", "2", "3"]]))
    result = run()
    assert result.staged_rows == 4 and value() == [(Decimal("99.99"),)] and result.refreshed["economic_summary"] == [2022]
    # A day that lands late does not take a newer value back.
    plain(base, "dynamic_data", "out", "2024/01/06", wide_response(datacontent=[["2022", "11.11"], ["2019", "4"]]))
    assert run().staged_rows == 2 and value() == [(Decimal("99.99"),)]
    assert house.table("warehouse", "fact_economic").where("year = 2019").count() == 1


def test_rejected_files_are_tried_again_and_hold_up_no_run(spark, tmp_path, house):
    base = str(tmp_path / "tree")
    plain(base, "domain", "prov", "2024/01/07", provinces())
    path = plain(base, "dynamic_data", "out", "2024/01/07", json.dumps({"status": "200"}))
    run = lambda: pipeline.run_pipeline(spark, base, house, plain_tree=True, skip_rejected=True)
    for _ in range(2):
        result = run()
        assert result.rejected == 1 and result.staged_rows == 0
        assert rows(house.table("staging", "rejected_responses"), "source", "reason") == [("dynamic_data", "no datacontent")]
    with open(path, "w") as out:
        out.write(wide_response())
    assert run().staged_rows == 12 and run().rejected == 0
