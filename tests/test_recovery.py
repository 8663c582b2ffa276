"""What must not get lost: broken-off swaps, corrections, unread responses, unloaded days."""

from __future__ import annotations

import datetime as dt
import json

import pytest

from conftest import REGION_CODES, REGION_NAMES, rows, wide_response
from lumbung.functions import columns
from lumbung.operators import model, quality
from lumbung.operators.load import Warehouse
from lumbung.operators.quality import QualityError
from lumbung.plans import marts, pipeline, serving
from lumbung.schemas import EconomicStar
from lumbung.sources import landing
from lumbung.sources import responses as parsers
from lumbung.streaming import ingest

REGION = "region_key string, region_code string, region_name string, n int"


def land(spark, base, items, day):
    data = [(source, dataset, day, body) for source, dataset, body in items]
    landing.land_responses(
        spark.createDataFrame(data, "source string, dataset string, landed_on date, body string"), base
    )


def provinces(codes=REGION_CODES):
    names = REGION_NAMES | {"1500": "FAR SHORE"}
    return json.dumps({"data": [{"page": 1}, [{"domain_id": c, "domain_name": names[c]} for c in codes]]})


@pytest.fixture
def house(spark, tmp_path):
    made = Warehouse(spark, str(tmp_path / "w"), f"rec{abs(hash(str(tmp_path))) % 10**8}_")
    yield made
    made.drop_schemas()


def test_a_swap_that_broke_off_loses_nothing(spark, house):
    first = spark.createDataFrame([("1", "1", "one", 0), ("2", "2", "two", 1)], REGION)
    house.upsert(first, "dim_region", ordinal="n")
    house._write(house.table("warehouse", "dim_region"), "warehouse", "dim_region__next", "errorifexists")
    spark.sql(f"DROP TABLE {house.name('warehouse', 'dim_region')}")  # stopped before the rename
    house.upsert(spark.createDataFrame([("3", "3", "three", 0)], REGION), "dim_region", ordinal="n")
    assert sorted(rows(house.table("warehouse", "dim_region"), "region_key")) == [("1",), ("2",), ("3",)]


def test_scratch_of_an_upsert_is_deleted(spark, house, tmp_path, monkeypatch):
    place = tmp_path / "scratch"
    monkeypatch.setattr("lumbung.operators.load.scratch_path", lambda s, label: f"{place}/{label}")
    for name in ("one", "uno"):
        house.upsert(spark.createDataFrame([("1", "1", name, 0)], REGION), "dim_region", ordinal="n")
    assert not any(place.iterdir())


def test_a_mart_whose_query_fails_stays(spark, house):
    house.build_mart(spark.createDataFrame([(2020, "a")], "year int, x string"), "m")
    with pytest.raises(Exception, match="broken"):
        house.build_mart(spark.range(1).selectExpr("2021 AS year", "raise_error('broken') AS x"), "m")
    assert rows(house.table("mart", "m")) == [(2020, "a")]
    house.build_mart(spark.createDataFrame([(2022, "b")], "year int, x string"), "m")
    assert rows(house.table("mart", "m")) == [(2022, "b")]
    left = [t.name for t in spark.catalog.listTables(f"{house.prefix}mart") if "__v" in t.name]
    assert len(left) == 1


def test_year_filters_prune_partitions(spark, house):
    house.create_tables()
    star = EconomicStar(*[house.table("warehouse", t) for t in ("fact_economic", "dim_date", "dim_region", "dim_indicator")])
    house.build_mart(marts.regional_performance(star), "regional_performance")

    def filters(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        return [line for line in plan.splitlines() if "PartitionFilters: [isnotnull(year" in line]

    assert filters(marts.regional_observations(star).where("year = 2021"))
    assert filters(serving.ranking_table(house.table("mart", "regional_performance"), "145", 2021))


def test_two_responses_of_one_day_need_an_order(spark, tmp_path):
    day = dt.date(2024, 1, 1)
    with pytest.raises(Exception, match="several responses of one day"):
        land(spark, str(tmp_path / "l"), [("domain", "prov", "[1]"), ("domain", "prov", "[2]")], day)


def test_responses_that_cannot_be_parsed_are_reported(spark, tmp_path, house):
    base = str(tmp_path / "landing")
    body = wide_response()
    land(spark, base, [
        ("dynamic_data", "a", body), ("dynamic_data", "b", body[: len(body) // 2]), ("domain", "prov", provinces()),
        ("glossary", "all", "  "),
    ], dt.date(2024, 1, 1))
    with pytest.raises(QualityError, match="2 responses cannot be parsed"):
        pipeline.run_pipeline(spark, base, house)
    assert house.is_empty("warehouse", "fact_economic")
    result = pipeline.run_pipeline(spark, base, house, skip_rejected=True)
    assert (result.rejected, result.staged_rows) == (2, 12)
    kept = rows(house.table("staging", "rejected_responses"), "dataset", "reason")
    assert sorted(kept) == [("all", "empty"), ("b", "no JSON")]
    assert rows(parsers.rejected(spark.createDataFrame([("x", "[]")], "doc string, body string"))) == []
    # Metadata that never landed leaves its dimensions empty.
    assert house.is_empty("warehouse", "dim_dataset") and house.is_empty("warehouse", "dim_glossary")


def test_all_landed_days_load_in_order_and_values_trace_to_their_file(spark, tmp_path, house):
    base = str(tmp_path / "landing")
    metadata = [("domain", "prov", provinces()), ("simdasi", "a", json.dumps({"data": [{"id": "D", "judul": "first"}]}))]
    land(spark, base, [("dynamic_data", "z", wide_response()), *metadata], dt.date(2024, 1, 9))
    # Later by day, earlier by path.
    later = wide_response(datacontent=[["2022", "1"]])
    land(spark, base, [
        ("dynamic_data", "a", later), ("simdasi", "a", json.dumps({"data": [{"id": "D", "judul": "last"}, {"id": "E"}]})),
    ], dt.date(2024, 1, 10))
    result = pipeline.run_pipeline(spark, base, house)
    assert result.staged_rows == 16 - 3
    traced = pipeline.trace(house.table("warehouse", "fact_economic"), pipeline.loaded_files(house))
    found = {(y, r): (float(v), "dataset=a" in doc) for y, r, v, doc in rows(traced, "year", "region_key", "value", "doc")}
    assert len(found) == 12 and found[2022, "1100"] == (1.0, True) and found[2021, "1100"] == (44.0, False)
    titles = dict(rows(house.table("warehouse", "dim_dataset"), "table_id", "title"))
    assert titles == {"D": "last", "E": None}

    again = pipeline.run_pipeline(spark, base, house)
    assert again.staged_rows == 0 and again.row_counts == result.row_counts
    # A correction on a later day replaces value and source.
    land(spark, base, [("dynamic_data", "c", wide_response(datacontent=[["2022", "7"]]))], dt.date(2024, 2, 1))
    pipeline.run_pipeline(spark, base, house)
    traced = pipeline.trace(house.table("warehouse", "fact_economic"), pipeline.loaded_files(house))
    value, doc = rows(traced.where("year = 2022 AND region_key = '1100'"), "value", "doc")[0]
    assert value == 7 and "dataset=c" in doc


def test_the_last_name_in_source_order_wins(spark):
    schema = "product_code string, product_name string, ordinal int"
    products = spark.createDataFrame([("1", "Zinc", 0), ("1", "Copper", 1), ("1", None, 2)], schema)
    assert rows(model.build_dim_product(products), "product_name") == [("Copper",)]


@pytest.mark.parametrize(
    "period, key",
    [("20230115", None), ("2023/01", None), (" ", None), ("2023-02-30", 20230230), ("99999-01", None), ("2023-1000", None)],
)
def test_odd_periods_abort_nothing(spark, period, key):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(period,)], "x string")
    assert df.select(columns.period_date_key(F.col("x"))).first()[0] == key
    year = spark.range(1).select(columns.year_date_key(F.lit(20230115))).first()[0]
    assert year is None


def test_trade_gate(spark):
    schema = (
        "trade_type string, commodity_code string, country_code string, port_code string, period string, "
        "value_usd string, net_weight_kg string"
    )
    good = ("ekspor", "1", "AA", "P", "2023-01", "5", None)
    def gate(*data):
        return quality.gate(quality.trade_checks(spark.createDataFrame(data, schema)))

    assert gate(good) == [] and gate() == []
    assert gate(good, (*good[:5], "much", "1")) == ["trade_amounts: 1 records have an amount that is no number"]
    with pytest.raises(QualityError, match="trade_period: 2 records"):
        gate(good, (*good[:4], "2023/01", "5", None), (*good[:4], "20230115", "5", None))
    with pytest.raises(QualityError, match="trade_keys: 1 records"):
        gate((None, *good[1:]))


def test_ingest_carries_new_indicators_regions_and_marts(spark, tmp_path, house):
    base, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    codes = [*REGION_CODES, "1500"]
    listed = spark.createDataFrame([(c, (REGION_NAMES | {"1500": "FAR SHORE"})[c]) for c in codes], "region_code string, region_name string")

    def run():
        ingest.ingest_available(spark, base, house, checkpoint, codes, regions=listed)
        return {(y, r, i): v for y, r, i, v in rows(house.table("mart", "regional_performance"), "year", "region_name", "indicator_name", "value")}

    land(spark, base, [("dynamic_data", "a", wide_response())], dt.date(2024, 1, 1))
    assert len(run()) == 12
    more = wide_response(
        variable=[{"id": "146", "label": "Prices", "description": "d"}], datacontent=[["2023", "1", "2", "3", "4", "5"]]
    )
    land(spark, base, [("dynamic_data", "b", more), ("dynamic_data", "bad", "{")], dt.date(2024, 1, 8))
    found = run()
    assert len(found) == 17 and found[2023, "FAR SHORE", "Prices"] == 5
    assert rows(house.table("staging", "rejected_responses"), "reason") == [("no JSON",)]
    # Values beyond the region list have no region; they are kept apart, not dropped unseen.
    land(spark, base, [("dynamic_data", "c", wide_response(datacontent=[["2024", *"123456"]]))], dt.date(2024, 1, 9))
    run()
    assert house.table("staging", "rejected_observations").count() == 1


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    from lumbung.functions import storage

    class Away:
        master = "spark://elsewhere:7077"

        def getConf(self):
            return self

        def get(self, *_):
            return None

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Away(), Away()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        storage.shared_dir(Session())
