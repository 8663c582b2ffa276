"""Gates whose counters are gathered while staging is written, and staging that only a passed gate changes."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from conftest import REGION_CODES, REGION_NAMES, rows, wide_response
from lumbung.functions.storage import scratch_path
from lumbung.operators import quality
from lumbung.operators.load import Warehouse
from lumbung.operators.quality import QualityError
from lumbung.plans import pipeline
from lumbung.sources import landing

STAGED = "variable_id string, vervar_id string, region_id string, year int, value decimal(20,6), period_type string"
GOOD = ("145", None, "1100", 2020, 1, "year")
TRADE = "trade_type string, commodity_code string, country_code string, port_code string, period string, " \
    "value_usd string, net_weight_kg string"


def written(spark, counted):
    path = scratch_path(spark, "audit")
    counted.rows.write.parquet(path)
    return spark.read.schema(counted.rows.schema).parquet(path)


@pytest.mark.parametrize("data", [
    [],
    [GOOD],
    [GOOD, GOOD, GOOD],
    [GOOD, (None, None, None, None, None, None)],
    [GOOD, ("145", None, None, 2021, 3, "year"), ("145", None, None, 2021, 3, "year")],
    [("145", None, None, 2021, 3, "year")],
    [GOOD, ("145", "1", "1100", 2020, -1, "year"), ("145", "2", "1100", 1800, 2, "year"), ("145", "3", "1100", 3000, 2, None)],
])
def test_checks_of_a_write_are_those_of_a_second_read(spark, data):
    told = STAGED.replace("decimal(20,6)", "int")
    frame = spark.createDataFrame(data, told).withColumn("value", F.col("value").cast("decimal(20,6)"))
    counted = quality.count_observations(frame)
    got = quality.written_checks(counted, written(spark, counted), "c")
    want = quality.mapping_check(frame).unionByName(quality.validate(frame, "c"))
    assert sorted(rows(got)) == sorted(rows(want))


def test_checks_of_written_trade(spark):
    data = [
        ("ekspor", "7", "A", "P", "2023", "1.5", "2"), ("ekspor", None, "A", "P", "2023", "x", "2"),
        (None, None, None, None, None, None, None), ("impor", "7", "A", "P", "soon", "1", "much"),
    ]
    for some in (data, data[:1], []):
        records = spark.createDataFrame(some, TRADE)
        counted = quality.count_trade(records)
        written(spark, counted)
        assert rows(quality.written_trade_checks(spark, counted)) == rows(quality.trade_checks(records))


@pytest.fixture
def house(spark, tmp_path):
    made = Warehouse(spark, str(tmp_path / "w"), f"aud{abs(hash(str(tmp_path))) % 10**8}_")
    yield made
    made.drop_schemas()


def land(spark, base, items, day):
    data = [(source, "prov" if source == "domain" else source, day, body) for source, body in items]
    landing.land_responses(
        spark.createDataFrame(data, "source string, dataset string, landed_on date, body string"), base
    )


def trade(period):
    names = ("jenis", "kode_barang", "kode_negara", "kode_pelabuhan", "periode", "nilai", "berat_bersih")
    return json.dumps({"data": [dict(zip(names, ("ekspor", "7", "A", "P", period, "5", "9")))]})


def staging_of(house, table):
    return sorted(rows(house.table("staging", table).drop("loaded_at")), key=str)


def test_a_failed_gate_leaves_staging_and_warehouse(spark, house, tmp_path):
    base = str(tmp_path / "landing")
    provinces = json.dumps(
        {"data": [{"page": 1}, [{"domain_id": c, "domain_name": REGION_NAMES[c]} for c in REGION_CODES]]}
    )
    land(spark, base, [
        ("dynamic_data", wide_response()), ("domain", provinces), ("foreign_trade", trade("2023")),
    ], dt.date(2024, 1, 1))
    assert pipeline.run_pipeline(spark, base, house).staged_rows == 12
    before = {t: staging_of(house, t) for t in ("dynamic_data", "trade_records")}
    facts = {t: staging_of_fact(house, t) for t in ("fact_economic", "fact_trade")}
    assert [len(found) for found in before.values()] == [12, 1]

    def unchanged():
        assert {t: staging_of(house, t) for t in before} == before
        assert {t: staging_of_fact(house, t) for t in facts} == facts
        versions = [t.name for t in spark.catalog.listTables(f"{house.prefix}staging") if "__v" in t.name]
        assert sorted(v.partition("__v")[0] for v in versions) == ["dynamic_data", "trade_records"]

    # The statistics pass, the trade records do not.
    later = wide_response(datacontent=[["2023", "1", "2", "3", "4"]])
    land(spark, base, [("dynamic_data", later), ("foreign_trade", trade("soon"))], dt.date(2024, 1, 8))
    with pytest.raises(QualityError, match="trade_period"):
        pipeline.run_pipeline(spark, base, house)
    unchanged()
    # Landed anew, the trade passes, but one row of the statistics repeats another.
    twice = wide_response(datacontent=[["2023", "1", "2", "3", "4"], ["2023", "1"]])
    land(spark, base, [("dynamic_data", twice), ("foreign_trade", trade("2024"))], dt.date(2024, 1, 8))
    with pytest.raises(QualityError, match="duplicates"):
        pipeline.run_pipeline(spark, base, house)
    unchanged()


def staging_of_fact(house, table):
    return sorted(rows(house.table("warehouse", table).select("date_key", "source_key")), key=str)


def test_the_gate_reads_the_written_columns_alone(spark, house):
    house.create_tables()
    observed = spark.sql(
        "SELECT 'd' AS doc, struct(1 AS place) AS ordinal, '145' AS variable_id, '' AS vervar_id, '1100' AS region_id, "
        "2020 AS year, 1.5 AS value, 't' AS table_id, 'year' AS period_type"
    )
    candidate = pipeline.stage_observations(house, observed)
    assert house.is_empty("staging", "dynamic_data")
    checked = candidate.rows().select("variable_id", "vervar_id", "region_id", "year", "value", "period_type")
    checks = quality.written_checks(candidate.counted, checked)
    plan = checks._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 1 and "doc" not in scans[0].partition("ReadSchema")[2]
    assert quality.gate(checks) == []
    candidate.publish()
    assert house.row_count("staging", "dynamic_data") == 1
