from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

import pytest

from conftest import (
    REGION_CODES, REGION_NAMES, YEARLY, national_trend, regional_growth, rows, wide_response,
)
from lumbung.operators.load import Warehouse
from lumbung.operators.quality import QualityError
from lumbung.plans import pipeline, serving
from lumbung.sources import landing
from lumbung.streaming import ingest

TRADE = [
    ("ekspor", "70010000", "AA", "P-ONE", "2023", "5100.25", "9000.00"),
    ("ekspor", "70010000", "BB", "P-ONE", "2023", "2400.50", "4000.00"),
    ("impor", "80020000", "CC", "P-TWO", "2023", "1500.75", "700.00"),
    ("impor", "80020000", "DD", "P-TWO", "2023", "1000.00", "800.00"),
    ("ekspor", "70010000", "AA", "P-ONE", "2024", "7300.00", "9900.00"),
]
TRADE_NAMES = ("jenis", "kode_barang", "kode_negara", "kode_pelabuhan", "periode", "nilai", "berat_bersih")


def land(spark, base, items, day=dt.date(2024, 1, 1)):
    data = [(source, dataset, day, body) for source, dataset, body in items]
    landing.land_responses(
        spark.createDataFrame(data, "source string, dataset string, landed_on date, body string"), base
    )


def everything():
    provinces = json.dumps(
        {"data": [{"page": 1}, [{"domain_id": c, "domain_name": REGION_NAMES[c]} for c in REGION_CODES]]}
    )
    glossary = {"data": [
        {"id": "G0", "nama_indikator": "Output", "konsep": "old"},
        {"id": "G1", "nama_indikator": " output\t", "konsep": "All that is produced", "sumber_data": "survey"},
    ]}
    return [
        ("dynamic_data", "pdrb", wide_response()),
        ("domain", "prov", provinces),
        ("glossary", "all", json.dumps(glossary)),
        ("simdasi", "all", json.dumps({"data": [{"id": "D1", "judul": "Output"}, {"id": "D2"}]})),
        ("foreign_trade", "all", json.dumps({"data": [dict(zip(TRADE_NAMES, r)) for r in TRADE]})),
    ]


def test_pipeline_loads_marts_and_repeats(spark, tmp_path):
    base = str(tmp_path / "landing")
    land(spark, base, everything())
    house = Warehouse(spark, str(tmp_path / "w"), "p1_")
    try:
        result = pipeline.run_pipeline(spark, base, house, periods="2020,2021,2022")
        assert result.staged_rows == 12
        assert result.row_counts == {"fact_economic": 12, "dim_date": 5, "dim_region": 5, "dim_indicator": 1}

        trend = serving.economic_trend(house.table("mart", "indicator_trend"))
        assert rows(trend, "year", "national_value", "growth_pct") == [
            *national_trend()
        ]
        ranking = serving.ranking_table(house.table("mart", "regional_performance"), "145", 2020)
        assert [r[0] for r in rows(ranking, "region_name")] == [
            REGION_NAMES[c] for _, c in sorted(zip(map(Decimal, YEARLY["2020"]), REGION_CODES), reverse=True)
        ]
        found = dict(rows(
            serving.growth_table(house.table("mart", "regional_performance"), "145", 2021),
            "region_name", "growth_pct",
        ))
        grown = regional_growth("2021")
        assert found == grown
        overview = house.table("mart", "economic_overview").where("year = 2022")
        assert rows(overview, "region_count", "concept", "data_source") == [(4, "All that is produced", "survey")]
        divergence = house.table("mart", "growth_divergence").where("year = 2021")
        assert rows(divergence, "top_region", "top_growth_pct", "bottom_region", "bottom_growth_pct") == [
            (max(grown, key=grown.get), max(grown.values()), min(grown, key=grown.get), min(grown.values()))
        ]
        bridge = house.table("mart", "economic_trade_bridge").where("year is null")
        assert sorted(rows(bridge, "export_total_usd", "import_total_usd", "trade_balance_usd")) == [
            (Decimal("7300.00"), 0, Decimal("7300.00")),
            (Decimal("7500.75"), Decimal("2500.75"), Decimal("5000.00")),
        ]
        commodity = house.table("mart", "trade_commodity").where("trade_flow = 'Ekspor'")
        assert sum(v for (v,) in rows(commodity, "total_value_usd")) == Decimal("14800.75")
        assert rows(serving.dataset_context(house.table("warehouse", "dim_dataset"))) == [
            ("D1", None, "Output", None, "2020,2021,2022", "BPS")
        ]
        traced = pipeline.trace(
            house.table("warehouse", "fact_economic"), house.table("staging", "dynamic_data")
        )
        assert all("dataset=pdrb" in d for (d,) in rows(traced, "doc"))

        again = pipeline.run_pipeline(spark, base, house, periods="2020,2021,2022")
        assert again.row_counts == result.row_counts
        summary = {(s, i): a for s, i, a in rows(pipeline.extraction_summary(
            house.table("staging", "dynamic_data").selectExpr("*", "struct(doc, place) as ordinal")))}
        assert summary[("national_value", "2022")] == float(national_trend()[-1][1])
        assert summary[("latest_year_region_value", "1400")] == 8.0
        assert summary[("count", "total_records")] == 12
    finally:
        house.drop_schemas()


def test_pipeline_without_regions_or_data_stops_at_the_gate(spark, tmp_path):
    base = str(tmp_path / "landing")
    land(spark, base, [("dynamic_data", "pdrb", wide_response())])
    house = Warehouse(spark, str(tmp_path / "w"), "p2_")
    try:
        with pytest.raises(QualityError, match="region_id: 12"):
            pipeline.run_pipeline(spark, base, house)
        assert house.is_empty("warehouse", "fact_economic")
        with pytest.raises(QualityError, match="nothing was staged"):
            pipeline.run_pipeline(spark, str(tmp_path / "nothing"), house)
    finally:
        house.drop_schemas()


def test_only_the_latest_day_of_a_dataset_is_loaded(spark, tmp_path):
    base = str(tmp_path / "landing")
    land(spark, base, [("domain", "prov", "[1]"), ("glossary", "a", "1")], dt.date(2023, 12, 31))
    land(spark, base, [("domain", "prov", "[2]")], dt.date(2024, 1, 1))
    latest = pipeline.latest_landed(
        landing.read_landed(spark, base), landing.list_landed(spark, base)
    )
    assert sorted(rows(latest, "source", "year")) == [("domain", 2024), ("glossary", 2023)]


def test_stream_takes_each_file_once_and_the_last_value_wins(spark, tmp_path):
    base, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    house = Warehouse(spark, str(tmp_path / "w"), "p3_")
    house.create_tables()

    def run():
        ingest.ingest_available(spark, base, house, checkpoint, REGION_CODES)
        table = house.table("warehouse", "fact_economic")
        return {(y, r): v for y, r, v in rows(table, "year", "region_key", "value")}

    try:
        land(spark, base, [("dynamic_data", "pdrb", wide_response()), ("domain", "prov", "[]")])
        assert len(run()) == 12
        land(
            spark, base,
            [("dynamic_data", "pdrb", wide_response(datacontent=[["2022", "1"], ["2023", "2", "3"]]))],
            dt.date(2024, 1, 8),
        )
        second = run()
        assert len(second) == 14
        assert second[(2022, "1100")] == 1 and second[(2023, "1200")] == 3
        assert second[(2022, "1200")] == Decimal(YEARLY["2022"][1])
        assert run() == second
        # The same files once more, from scratch, leave the table as it is.
        ingest.ingest_available(spark, base, house, str(tmp_path / "other"), REGION_CODES, max_files=1)
        assert run() == second
    finally:
        house.drop_schemas()
