from __future__ import annotations

from dataclasses import replace
from decimal import Decimal as D

import pytest

from conftest import REGION_CODES, REGION_NAMES, national_trend, regional_growth, responses, rows, wide_response
from lumbung.functions.storage import materialize
from lumbung.operators import model, staging
from lumbung.operators.load import Warehouse
from lumbung.plans import analytics, marts, serving
from lumbung.schemas import EconomicStar, TradeStar
from registry import mart_queries, serving_queries


def star_of(spark, data, methods=None):
    """data: (year, region, indicator, value)"""
    fact = model.build_fact_economic(
        spark.createDataFrame(
            [(y, r, i, None if v is None else D(str(v))) for y, r, i, v in data],
            "year int, region_id string, variable_id string, value decimal(20,6)",
        )
    )
    regions = sorted({r for _, r, _, _ in data})
    codes = sorted({i for _, _, i, _ in data})
    dim_region = model.build_dim_region(
        spark.createDataFrame([(r, f"name {r}") for r in regions], "region_code string, region_name string")
    )
    dim_indicator = model.build_dim_indicator(
        spark.createDataFrame(
            [(i, f"ind {i}", (methods or {}).get(i, "SUM")) for i in codes],
            "indicator_code string, indicator_name string, aggregation_method string",
        )
    )
    return EconomicStar(fact, model.calendar(spark), dim_region, dim_indicator)


@pytest.fixture(scope="module")
def fixture_star(spark):
    staged = staging.stage(responses(spark, wide_response()), REGION_CODES)
    regions = spark.createDataFrame(list(REGION_NAMES.items()), "region_code string, region_name string")
    return EconomicStar(
        model.build_fact_economic(staged.data),
        model.build_dim_date(staged.data),
        model.build_dim_region(regions),
        model.dim_indicator_from_staged(staged.described),
    )


def test_fixture_trend_and_ranking(fixture_star):
    trend = marts.indicator_trend(fixture_star).orderBy("year")
    assert rows(trend, "year", "national_value", "growth_pct", "unit") == [
        (*row, "Million credits") for row in national_trend()
    ]
    ranked = marts.regional_performance(fixture_star).where("year = 2020").orderBy("regional_rank")
    assert rows(ranked, "region_key", "regional_rank") == [("1200", 1), ("1300", 2), ("1100", 3), ("1400", 4)]
    grown = marts.regional_performance(fixture_star).where("year = 2021")
    assert dict(rows(grown, "region_key", "growth_pct"))["1100"] == regional_growth("2021")["NORTH HILLS"]
    assert set(rows(marts.economic_overview(fixture_star), "region_count")) == {(4,)}


def test_lag_takes_the_previous_observed_year_and_zero_has_no_growth(spark):
    star = star_of(spark, [(2018, "a", "x", 10), (2021, "a", "x", 0), (2022, "a", "x", 5), (2023, "a", "x", 4)])
    got = rows(marts.regional_performance(star).orderBy("year"), "year", "previous_value", "growth_pct")
    assert got == [(2018, None, None), (2021, 10, D("-100.00")), (2022, 0, None), (2023, 5, D("-20.00"))]
    status = rows(serving.growth_table(marts.regional_performance(star), "x", 2022), "growth_status")
    assert status == [("Stable",)]


def test_null_values_rank_first_and_ties_share_a_rank(spark):
    data = [(2020, "a", "x", None), (2020, "b", "x", 7), (2020, "c", "x", 7), (2020, "d", "x", 1)]
    expected = [("a", 1), ("b", 2), ("c", 2), ("d", 4)]
    mart = marts.regional_performance(star_of(spark, data))
    assert sorted(rows(mart, "region_key", "regional_rank")) == expected


def test_growth_rounds_half_away_from_zero(spark):
    star = star_of(spark, [(2020, "a", "x", 800), (2021, "a", "x", 801), (2022, "a", "x", "799.99875")])
    # 0.125 % and -0.125 %
    got = rows(marts.regional_performance(star).orderBy("year"), "growth_pct")
    assert got == [(None,), (D("0.13"),), (D("-0.13"),)]


def test_divergence_decides_ties_by_region_key(spark):
    data = [(2020, r, "x", 100) for r in "abc"] + [(2021, "a", "x", 110), (2021, "b", "x", 110), (2021, "c", "x", 90)]
    got = marts.growth_divergence(star_of(spark, data)).orderBy("year")
    assert rows(got, "top_region", "top_growth_pct", "bottom_region") == [
        (None, None, None), ("name a", D("10.00"), "name c"),
    ]


def test_declared_aggregation_method(spark):
    data = [(2020, r, i, v) for i in ("s", "a", "n") for r, v in (("p", 1), ("q", 3))]
    star = star_of(spark, data, {"s": "SUM", "a": "AVG", "n": "N/A"})
    assert sorted(rows(marts.national_by_method(star), "indicator_key", "national_value")) == [
        ("a", D("2")), ("n", None), ("s", D("4")),
    ]


TRADE = [
    ("ekspor", "70010000", "AA", "P-ONE", "2023", "5100.25", "9000.00"),
    ("ekspor", "70010000", "BB", "P-ONE", "2023-01", "2400.50", "4000.00"),
    ("impor", "80020000", "CC", "P-TWO", "2023-01-01", "1500.75", "700.00"),
    ("impor", "80020000", "DD", "P-TWO", "2023", "1000.00", "800.00"),
    ("ekspor", "70010000", "AA", "P-ONE", "2024", "7300.00", "9900.00"),
    ("ekspor", "70010000", "AA", "P-ONE", "", "1", "1"),
    ("ekspor", "999", "AA", "P-ONE", "2024", "n/a", "x"),
]
TRADE_COLUMNS = "trade_type commodity_code country_code port_code period value_usd net_weight_kg"


@pytest.fixture(scope="module")
def trade_star(spark):
    records = spark.createDataFrame(TRADE, ", ".join(f"{c} string" for c in TRADE_COLUMNS.split()))
    products = records.selectExpr("commodity_code as product_code", "'p' || commodity_code as product_name")
    countries = records.selectExpr("country_code", "'c' || country_code as country_name")
    return TradeStar(
        model.build_fact_trade(records), model.calendar(spark, "MONTH"),
        model.build_dim_product(products), model.build_dim_country(countries),
        model.build_dim_trade_flow(spark),
    )


def test_trade_fact_keys_and_amounts(trade_star):
    assert sorted(rows(trade_star.fact.select("date_key").distinct())) == [(0,), (20230101,), (20240101,)]
    assert rows(trade_star.fact.where("product_key = '999'"), "value_usd", "net_weight_kg") == [(None, None)]
    with pytest.raises(ValueError, match="port_code"):
        model.build_fact_trade(trade_star.fact.selectExpr(
            "trade_type", "product_key as commodity_code", "country_key as country_code"))


def test_trade_marts(trade_star):
    trend = {(y, f): (v, n) for y, f, v, n in rows(
        marts.trade_trend(trade_star), "year", "trade_flow", "total_value_usd", "transaction_count")}
    assert trend[(2023, "Ekspor")] == (D("7500.75"), 2)
    assert trend[(2023, "Impor")] == (D("2500.75"), 2)
    # Without a dated period a row belongs to no year.
    assert sum(n for _, n in trend.values()) == 6
    assert sorted(rows(marts.trade_regional(trade_star).where("year = 2023"), "port_key", "record_count")) == [
        ("P-ONE", 2), ("P-TWO", 2)]
    commodity = marts.trade_commodity(trade_star).where("year = 2024")
    # A total of no known values ranks first and reads as zero.
    assert sorted(rows(commodity, "product_code", "total_value_usd", "commodity_rank")) == [
        ("70010000", D("7300.00"), 2), ("999", 0, 1)]
    partner = marts.trade_partner(trade_star).where("year = 2023 and trade_flow = 'Impor'")
    assert sorted(rows(partner, "country_code", "partner_rank")) == [("CC", 1), ("DD", 2)]


def test_bridge_repeats_trade_and_keeps_trade_only_years(spark, trade_star):
    star = star_of(spark, [(2022, "a", "x", 1), (2023, "a", "x", 2), (2023, "a", "y", 5)])
    overview, trend = marts.economic_overview(star), marts.trade_trend(trade_star)
    columns = ("year", "national_value", "export_total_usd", "trade_balance_usd")
    got = sorted(rows(marts.economic_trade_bridge(overview, trend), *columns), key=str)
    assert got == sorted([
        (2022, 1, 0, 0), (2023, 2, D("7500.75"), D("5000.00")),
        (2023, 5, D("7500.75"), D("5000.00")), (None, None, D("7300.00"), D("7300.00")),
    ], key=str)
    filled = marts.economic_trade_bridge(overview, trend, fill_trade_years=True)
    assert (2024,) in rows(filled, "year")


def test_dimension_builders(spark):
    dates = model.build_dim_date(spark.createDataFrame([(2022,), (2023,), (2023,), (None,)], "year int"))
    assert rows(dates.orderBy("year"), "date_key", "month_name", "period_type") == [
        (20220101, "January", "YEAR"), (20230101, "January", "YEAR")]
    keys = spark.createDataFrame([(20230815,), (0,), (20231301,)], "date_key int")
    assert rows(model.build_dim_date_from_keys(keys), "date_key", "quarter", "month_name") == [
        (20230815, 3, "August")]
    assert model.calendar(spark, "QUARTER").where("year = 2023").count() == 4
    fallback = model.dim_region_for_domain(spark, "1100", None)
    assert sorted(rows(fallback, "region_key", "region_name")) == [
        ("0000", "INDONESIA"), ("1100", "Region 1100")]


def test_glossary_enrichment(spark):
    indicators = model.build_dim_indicator(spark.createDataFrame(
        [("1", " Produk "), ("2", "other"), ("3", None)], "indicator_code string, indicator_name string"))
    schema = "indicator_name string, concept string, definition string, classification string, measure string, data_source string, ordinal int"
    glossary = spark.createDataFrame(
        [("produk", "old", "d", "c", "m", "s", 0), ("PRODUK ", "new", None, "c", "m", "s", 1),
         (None, "null", "d", "c", "m", "s", 2), ("  ", "blank", "d", "c", "m", "s", 3)], schema)
    got = rows(model.enrich_indicators(indicators, glossary).orderBy("indicator_key"),
               "indicator_key", "concept", "definition", "data_source")
    assert got == [("1", "new", None, "s"), ("2", None, None, None), ("3", None, None, None)]


def test_fact_builder_names_the_missing_column(spark):
    with pytest.raises(ValueError, match="region_id is required"):
        model.build_fact_economic(spark.createDataFrame([("1", 2020, 1.0)], "variable_id string, year int, value double"))


def test_analyses_on_a_gap(spark):
    star = star_of(spark, [(2015, "a", "x", 1), (2019, "a", "x", 2), (2020, "a", "x", 3), (2021, "a", "x", 6)])
    assert rows(analytics.moving_average(star), "moving_avg_3y") == [
        (D("1"),), (D("1.5"),), (D("2"),), (D("3.666667"),)]
    assert rows(analytics.growth_acceleration(star), "year", "growth_pct", "acceleration_pct") == [
        (2020, D("50.00"), D("-50.00")), (2021, D("100.00"), D("50.00"))]
    assert rows(analytics.recent_years(star), "year") == [(2019,), (2020,), (2021,)]
    assert rows(analytics.fastest_regions(star, "ind x", 2), "year") == [(2019,), (2021,)]
    assert rows(analytics.long_term_trend(star), "years_observed", "total_change_pct") == [(4, D("500.00"))]
    wide = analytics.region_comparison(star, "ind x", {"name a": "a", "nowhere": "b"})
    assert rows(wide, "a", "b")[0] == (D("1"), None)
    assert rows(analytics.latest_regional_ranking(star), "year", "regional_rank") == [(2021, 1)]


def test_volatility_needs_two_observations(spark):
    star = star_of(spark, [(2020, "a", "x", 2), (2021, "a", "x", 4), (2020, "b", "x", 1)])
    assert rows(analytics.volatility(star), "region_name", "coefficient_of_variation") == [("name a", 47.14)]


def test_latest_year_of_all_and_of_each(spark):
    star = star_of(spark, [(2020, "a", "x", 2), (2021, "a", "y", 4)])
    overview = marts.economic_overview(star)
    # x has nothing in the latest year of the mart, but has a latest year of its own.
    assert rows(serving.kpi_current_value(overview, "x")) == []
    assert rows(serving.kpi_current_value(overview, "y"), "latest_period") == [(2021,)]
    assert rows(serving.overview(overview), "indicator_key", "latest_year", "current_value") == [
        ("x", 2020, 2), ("y", 2021, 4)]


@pytest.mark.parametrize("limit", [0, 101, 1000])
def test_limits_are_checked(spark, fixture_star, limit):
    with pytest.raises(ValueError, match="limit"):
        serving.regional_ranking(marts.regional_performance(fixture_star), limit=limit)


def test_year_zero_means_no_filter(fixture_star):
    performance = marts.regional_performance(fixture_star)
    assert serving.economic_regional(performance, year=0).count() == 12
    assert serving.economic_regional(performance, year=1999).count() == 0
    assert serving.regional_ranking(performance, "145", 2022, 2).count() == 2


def test_a_year_of_a_stored_mart_reads_its_partition(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "w"), "stored_")
    columns = "year int, trade_flow string, total_value_usd double, total_weight_kg double, transaction_count long"
    data = [(year, "Ekspor", float(year or 0), 1.0, 1) for year in (2020, 2021, 2022, None)]
    try:
        house.build_mart(spark.createDataFrame(data, columns), "trade_trend")
        read = serving.trade_trend_by_year(house.table("mart", "trade_trend"), 2021)
        assert rows(read, "year", "total_value_usd") == [(2021, 2021.0)]
        plan = read._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(year" in plan
        assert len(read.inputFiles()) == 1
        assert rows(serving.trade_trend_by_year(house.table("mart", "trade_trend")), "year")[0] == (None,)
    finally:
        house.drop_schemas()


@pytest.mark.parametrize("module, query, mart", [
    (serving_queries, "r08", None), (serving_queries, "r09", None),
    (mart_queries, "m08", marts.trade_commodity), (mart_queries, "m09", marts.trade_partner),
])
def test_ranked_trade_queries_sum_the_fact_once(spark, trade_star, monkeypatch, module, query, mart):
    star = replace(trade_star, fact=materialize(trade_star.fact, "fact"))
    monkeypatch.setattr(module, "trade_star", lambda *_: star)
    ranked = getattr(module, query)(spark, "")
    # What is left to read are the stored sums.
    assert ranked.inputFiles() and not set(ranked.inputFiles()) & set(star.fact.inputFiles())
    if mart is not None:
        assert sorted(rows(ranked)) == sorted(rows(mart(star)))
