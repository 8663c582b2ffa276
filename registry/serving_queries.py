"""Dashboard and read queries on marts computed from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumbung.functions.storage import materialize
from lumbung.operators import model
from lumbung.plans import marts, pipeline, serving
from lumbung.sources import responses as parsers
from registry.adapters import (
    ECONOMIC,
    GLOSSARY_SQL,
    dataset_responses,
    economic_fact,
    economic_star,
    glossary_responses,
    indicators,
    trade_star,
)
from registry.catalog import register
from registry.mart_queries import (
    BRIDGE_SQL,
    COMMODITY_SQL,
    OVERVIEW_SQL,
    PARTNER_SQL,
    PERFORMANCE_SQL,
    TRADE_TREND_SQL,
    TREND_SQL,
)

# What the parameterised queries are asked about.
KEY, YEAR, REGION, LIMIT = "Brand#12", 1998, "7", 20

STATUS = (
    "CASE WHEN growth_pct > 0 THEN 'Positive' WHEN growth_pct < 0 THEN 'Negative' "
    "ELSE 'Stable' END AS growth_status"
)
_LATEST = f"FROM overview WHERE year = (SELECT MAX(year) FROM overview) AND indicator_key = '{KEY}'"
_REGIONAL = (
    "year, region_key, region_name, indicator_key, indicator_name, value, regional_rank, "
    "previous_value, growth_pct"
)


def overview(spark, sf_dir):
    return marts.economic_overview(economic_star(spark, sf_dir))


def performance(spark, sf_dir):
    return marts.regional_performance(economic_star(spark, sf_dir))


def trend(spark, sf_dir):
    return marts.indicator_trend(economic_star(spark, sf_dir))


@register(
    "v01_kpi_current_value",
    f"""WITH {OVERVIEW_SQL}
    SELECT indicator_name, national_value AS current_value, unit, year AS latest_period {_LATEST}""",
)
def v01(spark, sf_dir):
    return serving.kpi_current_value(overview(spark, sf_dir), KEY)


@register(
    "v02_kpi_growth",
    f"WITH {OVERVIEW_SQL} SELECT indicator_name, national_growth_pct AS yoy_growth, year {_LATEST}",
)
def v02(spark, sf_dir):
    return serving.kpi_growth(overview(spark, sf_dir), KEY)


@register(
    "v03_kpi_region_count",
    f"WITH {OVERVIEW_SQL} SELECT region_count, indicator_name {_LATEST}",
)
def v03(spark, sf_dir):
    return serving.kpi_region_count(overview(spark, sf_dir), KEY)


@register(
    "v04_kpi_latest_period",
    f"""WITH {OVERVIEW_SQL}
    SELECT MAX(year) AS latest_year, COUNT(DISTINCT year) AS years_available
    FROM overview WHERE indicator_key = '{KEY}'""",
)
def v04(spark, sf_dir):
    return serving.kpi_latest_period(overview(spark, sf_dir), KEY)


@register(
    "v05_trend_chart",
    f"""WITH {TREND_SQL}
    SELECT year, national_value, previous_value, growth_pct, indicator_name, unit
    FROM trend WHERE indicator_key = '{KEY}'""",
)
def v05(spark, sf_dir):
    return serving.trend_chart(trend(spark, sf_dir), KEY)


@register(
    "v06_ranking_table",
    f"""WITH {PERFORMANCE_SQL}
    SELECT region_name, value, regional_rank, growth_pct, year
    FROM performance WHERE indicator_key = '{KEY}' AND year = {YEAR}""",
)
def v06(spark, sf_dir):
    return serving.ranking_table(performance(spark, sf_dir), KEY, YEAR)


@register(
    "v07_growth_table",
    f"""WITH {PERFORMANCE_SQL}
    SELECT region_name, value, previous_value, growth_pct, {STATUS}, year
    FROM performance WHERE indicator_key = '{KEY}' AND year = {YEAR}""",
)
def v07(spark, sf_dir):
    return serving.growth_table(performance(spark, sf_dir), KEY, YEAR)


@register(
    "v08_region_filter",
    f"""WITH {PERFORMANCE_SQL}
    SELECT DISTINCT region_key, region_name FROM performance WHERE indicator_key = '{KEY}'""",
)
def v08(spark, sf_dir):
    return serving.region_filter(performance(spark, sf_dir), KEY)


_INDICATOR_ROWS = """
metadata AS (
    SELECT indicator_key, indicator_key AS indicator_code, indicator_name, subject_name,
           CAST(NULL AS VARCHAR) AS category_name, unit, frequency, concept, definition,
           CAST(NULL AS VARCHAR) AS classification, CAST(NULL AS VARCHAR) AS measure,
           data_source, aggregation_method
    FROM e_indicator
)"""
_INDICATOR_SQL = f"{ECONOMIC}, {_INDICATOR_ROWS}"


@register(
    "v09_metadata_panel",
    f"""WITH {_INDICATOR_SQL}
    SELECT indicator_name, unit, frequency, subject_name, category_name, concept, definition,
           classification, measure, data_source, aggregation_method
    FROM metadata WHERE indicator_key = '{KEY}'""",
)
def v09(spark, sf_dir):
    return serving.metadata_panel(indicators(spark, sf_dir), KEY)


@register(
    "v10_dataset_context",
    """SELECT MIN(p_brand) AS table_id, MIN('T-' || p_brand) AS table_code,
              MIN('Parts of ' || p_brand) AS title, 'Parts' AS dataset_subject,
              '1995-2001' AS available_years, 'BPS' AS source_system
    FROM part""",
)
def v10(spark, sf_dir):
    records = parsers.dataset_records(dataset_responses(spark, sf_dir))
    return serving.dataset_context(model.build_dim_dataset(records, "1995-2001"))


@register(
    "r01_overview",
    f"""WITH {OVERVIEW_SQL},
    latest AS (
        SELECT indicator_key, MAX(year) AS latest_year, COUNT(DISTINCT year) AS years_available,
               MAX(region_count) AS region_count
        FROM overview GROUP BY indicator_key
    )
    SELECT o.indicator_key, o.indicator_name, o.unit, o.frequency, l.latest_year,
           l.years_available, l.region_count, o.national_value AS current_value,
           o.national_growth_pct AS yoy_growth
    FROM latest l JOIN overview o
        ON o.indicator_key = l.indicator_key AND o.year = l.latest_year""",
)
def r01(spark, sf_dir):
    return serving.overview(overview(spark, sf_dir))


@register(
    "r02_trend",
    f"""WITH {TREND_SQL}
    SELECT year, indicator_key, indicator_name, unit, national_value, previous_value, growth_pct
    FROM trend""",
)
def r02(spark, sf_dir):
    return serving.economic_trend(trend(spark, sf_dir))


@register(
    "r03_regional",
    f"WITH {PERFORMANCE_SQL} SELECT {_REGIONAL} FROM performance WHERE year = {YEAR}",
)
def r03(spark, sf_dir):
    return serving.economic_regional(performance(spark, sf_dir), year=YEAR)


@register(
    "r04_indicators",
    f"WITH {OVERVIEW_SQL} SELECT DISTINCT indicator_key, indicator_name, unit, frequency FROM overview",
)
def r04(spark, sf_dir):
    return serving.indicators(overview(spark, sf_dir))


@register(
    "r05_ranking",
    f"""WITH {PERFORMANCE_SQL}
    SELECT {_REGIONAL}, {STATUS} FROM performance
    ORDER BY year DESC, regional_rank, indicator_key, region_key LIMIT {LIMIT}""",
)
def r05(spark, sf_dir):
    return serving.regional_ranking(performance(spark, sf_dir), limit=LIMIT)


@register(
    "r06_region_detail",
    f"WITH {PERFORMANCE_SQL} SELECT {_REGIONAL} FROM performance WHERE region_key = '{REGION}'",
)
def r06(spark, sf_dir):
    return serving.region_detail(performance(spark, sf_dir), REGION)


@register("r07_trade_trend", f"WITH {TRADE_TREND_SQL} SELECT * FROM trade_trend WHERE year = {YEAR}")
def r07(spark, sf_dir):
    return serving.trade_trend_by_year(marts.trade_trend(trade_star(spark, sf_dir)), YEAR)


@register(
    "r08_commodities",
    f"""WITH {COMMODITY_SQL}
    SELECT * FROM commodity WHERE trade_flow = 'Ekspor'
    ORDER BY year DESC, commodity_rank, trade_flow, product_code LIMIT {LIMIT}""",
)
def r08(spark, sf_dir):
    mart = marts.trade_commodity(trade_star(spark, sf_dir), materialize)
    return serving.top_commodities(mart, trade_flow="Ekspor", limit=LIMIT)


@register(
    "r09_partners",
    f"""WITH {PARTNER_SQL}
    SELECT * FROM partner WHERE year = {YEAR}
    ORDER BY year DESC, partner_rank, trade_flow, country_code LIMIT {LIMIT}""",
)
def r09(spark, sf_dir):
    mart = marts.trade_partner(trade_star(spark, sf_dir), materialize)
    return serving.top_partners(mart, year=YEAR, limit=LIMIT)


@register("r10_trade_balance", f"WITH {BRIDGE_SQL} SELECT * FROM bridge")
def r10(spark, sf_dir):
    bridge = marts.economic_trade_bridge(
        overview(spark, sf_dir), marts.trade_trend(trade_star(spark, sf_dir))
    )
    return serving.trade_balance(bridge)


@register(
    "r11_indicator_metadata",
    f"WITH {_INDICATOR_SQL} SELECT * FROM metadata WHERE indicator_key = '{KEY}'",
)
def r11(spark, sf_dir):
    return serving.indicator_metadata(indicators(spark, sf_dir), KEY)


@register(
    "r12_indicator_list",
    f"""WITH {_INDICATOR_SQL}
    SELECT indicator_key, indicator_code, indicator_name, subject_name, category_name, unit,
           frequency, data_source FROM metadata""",
)
def r12_indicators(spark, sf_dir):
    return serving.indicator_list(indicators(spark, sf_dir))


@register(
    "r12_glossary_list",
    f"""WITH {GLOSSARY_SQL}
    SELECT place + 1 AS glossary_key, glossary_id, indicator_name, concept, definition,
           classification, measure, unit, data_source FROM glossary""",
)
def r12_glossary(spark, sf_dir):
    records = parsers.glossary_records(glossary_responses(spark, sf_dir))
    return serving.glossary_list(model.build_dim_glossary(records))


@register(
    "r13_flow_chart",
    f"""WITH {TRADE_TREND_SQL}
    SELECT year, SUM(total_value_usd) FILTER (trade_flow = 'Ekspor') AS Ekspor,
           SUM(total_value_usd) FILTER (trade_flow = 'Impor') AS Impor
    FROM trade_trend GROUP BY year""",
)
def r13(spark, sf_dir):
    return serving.flow_chart(marts.trade_trend(trade_star(spark, sf_dir)))


@register(
    "r14_extraction_summary",
    f"""WITH {ECONOMIC}
    SELECT 'national_value' AS section, CAST(year AS VARCHAR) AS item,
           CAST(SUM(value) AS DOUBLE) AS amount
    FROM e_fact GROUP BY year
    UNION ALL
    SELECT 'latest_year_region_value', region_key, CAST(MAX_BY(value, indicator_key) AS DOUBLE)
    FROM e_fact WHERE year = (SELECT MAX(year) FROM e_fact) GROUP BY region_key
    UNION ALL
    SELECT 'count', item, amount FROM (
        SELECT CAST(COUNT(*) AS DOUBLE) AS total_records,
               CAST(COUNT(DISTINCT region_key) AS DOUBLE) AS regions,
               CAST(COUNT(DISTINCT year) AS DOUBLE) AS years_available,
               CAST(MAX(year) AS DOUBLE) AS latest_year
        FROM e_fact
    ) UNPIVOT (amount FOR item IN (total_records, regions, years_available, latest_year))""",
)
def r14(spark, sf_dir):
    """All observations; of a region's values of the latest year the last by indicator."""
    data = economic_fact(spark, sf_dir).select(
        "year", F.col("region_key").alias("region_id"), "value", F.col("indicator_key").alias("ordinal")
    )
    return pipeline.extraction_summary(materialize(data, "observations"))
