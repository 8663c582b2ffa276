"""Data marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumbung.functions.storage import materialize
from lumbung.plans import marts
from registry.adapters import (
    ECONOMIC,
    FLOW_NAME,
    OBSERVED,
    TRADE_FACT,
    economic_star,
    growth_sql,
    stored_star,
    trade_star,
)
from registry.catalog import register

# Marts in SQL, reused by the read queries.
TREND_SQL = (
    ECONOMIC
    + f""",
totals AS (
    SELECT year, indicator_key, SUM(value) AS national_value
    FROM e_fact GROUP BY year, indicator_key
),
lagged AS (
    SELECT *, LAG(national_value) OVER (PARTITION BY indicator_key ORDER BY year) AS previous_value
    FROM totals
),
trend AS (
    SELECT year, indicator_key, indicator_name, unit, frequency,
           CAST(national_value AS DOUBLE) AS national_value,
           CAST(previous_value AS DOUBLE) AS previous_value,
           {growth_sql('national_value', 'previous_value')} AS growth_pct
    FROM lagged JOIN e_indicator USING (indicator_key)
)"""
)

PERFORMANCE_SQL = (
    OBSERVED
    + f""",
lagged AS (
    SELECT *,
           RANK() OVER (PARTITION BY year, indicator_key ORDER BY value DESC NULLS FIRST)
               AS regional_rank,
           LAG(value) OVER (PARTITION BY region_key, indicator_key ORDER BY year) AS previous
    FROM obs
),
performance AS (
    SELECT year, region_key, region_name, indicator_key, indicator_name,
           CAST(value AS DOUBLE) AS value,
           CAST(regional_rank AS INTEGER) AS regional_rank,
           CAST(previous AS DOUBLE) AS previous_value,
           {growth_sql('value', 'previous')} AS growth_pct
    FROM lagged
)"""
)

OVERVIEW_SQL = (
    ECONOMIC
    + f""",
overview_totals AS (
    SELECT year, indicator_key, SUM(value) AS total, COUNT(DISTINCT region_key) AS region_count
    FROM e_fact JOIN e_region USING (region_key) GROUP BY year, indicator_key
),
overview_lagged AS (
    SELECT *, LAG(total) OVER (PARTITION BY indicator_key ORDER BY year) AS previous
    FROM overview_totals
),
overview AS (
    SELECT year, indicator_key, indicator_name, unit, frequency, concept, definition,
           data_source,
           CAST(total AS DOUBLE) AS national_value,
           CAST(previous AS DOUBLE) AS previous_national_value,
           {growth_sql('total', 'previous')} AS national_growth_pct,
           region_count
    FROM overview_lagged JOIN e_indicator USING (indicator_key)
)"""
)

TRADE_TREND_SQL = (
    TRADE_FACT
    + f""",
trade_trend AS (
    SELECT year, {FLOW_NAME} AS trade_flow,
           CAST(COALESCE(SUM(value_usd), 0) AS DOUBLE) AS total_value_usd,
           CAST(COALESCE(SUM(net_weight_kg), 0) AS DOUBLE) AS total_weight_kg,
           COUNT(*) AS transaction_count
    FROM x_fact GROUP BY year, trade_type
)"""
)

COMMODITY_SQL = (
    TRADE_FACT
    + f""",
product_sums AS (
    SELECT year, {FLOW_NAME} AS trade_flow, product_key,
           SUM(value_usd) AS usd, SUM(net_weight_kg) AS kg
    FROM x_fact GROUP BY year, trade_type, product_key
),
commodity AS (
    SELECT year, trade_flow, product_key AS product_code, p_name AS product_name,
           CAST(COALESCE(usd, 0) AS DOUBLE) AS total_value_usd,
           CAST(COALESCE(kg, 0) AS DOUBLE) AS total_weight_kg,
           CAST(RANK() OVER (PARTITION BY year, trade_flow ORDER BY usd DESC NULLS FIRST)
                AS INTEGER) AS commodity_rank
    FROM product_sums JOIN part ON product_key = CAST(p_partkey AS VARCHAR)
)"""
)

PARTNER_SQL = (
    TRADE_FACT
    + f""",
country_sums AS (
    SELECT year, {FLOW_NAME} AS trade_flow, country_key, SUM(value_usd) AS usd
    FROM x_fact GROUP BY year, trade_type, country_key
),
partner AS (
    SELECT year, trade_flow, country_key AS country_code, n_name AS country_name,
           CAST(COALESCE(usd, 0) AS DOUBLE) AS total_value_usd,
           CAST(RANK() OVER (PARTITION BY year, trade_flow ORDER BY usd DESC NULLS FIRST)
                AS INTEGER) AS partner_rank
    FROM country_sums JOIN nation ON country_key = CAST(n_nationkey AS VARCHAR)
)"""
)

BRIDGE_SQL = (
    OVERVIEW_SQL
    + ","
    + TRADE_FACT
    + """,
trade_by_year AS (
    SELECT year,
           SUM(CASE WHEN trade_type = 'ekspor' THEN value_usd ELSE 0 END) AS exported,
           SUM(CASE WHEN trade_type = 'impor' THEN value_usd ELSE 0 END) AS imported
    FROM x_fact GROUP BY year
),
bridge AS (
    SELECT o.year, o.national_value, o.national_growth_pct,
           CAST(COALESCE(t.exported, 0) AS DOUBLE) AS export_total_usd,
           CAST(COALESCE(t.imported, 0) AS DOUBLE) AS import_total_usd,
           CAST(COALESCE(t.exported - t.imported, 0) AS DOUBLE) AS trade_balance_usd
    FROM overview o FULL OUTER JOIN trade_by_year t ON o.year = t.year
)"""
)


@register("m01_indicator_trend", f"WITH {TREND_SQL} SELECT * FROM trend")
def m01(spark, sf_dir):
    return marts.indicator_trend(economic_star(spark, sf_dir))


@register("m02_regional_performance", f"WITH {PERFORMANCE_SQL} SELECT * FROM performance")
def m02(spark, sf_dir):
    return marts.regional_performance(economic_star(spark, sf_dir))


@register("m03_economic_overview", f"WITH {OVERVIEW_SQL} SELECT * FROM overview")
def m03(spark, sf_dir):
    return marts.economic_overview(economic_star(spark, sf_dir))


@register(
    "m04_economic_summary",
    f"""WITH {OBSERVED}
    SELECT year, region_name, indicator_name, ROUND(AVG(value), 6) AS avg_value
    FROM obs GROUP BY ALL""",
)
def m04(spark, sf_dir):
    summary = marts.economic_summary(economic_star(spark, sf_dir))
    return summary.withColumn("avg_value", F.round("avg_value", 6))


@register(
    "m05_growth_divergence",
    f"""WITH {TREND_SQL.replace("lagged AS", "national_lagged AS").replace("FROM lagged", "FROM national_lagged")},
    {PERFORMANCE_SQL.split(ECONOMIC + ",", 1)[1]},
    ordered AS (
        SELECT *,
            ROW_NUMBER() OVER (PARTITION BY year, indicator_key
                               ORDER BY growth_pct DESC, region_key) AS from_top,
            ROW_NUMBER() OVER (PARTITION BY year, indicator_key
                               ORDER BY growth_pct, region_key) AS from_bottom
        FROM performance WHERE growth_pct IS NOT NULL
    )
    SELECT t.year, t.indicator_key, t.indicator_name, t.national_value,
           t.growth_pct AS national_growth_pct,
           a.region_name AS top_region, a.growth_pct AS top_growth_pct,
           b.region_name AS bottom_region, b.growth_pct AS bottom_growth_pct
    FROM trend t
    LEFT JOIN ordered a
        ON a.year = t.year AND a.indicator_key = t.indicator_key AND a.from_top = 1
    LEFT JOIN ordered b
        ON b.year = t.year AND b.indicator_key = t.indicator_key AND b.from_bottom = 1""",
)
def m05(spark, sf_dir):
    return marts.growth_divergence(stored_star(spark, sf_dir))


@register("m06_trade_trend", f"WITH {TRADE_TREND_SQL} SELECT * FROM trade_trend")
def m06(spark, sf_dir):
    return marts.trade_trend(trade_star(spark, sf_dir))


@register(
    "m07_trade_regional",
    f"""WITH {TRADE_FACT}
    SELECT year, port_key, trade_type,
           CAST(COALESCE(SUM(value_usd), 0) AS DOUBLE) AS value_usd,
           CAST(COALESCE(SUM(net_weight_kg), 0) AS DOUBLE) AS weight_kg,
           COUNT(*) AS record_count
    FROM x_fact GROUP BY year, port_key, trade_type""",
)
def m07(spark, sf_dir):
    return marts.trade_regional(trade_star(spark, sf_dir))


@register("m08_trade_commodity", f"WITH {COMMODITY_SQL} SELECT * FROM commodity")
def m08(spark, sf_dir):
    return marts.trade_commodity(trade_star(spark, sf_dir), materialize)


@register("m09_trade_partner", f"WITH {PARTNER_SQL} SELECT * FROM partner")
def m09(spark, sf_dir):
    return marts.trade_partner(trade_star(spark, sf_dir), materialize)


@register("m10_economic_trade_bridge", f"WITH {BRIDGE_SQL} SELECT * FROM bridge")
def m10(spark, sf_dir):
    return marts.economic_trade_bridge(
        marts.economic_overview(economic_star(spark, sf_dir)),
        marts.trade_trend(trade_star(spark, sf_dir)),
    )


@register(
    "m11_national_by_method",
    f"""WITH {ECONOMIC}
    SELECT year, indicator_key, indicator_name, aggregation_method,
           ROUND(CASE aggregation_method WHEN 'SUM' THEN CAST(SUM(value) AS DOUBLE)
                      WHEN 'AVG' THEN CAST(AVG(value) AS DOUBLE) END, 6) AS national_value
    FROM e_fact JOIN e_indicator USING (indicator_key)
    GROUP BY year, indicator_key, indicator_name, aggregation_method""",
)
def m11(spark, sf_dir):
    table = marts.national_by_method(economic_star(spark, sf_dir))
    return table.withColumn("national_value", F.round("national_value", 6))
