"""Ad-hoc analyses."""

from __future__ import annotations

from lumbung.plans import analytics
from registry.adapters import (
    ECONOMIC,
    OBSERVED,
    economic_star,
    growth_sql,
    rounded_sql,
    stored_star,
)
from registry.catalog import register

# What the one-indicator analyses are asked about.
INDICATOR = "BRAND#12"
COMPARED = {f"NATION_{i}": f"nation_{i}" for i in range(5)}

_SERIES = "WINDOW series AS (PARTITION BY region_name, indicator_name ORDER BY year)"


@register(
    "a01_year_over_year",
    f"""WITH {OBSERVED},
    lagged AS (SELECT *, LAG(value) OVER series AS previous FROM obs {_SERIES})
    SELECT year, region_name, indicator_name, CAST(value AS DOUBLE) AS value,
           CAST(previous AS DOUBLE) AS previous_year_value,
           {growth_sql('value', 'previous')} AS yoy_growth_pct
    FROM lagged""",
)
def a01(spark, sf_dir):
    return analytics.year_over_year(economic_star(spark, sf_dir))


@register(
    "a02_year_over_year_of_indicator",
    f"""WITH {OBSERVED},
    lagged AS (
        SELECT *, LAG(value) OVER series AS previous
        FROM obs WHERE indicator_name = '{INDICATOR}' {_SERIES}
    )
    SELECT year, region_name, CAST(value AS DOUBLE) AS value,
           {growth_sql('value', 'previous')} AS yoy_growth_pct
    FROM lagged""",
)
def a02(spark, sf_dir):
    return analytics.year_over_year_of(economic_star(spark, sf_dir), INDICATOR)


@register(
    "a03_national_year_over_year",
    f"""WITH {ECONOMIC},
    totals AS (
        SELECT year, indicator_name, SUM(value) AS total
        FROM e_fact JOIN e_indicator USING (indicator_key) GROUP BY year, indicator_name
    ),
    lagged AS (
        SELECT *, LAG(total) OVER (PARTITION BY indicator_name ORDER BY year) AS previous
        FROM totals
    )
    SELECT year, indicator_name, CAST(total AS DOUBLE) AS national_value,
           {growth_sql('total', 'previous')} AS yoy_growth_pct
    FROM lagged""",
)
def a03(spark, sf_dir):
    return analytics.national_year_over_year(economic_star(spark, sf_dir))


@register(
    "a04_latest_regional_ranking",
    f"""WITH {OBSERVED}
    SELECT year, region_name, indicator_name, CAST(value AS DOUBLE) AS value,
           CAST(RANK() OVER (PARTITION BY indicator_name ORDER BY value DESC NULLS FIRST)
                AS INTEGER) AS regional_rank
    FROM obs WHERE year = (SELECT MAX(year) FROM e_fact)""",
)
def a04(spark, sf_dir):
    return analytics.latest_regional_ranking(stored_star(spark, sf_dir))


@register(
    "a05_region_comparison",
    f"""WITH {OBSERVED}
    SELECT indicator_name, year,
           {", ".join(
               f"CAST(MAX(value) FILTER (region_name = '{name}') AS DOUBLE) AS {column}"
               for name, column in COMPARED.items()
           )}
    FROM obs WHERE indicator_name = '{INDICATOR}' GROUP BY indicator_name, year""",
)
def a05(spark, sf_dir):
    return analytics.region_comparison(economic_star(spark, sf_dir), INDICATOR, COMPARED)


@register(
    "a06_fastest_regions",
    f"""WITH {OBSERVED},
    lagged AS (
        SELECT *, LAG(value) OVER series AS previous
        FROM obs WHERE indicator_name = '{INDICATOR}' {_SERIES}
    )
    SELECT region_name, year, CAST(value AS DOUBLE) AS value,
           CAST(previous AS DOUBLE) AS prev_value,
           {growth_sql('value', 'previous')} AS growth_pct
    FROM lagged WHERE previous IS NOT NULL
    ORDER BY growth_pct DESC NULLS FIRST, region_name, year LIMIT 10""",
)
def a06(spark, sf_dir):
    return analytics.fastest_regions(economic_star(spark, sf_dir), INDICATOR, 10)


@register(
    "a07_regional_averages",
    f"""WITH {OBSERVED}
    SELECT region_name, indicator_name, ROUND(AVG(value), 6) AS avg_value,
           CAST(MIN(value) AS DOUBLE) AS min_value, CAST(MAX(value) AS DOUBLE) AS max_value,
           COUNT(*) AS observation_count
    FROM obs GROUP BY region_name, indicator_name""",
)
def a07(spark, sf_dir):
    return analytics.regional_averages(economic_star(spark, sf_dir))


@register(
    "a08_long_term_trend",
    f"""WITH {OBSERVED}
    SELECT indicator_name, region_name, COUNT(*) AS years_observed,
           ROUND(AVG(value), 6) AS avg_value,
           ROUND(STDDEV_SAMP(CAST(value AS DOUBLE)), 6) AS stddev_value,
           {growth_sql('MAX(value)', 'MIN(value)')} AS total_change_pct
    FROM obs GROUP BY indicator_name, region_name""",
)
def a08(spark, sf_dir):
    return analytics.long_term_trend(economic_star(spark, sf_dir))


@register(
    "a09_recent_years",
    f"""WITH {OBSERVED}
    SELECT year, indicator_name, region_name, CAST(value AS DOUBLE) AS value
    FROM obs WHERE year >= (SELECT MAX(year) - 4 FROM e_fact)""",
)
def a09(spark, sf_dir):
    return analytics.recent_years(stored_star(spark, sf_dir))


@register(
    "a10_moving_average",
    f"""WITH {OBSERVED}
    SELECT year, region_name, indicator_name, CAST(value AS DOUBLE) AS value,
           ROUND(AVG(value) OVER (series ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6)
               AS moving_avg_3y
    FROM obs {_SERIES}""",
)
def a10(spark, sf_dir):
    return analytics.moving_average(economic_star(spark, sf_dir))


@register(
    "a11_growth_acceleration",
    f"""WITH {OBSERVED},
    lagged AS (
        SELECT *, LAG(value) OVER series AS p1, LAG(value, 2) OVER series AS p2 FROM obs {_SERIES}
    )
    SELECT year, region_name, indicator_name, CAST(value AS DOUBLE) AS value,
           {growth_sql('value', 'p1')} AS growth_pct,
           {rounded_sql("(value - p1) * 100 / NULLIF(p1, 0) - (p1 - p2) * 100 / NULLIF(p2, 0)")}
               AS acceleration_pct
    FROM lagged WHERE p1 IS NOT NULL AND p2 IS NOT NULL""",
)
def a11(spark, sf_dir):
    return analytics.growth_acceleration(economic_star(spark, sf_dir))


@register(
    "a12_volatility",
    f"""WITH {OBSERVED}
    SELECT indicator_name, region_name, ROUND(AVG(value), 6) AS mean_value,
           ROUND(STDDEV_SAMP(CAST(value AS DOUBLE)), 6) AS stddev_value,
           ROUND(STDDEV_SAMP(CAST(value AS DOUBLE)) / NULLIF(AVG(CAST(value AS DOUBLE)), 0) * 100, 2)
               AS coefficient_of_variation
    FROM obs GROUP BY indicator_name, region_name HAVING COUNT(*) > 1""",
)
def a12(spark, sf_dir):
    return analytics.volatility(economic_star(spark, sf_dir))
