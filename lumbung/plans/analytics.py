"""Ad-hoc analyses of the economic star, ordered as a report reader expects.

Pass ``ordered=False`` where the result is written or joined on, to spare the global sort.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumbung.functions.columns import change_ratio_pct, growth_pct
from lumbung.functions.ranking import rank_desc
from lumbung.plans.marts import dated, regional_observations
from lumbung.schemas import EconomicStar

# The regions of the comparison table and its column names.
COMPARED_REGIONS = {
    "ACEH": "aceh",
    "SUMATERA UTARA": "sumatera_utara",
    "JAKARTA": "jakarta",
    "JAWA BARAT": "jawa_barat",
    "JAWA TIMUR": "jawa_timur",
}

_SERIES = ("region_name", "indicator_name")


def _report(df: DataFrame, ordered: bool, *order: str | Column) -> DataFrame:
    return df.orderBy(*order) if ordered else df


def _one_indicator(star: EconomicStar, indicator_name: str) -> DataFrame:
    return regional_observations(star).where(F.col("indicator_name") == indicator_name)


def year_over_year(star: EconomicStar, ordered: bool = True) -> DataFrame:
    """Growth of every indicator in every region."""
    series = Window.partitionBy(*_SERIES).orderBy("year")
    grown = (
        regional_observations(star)
        .withColumn("previous_year_value", F.lag("value").over(series))
        .select(
            "year", "region_name", "indicator_name", "value", "previous_year_value",
            growth_pct(F.col("value"), F.col("previous_year_value")).alias("yoy_growth_pct"),
        )
    )
    return _report(grown, ordered, "indicator_name", "region_name", "year")


def year_over_year_of(star: EconomicStar, indicator_name: str, ordered: bool = True) -> DataFrame:
    """Growth of one indicator in every region."""
    series = Window.partitionBy("region_name").orderBy("year")
    grown = (
        _one_indicator(star, indicator_name)
        .withColumn("_previous", F.lag("value").over(series))
        .select(
            "year", "region_name", "value",
            growth_pct(F.col("value"), F.col("_previous")).alias("yoy_growth_pct"),
        )
    )
    return _report(grown, ordered, "region_name", "year")


def national_year_over_year(star: EconomicStar, ordered: bool = True) -> DataFrame:
    """Growth of the national total of every indicator."""
    by_key = (
        dated(star.fact, star.dim_date)
        .groupBy("year", "indicator_key")
        .agg(F.sum("value").alias("_value"))
    )
    series = Window.partitionBy("indicator_name").orderBy("year")
    grown = (
        by_key.join(star.dim_indicator.select("indicator_key", "indicator_name"), "indicator_key")
        .groupBy("year", "indicator_name")
        .agg(F.sum("_value").alias("national_value"))
        .withColumn("_previous", F.lag("national_value").over(series))
        .select(
            "year", "indicator_name", "national_value",
            growth_pct(F.col("national_value"), F.col("_previous")).alias("yoy_growth_pct"),
        )
    )
    return _report(grown, ordered, "indicator_name", "year")


def latest_regional_ranking(star: EconomicStar, ordered: bool = True) -> DataFrame:
    """Regions ranked within each indicator in the latest year of the fact."""
    observed = regional_observations(star)
    latest = observed.where(F.col("year") == latest_year(star)).select(
        "year", "region_name", "indicator_name", "value"
    )
    ranked = rank_desc(latest, ["indicator_name"], "value", "regional_rank")
    return _report(ranked, ordered, "indicator_name", F.col("value").desc_nulls_first())


def latest_year(star: EconomicStar) -> Column:
    """Latest year with a fact row, as a scalar subquery.

    The pairs of date and year are few after a partial aggregate, so the join is over them alone.
    """
    keys = [key for key in ("date_key", "year") if key in star.fact.columns]
    return (
        star.fact.select(*keys).distinct()
        .join(star.dim_date.select("date_key", "year"), keys)
        .select(F.max("year"))
        .scalar()
    )


def region_comparison(
    star: EconomicStar,
    indicator_name: str,
    regions: Mapping[str, str] = COMPARED_REGIONS,
    ordered: bool = True,
) -> DataFrame:
    """One column per region, one row per year."""
    table = (
        _one_indicator(star, indicator_name)
        .groupBy("indicator_name", "year")
        .pivot("region_name", list(regions))
        .agg(F.max("value"))
        .withColumnsRenamed(dict(regions))
    )
    return _report(table, ordered, "year")


def fastest_regions(star: EconomicStar, indicator_name: str, limit: int) -> DataFrame:
    """Highest year-over-year growth of one indicator; ties by region and year."""
    series = Window.partitionBy("region_name").orderBy("year")
    return (
        _one_indicator(star, indicator_name)
        .withColumn("prev_value", F.lag("value").over(series))
        .where(F.col("prev_value").isNotNull())
        .select(
            "region_name", "year", "value", "prev_value",
            growth_pct(F.col("value"), F.col("prev_value")).alias("growth_pct"),
        )
        .orderBy(F.col("growth_pct").desc_nulls_first(), "region_name", "year")
        .limit(limit)
    )


def regional_averages(star: EconomicStar, ordered: bool = True) -> DataFrame:
    """Average, smallest and largest value of every region and indicator."""
    table = (
        regional_observations(star)
        .groupBy(*_SERIES)
        .agg(
            F.round(F.avg("value"), 6).alias("avg_value"),
            F.round(F.min("value"), 6).alias("min_value"),
            F.round(F.max("value"), 6).alias("max_value"),
            F.count(F.lit(1)).alias("observation_count"),
        )
    )
    return _report(table, ordered, "indicator_name", F.col("avg_value").desc_nulls_first())


def long_term_trend(star: EconomicStar, ordered: bool = True) -> DataFrame:
    """Level, spread and total range of every series."""
    lowest, highest = F.min("value"), F.max("value")
    table = (
        regional_observations(star)
        .groupBy("indicator_name", "region_name")
        .agg(
            F.count(F.lit(1)).alias("years_observed"),
            F.round(F.avg("value"), 6).alias("avg_value"),
            F.round(F.stddev_samp("value"), 6).alias("stddev_value"),
            growth_pct(highest, lowest).alias("total_change_pct"),
        )
    )
    return _report(table, ordered, "indicator_name", "region_name")


def recent_years(star: EconomicStar, years: int = 5, ordered: bool = True) -> DataFrame:
    """Observations of the latest calendar years."""
    table = (
        regional_observations(star)
        .where(F.col("year") >= latest_year(star) - (years - 1))
        .select("year", "indicator_name", "region_name", "value")
    )
    return _report(table, ordered, "indicator_name", "year", "region_name")


def moving_average(star: EconomicStar, rows: int = 3, ordered: bool = True) -> DataFrame:
    """Mean of the current and the preceding observed rows of a series."""
    frame = Window.partitionBy(*_SERIES).orderBy("year").rowsBetween(1 - rows, 0)
    table = regional_observations(star).select(
        "year", "region_name", "indicator_name", "value",
        F.round(F.avg("value").over(frame), 6).alias(f"moving_avg_{rows}y"),
    )
    return _report(table, ordered, "indicator_name", "region_name", "year")


def growth_acceleration(star: EconomicStar, ordered: bool = True) -> DataFrame:
    """Growth and its change against the growth one observation earlier."""
    series = Window.partitionBy(*_SERIES).orderBy("year")
    value, before, earlier = F.col("value"), F.col("_before"), F.col("_earlier")
    table = (
        regional_observations(star)
        .withColumn("_before", F.lag("value", 1).over(series))
        .withColumn("_earlier", F.lag("value", 2).over(series))
        .where(before.isNotNull() & earlier.isNotNull())
        .select(
            "year", "region_name", "indicator_name", "value",
            growth_pct(value, before).alias("growth_pct"),
            F.round(
                change_ratio_pct(value, before) - change_ratio_pct(before, earlier), 2
            ).alias("acceleration_pct"),
        )
    )
    return _report(table, ordered, "indicator_name", "region_name", "year")


def volatility(star: EconomicStar, ordered: bool = True) -> DataFrame:
    """Coefficient of variation of every series with more than one observation."""
    spread, mean = F.stddev_samp("value"), F.avg(F.col("value").cast("double"))
    table = (
        regional_observations(star)
        .groupBy("indicator_name", "region_name")
        .agg(
            F.count(F.lit(1)).alias("_observed"),
            F.round(F.avg("value"), 6).alias("mean_value"),
            F.round(spread, 6).alias("stddev_value"),
            F.round(spread / F.nullif(mean, F.lit(0.0)) * 100, 2).alias("coefficient_of_variation"),
        )
        .where(F.col("_observed") > 1)
        .drop("_observed")
    )
    return _report(
        table, ordered,
        F.col("coefficient_of_variation").asc_nulls_last(), "indicator_name", "region_name",
    )
