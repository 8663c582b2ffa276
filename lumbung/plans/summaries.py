"""Stored summaries that merge: moments of every series and bitmaps of the reporting regions, by year.

Spread over all years and distinct regions of a span of years cannot be kept up to date from their
old results. They can from one partial result a year: a load has only the years that it touched
summarised anew (`follow`, called by the refresh of the marts), and what is asked for is merged from
the stored years without reading the facts. A row of moments stands for the observations of one
year and series, so summaries are smaller than facts of months or quarters, and never larger.

Defined results: rows without a value count as observed and are no part of the moments; a series
without values has NULL moments, one with a single value a NULL spread; facts without a known date
are no part of a summary, those of a region outside the dimension no part of the bitmaps.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumbung.functions.columns import growth_pct
from lumbung.functions.ranking import join_null_safe
from lumbung.operators.load import Warehouse
from lumbung.plans import marts
from lumbung.schemas import EconomicStar

MOMENTS, REGIONS = "series_moments", "region_bitmaps"
# Layer and name of the table that numbers the regions.
NUMBERS = ("warehouse", "region_numbers")
# Sums keep ten digits more than a value, as Spark's own sum of decimals.
_TOTAL = "decimal(30,6)"


def series_moments(star: EconomicStar) -> DataFrame:
    """Count, total, mean, sum of squared deviations and extremes of each year and series."""
    value = F.col("value").cast("double")
    return (
        marts.dated(star.fact, star.dim_date)
        .groupBy("year", "region_key", "indicator_key")
        .agg(
            F.count(F.lit(1)).alias("observed"),
            F.count("value").alias("n"),
            F.sum("value").cast(_TOTAL).alias("total"),
            F.avg(value).alias("mean"),
            (F.var_pop(value) * F.count("value")).alias("m2"),
            F.min("value").alias("lowest"),
            F.max("value").alias("highest"),
        )
    )


def merged_moments(moments: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row of moments for each `keys`, from any rows of moments.

    Squared deviations are moved from each row's mean to the common one, which loses no digits to
    large values as a difference of squares would. Partial aggregates take any number of rows a key.
    """
    whole = moments.groupBy(*keys).agg(
        F.sum("observed").alias("observed"), F.sum("n").alias("n"),
        F.sum("total").cast(_TOTAL).alias("total"),
        (F.sum(F.col("n") * F.col("mean")) / F.nullif(F.sum("n"), F.lit(0))).alias("mean"),
        F.min("lowest").alias("lowest"), F.max("highest").alias("highest"),
    )
    parts = moments.where("n > 0").select(*keys, "n", "m2", F.col("mean").alias("_own"))
    moved = F.col("m2") + F.col("n") * F.pow(F.col("_own") - F.col("mean"), 2)
    spread = join_null_safe(parts, whole.select(*keys, "mean"), keys).groupBy(*keys).agg(F.sum(moved).alias("m2"))
    renamed = spread.withColumnsRenamed({key: f"_spread_{key}" for key in keys})
    same = [F.col(key).eqNullSafe(F.col(f"_spread_{key}")) for key in keys]
    return whole.join(renamed, same, "left").select(
        *keys, "observed", "n", "total", "mean", "m2", "lowest", "highest"
    )


def average() -> Column:
    """Exact mean of a row of moments."""
    return (F.col("total") / F.nullif(F.col("n"), F.lit(0))).cast("decimal(24,10)")


def spread() -> Column:
    """Sample standard deviation of a row of moments."""
    return F.sqrt(F.when(F.col("n") > 1, F.col("m2") / (F.col("n") - 1)))


def region_bitmaps(star: EconomicStar, numbers: DataFrame) -> DataFrame:
    """Bitmaps of the numbers of the regions that report an indicator in a year, by bucket of numbers."""
    number = F.col("number")
    return (
        marts.dated(star.fact, star.dim_date)
        .join(numbers, "region_key")
        .groupBy("year", "indicator_key", F.bitmap_bucket_number(number).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("regions"))
    )


def region_counts(bitmaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Exact number of distinct regions of each `keys`, of any span of years."""
    return (
        bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_count(F.bitmap_or_agg("regions")).alias("_set"))
        .groupBy(*keys).agg(F.sum("_set").alias("region_count"))
    )


def number_regions(house: Warehouse) -> DataFrame:
    """Numbers of all regions of the dimension; new ones get theirs, others keep what they have.

    Numbers are distinct and need not be without gaps: those of one writing task follow each other.
    """
    regions = house.table("warehouse", "dim_region").select("region_key")
    least = 1
    if house.exists(*NUMBERS):
        known = house.table(*NUMBERS)
        regions = regions.join(known, "region_key", "left_anti")
        least += known.agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]
        if regions.isEmpty():
            return known
    house.load(regions.withColumn("number", F.monotonically_increasing_id() + least), *NUMBERS)
    return house.table(*NUMBERS)


def exist(house: Warehouse) -> bool:
    return all(house.spark.catalog.tableExists(house.name("mart", name)) for name in (MOMENTS, REGIONS))


def build(house: Warehouse) -> None:
    """Build the summaries of all years; from then on they follow whenever the marts do."""
    star, numbers = house.economic_star(), number_regions(house)
    house.build_mart(series_moments(star), MOMENTS)
    house.build_mart(region_bitmaps(star, numbers), REGIONS)


def follow(house: Warehouse, years: Sequence[int]) -> None:
    """Summarise these years anew."""
    star, numbers = house.economic_star(), number_regions(house)
    own = replace(star, fact=star.fact.where(F.col("year").isin(list(years))))
    house.replace_years(series_moments(own), MOMENTS, years)
    house.replace_years(region_bitmaps(own, numbers), REGIONS, years)


def _named(house: Warehouse) -> DataFrame:
    star = house.economic_star()
    return (
        house.table("mart", MOMENTS)
        .join(star.dim_region.select("region_key", "region_name"), "region_key")
        .join(star.dim_indicator.select("indicator_key", "indicator_name"), "indicator_key")
    )


def long_term_trend(house: Warehouse, ordered: bool = True) -> DataFrame:
    """`analytics.long_term_trend` from the stored moments."""
    keys = ["indicator_name", "region_name"]
    table = merged_moments(_named(house), keys).select(
        *keys, F.col("observed").alias("years_observed"),
        F.round(average(), 6).alias("avg_value"), F.round(spread(), 6).alias("stddev_value"),
        growth_pct(F.col("highest"), F.col("lowest")).alias("total_change_pct"),
    )
    return table.orderBy(*keys) if ordered else table


def volatility(house: Warehouse, ordered: bool = True) -> DataFrame:
    """`analytics.volatility` from the stored moments."""
    keys = ["indicator_name", "region_name"]
    mean = F.nullif(F.col("mean"), F.lit(0.0))
    table = merged_moments(_named(house), keys).where("observed > 1").select(
        *keys, F.round(average(), 6).alias("mean_value"), F.round(spread(), 6).alias("stddev_value"),
        F.round(spread() / mean * 100, 2).alias("coefficient_of_variation"),
    )
    return table.orderBy(F.col("coefficient_of_variation").asc_nulls_last(), *keys) if ordered else table


def reporting_regions(house: Warehouse, first: int | None = None, last: int | None = None) -> DataFrame:
    """Distinct regions that reported each indicator in a span of years, its ends included."""
    bitmaps = house.table("mart", REGIONS)
    if first is not None:
        bitmaps = bitmaps.where(F.col("year") >= first)
    if last is not None:
        bitmaps = bitmaps.where(F.col("year") <= last)
    return region_counts(bitmaps, ["indicator_key"])


def economic_overview(house: Warehouse) -> DataFrame:
    """`marts.economic_overview` from the stored moments and bitmaps, without reading a fact."""
    star = house.economic_star()
    keys = ["year", "indicator_key"]
    totals = (
        house.table("mart", MOMENTS)
        .join(star.dim_region.select("region_key"), "region_key", "left_semi")
        .groupBy(*keys).agg(F.sum("total").alias("national_value"))
        .join(region_counts(house.table("mart", REGIONS), keys), keys)
    )
    return marts.overview_of(totals, star.dim_indicator)
