"""Data marts over the economic and the trade star.

Facts are reduced on their keys before any dimension attribute is joined, so what a join or
a window shuffles is already aggregated. Dimensions carry no broadcast hint: Catalyst and
AQE broadcast the ones they measure as small and shuffle the others.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumbung.functions.columns import growth_pct
from lumbung.functions.ranking import rank_desc
from lumbung.schemas import EconomicStar, TradeStar

# Stores rows under a label and gives them back read from there.
Keep = Callable[[DataFrame, str], DataFrame]


def dated(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Fact rows with the year of their date; rows without a known date drop out.

    A stored fact is partitioned by the year of its date, so the year is part of the join: a filter
    on it prunes the fact's partitions. A fact without that column is joined on the date alone.
    """
    keys = [key for key in ("date_key", "year") if key in fact.columns]
    return fact.join(dim_date.select("date_key", "year"), keys)


def _with_growth(df: DataFrame, keys: list[str], value: str, previous: str, growth: str) -> DataFrame:
    """Previous observed value in the series `keys` and the growth over it.

    A series has one row per period, which bounds the window by the calendar.
    """
    series = Window.partitionBy(*keys).orderBy("year")
    return df.withColumn(previous, F.lag(value).over(series)).withColumn(
        growth, growth_pct(F.col(value), F.col(previous))
    )


def indicator_trend(star: EconomicStar) -> DataFrame:
    """National total per year and indicator with its growth."""
    totals = (
        dated(star.fact, star.dim_date)
        .groupBy("year", "indicator_key")
        .agg(F.sum("value").alias("national_value"))
    )
    described = totals.join(
        star.dim_indicator.select("indicator_key", "indicator_name", "unit", "frequency"),
        "indicator_key",
    )
    return _with_growth(
        described, ["indicator_key"], "national_value", "previous_value", "growth_pct"
    ).select(
        "year", "indicator_key", "indicator_name", "unit", "frequency",
        "national_value", "previous_value", "growth_pct",
    )


def regional_observations(star: EconomicStar) -> DataFrame:
    """Fact rows with year, region name and indicator name."""
    return (
        dated(star.fact, star.dim_date)
        .select("year", "region_key", "indicator_key", "value")
        .join(star.dim_region.select("region_key", "region_name"), "region_key")
        .join(star.dim_indicator.select("indicator_key", "indicator_name"), "indicator_key")
    )


def regional_growth(star: EconomicStar) -> DataFrame:
    """Observations with previous value and growth within region and indicator."""
    return _with_growth(
        regional_observations(star),
        ["region_key", "indicator_key"], "value", "previous_value", "growth_pct",
    )


def regional_performance(star: EconomicStar) -> DataFrame:
    """Rank of each region within year and indicator, with growth within the region."""
    ranked = rank_desc(
        regional_growth(star), ["year", "indicator_key"], "value", "regional_rank"
    )
    return ranked.select(
        "year", "region_key", "region_name", "indicator_key", "indicator_name", "value",
        "regional_rank", "previous_value", "growth_pct",
    )


def economic_overview(star: EconomicStar) -> DataFrame:
    """National total, growth and number of reporting regions, with indicator context."""
    totals = (
        dated(star.fact, star.dim_date)
        .join(star.dim_region.select("region_key"), "region_key", "left_semi")
        .groupBy("year", "indicator_key")
        .agg(
            F.sum("value").alias("national_value"),
            F.count_distinct("region_key").alias("region_count"),
        )
    )
    return overview_of(totals, star.dim_indicator)


def overview_of(totals: DataFrame, dim_indicator: DataFrame) -> DataFrame:
    """`economic_overview` from national_value and region_count per year and indicator."""
    context = dim_indicator.select(
        "indicator_key", "indicator_name", "unit", "frequency", "concept", "definition",
        "data_source",
    )
    return _with_growth(
        totals.join(context, "indicator_key"),
        ["indicator_key"],
        "national_value",
        "previous_national_value",
        "national_growth_pct",
    ).select(
        "year", "indicator_key", "indicator_name", "unit", "frequency", "concept",
        "definition", "data_source", "national_value", "previous_national_value",
        "national_growth_pct", "region_count",
    )


def economic_summary(star: EconomicStar) -> DataFrame:
    """Average value per year, region name and indicator name."""
    return (
        regional_observations(star)
        .groupBy("year", "region_name", "indicator_name")
        .agg(F.avg("value").alias("avg_value"))
    )


def growth_divergence(star: EconomicStar) -> DataFrame:
    """National growth against the fastest and the slowest growing region.

    Equal growth is decided by the smaller region key.
    """
    return divergence(indicator_trend(star), regional_growth(star))


def divergence(trend: DataFrame, performance: DataFrame) -> DataFrame:
    """`growth_divergence` from the marts that hold national trend and regional growth."""
    grown = performance.where(F.col("growth_pct").isNotNull())
    extremes = grown.groupBy("year", "indicator_key").agg(
        F.min(F.struct((-F.col("growth_pct")).alias("order"), "region_key", "region_name")).alias("top"),
        F.min(F.struct(F.col("growth_pct").alias("order"), "region_key", "region_name")).alias("bottom"),
    )
    return (
        trend
        .join(extremes, ["year", "indicator_key"], "left")
        .select(
            "year", "indicator_key", "indicator_name", "national_value",
            F.col("growth_pct").alias("national_growth_pct"),
            F.col("top.region_name").alias("top_region"),
            (-F.col("top.order")).alias("top_growth_pct"),
            F.col("bottom.region_name").alias("bottom_region"),
            F.col("bottom.order").alias("bottom_growth_pct"),
        )
    )


def national_by_method(star: EconomicStar) -> DataFrame:
    """National value by the indicator's declared method: SUM, AVG, or NULL for N/A."""
    totals = (
        dated(star.fact, star.dim_date)
        .groupBy("year", "indicator_key")
        .agg(F.sum("value").alias("_sum"), F.avg("value").alias("_avg"))
    )
    method = F.col("aggregation_method")
    return totals.join(
        star.dim_indicator.select("indicator_key", "indicator_name", "aggregation_method"),
        "indicator_key",
    ).select(
        "year", "indicator_key", "indicator_name", "aggregation_method",
        F.when(method == "SUM", F.col("_sum"))
        .when(method == "AVG", F.col("_avg"))
        .alias("national_value"),
    )


def _trade_sums(star: TradeStar, *keys: str) -> DataFrame:
    return (
        dated(star.fact, star.dim_date)
        .groupBy("year", *keys)
        .agg(
            F.sum("value_usd").alias("_usd"),
            F.sum("net_weight_kg").alias("_kg"),
            F.count(F.lit(1)).alias("_rows"),
        )
    )


def _or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def _flows(star: TradeStar) -> DataFrame:
    return star.dim_trade_flow.select(
        F.col("trade_flow").alias("trade_type"), F.col("flow_name").alias("trade_flow")
    )


def trade_trend(star: TradeStar) -> DataFrame:
    """Value, weight and number of trade rows per year and flow."""
    return (
        _trade_sums(star, "trade_type")
        .join(_flows(star), "trade_type")
        .select(
            "year", "trade_flow",
            _or_zero("_usd").alias("total_value_usd"),
            _or_zero("_kg").alias("total_weight_kg"),
            F.col("_rows").alias("transaction_count"),
        )
    )


def trade_regional(star: TradeStar) -> DataFrame:
    """Value, weight and number of trade rows per year, port and trade type."""
    return _trade_sums(star, "port_key", "trade_type").select(
        "year", "port_key", "trade_type",
        _or_zero("_usd").alias("value_usd"),
        _or_zero("_kg").alias("weight_kg"),
        F.col("_rows").alias("record_count"),
    )


def trade_commodity(star: TradeStar, keep: Keep | None = None) -> DataFrame:
    """Products ranked by value within year and flow; a NULL total ranks first.

    A rank reads the sums twice, once for the values alone and once for the rows. As the two need
    other columns, Catalyst shares nothing between them: without `keep` the fact is summed twice.
    """
    sums = (
        _trade_sums(star, "trade_type", "product_key")
        .join(_flows(star), "trade_type")
        .join(star.dim_product, "product_key")
        .select("year", "trade_flow", "product_code", "product_name", "_usd", "_kg")
    )
    sums = keep(sums, "commodity-sums") if keep else sums
    ranked = rank_desc(sums, ["year", "trade_flow"], "_usd", "commodity_rank")
    return ranked.select(
        "year", "trade_flow", "product_code", "product_name",
        _or_zero("_usd").alias("total_value_usd"),
        _or_zero("_kg").alias("total_weight_kg"),
        "commodity_rank",
    )


def trade_partner(star: TradeStar, keep: Keep | None = None) -> DataFrame:
    """Countries ranked by value within year and flow; a NULL total ranks first.

    `keep` is as in `trade_commodity`: a filter on the mart reaches one of the two reads only.
    """
    sums = (
        _trade_sums(star, "trade_type", "country_key")
        .join(_flows(star), "trade_type")
        .join(star.dim_country, "country_key")
        .select("year", "trade_flow", "country_code", "country_name", "_usd")
    )
    sums = keep(sums, "partner-sums") if keep else sums
    ranked = rank_desc(sums, ["year", "trade_flow"], "_usd", "partner_rank")
    return ranked.select(
        "year", "trade_flow", "country_code", "country_name",
        _or_zero("_usd").alias("total_value_usd"), "partner_rank",
    )


def economic_trade_bridge(
    overview: DataFrame, trend: DataFrame, fill_trade_years: bool = False
) -> DataFrame:
    """National values beside exports, imports and balance of the same year.

    The economic side has one row per indicator, so a year's trade totals repeat. Years with
    trade only come out with a NULL year, or with their year if `fill_trade_years` is set.
    """
    usd = F.col("total_value_usd")
    exported, imported = F.col("trade_flow") == "Ekspor", F.col("trade_flow") == "Impor"
    trade = trend.groupBy(F.col("year").alias("_trade_year")).agg(
        F.sum(F.when(exported, usd).otherwise(0)).alias("_export"),
        F.sum(F.when(imported, usd).otherwise(0)).alias("_import"),
        F.sum(F.when(exported, usd).when(imported, -usd).otherwise(0)).alias("_balance"),
    )
    year = F.coalesce("year", "_trade_year") if fill_trade_years else F.col("year")
    return (
        overview.select("year", "national_value", "national_growth_pct")
        .join(trade, F.col("year") == F.col("_trade_year"), "full_outer")
        .select(
            year.alias("year"), "national_value", "national_growth_pct",
            _or_zero("_export").alias("export_total_usd"),
            _or_zero("_import").alias("import_total_usd"),
            _or_zero("_balance").alias("trade_balance_usd"),
        )
    )
