"""Dashboard and read queries over stored marts and dimensions.

Each takes the mart it reads. No match gives an empty DataFrame. Ties in limited queries are
decided by the key columns, so that the rows returned are determined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumbung.functions.columns import growth_status

MAX_LIMIT = 100


def _checked(limit: int) -> int:
    if not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must be between 1 and {MAX_LIMIT}, got {limit}")
    return limit


def _matching(df: DataFrame, **wanted: object) -> DataFrame:
    """Equality filters; None, 0 and the empty string mean no filter."""
    for column, value in wanted.items():
        if value:
            df = df.where(F.col(column) == value)
    return df


# Dashboard cards and panels


def _in_latest_year(overview: DataFrame, indicator_key: str, *columns: Column) -> DataFrame:
    """The indicator's row in the latest year of the whole mart, in one pass over it."""
    mine = F.col("indicator_key") == indicator_key
    picked = F.max_by(F.struct("year", *columns), F.when(mine, F.col("year")))
    return (
        overview.agg(F.max("year").alias("_latest"), picked.alias("_row"))
        .where(F.col("_row.year") == F.col("_latest"))
        .select("_row.*")
    )


def kpi_current_value(overview: DataFrame, indicator_key: str) -> DataFrame:
    return _in_latest_year(
        overview, indicator_key,
        F.col("indicator_name"), F.col("national_value").alias("current_value"), F.col("unit"),
    ).select("indicator_name", "current_value", "unit", F.col("year").alias("latest_period"))


def kpi_growth(overview: DataFrame, indicator_key: str) -> DataFrame:
    return _in_latest_year(
        overview, indicator_key,
        F.col("indicator_name"), F.col("national_growth_pct").alias("yoy_growth"),
    ).select("indicator_name", "yoy_growth", "year")


def kpi_region_count(overview: DataFrame, indicator_key: str) -> DataFrame:
    return _in_latest_year(
        overview, indicator_key, F.col("region_count"), F.col("indicator_name")
    ).select("region_count", "indicator_name")


def kpi_latest_period(overview: DataFrame, indicator_key: str) -> DataFrame:
    return overview.where(F.col("indicator_key") == indicator_key).agg(
        F.max("year").alias("latest_year"), F.count_distinct("year").alias("years_available")
    )


def trend_chart(trend: DataFrame, indicator_key: str) -> DataFrame:
    return (
        trend.where(F.col("indicator_key") == indicator_key)
        .select(
            "year", "national_value", "previous_value", "growth_pct", "indicator_name", "unit"
        )
        .orderBy("year")
    )


def _regions_in(performance: DataFrame, indicator_key: str, year: int) -> DataFrame:
    return performance.where(
        (F.col("indicator_key") == indicator_key) & (F.col("year") == year)
    )


def ranking_table(performance: DataFrame, indicator_key: str, year: int) -> DataFrame:
    return (
        _regions_in(performance, indicator_key, year)
        .select("region_name", "value", "regional_rank", "growth_pct", "year")
        .orderBy("regional_rank")
    )


def growth_table(performance: DataFrame, indicator_key: str, year: int) -> DataFrame:
    return (
        _regions_in(performance, indicator_key, year)
        .select(
            "region_name", "value", "previous_value", "growth_pct",
            growth_status(F.col("growth_pct")).alias("growth_status"), "year",
        )
        .orderBy(F.col("growth_pct").desc_nulls_first())
    )


def region_filter(performance: DataFrame, indicator_key: str) -> DataFrame:
    return (
        performance.where(F.col("indicator_key") == indicator_key)
        .select("region_key", "region_name")
        .distinct()
        .orderBy("region_name")
    )


def metadata_panel(dim_indicator: DataFrame, indicator_key: str) -> DataFrame:
    return dim_indicator.where(F.col("indicator_key") == indicator_key).select(
        "indicator_name", "unit", "frequency", "subject_name", "category_name", "concept",
        "definition", "classification", "measure", "data_source", "aggregation_method",
    )


def dataset_context(dim_dataset: DataFrame) -> DataFrame:
    """One dataset row: the one with the smallest key."""
    return (
        dim_dataset.orderBy("dataset_key", "table_id")
        .limit(1)
        .select(
            "table_id", "table_code", "title", F.col("subject").alias("dataset_subject"),
            "available_years", "source_system",
        )
    )


# Read queries


def overview(economic_overview: DataFrame) -> DataFrame:
    """Latest value and growth of every indicator, each in its own latest year; one pass."""
    latest = F.max_by(F.struct("national_value", "national_growth_pct"), "year")
    return (
        economic_overview.groupBy("indicator_key", "indicator_name", "unit", "frequency")
        .agg(
            F.max("year").alias("latest_year"),
            F.count_distinct("year").alias("years_available"),
            F.max("region_count").alias("region_count"),
            latest.alias("_latest"),
        )
        .select(
            "indicator_key", "indicator_name", "unit", "frequency", "latest_year",
            "years_available", "region_count",
            F.col("_latest.national_value").alias("current_value"),
            F.col("_latest.national_growth_pct").alias("yoy_growth"),
        )
        .orderBy("indicator_name")
    )


def economic_trend(trend: DataFrame, indicator_key: str | None = None) -> DataFrame:
    return (
        _matching(trend, indicator_key=indicator_key)
        .select(
            "year", "indicator_key", "indicator_name", "unit", "national_value",
            "previous_value", "growth_pct",
        )
        .orderBy("indicator_name", "year")
    )


_REGIONAL = (
    "year", "region_key", "region_name", "indicator_key", "indicator_name", "value",
    "regional_rank", "previous_value", "growth_pct",
)


def economic_regional(
    performance: DataFrame, indicator_key: str | None = None, year: int | None = None
) -> DataFrame:
    return (
        _matching(performance, indicator_key=indicator_key, year=year)
        .select(*_REGIONAL)
        .orderBy("year", "regional_rank")
    )


def indicators(economic_overview: DataFrame) -> DataFrame:
    return (
        economic_overview.select("indicator_key", "indicator_name", "unit", "frequency")
        .distinct()
        .orderBy("indicator_name")
    )


def regional_ranking(
    performance: DataFrame,
    indicator_key: str | None = None,
    year: int | None = None,
    limit: int = 20,
) -> DataFrame:
    return (
        _matching(performance, indicator_key=indicator_key, year=year)
        .select(*_REGIONAL, growth_status(F.col("growth_pct")).alias("growth_status"))
        .orderBy(F.col("year").desc_nulls_first(), "regional_rank", "indicator_key", "region_key")
        .limit(_checked(limit))
    )


def region_detail(performance: DataFrame, region_key: str) -> DataFrame:
    return (
        performance.where(F.col("region_key") == region_key)
        .select(*_REGIONAL)
        .orderBy("indicator_name", "year")
    )


def trade_trend_by_year(trend: DataFrame, year: int | None = None) -> DataFrame:
    return (
        _matching(trend, year=year)
        .select(
            "year", "trade_flow", "total_value_usd", "total_weight_kg", "transaction_count"
        )
        .orderBy("year", "trade_flow")
    )


def top_commodities(
    commodity: DataFrame,
    year: int | None = None,
    trade_flow: str | None = None,
    limit: int = 20,
) -> DataFrame:
    return (
        _matching(commodity, year=year, trade_flow=trade_flow)
        .select(
            "year", "trade_flow", "product_code", "product_name", "total_value_usd",
            "total_weight_kg", "commodity_rank",
        )
        .orderBy(
            F.col("year").desc_nulls_first(), "commodity_rank", "trade_flow", "product_code"
        )
        .limit(_checked(limit))
    )


def top_partners(
    partner: DataFrame,
    year: int | None = None,
    trade_flow: str | None = None,
    limit: int = 20,
) -> DataFrame:
    return (
        _matching(partner, year=year, trade_flow=trade_flow)
        .select(
            "year", "trade_flow", "country_code", "country_name", "total_value_usd",
            "partner_rank",
        )
        .orderBy(
            F.col("year").desc_nulls_first(), "partner_rank", "trade_flow", "country_code"
        )
        .limit(_checked(limit))
    )


def trade_balance(bridge: DataFrame) -> DataFrame:
    return bridge.select(
        "year", "national_value", "national_growth_pct", "export_total_usd",
        "import_total_usd", "trade_balance_usd",
    ).orderBy(F.col("year").asc_nulls_last())


def indicator_metadata(dim_indicator: DataFrame, indicator_key: str) -> DataFrame:
    return (
        dim_indicator.where(F.col("indicator_key") == indicator_key)
        .select(
            "indicator_key", "indicator_code", "indicator_name", "subject_name",
            "category_name", "unit", "frequency", "concept", "definition", "classification",
            "measure", "data_source", "aggregation_method",
        )
        .limit(1)
    )


def indicator_list(dim_indicator: DataFrame) -> DataFrame:
    return dim_indicator.select(
        "indicator_key", "indicator_code", "indicator_name", "subject_name", "category_name",
        "unit", "frequency", "data_source",
    ).orderBy("indicator_name")


def glossary_list(dim_glossary: DataFrame) -> DataFrame:
    return dim_glossary.select(
        "glossary_key", "glossary_id", "indicator_name", "concept", "definition",
        "classification", "measure", "unit", "data_source",
    ).orderBy(F.col("indicator_name").asc_nulls_last())


def flow_chart(trend: DataFrame) -> DataFrame:
    """One row per year, one column per flow."""
    return (
        trend.groupBy("year").pivot("trade_flow", ["Ekspor", "Impor"]).sum("total_value_usd")
        .orderBy("year")
    )
