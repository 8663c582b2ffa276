"""Builders of the dimension and fact tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.functions.columns import (
    constant_rows,
    match_name,
    numeric,
    period_date_key,
    year_date_key,
)
from lumbung.schemas import DIMENSIONS, MONEY, SOURCE_SYSTEM

# The calendar that a valid period may lie in.
FIRST_YEAR, LAST_YEAR = 1900, 2200

# The national region.
NATIONAL_CODE, NATIONAL_NAME = "0000", "INDONESIA"

# Trade flow codes and names.
TRADE_FLOWS = [("ekspor", "Ekspor"), ("impor", "Impor")]

# Fixed value: endpoint of glossary entries.
GLOSSARY_ENDPOINT = "glosarium"

ENRICHED = ("concept", "definition", "classification", "measure", "data_source")


def _require(df: DataFrame, columns: Sequence[str]) -> None:
    for column in columns:
        if column not in df.columns:
            raise ValueError(f"column {column} is required")


def _conform(df: DataFrame, table: str) -> DataFrame:
    """Columns of a dimension in order and type; absent ones are NULL.

    An `ordinal`, the place in the source, is carried along for the load, which sets the version.
    """
    present, spec = set(df.columns), DIMENSIONS[table]
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in spec.schema.fields if f.name != spec.version or f.name in present
        ],
        *_carried(df, "ordinal"),
    )


def _default_key(df: DataFrame, key: str, code: str) -> DataFrame:
    return df if key in df.columns else df.withColumn(key, F.col(code))


# Dates


def _date_rows(years: DataFrame) -> DataFrame:
    return years.select(
        year_date_key(F.col("year")).alias("date_key"),
        F.make_date("year", F.lit(1), F.lit(1)).alias("full_date"),
        F.col("year").cast("int").alias("year"),
        F.lit(1).alias("quarter"),
        F.lit(1).alias("month"),
        F.lit("January").alias("month_name"),
        F.lit("YEAR").alias("period_type"),
    )


def build_dim_date(years: DataFrame) -> DataFrame:
    """One reference day per distinct value of the column `year`."""
    return _date_rows(years.select("year").where(F.col("year").isNotNull()).distinct())


def build_dim_date_from_keys(keys: DataFrame, period_type: str = "MONTH") -> DataFrame:
    """Dates of the distinct values of `date_key`; keys that are no date drop out."""
    day = F.try_to_timestamp(F.col("date_key").cast("string"), F.lit("yyyyMMdd")).cast("date")
    dated = (
        keys.select("date_key").distinct().withColumn("full_date", day)
        .where(F.col("full_date").isNotNull())
    )
    return _calendar_columns(dated, period_type)


def _calendar_columns(dated: DataFrame, period_type: str) -> DataFrame:
    return dated.select(
        F.col("date_key").cast("int").alias("date_key"),
        "full_date",
        F.year("full_date").alias("year"),
        F.quarter("full_date").alias("quarter"),
        F.month("full_date").alias("month"),
        F.date_format("full_date", "MMMM").alias("month_name"),
        F.lit(period_type).alias("period_type"),
    )


def calendar(spark: SparkSession, period_type: str = "YEAR") -> DataFrame:
    """Every YEAR, QUARTER or MONTH of the valid range, without reading any data."""
    if period_type == "YEAR":
        return _date_rows(
            spark.range(FIRST_YEAR, LAST_YEAR + 1, 1, 1).select(
                F.col("id").cast("int").alias("year")
            )
        )
    step = {"QUARTER": 3, "MONTH": 1}[period_type]
    month = F.col("id").cast("int")
    first = F.make_date(F.floor(month / 12).cast("int"), month % 12 + 1, F.lit(1))
    dated = spark.range(FIRST_YEAR * 12, (LAST_YEAR + 1) * 12, step, 1).select(
        first.alias("full_date"), F.date_format(first, "yyyyMMdd").alias("date_key")
    )
    return _calendar_columns(dated, period_type)


# Regions


def build_dim_region(records: DataFrame) -> DataFrame:
    """Region rows; the key defaults to the code."""
    return _conform(_default_key(records, "region_key", "region_code"), "dim_region")


def dim_region_for_domain(spark: SparkSession, domain: str, regions: DataFrame | None) -> DataFrame:
    """The national row and the regions that values of `domain` map to.

    Without a region list a domain other than the national one gets a placeholder row.
    """
    names = ("region_code", "region_name", "province_name")
    national = constant_rows(spark, names, [(NATIONAL_CODE, NATIONAL_NAME, NATIONAL_NAME)])
    if regions is not None:
        listed = regions.where(F.col("region_code") != NATIONAL_CODE).select(
            F.col("region_code").cast("string").alias("region_code"),
            "region_name",
            F.col("region_name").alias("province_name"),
        )
        national = national.unionByName(listed)
    elif domain and domain != NATIONAL_CODE:
        fallback = constant_rows(spark, names, [(str(domain), f"Region {domain}", None)])
        national = national.unionByName(fallback)
    return build_dim_region(national)


# Indicators


def build_dim_indicator(records: DataFrame) -> DataFrame:
    """Indicator rows; the key defaults to the code, the aggregation method to SUM."""
    keyed = _default_key(records, "indicator_key", "indicator_code")
    if "aggregation_method" not in keyed.columns:
        keyed = keyed.withColumn("aggregation_method", F.lit("SUM"))
    return _conform(keyed, "dim_indicator")


def dim_indicator_from_staged(described: DataFrame) -> DataFrame:
    """Indicators from staged variables beside the metadata of their table."""
    return build_dim_indicator(
        described.select(
            F.col("variable_id").cast("string").alias("indicator_code"),
            F.col("variable_name").alias("indicator_name"),
            F.col("subject").alias("subject_name"),
            "unit",
            "frequency",
            *_carried(described, "ordinal"),
        )
    )


def enrich_indicators(
    dim_indicator: DataFrame, glossary: DataFrame, ordinal: str | Column = "ordinal"
) -> DataFrame:
    """Fill the glossary columns by indicator name; of equal names the last entry wins.

    `ordinal` is the position of an entry in its source. Names are compared stripped and in
    lower case.
    """
    entries = (
        glossary.groupBy(match_name(F.col("indicator_name")).alias("_name"))
        .agg(F.max_by(F.struct(*ENRICHED), ordinal).alias("_entry"))
        .where(F.col("_name").isNotNull())
    )
    named = dim_indicator.drop(*ENRICHED).withColumn("_name", match_name(F.col("indicator_name")))
    joined = named.join(entries, "_name", "left")
    return joined.select(
        *[
            F.col(f"_entry.{name}").alias(name) if name in ENRICHED else F.col(name)
            for name in (*dim_indicator.drop(*ENRICHED).columns, *ENRICHED)
        ]
    )


# Metadata


def build_dim_dataset(records: DataFrame, available_years: str | Column | None = None) -> DataFrame:
    """Dataset rows keyed by position; `position` counts from 0 within a source."""
    years = F.lit(available_years) if isinstance(available_years, str) else available_years
    if years is not None:
        records = records.withColumn("available_years", years)
    keyed = records.withColumn("dataset_key", F.col("position") + 1).withColumn(
        "source_system", F.lit(SOURCE_SYSTEM)
    )
    return _conform(keyed, "dim_dataset")


def build_dim_glossary(records: DataFrame) -> DataFrame:
    """Glossary rows keyed by position; `position` counts from 0 within a source."""
    keyed = records.withColumn("glossary_key", F.col("position") + 1).withColumn(
        "endpoint", F.lit(GLOSSARY_ENDPOINT)
    )
    return _conform(keyed, "dim_glossary")


# Trade dimensions


def build_dim_product(records: DataFrame) -> DataFrame:
    return _code_dimension(records, "product")


def build_dim_country(records: DataFrame) -> DataFrame:
    return _code_dimension(records, "country")


def _code_dimension(records: DataFrame, entity: str) -> DataFrame:
    """One row per code with its last name in source order, the greatest one without an order."""
    code, name = F.col(f"{entity}_code").cast("string"), F.col(f"{entity}_name")
    ordered = "ordinal" in records.columns
    order = F.when(name.isNotNull(), F.col("ordinal") if ordered else name)
    rows = records.groupBy(code.alias(f"{entity}_code")).agg(
        F.max_by(name, order).alias(f"{entity}_name"),
        *([F.coalesce(F.max(order), F.max("ordinal")).alias("ordinal")] if ordered else []),
    )
    return _conform(rows.withColumn(f"{entity}_key", F.col(f"{entity}_code")), f"dim_{entity}")


def build_dim_trade_flow(spark: SparkSession) -> DataFrame:
    return constant_rows(spark, ("trade_flow", "flow_name"), TRADE_FLOWS)


# Facts


def _carried(df: DataFrame, *columns: str) -> list[str]:
    return [column for column in columns if column in df.columns]


def build_fact_economic(staged: DataFrame) -> DataFrame:
    """Fact rows of staged observations, in source order if staged rows carry `ordinal`.

    Several staged rows may share a grain; the keyed load keeps the last of them.
    """
    _require(staged, ["variable_id", "region_id", "year", "value"])
    return staged.select(
        year_date_key(F.col("year")).alias("date_key"),
        F.col("region_id").alias("region_key"),
        F.col("variable_id").alias("indicator_key"),
        "value",
        "year",
        *_carried(staged, "source_key", "ordinal"),
    )


def build_fact_trade(records: DataFrame) -> DataFrame:
    """Fact rows of trade records; amounts that are no number become NULL."""
    _require(
        records,
        ["trade_type", "commodity_code", "country_code", "port_code", "period", "value_usd",
         "net_weight_kg"],
    )
    key = period_date_key(F.col("period"))
    return records.select(
        key.alias("date_key"),
        F.col("commodity_code").alias("product_key"),
        F.col("country_code").alias("country_key"),
        F.col("port_code").alias("port_key"),
        "trade_type",
        numeric(F.col("value_usd"), MONEY).alias("value_usd"),
        numeric(F.col("net_weight_kg"), MONEY).alias("net_weight_kg"),
        F.floor(key / 10000).cast("int").alias("year"),
        *_carried(records, "source_key", "ordinal"),
    )


def region_codes_by_domain(regions: DataFrame) -> DataFrame:
    """One row per domain with its region codes in list order.

    A list is one response of the region service, so its length is the number of regions of
    that level.
    """
    pair = F.struct("position", F.col("region_code").cast("string").alias("code"))
    return regions.groupBy("domain").agg(
        F.transform(F.sort_array(F.collect_list(pair)), lambda p: p["code"]).alias("region_codes")
    )
