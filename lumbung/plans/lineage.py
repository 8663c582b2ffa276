"""From a number to what it was made of: mart rows to fact rows, fact rows to landed files.

Nothing is stored beside the `source_key` of a fact row. Marts aggregate by their keys, so the facts of
a mart row are found by joining back on these keys, however many there are, and those of the previous
value by joining on the key of the row before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumbung.operators.load import Warehouse
from lumbung.plans import marts

ECONOMIC, TRADE = "fact_economic", "fact_trade"
#: The key of a mart row, by the mart; the fact it is made of.
MART_KEYS: dict[str, tuple[str, tuple[str, ...]]] = {
    "indicator_trend": (ECONOMIC, ("year", "indicator_key")),
    "regional_performance": (ECONOMIC, ("year", "region_key", "indicator_key")),
    "economic_overview": (ECONOMIC, ("year", "indicator_key")),
    "economic_summary": (ECONOMIC, ("year", "region_name", "indicator_name")),
    "growth_divergence": (ECONOMIC, ("year", "indicator_key")),
    "trade_trend": (TRADE, ("year", "trade_flow")),
    "trade_regional": (TRADE, ("year", "port_key", "trade_type")),
    "trade_commodity": (TRADE, ("year", "trade_flow", "product_code")),
    "trade_partner": (TRADE, ("year", "trade_flow", "country_code")),
}
#: Marts with a previous value: the series in which a row has a row before.
SERIES = {
    "indicator_trend": ("indicator_key",),
    "economic_overview": ("indicator_key",),
    "regional_performance": ("region_key", "indicator_key"),
    "growth_divergence": ("region_key", "indicator_key"),
}
BRIDGE = "economic_trade_bridge"


def trace(fact: DataFrame, files: DataFrame) -> DataFrame:
    """Fact rows with the landed file that their value comes from.

    `files` has source_key and doc, as `loaded_files` and the staged rows do.
    """
    sources = files.groupBy("source_key").agg(F.max("doc").alias("doc"))
    return fact.join(sources, "source_key", "left")


def facts_of(warehouse: Warehouse, fact: str) -> DataFrame:
    """Rows of a fact that the marts count, with the names that marts are keyed by."""
    if fact == ECONOMIC:
        star = warehouse.economic_star()
        return (
            marts.dated(star.fact, star.dim_date)
            .join(star.dim_region.select("region_key", "region_name"), "region_key", "left")
            .join(star.dim_indicator.select("indicator_key", "indicator_name"), "indicator_key")
            .select(
                "year", "region_key", "region_name", "indicator_key", "indicator_name", F.col("fact_key"),
                F.col("value").alias("amount"), "source_key",
            )
        )
    star = warehouse.trade_star()
    flows = star.dim_trade_flow.select(
        F.col("trade_flow").alias("trade_type"), F.col("flow_name").alias("trade_flow")
    )
    return (
        marts.dated(star.fact, star.dim_date)
        .join(flows, "trade_type", "left")
        .join(star.dim_product.select("product_key", "product_code"), "product_key", "left")
        .join(star.dim_country.select("country_key", "country_code"), "country_key", "left")
        .select(
            "year", "port_key", "trade_type", "trade_flow", "product_code", "country_code",
            F.col("trade_key").alias("fact_key"), F.col("value_usd").alias("amount"), "source_key",
        )
    )


def trace_mart(
    warehouse: Warehouse, mart: str, files: DataFrame, wanted: Column | None = None
) -> DataFrame:
    """The facts of mart rows and their files: mart key, `role`, fact_key, amount, source_key, doc.

    `role` is `current` for the facts that a row aggregates and `previous` for those of the value it
    is compared with. `wanted` chooses mart rows, all of them if it is None. Of the bridge, a row's
    key is its year; its economic and its trade facts have the roles `economic`, `previous` and
    `trade`. The regions that a rank compares are the `current` facts of the other rows of its year.
    """
    if mart != BRIDGE and mart not in MART_KEYS:
        raise ValueError(f"unknown mart {mart}")
    rows = warehouse.table("mart", mart)
    rows = rows if wanted is None else rows.where(wanted)
    if mart == BRIDGE:
        return _trace_bridge(warehouse, files, rows)
    fact, keys = MART_KEYS[mart]
    chosen, detail = rows.select(*keys).distinct(), facts_of(warehouse, fact)
    if mart in ("economic_summary", "regional_performance", "economic_overview"):
        detail = detail.where(F.col("region_name").isNotNull())
    names = (*keys, "role", "fact_key", "amount", "source_key")
    found = _matched(chosen, detail, list(keys)).withColumn("role", F.lit("current")).select(*names)
    if mart in SERIES:
        series = list(SERIES[mart])
        # The observed years of a series are few; each names the one before.
        order = Window.partitionBy(*series).orderBy("year")
        before = (
            detail.select(*series, "year").distinct()
            .withColumn("_before", F.lag("year").over(order))
            .where(F.col("_before").isNotNull())
        )
        asked = chosen.join(before, [k for k in keys if k in before.columns])
        earlier = detail.withColumnRenamed("year", "_before")
        matched = asked.join(earlier.drop(*[c for c in keys if c not in (*series, "year")]), [*series, "_before"])
        found = found.unionByName(matched.withColumn("role", F.lit("previous")).select(*names))
    return trace(found, files).select(*names, "doc")


def _matched(rows: DataFrame, detail: DataFrame, keys: list[str]) -> DataFrame:
    """Facts of the rows; names may be NULL on both sides."""
    other = rows.withColumnsRenamed({key: f"_{key}" for key in keys})
    same = [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys]
    return detail.join(other, same).drop(*[f"_{key}" for key in keys])


def _trace_bridge(warehouse: Warehouse, files: DataFrame, rows: DataFrame) -> DataFrame:
    overview = warehouse.table("mart", "economic_overview").select("year").distinct()
    years = rows.select("year").distinct()
    names = ("year", "role", "fact_key", "amount", "source_key")
    parts = trace_mart(warehouse, "economic_overview", files).join(years, "year", "left_semi")
    economic = parts.withColumn(
        "role", F.when(F.col("role") == "current", "economic").otherwise(F.col("role"))
    ).select(*names).distinct()
    detail = facts_of(warehouse, TRADE)
    # Years of trade alone stand in the bridge without their year.
    placed = detail.join(overview.withColumn("_known", F.lit(True)), "year", "left").withColumn(
        "year", F.when(F.col("_known"), F.col("year"))
    )
    trade = _matched(years, placed, ["year"]).withColumn("role", F.lit("trade")).select(*names)
    return trace(economic.unionByName(trade), files).select(*names, "doc")
