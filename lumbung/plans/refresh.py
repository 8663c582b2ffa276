"""Marts that follow the loads: what a load touched is carried on to the mart rows it changes.

A load notes the keys it changes (`Warehouse.changed`). A value of a year is part of the mart rows of
that year and indicator and, as growth compares with the previous observed value, of those of the next
year that the series was observed in. Only the year partitions that hold such rows are rewritten: rows
of other indicators are taken over from the stored mart, the touched ones are computed anew from the
touched indicators' history. Changes of names reach every year in which the named thing was observed.
Trade marts compare nothing across years, so their touched years are computed from those years alone.
Stored summaries, where there are any, follow in the touched years too.

The notes are dropped when all marts have followed, so a run that breaks off is made up for by the next.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumbung.functions.storage import discard, scratch_path
from lumbung.operators.load import Warehouse
from lumbung.plans import marts, summaries
from lumbung.schemas import EconomicStar, TradeStar

#: Marts whose rows belong to one indicator and compare a year with the one observed before.
SERIES_MARTS: dict[str, Callable[[EconomicStar], DataFrame]] = {
    "indicator_trend": marts.indicator_trend,
    "regional_performance": marts.regional_performance,
    "economic_overview": marts.economic_overview,
}
#: Marts that are computed from the facts of one year.
YEARLY_ECONOMIC_MARTS: dict[str, Callable[[EconomicStar], DataFrame]] = {
    "economic_summary": marts.economic_summary,
}
TRADE_MARTS: dict[str, Callable[[TradeStar], DataFrame]] = {
    "trade_trend": marts.trade_trend,
    "trade_regional": marts.trade_regional,
    "trade_commodity": marts.trade_commodity,
    "trade_partner": marts.trade_partner,
}
ALL_MARTS = (*SERIES_MARTS, *YEARLY_ECONOMIC_MARTS, "growth_divergence", *TRADE_MARTS, "economic_trade_bridge")
KEY = ["year", "indicator_key"]


def build_marts(warehouse: Warehouse) -> None:
    """Build every mart anew; those that compare others read them as they were just stored."""
    economic, trade = warehouse.economic_star(), warehouse.trade_star()
    for name, mart in (SERIES_MARTS | YEARLY_ECONOMIC_MARTS).items():
        warehouse.build_mart(mart(economic), name)
    for name, mart in TRADE_MARTS.items():
        warehouse.build_mart(mart(trade), name)
    warehouse.build_mart(_divergence(warehouse), "growth_divergence")
    _build_bridge(warehouse)
    if summaries.exist(warehouse):
        summaries.build(warehouse)
    warehouse.forget_changes()


def refresh_marts(warehouse: Warehouse) -> dict[str, list[int]]:
    """Bring the marts up to date with the loads since the last time; the years rewritten, by mart.

    A mart that does not exist yet has all marts built. Without changes nothing is written.
    """
    if not all(warehouse.spark.catalog.tableExists(warehouse.name("mart", name)) for name in ALL_MARTS):
        build_marts(warehouse)
        return {}
    path = scratch_path(warehouse.spark, "refresh")
    try:
        done = _refresh_economic(warehouse, path) | _refresh_trade(warehouse, path)
    finally:
        discard(warehouse.spark, path)
    if done:
        # A row per year and indicator, from the stored marts; years of trade alone share a partition.
        _build_bridge(warehouse)
    warehouse.forget_changes()
    return done


def _divergence(warehouse: Warehouse) -> DataFrame:
    return marts.divergence(
        warehouse.table("mart", "indicator_trend"), warehouse.table("mart", "regional_performance")
    )


def _build_bridge(warehouse: Warehouse) -> None:
    bridge = marts.economic_trade_bridge(
        warehouse.table("mart", "economic_overview"), warehouse.table("mart", "trade_trend")
    )
    warehouse.build_mart(bridge, "economic_trade_bridge")


def _kept(rows: DataFrame, path: str) -> DataFrame:
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _touched(warehouse: Warehouse, fact: str, keys: list[str], references: dict[str, tuple[str, str]]) -> DataFrame | None:
    """Distinct `keys` of what changed: the noted ones of the fact, and those of facts whose
    dimension rows changed (`references`: dimension to its key and the fact's)."""
    rows = warehouse.table("warehouse", fact)
    parts = []
    noted = warehouse.changed(fact)
    if noted is not None:
        parts.append(noted.select(*keys))
    for dimension, (key, own) in references.items():
        changed = warehouse.changed(dimension)
        if changed is not None and not changed.isEmpty():
            parts.append(rows.join(changed.select(F.col(key).alias(own)), own, "left_semi").select(*keys))
    return reduce(DataFrame.union, parts).distinct() if parts else None


def _years(keys: DataFrame) -> list[int]:
    """Years of some keys: at most one for each of the calendar."""
    return sorted(row[0] for row in keys.where("year IS NOT NULL").select("year").distinct().collect())


def affected(fact: DataFrame, touched: DataFrame) -> DataFrame:
    """Keys (year, indicator_key) of the mart rows that depend on `touched` facts.

    Those keys, the next year that the indicator was observed in anywhere, which national totals
    compare with, and for every region the next year that it was observed in there.
    """
    def following(*series: str) -> DataFrame:
        order = Window.partitionBy(*series).orderBy("year")
        pairs = (
            fact.select("year", *series).distinct()
            .withColumn("_before", F.lag("year").over(order))
            .select(F.col("year").alias("_next"), F.col("_before").alias("year"), "indicator_key")
        )
        return pairs.join(touched, KEY, "left_semi").select(F.col("_next").alias("year"), "indicator_key")

    national, regional = following("indicator_key"), following("region_key", "indicator_key")
    return touched.select(*KEY).union(national).union(regional).distinct()


def _refresh_economic(warehouse: Warehouse, path: str) -> dict[str, list[int]]:
    references = {
        "dim_date": ("date_key", "date_key"), "dim_region": ("region_key", "region_key"),
        "dim_indicator": ("indicator_key", "indicator_key"),
    }
    touched = _touched(warehouse, "fact_economic", KEY, references)
    if touched is None:
        return {}
    touched = _kept(touched, f"{path}/economic")
    years = _years(touched)
    if not years:
        return {}
    star = warehouse.economic_star()
    history = replace(star, fact=star.fact.join(touched.select("indicator_key").distinct(), "indicator_key", "left_semi"))
    dependent = _kept(affected(marts.dated(history.fact, star.dim_date), touched), f"{path}/affected")
    wide = _years(dependent)
    for name, mart in SERIES_MARTS.items():
        stored = warehouse.table("mart", name).where(F.col("year").isin(wide))
        anew = mart(history).join(dependent, KEY, "left_semi")
        rows = stored.join(dependent, KEY, "left_anti").unionByName(anew.select(*stored.columns))
        warehouse.replace_years(rows, name, wide)
    for name, mart in YEARLY_ECONOMIC_MARTS.items():
        rows = mart(replace(star, fact=star.fact.where(F.col("year").isin(years))))
        warehouse.replace_years(rows, name, years)
    warehouse.replace_years(_divergence(warehouse), "growth_divergence", wide)
    if summaries.exist(warehouse):
        summaries.follow(warehouse, years)
    return {name: wide for name in (*SERIES_MARTS, "growth_divergence")} | {
        name: years for name in YEARLY_ECONOMIC_MARTS
    }


def _refresh_trade(warehouse: Warehouse, path: str) -> dict[str, list[int]]:
    references = {
        "dim_date": ("date_key", "date_key"), "dim_product": ("product_key", "product_key"),
        "dim_country": ("country_key", "country_key"), "dim_trade_flow": ("trade_flow", "trade_type"),
    }
    touched = _touched(warehouse, "fact_trade", ["year"], references)
    years = [] if touched is None else _years(touched)
    if not years:
        return {}
    star = warehouse.trade_star()
    own = replace(star, fact=star.fact.where(F.col("year").isin(years)))
    for name, mart in TRADE_MARTS.items():
        warehouse.replace_years(mart(own), name, years)
    return {name: years for name in TRADE_MARTS}
