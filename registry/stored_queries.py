"""Read queries on marts that are stored in a warehouse, where a year reads its partition alone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lumbung.plans import marts, serving
from lumbung.schemas import EconomicStar, TradeStar
from registry.adapters import economic_star, trade_star
from registry.catalog import ORACLES, register
from registry.load_queries import new_warehouse
from registry.mart_queries import PERFORMANCE_SQL
from registry.serving_queries import KEY, LIMIT, STATUS, YEAR, _REGIONAL

_Star = Callable[[SparkSession, str], EconomicStar | TradeStar]


def stored(spark: SparkSession, sf_dir: str, star: _Star, mart: str) -> DataFrame:
    """A mart of the given tables as readers of a warehouse find it."""
    house = new_warehouse(spark, "stored")
    house.build_mart(getattr(marts, mart)(star(spark, sf_dir)), mart)
    return house.table("mart", mart)


@register(
    "r05_ranking_stored",
    f"""WITH {PERFORMANCE_SQL}
    SELECT {_REGIONAL}, {STATUS} FROM performance WHERE year = {YEAR} AND indicator_key = '{KEY}'
    ORDER BY year DESC, regional_rank, indicator_key, region_key LIMIT {LIMIT}""",
)
def r05_stored(spark, sf_dir):
    performance = stored(spark, sf_dir, economic_star, "regional_performance")
    return serving.regional_ranking(performance, indicator_key=KEY, year=YEAR, limit=LIMIT)


@register("r07_trade_trend_stored", ORACLES["r07_trade_trend"])
def r07_stored(spark, sf_dir):
    return serving.trade_trend_by_year(stored(spark, sf_dir, trade_star, "trade_trend"), YEAR)


@register("r09_partners_stored", ORACLES["r09_partners"])
def r09_stored(spark, sf_dir):
    return serving.top_partners(stored(spark, sf_dir, trade_star, "trade_partner"), year=YEAR, limit=LIMIT)
