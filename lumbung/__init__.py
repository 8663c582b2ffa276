"""Statistical warehouse on Spark: landing, staging, star schema, marts and analyses."""

from lumbung.schemas import EconomicStar, TradeStar

__all__ = ["EconomicStar", "TradeStar"]
