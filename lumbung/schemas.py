"""Table schemas of the staging, warehouse and mart layers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

STRING = T.StringType()
INT = T.IntegerType()
LONG = T.LongType()
DATE = T.DateType()
STAMP = T.TimestampType()
VALUE = T.DecimalType(20, 6)
MONEY = T.DecimalType(20, 2)

# Fixed value: the origin of dataset metadata.
SOURCE_SYSTEM = "BPS"

LAYERS = ("raw", "staging", "warehouse", "mart")


def _schema(required: str = "", **columns: T.DataType) -> T.StructType:
    needed = set(required.split())
    return T.StructType(
        [T.StructField(name, kind, name not in needed) for name, kind in columns.items()]
    )


@dataclass(frozen=True)
class TableSpec:
    """Columns, natural key, further unique keys, partitioning and column defaults of a table.

    `version` names the column by which an existing row is older or newer than one that is loaded.

    `surrogate` names a generated key: a hash of the natural key, so it is the same in every
    run. A column `loaded_at` defaults to the time of the load.
    """

    schema: T.StructType
    key: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    partition_by: tuple[str, ...] = ()
    surrogate: str | None = None
    defaults: tuple[tuple[str, str], ...] = ()
    version: str | None = None

    @property
    def required(self) -> list[str]:
        return [field.name for field in self.schema.fields if not field.nullable]


STAGING_TABLES = {
    "dynamic_data": TableSpec(
        _schema(
            staging_key=LONG, variable_id=STRING, vervar_id=STRING, region_id=STRING,
            year=INT, value=VALUE, table_id=STRING, loaded_at=STAMP,
            period_type=STRING, source_key=LONG, doc=STRING, place=INT,
        )
    ),
    "domain_regions": TableSpec(
        _schema(region_code=STRING, region_name=STRING, level=STRING, loaded_at=STAMP)
    ),
    "variables": TableSpec(
        _schema(
            variable_id=STRING, variable_name=STRING, variable_description=STRING,
            table_id=STRING, loaded_at=STAMP,
        )
    ),
    "glossary": TableSpec(
        _schema(
            glossary_id=STRING, indicator_name=STRING, concept=STRING, definition=STRING,
            classification=STRING, measure=STRING, unit=STRING, data_source=STRING,
            loaded_at=STAMP,
        )
    ),
}

DIMENSIONS = {
    "dim_region": TableSpec(
        _schema(
            "region_key region_code region_name",
            region_key=STRING, region_code=STRING, region_name=STRING,
            province_name=STRING, regency_name=STRING, district_name=STRING,
        ),
        key=("region_key",),
        unique=(("region_code",),),
    ),
    "dim_indicator": TableSpec(
        _schema(
            "indicator_key indicator_name",
            indicator_key=STRING, indicator_code=STRING, indicator_name=STRING,
            subject_name=STRING, category_name=STRING, unit=STRING, frequency=STRING,
            concept=STRING, definition=STRING, classification=STRING, measure=STRING,
            data_source=STRING, aggregation_method=STRING, source_day=INT,
        ),
        key=("indicator_key",),
        version="source_day",
        unique=(("indicator_code", "indicator_name"),),
        defaults=(("aggregation_method", "SUM"),),
    ),
    "dim_date": TableSpec(
        _schema(
            "date_key full_date year",
            date_key=INT, full_date=DATE, year=INT, quarter=INT, month=INT,
            month_name=STRING, period_type=STRING,
        ),
        key=("date_key",),
        defaults=(("period_type", "YEAR"),),
    ),
    "dim_dataset": TableSpec(
        _schema(
            dataset_key=LONG, table_id=STRING, table_code=STRING, title=STRING,
            subject=STRING, available_years=STRING, source_system=STRING, source_day=INT,
        ),
        key=("table_id",),
        version="source_day",
        defaults=(("source_system", SOURCE_SYSTEM),),
    ),
    "dim_glossary": TableSpec(
        _schema(
            glossary_key=LONG, glossary_id=STRING, indicator_name=STRING, concept=STRING,
            definition=STRING, classification=STRING, measure=STRING, unit=STRING,
            data_source=STRING, endpoint=STRING, source_day=INT,
        ),
        key=("glossary_id",),
        version="source_day",
    ),
    "dim_product": TableSpec(
        _schema(
            "product_key", product_key=STRING, product_code=STRING, product_name=STRING, source_day=INT,
        ),
        key=("product_key",),
        version="source_day",
        unique=(("product_code",),),
    ),
    "dim_country": TableSpec(
        _schema(
            "country_key", country_key=STRING, country_code=STRING, country_name=STRING, source_day=INT,
        ),
        key=("country_key",),
        version="source_day",
        unique=(("country_code",),),
    ),
    "dim_trade_flow": TableSpec(
        _schema("trade_flow", trade_flow=STRING, flow_name=STRING), key=("trade_flow",)
    ),
}

ECONOMIC_GRAIN = ("date_key", "region_key", "indicator_key")
TRADE_GRAIN = ("date_key", "product_key", "country_key", "port_key", "trade_type")

FACTS = {
    "fact_economic": TableSpec(
        _schema(
            "date_key region_key indicator_key",
            fact_key=LONG, date_key=INT, region_key=STRING, indicator_key=STRING,
            value=VALUE, source_key=LONG, source_day=INT, loaded_at=STAMP, year=INT,
        ),
        key=ECONOMIC_GRAIN,
        version="source_day",
        surrogate="fact_key",
        partition_by=("year",),
    ),
    "fact_trade": TableSpec(
        _schema(
            trade_key=LONG, date_key=INT, product_key=STRING, country_key=STRING,
            port_key=STRING, trade_type=STRING, value_usd=MONEY, net_weight_kg=MONEY,
            source_key=LONG, source_day=INT, loaded_at=STAMP, year=INT,
        ),
        key=TRADE_GRAIN,
        version="source_day",
        surrogate="trade_key",
        partition_by=("year",),
    ),
}

WAREHOUSE_TABLES = {**DIMENSIONS, **FACTS}

FOREIGN_KEYS = {
    "fact_economic": {
        "date_key": ("dim_date", "date_key"),
        "region_key": ("dim_region", "region_key"),
        "indicator_key": ("dim_indicator", "indicator_key"),
    },
    "fact_trade": {"date_key": ("dim_date", "date_key")},
}


@dataclass(frozen=True)
class EconomicStar:
    """fact_economic with the dimensions its marts read."""

    fact: DataFrame
    dim_date: DataFrame
    dim_region: DataFrame
    dim_indicator: DataFrame


@dataclass(frozen=True)
class TradeStar:
    """fact_trade with the dimensions its marts read."""

    fact: DataFrame
    dim_date: DataFrame
    dim_product: DataFrame
    dim_country: DataFrame
    dim_trade_flow: DataFrame
