"""Dimension and fact builders."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumbung.functions.columns import period_date_key
from lumbung.operators import model, staging
from lumbung.plans import pipeline
from lumbung.sources import responses as parsers
from registry import adapters
from registry.adapters import ECONOMIC, ECONOMIC_FACT, GLOSSARY_SQL, TRADE_LINES
from registry.catalog import register

_INDICATOR_COLUMNS = """
    CAST(NULL AS VARCHAR) AS category_name, 'USD' AS unit, 'Annual' AS frequency,
    CAST(NULL AS VARCHAR) AS concept, CAST(NULL AS VARCHAR) AS definition,
    CAST(NULL AS VARCHAR) AS classification, CAST(NULL AS VARCHAR) AS measure,
    CAST(NULL AS VARCHAR) AS data_source, 'SUM' AS aggregation_method"""


@register(
    "b01_fact_economic",
    f"""WITH {ECONOMIC_FACT}
    SELECT date_key, region_key, indicator_key, CAST(value AS DOUBLE) AS value, year FROM e_fact""",
)
def b01(spark, sf_dir):
    staged = adapters.economic_fact(spark, sf_dir).select(
        F.col("indicator_key").alias("variable_id"), F.col("region_key").alias("region_id"),
        "year", "value",
    )
    return model.build_fact_economic(staged)


_MONTH_COLUMNS = "CAST(quarter(day) AS INTEGER) AS quarter, CAST(month(day) AS INTEGER) AS month, monthname(day) AS month_name"


@register(
    "b02_dim_date",
    """SELECT DISTINCT CAST(year(o_orderdate) * 10000 + 101 AS INTEGER) AS date_key,
              year(o_orderdate) || '-01-01' AS full_date, CAST(year(o_orderdate) AS INTEGER) AS year,
              1 AS quarter, 1 AS month, 'January' AS month_name, 'YEAR' AS period_type
    FROM orders""",
)
def b02(spark, sf_dir):
    orders = adapters.table(spark, sf_dir, "orders")
    return model.build_dim_date(orders.select(F.year("o_orderdate").alias("year")))


@register(
    "b02m_dim_date_from_keys",
    f"""SELECT CAST(strftime(day, '%Y%m%d') AS INTEGER) AS date_key, CAST(day AS VARCHAR) AS full_date,
              CAST(year(day) AS INTEGER) AS year, {_MONTH_COLUMNS}, 'MONTH' AS period_type
    FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders)""",
)
def b02m(spark, sf_dir):
    orders = adapters.table(spark, sf_dir, "orders")
    keys = orders.select(period_date_key(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date_key"))
    return model.build_dim_date_from_keys(keys)


_REGION = """
    SELECT CAST(n_nationkey AS VARCHAR) AS region_key, CAST(n_nationkey AS VARCHAR) AS region_code,
           n_name AS region_name, r_name AS province_name,
           CAST(NULL AS VARCHAR) AS regency_name, CAST(NULL AS VARCHAR) AS district_name
    FROM nation JOIN region ON n_regionkey = r_regionkey"""


@register("b03_dim_region", _REGION)
def b03(spark, sf_dir):
    return model.build_dim_region(adapters.regions(spark, sf_dir).drop("region_key"))


@register(
    "b04_dim_region_for_domain",
    """SELECT code AS region_key, code AS region_code, name AS region_name, name AS province_name,
              CAST(NULL AS VARCHAR) AS regency_name, CAST(NULL AS VARCHAR) AS district_name
    FROM (
        SELECT '0000' AS code, 'INDONESIA' AS name
        UNION ALL SELECT LPAD(CAST(r_regionkey AS VARCHAR), 2, '0'), r_name FROM region
    )""",
)
def b04(spark, sf_dir):
    regions = pipeline.domain_regions(adapters.region_responses(spark, sf_dir), "0000")
    return model.dim_region_for_domain(spark, "0000", regions)


@register(
    "b05_region_codes",
    """SELECT 'prov' AS domain,
              string_agg(LPAD(CAST(r_regionkey AS VARCHAR), 2, '0'), ',' ORDER BY r_regionkey) AS codes
    FROM region
    UNION ALL
    SELECT 'kab', string_agg(LPAD(CAST(n_regionkey AS VARCHAR), 2, '0')
                             || LPAD(CAST(n_nationkey AS VARCHAR), 2, '0'), ',' ORDER BY n_nationkey)
    FROM nation""",
)
def b05(spark, sf_dir):
    records = parsers.region_records(adapters.region_responses(spark, sf_dir))
    codes = model.region_codes_by_domain(records.withColumn("domain", F.col("dataset")))
    return codes.select("domain", F.array_join("region_codes", ",").alias("codes"))


@register(
    "b06_dim_indicator",
    f"""SELECT p_type AS indicator_key, p_type AS indicator_code, lower(p_type) AS indicator_name,
              'Parts' AS subject_name, {_INDICATOR_COLUMNS}
    FROM part GROUP BY p_type""",
)
def b06(spark, sf_dir):
    records = adapters.table(spark, sf_dir, "part").select("p_type").distinct().select(
        F.col("p_type").alias("indicator_code"), F.lower("p_type").alias("indicator_name"),
        F.lit("Parts").alias("subject_name"), F.lit("USD").alias("unit"),
        F.lit("Annual").alias("frequency"),
    )
    return model.build_dim_indicator(records)


@register(
    "b07_dim_indicator_from_staged",
    f"""SELECT p_brand AS indicator_key, p_brand AS indicator_code, upper(p_brand) AS indicator_name,
              'Trade' AS subject_name, {_INDICATOR_COLUMNS}
    FROM part GROUP BY p_brand""",
)
def b07(spark, sf_dir):
    staged = staging.stage(adapters.wide_responses(spark, sf_dir))
    return model.dim_indicator_from_staged(staged.described)


_OWN_DATASET = """
    SELECT 1 AS dataset_key, p_brand AS table_id, 'T-' || p_brand AS table_code,
           'Parts of ' || p_brand AS title, 'Parts' AS subject,
           '1995-2001' AS available_years, 'BPS' AS source_system
    FROM part GROUP BY p_brand"""


@register(
    "b08_dim_dataset",
    f"""{_OWN_DATASET}
    UNION ALL
    SELECT 2, p_brand || '/2', 'x', 'x', 'x', '1995-2001', 'BPS' FROM part GROUP BY p_brand""",
)
def b08(spark, sf_dir):
    """Every entry of a response by its position."""
    records = parsers.dataset_records(adapters.dataset_responses(spark, sf_dir))
    return model.build_dim_dataset(records, "1995-2001")


@register("b08_dim_dataset_first", _OWN_DATASET)
def b08_first(spark, sf_dir):
    """The first entry of each response only."""
    records = parsers.dataset_records(adapters.dataset_responses(spark, sf_dir), first_only=True)
    return model.build_dim_dataset(records, "1995-2001")


@register(
    "b09_dim_glossary",
    f"""WITH {GLOSSARY_SQL}
    SELECT place + 1 AS glossary_key, glossary_id, indicator_name, concept, definition,
           classification, measure, unit, data_source, 'glosarium' AS endpoint FROM glossary""",
)
def b09(spark, sf_dir):
    return model.build_dim_glossary(
        parsers.glossary_records(adapters.glossary_responses(spark, sf_dir))
    )


@register(
    "b10_enrich_indicators",
    f"""WITH {ECONOMIC}, {GLOSSARY_SQL},
    last_entry AS (SELECT * FROM glossary QUALIFY place = MAX(place) OVER (PARTITION BY doc))
    SELECT i.indicator_key, i.indicator_key AS indicator_code, i.indicator_name, i.subject_name,
           CAST(NULL AS VARCHAR) AS category_name, i.unit, i.frequency,
           g.concept, g.definition, g.classification, g.measure, g.data_source,
           i.aggregation_method
    FROM e_indicator i LEFT JOIN last_entry g ON lower(i.indicator_name) = lower(g.doc)""",
)
def b10(spark, sf_dir):
    glossary = parsers.glossary_records(adapters.glossary_responses(spark, sf_dir))
    return model.enrich_indicators(
        adapters.indicators(spark, sf_dir), glossary, F.struct("doc", "position")
    )


@register(
    "b12_fact_trade",
    f"""WITH {TRADE_LINES}
    SELECT date_key, commodity_code AS product_key, country_code AS country_key,
           port_code AS port_key, trade_type, CAST(usd AS DOUBLE) AS value_usd,
           CAST(kg AS DOUBLE) AS net_weight_kg, year FROM lines""",
)
def b12(spark, sf_dir):
    return model.build_fact_trade(parsers.trade_records(adapters.trade_responses(spark, sf_dir)))


@register(
    "b13_period_date_key",
    """SELECT form, CAST(key AS INTEGER) AS date_key, COUNT(*) AS n
    FROM (
        SELECT UNNEST([
            {'form': 'year', 'key': year(o_orderdate) * 10000 + 101},
            {'form': 'month', 'key': year(o_orderdate) * 10000 + month(o_orderdate) * 100 + 1},
            {'form': 'day', 'key': CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT)},
            {'form': 'none', 'key': 0}
        ], recursive := true) FROM orders
    ) GROUP BY form, key""",
)
def b13(spark, sf_dir):
    forms = {"year": "' 'yyyy' '", "month": "yyyy-MM", "day": "yyyy-MM-dd"}
    date = F.col("o_orderdate")
    periods = F.array(
        *[F.struct(F.lit(n).alias("form"), F.date_format(date, f).alias("period")) for n, f in forms.items()],
        F.struct(F.lit("none").alias("form"), F.lit("").alias("period")),
    )
    rows = adapters.table(spark, sf_dir, "orders").select(F.inline(periods))
    return rows.groupBy("form", period_date_key(F.col("period")).alias("date_key")).agg(
        F.count(F.lit(1)).alias("n")
    )


@register(
    "b14_dim_product",
    f"""WITH {TRADE_LINES}
    SELECT DISTINCT commodity_code AS product_key, commodity_code AS product_code,
           commodity_name AS product_name FROM lines""",
)
def b14(spark, sf_dir):
    records = parsers.trade_records(adapters.trade_responses(spark, sf_dir))
    return model.build_dim_product(
        records.select(
            F.col("commodity_code").alias("product_code"),
            F.col("commodity_name").alias("product_name"),
        )
    )


@register(
    "b15_dim_country",
    f"""WITH {TRADE_LINES}
    SELECT DISTINCT country_code AS country_key, country_code, country_name FROM lines""",
)
def b15(spark, sf_dir):
    return model.build_dim_country(
        parsers.trade_records(adapters.trade_responses(spark, sf_dir))
    )


@register(
    "b16_dim_trade_flow",
    """SELECT f.trade_flow, f.flow_name, COUNT(*) AS lines
    FROM (VALUES ('ekspor', 'Ekspor', true), ('impor', 'Impor', false)) AS f(trade_flow, flow_name, open)
    JOIN lineitem ON (l_linestatus = 'O') = open GROUP BY ALL""",
)
def b16(spark, sf_dir):
    """The two flows with the order lines that belong to each."""
    flow = F.when(F.col("l_linestatus") == "O", "ekspor").otherwise("impor")
    lines = adapters.table(spark, sf_dir, "lineitem").groupBy(flow.alias("trade_flow")).agg(
        F.count(F.lit(1)).alias("lines")
    )
    return model.build_dim_trade_flow(spark).join(lines, "trade_flow")
