"""Landing, parsers and staging, fed with responses spelled from the tables."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.functions.columns import numeric, whole_year
from lumbung.functions.storage import scratch_path
from lumbung.operators import staging
from lumbung.schemas import VALUE
from lumbung.sources import landing
from lumbung.sources import responses as parsers
from registry import adapters
from registry.adapters import ECONOMIC, ECONOMIC_FACT, GLOSSARY_SQL, TRADE_LINES
from registry.catalog import register

DAY = datetime.date(2024, 1, 8)


def landed_wide(spark: SparkSession, sf_dir: str) -> str:
    """Land the wide responses and the region lists in a new folder."""
    base = scratch_path(spark, "landing")
    statistics = adapters.wide_responses(spark, sf_dir).select(
        F.lit("dynamic_data").alias("source"), F.col("doc").alias("dataset"), F.lit(DAY).alias("landed_on"), "body"
    )
    regions = adapters.region_responses(spark, sf_dir).select(
        "source", "dataset", F.lit(DAY).alias("landed_on"), "body"
    )
    landing.land_responses(statistics.unionByName(regions), base)
    return base


_DATASETS = """
    SELECT 'dynamic_data' AS source, p_brand AS dataset FROM part GROUP BY p_brand
    UNION ALL SELECT 'domain', level FROM (VALUES ('prov'), ('kab')) AS l(level)
"""


@register(
    "l01_land_responses",
    f"SELECT source, COUNT(*) AS responses, 8 AS day FROM ({_DATASETS}) GROUP BY source",
)
def l01(spark, sf_dir):
    base = landed_wide(spark, sf_dir)
    # Landing the same day again replaces, it does not add.
    again = adapters.region_responses(spark, sf_dir)
    landing.land_responses(
        again.select("source", "dataset", F.lit(DAY).alias("landed_on"), "body"), base
    )
    landed = landing.read_landed(spark, base)
    return landed.groupBy("source").agg(F.count("body").alias("responses"), F.max("day").alias("day"))


@register(
    "l02_read_landed",
    f"""WITH {ECONOMIC_FACT}
    SELECT indicator_key AS dataset, CAST(COUNT(DISTINCT year) AS INTEGER) AS years
    FROM e_fact GROUP BY indicator_key""",
)
def l02(spark, sf_dir):
    landed = landing.read_landed(spark, landed_wide(spark, sf_dir), "dynamic_data")
    rows = parsers.parse_statistics(landed).select("dataset", F.size("content_rows").alias("years"))
    return rows


@register("l03_list_landed", f"{_DATASETS}")
def l03(spark, sf_dir):
    return landing.list_landed(spark, landed_wide(spark, sf_dir)).select("source", "dataset")


_PROVINCES = """
    SELECT LPAD(CAST(r_regionkey AS VARCHAR), 2, '0') AS region_code, r_name AS region_name,
           'prov' AS level FROM region"""
_REGENCIES = """
    SELECT LPAD(CAST(n_regionkey AS VARCHAR), 2, '0') || LPAD(CAST(n_nationkey AS VARCHAR), 2, '0')
               AS region_code,
           n_name AS region_name, 'kab' AS level FROM nation"""


@register("l04_region_records", f"{_PROVINCES} UNION ALL {_REGENCIES}")
def l04(spark, sf_dir):
    records = parsers.region_records(adapters.region_responses(spark, sf_dir))
    return records.select("region_code", "region_name", F.col("dataset").alias("level"))


@register("l05_regions_of_level", f"{_REGENCIES} WHERE n_regionkey = 2")
def l05(spark, sf_dir):
    lists = adapters.region_responses(spark, sf_dir)
    regencies = parsers.regions_of_level(lists, "kab")
    return parsers.regions_for_domain(regencies, "0200").select("region_code", "region_name", "level")


def wide_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parsers.parse_statistics(adapters.wide_responses(spark, sf_dir))
    return staging.observations(parsed, adapters.region_codes(spark, sf_dir))


@register(
    "l06_select_observations",
    f"""WITH {ECONOMIC_FACT}
    SELECT indicator_key AS variable_id, region_key AS region_id, year, CAST(value AS DOUBLE) AS value
    FROM e_fact WHERE indicator_key IN ('Brand#12', 'Brand#3') AND year IN (1996, 1998)""",
)
def l06(spark, sf_dir):
    selected = parsers.select_observations(
        wide_observations(spark, sf_dir), "Brand#12,Brand#3", "1996,1998"
    )
    return selected.where(F.col("value").isNotNull()).select("variable_id", "region_id", "year", "value")


@register(
    "l07_variables",
    """SELECT p_brand AS doc, 0 AS position, p_brand AS variable_id, upper(p_brand) AS variable_name,
              CAST(NULL AS VARCHAR) AS variable_description FROM part GROUP BY p_brand""",
)
def l07(spark, sf_dir):
    return parsers.variables(parsers.parse_statistics(adapters.wide_responses(spark, sf_dir)))


_VERVARS = """
    SELECT p_brand AS doc, position, vervar_id, vervar_name, vervar_description, 'USD' AS vervar_unit
    FROM (SELECT DISTINCT p_brand FROM part),
         (VALUES (0, '1', 'plain', 'the plain value'), (1, '2', 'negative', 'the negative value'))
             AS v(position, vervar_id, vervar_name, vervar_description)
"""


@register("l08_vertical_variables", _VERVARS)
def l08(spark, sf_dir):
    return parsers.vertical_variables(
        parsers.parse_statistics(adapters.paired_responses(spark, sf_dir))
    )


@register(
    "l09_content_rows",
    f"""WITH {ECONOMIC_FACT}
    SELECT indicator_key AS doc, CAST(year AS VARCHAR) AS year,
           CAST((SELECT COUNT(*) FROM nation) AS INTEGER) AS places,
           CAST(COUNT(*) AS INTEGER) AS filled,
           'Values of ' || indicator_key AS region_names
    FROM e_fact GROUP BY indicator_key, year""",
)
def l09(spark, sf_dir):
    rows = parsers.content_rows(parsers.parse_statistics(adapters.wide_responses(spark, sf_dir)))
    return rows.select(
        "doc", "year", F.size("values").alias("places"),
        F.size(F.filter("values", lambda v: v.isNotNull())).alias("filled"), "region_names",
    )


_TRADE_COLUMNS = (
    "trade_type, commodity_code, commodity_name, country_code, country_name, port_code, port_name, "
    "period, CAST(usd AS VARCHAR) AS value_usd, COALESCE(CAST(kg AS VARCHAR), 'unknown') AS net_weight_kg"
)


@register("l11_trade_records", f"WITH {TRADE_LINES} SELECT doc, 0 AS position, {_TRADE_COLUMNS} FROM lines")
def l11(spark, sf_dir):
    return parsers.trade_records(adapters.trade_responses(spark, sf_dir))


@register(
    "l12_select_trade",
    f"""WITH {TRADE_LINES}
    SELECT doc, 0 AS position, {_TRADE_COLUMNS} FROM lines
    WHERE trade_type = 'ekspor' AND period = '1998-03' AND country_code = '7'""",
)
def l12(spark, sf_dir):
    records = parsers.trade_records(adapters.trade_responses(spark, sf_dir))
    return parsers.select_trade(records, "ekspor", "1998-03", country_code="7")


_GLOSSARY_COLUMNS = (
    "doc, CAST(place AS INTEGER) AS position, glossary_id, indicator_name, concept, definition, "
    "classification, measure, unit, data_source"
)


@register("l13_glossary_records", f"WITH {GLOSSARY_SQL} SELECT {_GLOSSARY_COLUMNS} FROM glossary")
def l13(spark, sf_dir):
    return parsers.glossary_records(adapters.glossary_responses(spark, sf_dir))


_DATASET = """
    SELECT p_brand AS doc, 0 AS position, p_brand AS table_id, 'T-' || p_brand AS table_code,
           'Parts of ' || p_brand AS title, 'Parts' AS subject, 'USD' AS unit,
           'Annual' AS frequency FROM part GROUP BY p_brand"""


@register("l14_dataset_records", _DATASET)
def l14(spark, sf_dir):
    return parsers.dataset_records(adapters.dataset_responses(spark, sf_dir), first_only=True)


@register(
    "l15_select_metadata",
    f"""WITH {GLOSSARY_SQL} SELECT {_GLOSSARY_COLUMNS} FROM glossary
    WHERE doc = 'Brand#12' AND unit = 'USD'""",
)
def l15(spark, sf_dir):
    records = parsers.glossary_records(adapters.glossary_responses(spark, sf_dir))
    return parsers.select_metadata(records, doc="Brand#12", unit="USD")


@register(
    "l15_select_dataset",
    f"SELECT * FROM ({_DATASET}) WHERE table_id = 'Brand#12'",
)
def l15_dataset(spark, sf_dir):
    records = parsers.dataset_records(adapters.dataset_responses(spark, sf_dir), first_only=False)
    return parsers.select_metadata(records, table_id="Brand#12")


# Staging


@register(
    "t01_table_metadata",
    """SELECT doc || form AS doc, table_id, table_code, table_name, 'Trade' AS subject,
              'USD' AS unit, frequency
    FROM (
        SELECT p_brand AS doc, '/wide' AS form, 'table ' || p_brand AS table_id,
               p_brand AS table_code, 'Values of ' || p_brand AS table_name, 'Annual' AS frequency
        FROM part GROUP BY p_brand
        UNION ALL
        SELECT p_brand, '/keyed', LPAD(regexp_extract(p_brand, '([0-9]+)$', 1), 3, '0'), NULL,
               upper(p_brand), NULL FROM part GROUP BY p_brand
    )""",
)
def t01(spark, sf_dir):
    return staging.table_metadata(both_forms(spark, sf_dir))


def both_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed wide and keyed responses in one input."""
    forms = [
        responses(spark, sf_dir).withColumn("doc", F.concat("doc", F.lit(f"/{form}")))
        for form, responses in (
            ("wide", adapters.wide_responses), ("keyed", adapters.keyed_responses)
        )
    ]
    return parsers.parse_statistics(forms[0].unionByName(forms[1]))


@register(
    "t02_staged_variables",
    """SELECT p_brand || form AS doc, 0 AS position,
              CASE form WHEN '/wide' THEN p_brand
                   ELSE LPAD(regexp_extract(p_brand, '([0-9]+)$', 1), 3, '0') END AS variable_id,
              upper(p_brand) AS variable_name, variable_description
    FROM (SELECT DISTINCT p_brand FROM part),
         (VALUES ('/wide', NULL), ('/keyed', 'parts')) AS f(form, variable_description)""",
)
def t02(spark, sf_dir):
    return staging.staged_variables(both_forms(spark, sf_dir))


@register(
    "t03_staged_vertical_variables",
    f"""{_VERVARS}
    UNION ALL
    SELECT p_brand || '/keyed', 0, '000', 'all', NULL, NULL FROM part GROUP BY p_brand""",
)
def t03(spark, sf_dir):
    keyed = adapters.keyed_responses(spark, sf_dir).withColumn("doc", F.concat("doc", F.lit("/keyed")))
    responses = adapters.paired_responses(spark, sf_dir).unionByName(keyed)
    return staging.staged_vertical_variables(parsers.parse_statistics(responses))


@register(
    "t04_year_labels",
    f"""WITH {ECONOMIC_FACT}
    SELECT DISTINCT indicator_key AS doc, LPAD(CAST(year - 1900 AS VARCHAR), 3, '0') AS year_id,
           CAST(year AS VARCHAR) AS year_label FROM e_fact""",
)
def t04(spark, sf_dir):
    return staging.year_labels(parsers.parse_statistics(adapters.keyed_responses(spark, sf_dir)))


@register(
    "t05_period_labels",
    """SELECT p_brand AS doc, period_id, period_label
    FROM (SELECT DISTINCT p_brand FROM part),
         (VALUES ('61', 'Semester 1'), ('63', 'Annual')) AS p(period_id, period_label)""",
)
def t05(spark, sf_dir):
    return staging.period_labels(parsers.parse_statistics(adapters.keyed_responses(spark, sf_dir)))


_NUMBER = "LPAD(regexp_extract(indicator_key, '([0-9]+)$', 1), 3, '0')"


@register(
    "t06_decode_key",
    f"""WITH {ECONOMIC_FACT}
    SELECT {adapters.FOUR_DIGIT_CODE} AS region, {_NUMBER} AS variable, '000' AS vervar,
           LPAD(CAST(year - 1900 AS VARCHAR), 3, '0') AS year, period
    FROM e_fact, (VALUES ('61'), ('63')) AS p(period)""",
)
def t06(spark, sf_dir):
    parsed = parsers.parse_statistics(adapters.keyed_responses(spark, sf_dir))
    keys = parsed.select(F.explode("content_keyed").alias("key", "value"))
    parts = staging.decode_key(F.col("key"))
    return keys.where(F.length("key") == staging.KEY_LENGTH).select(
        *[part.alias(name) for name, part in parts.items()]
    )


@register(
    "t07_keyed_observations",
    f"""WITH {ECONOMIC_FACT}
    SELECT indicator_key AS doc, {_NUMBER} AS variable_id, '000' AS vervar_id,
           {adapters.FOUR_DIGIT_CODE} AS region_id, year,
           CAST(CASE period_type WHEN 'Annual' THEN value
                     ELSE CAST(value / 2 AS DECIMAL(20,6)) END AS DOUBLE) AS value,
           period_type
    FROM e_fact, (VALUES ('Semester 1'), ('Annual')) AS p(period_type)""",
)
def t07(spark, sf_dir):
    parsed = parsers.parse_statistics(adapters.keyed_responses(spark, sf_dir))
    return staging.observations(parsed).drop("ordinal", "table_id")


_WIDE = f"""
    SELECT indicator_key AS variable_id, region_key AS region_id, year,
           CAST(value AS DOUBLE) AS value FROM e_fact"""


@register("t08_wide_observations", f"WITH {ECONOMIC_FACT} {_WIDE}")
def t08(spark, sf_dir):
    observed = wide_observations(spark, sf_dir).where(F.col("value").isNotNull())
    return observed.select("variable_id", "region_id", "year", "value")


@register(
    "t09_vertical_observations",
    f"""WITH {ECONOMIC_FACT}
    SELECT indicator_key AS variable_id, region_key AS region_id, vervar_id, year,
           CAST(CASE vervar_id WHEN '1' THEN value ELSE -value END AS DOUBLE) AS value
    FROM e_fact, (VALUES ('1'), ('2')) AS v(vervar_id)""",
)
def t09(spark, sf_dir):
    parsed = parsers.parse_statistics(adapters.paired_responses(spark, sf_dir))
    observed = staging.observations(parsed, adapters.region_codes(spark, sf_dir))
    return observed.where(F.col("value").isNotNull()).select(
        "variable_id", "region_id", "vervar_id", "year", "value"
    )


@register(
    "t10_numeric_coercion",
    f"""WITH {adapters.MESSY}
    SELECT variable_id, region_id, TRY_CAST(year AS INTEGER) AS year, COUNT(*) AS n,
           CAST(SUM(TRY_CAST(value AS DECIMAL(20,6))) AS DOUBLE) AS total,
           COUNT(TRY_CAST(value AS DECIMAL(20,6))) AS numbers
    FROM messy GROUP BY ALL""",
)
def t10(spark, sf_dir):
    messy = adapters.messy_staging(spark, sf_dir).withColumns(
        {"year": whole_year(F.col("year")), "value": numeric(F.col("value"), VALUE)}
    )
    return messy.groupBy("variable_id", "region_id", "year").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"), F.count("value").alias("numbers")
    )


@register(
    "t11_stage",
    f"""WITH {ECONOMIC}
    SELECT v.indicator_name AS variable_name, v.unit, f.region_key AS region_id, f.year,
           CAST(f.value AS DOUBLE) AS value, 'table ' || v.indicator_key AS table_id
    FROM e_fact f JOIN e_indicator v USING (indicator_key)""",
)
def t11(spark, sf_dir):
    staged = staging.stage(
        adapters.wide_responses(spark, sf_dir), adapters.region_codes(spark, sf_dir)
    )
    described = staged.variables.join(staged.metadata, "doc").select(
        "variable_id", "variable_name", "unit"
    )
    return (
        staged.data.where(F.col("value").isNotNull())
        .join(described, "variable_id")
        .select("variable_name", "unit", "region_id", "year", "value", "table_id")
    )
