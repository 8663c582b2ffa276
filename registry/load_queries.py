"""Loads into a warehouse of their own, in a new folder for every run."""

from __future__ import annotations

import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.functions.storage import materialize, scratch_path
from lumbung.operators import staging
from lumbung.operators.load import Warehouse
from lumbung.plans import lineage, marts, pipeline, refresh, summaries
from lumbung.sources import landing
from lumbung.streaming import ingest
from registry import adapters
from registry.adapters import ECONOMIC, ECONOMIC_FACT, GLOSSARY_SQL, OBSERVED, TRADE_FACT, growth_sql
from registry.catalog import ORACLES, register
from registry.mart_queries import OVERVIEW_SQL, TREND_SQL
from registry.source_queries import DAY, landed_wide


def new_warehouse(spark: SparkSession, label: str) -> Warehouse:
    place = scratch_path(spark, label)
    return Warehouse(spark, place, f"{label}_{place.rsplit('-', 1)[1]}_")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.economic_fact(spark, sf_dir)


@register(
    "k01_create_schemas",
    f"""WITH {ECONOMIC_FACT}
    SELECT layer, COUNT(*) AS rows FROM e_fact, (VALUES ('raw'), ('staging'), ('warehouse'), ('mart'))
        AS l(layer) GROUP BY layer""",
)
def k01(spark, sf_dir):
    """Every layer takes a copy of the observations."""
    house = new_warehouse(spark, "k01")
    house.create_schemas()
    layers = ("raw", "staging", "warehouse", "mart")
    house.load(observations(spark, sf_dir), layers[0], "copy")
    for layer in layers[1:]:
        house.load(house.table(layers[0], "copy"), layer, "copy")
    counts = [
        house.table(layer, "copy").agg(F.lit(layer).alias("layer"), F.count(F.lit(1)).alias("rows"))
        for layer in layers
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3])


@register(
    "k02_create_tables",
    f"""WITH {ECONOMIC_FACT}
    SELECT date_key, region_key, indicator_key, CAST(value AS DOUBLE) AS value, year FROM e_fact""",
)
def k02(spark, sf_dir):
    """The typed fact table takes the observations as they are."""
    house = new_warehouse(spark, "k02")
    house.create_tables()
    house.create_tables()
    names = house.table("warehouse", "fact_economic").schema.names
    fact = observations(spark, sf_dir)
    rows = fact.select(
        *[F.col(n) if n in fact.columns else F.lit(None).alias(n) for n in names]
    )
    rows.write.insertInto(house.name("warehouse", "fact_economic"))
    return house.table("warehouse", "fact_economic").select(
        "date_key", "region_key", "indicator_key", "value", "year"
    )


@register(
    "k03_load_modes",
    f"""WITH {ECONOMIC_FACT}
    SELECT CASE copy WHEN 0 THEN 'replaced' ELSE 'appended' END AS part, year, COUNT(*) AS rows
    FROM e_fact, (VALUES (0), (1), (2)) AS c(copy) GROUP BY part, year""",
)
def k03(spark, sf_dir):
    """One table appended to, one replaced; a third load into it fails."""
    house = new_warehouse(spark, "k03")
    house.load(observations(spark, sf_dir), "staging", "appended")
    loaded = house.table("staging", "appended")
    house.load(loaded, "staging", "replaced")
    house.load(loaded, "staging", "replaced", "replace")
    house.load(house.table("staging", "replaced"), "staging", "appended", "append")
    try:
        house.load(loaded, "staging", "replaced", "fail")
    except Exception as error:  # the table exists, as it must
        if "ALREADY_EXISTS" not in str(error):
            raise
    return (
        house.table("staging", "appended").withColumn("part", F.lit("appended"))
        .unionByName(house.table("staging", "replaced").withColumn("part", F.lit("replaced")))
        .groupBy("part", "year").agg(F.count(F.lit(1)).alias("rows"))
    )


@register(
    "k04_upsert",
    f"""WITH {ECONOMIC_FACT}
    SELECT date_key, region_key, indicator_key, year,
           CAST(CASE WHEN year % 2 = 0 AND region_key IN ('3', '7') THEN value + 5
                     ELSE value END AS DOUBLE) AS value
    FROM e_fact""",
)
def k04(spark, sf_dir):
    """Even years, then the rest with corrections of two regions, each key given twice."""
    house = new_warehouse(spark, "k04")
    house.load(observations(spark, sf_dir), "staging", "observations")
    rows = house.table("staging", "observations")
    house.upsert(rows.where(F.col("year") % 2 == 0), "fact_economic", update=["value"])
    second = rows.where((F.col("year") % 2 == 1) | F.col("region_key").isin("3", "7"))
    given = second.withColumn("attempt", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn(
        "value",
        F.when(F.col("attempt") == 1, F.col("value") * 2)
        .when(F.col("year") % 2 == 0, F.col("value") + 5)
        .otherwise(F.col("value"))
        .cast("decimal(20,6)"),
    )
    for _ in range(2):
        house.upsert(given, "fact_economic", update=["value"], ordinal="attempt")
    return house.table("warehouse", "fact_economic").select(
        "date_key", "region_key", "indicator_key", "year", "value"
    )


@register(
    "k05_upsert_set",
    f"""WITH {ECONOMIC}
    SELECT 'fact_economic' AS table_name, COUNT(*) AS rows FROM e_fact
    UNION ALL SELECT 'dim_date', COUNT(DISTINCT year) FROM e_fact
    UNION ALL SELECT 'dim_region', COUNT(*) FROM e_region
    UNION ALL SELECT 'dim_indicator', COUNT(*) FROM e_indicator""",
)
def k05(spark, sf_dir):
    """The load set twice over: the second load adds nothing."""
    house = new_warehouse(spark, "k05")
    star = adapters.economic_star(spark, sf_dir)
    house.load(star.fact, "staging", "observations")
    fact = house.table("staging", "observations")
    dates = star.dim_date.join(fact.select("date_key").distinct(), "date_key", "left_semi")
    tables = {
        "dim_date": dates, "dim_region": star.dim_region, "dim_indicator": star.dim_indicator,
        "fact_economic": fact,
    }
    for _ in range(2):
        for name, df in tables.items():
            house.upsert(df, name, update=["value"] if name == "fact_economic" else None)
    counts = [
        house.table("warehouse", name).agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows")
        )
        for name in tables
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3])


@register(
    "k06_truncate",
    f"WITH {ECONOMIC_FACT} SELECT COUNT(*) AS rows_before, 0 AS rows_after FROM e_fact",
)
def k06(spark, sf_dir):
    house = new_warehouse(spark, "k06")
    house.load(observations(spark, sf_dir), "staging", "observations")
    house.load(house.table("staging", "observations"), "warehouse", "copy")
    house.truncate("warehouse", "copy")
    before = house.table("staging", "observations").agg(F.count(F.lit(1)).alias("rows_before"))
    after = house.table("warehouse", "copy").agg(F.count(F.lit(1)))
    return before.withColumn("rows_after", after.scalar())


@register("k07_row_count", f"WITH {ECONOMIC_FACT} SELECT COUNT(*) AS rows FROM e_fact")
def k07(spark, sf_dir):
    house = new_warehouse(spark, "k07")
    house.load(observations(spark, sf_dir), "warehouse", "observations")
    rows = house.row_count("warehouse", "observations")
    # The count beside a row of the table it was taken of.
    return house.table("warehouse", "observations").agg(F.lit(rows).cast("long").alias("rows"))


@register("k08_build_mart", f"WITH {TREND_SQL} SELECT * FROM trend")
def k08(spark, sf_dir):
    house = new_warehouse(spark, "k08")
    for _ in range(2):
        house.build_mart(
            marts.indicator_trend(adapters.economic_star(spark, sf_dir)), "indicator_trend"
        )
    return house.table("mart", "indicator_trend")


@register(
    "k09_table_state",
    f"""WITH {ECONOMIC_FACT}
    SELECT TRUE AS loaded_exists, COUNT(*) = 0 AS loaded_empty, FALSE AS other_exists,
           COUNT(*) AS rows FROM e_fact""",
)
def k09(spark, sf_dir):
    house = new_warehouse(spark, "k09")
    house.load(observations(spark, sf_dir), "warehouse", "loaded")
    return house.table("warehouse", "loaded").agg(
        F.lit(house.exists("warehouse", "loaded")).alias("loaded_exists"),
        F.lit(house.is_empty("warehouse", "loaded")).alias("loaded_empty"),
        F.lit(house.exists("warehouse", "other")).alias("other_exists"),
        F.count(F.lit(1)).alias("rows"),
    )


def everything(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Responses (doc, body) of all five sources; the statistics are keyed, so regions have four-digit codes."""
    nations = F.sort_array(
        F.collect_list(
            F.struct(adapters.four_digit_code("region_code").alias("kode"), F.col("region_name").alias("nama"))
        )
    )
    provinces = adapters.regions(spark, sf_dir).agg(F.to_json(nations).alias("body"))
    return {
        "dynamic_data": adapters.keyed_responses(spark, sf_dir),
        "domain": provinces.withColumn("doc", F.lit("prov")),
        "glossary": adapters.glossary_responses(spark, sf_dir),
        "simdasi": adapters.dataset_responses(spark, sf_dir),
        "foreign_trade": adapters.port_responses(spark, sf_dir),
    }


def land(base: str, sources: dict[str, DataFrame], day: datetime.date = DAY) -> None:
    parts = [
        responses.select(
            F.lit(source).alias("source"), F.col("doc").alias("dataset"), F.lit(day).alias("landed_on"), "body"
        )
        for source, responses in sources.items()
    ]
    landing.land_responses(reduce(DataFrame.union, parts), base)


#: How a mart is told in the long format of `every_mart`: its text keys, and its numbers.
_TOLD = {
    "indicator_trend": (["indicator_name"], ["national_value", "previous_value", "growth_pct"]),
    "regional_performance": (["region_name", "indicator_name"], ["value", "regional_rank", "previous_value", "growth_pct"]),
    "economic_overview": (
        ["indicator_name", "concept"], ["national_value", "previous_national_value", "national_growth_pct", "region_count"],
    ),
    "economic_summary": (["region_name", "indicator_name"], ["avg_value"]),
    "growth_divergence": (
        ["indicator_name", "top_region", "bottom_region"], ["national_growth_pct", "top_growth_pct", "bottom_growth_pct"],
    ),
    "trade_trend": (["trade_flow"], ["total_value_usd", "total_weight_kg", "transaction_count"]),
    "trade_regional": (["port_key", "trade_type"], ["value_usd", "weight_kg", "record_count"]),
    "trade_commodity": (["trade_flow", "product_code"], ["total_value_usd", "total_weight_kg", "commodity_rank"]),
    "trade_partner": (["trade_flow", "country_code"], ["total_value_usd", "partner_rank"]),
    "economic_trade_bridge": (
        [], ["national_value", "national_growth_pct", "export_total_usd", "import_total_usd", "trade_balance_usd"],
    ),
}
_NUMBERS = ("a", "b", "c", "d", "e")


def every_mart(house: Warehouse) -> DataFrame:
    """All ten marts in one long format: mart, year, item (its text keys), up to five numbers."""
    parts = []
    for mart, (keys, numbers) in _TOLD.items():
        given = [*numbers, *[None] * (len(_NUMBERS) - len(numbers))]
        told = [
            (F.lit(None) if n is None else F.round(n, 6) if n == "avg_value" else F.col(n)).cast("double").alias(name)
            for name, n in zip(_NUMBERS, given)
        ]
        item = F.concat_ws("|", *keys) if keys else F.lit("")
        parts.append(house.table("mart", mart).select(F.lit(mart).alias("mart"), "year", item.alias("item"), *told))
    return reduce(DataFrame.union, parts)


# Facts of `everything`: a year, country, port and flow of all products together.
_YEARLY = f"""
    SELECT year, 'ALL' AS product_code, country_key AS country_code, port_key, trade_type,
           CASE trade_type WHEN 'ekspor' THEN 'Ekspor' ELSE 'Impor' END AS trade_flow,
           SUM(value_usd) AS usd, SUM(net_weight_kg) AS kg
    FROM (WITH {TRADE_FACT} SELECT * FROM x_fact) GROUP BY ALL"""


def _trade_sums(keys: str, more: str) -> str:
    return f"SELECT year, {keys}, {more} FROM ({_YEARLY}) GROUP BY year, {keys}"


_MART_SQL = {
    "indicator_trend": ORACLES["m01_indicator_trend"],
    "regional_performance": ORACLES["m02_regional_performance"],
    "economic_overview": ORACLES["m03_economic_overview"],
    "economic_summary": ORACLES["m04_economic_summary"],
    "growth_divergence": ORACLES["m05_growth_divergence"],
    "trade_trend": _trade_sums(
        "trade_flow", "SUM(usd) AS total_value_usd, SUM(kg) AS total_weight_kg, COUNT(*) AS transaction_count"
    ),
    "trade_regional": _trade_sums(
        "port_key, trade_type", "SUM(usd) AS value_usd, SUM(kg) AS weight_kg, COUNT(*) AS record_count"
    ),
    "trade_commodity": _trade_sums(
        "trade_flow, product_code", "SUM(usd) AS total_value_usd, SUM(kg) AS total_weight_kg, 1 AS commodity_rank"
    ),
    "trade_partner": _trade_sums(
        "trade_flow, country_code",
        "SUM(usd) AS total_value_usd, RANK() OVER (PARTITION BY year, trade_flow ORDER BY SUM(usd) DESC) AS partner_rank",
    ),
    "economic_trade_bridge": ORACLES["m10_economic_trade_bridge"],
}


def _told_sql(mart: str) -> str:
    keys, numbers = _TOLD[mart]
    item = f"concat_ws('|', {', '.join(keys)})" if keys else "''"
    given = [*numbers, *["NULL"] * (len(_NUMBERS) - len(numbers))]
    told = ", ".join(f"CAST({n} AS DOUBLE) AS {name}" for name, n in zip(_NUMBERS, given))
    return f"SELECT '{mart}' AS mart, year, {item} AS item, {told} FROM ({_MART_SQL[mart]})"


EVERY_MART = " UNION ALL ".join(f"({_told_sql(mart)})" for mart in _TOLD)


@register(
    "b11_metadata_dimensions",
    f"""WITH {GLOSSARY_SQL}
    SELECT 'dim_glossary' AS table_name, COUNT(*) AS rows FROM glossary
    UNION ALL SELECT 'dim_dataset', 0""",
)
def b11(spark, sf_dir):
    """The metadata that has landed is loaded; dataset metadata, which has not, leaves its table empty."""
    house = new_warehouse(spark, "b11")
    house.create_tables()
    base = scratch_path(spark, "landing")
    land(base, {"glossary": adapters.glossary_responses(spark, sf_dir)})
    landed = landing.read_landed(spark, base)
    pipeline.load_responses(spark, house, landed, pipeline.domain_regions(landed, "0000"))
    counts = [
        house.table("warehouse", name).agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows"))
        for name in ("dim_glossary", "dim_dataset")
    ]
    return counts[0].unionByName(counts[1])


@register("k10_pipeline", EVERY_MART)
def k10(spark, sf_dir):
    """Landed responses to the marts of both domains."""
    house = new_warehouse(spark, "k10")
    base = scratch_path(spark, "landing")
    land(base, everything(spark, sf_dir))
    pipeline.run_pipeline(spark, base, house)
    return every_mart(house)


@register("k10_landed_anew", EVERY_MART)
def k10_landed_anew(spark, sf_dir):
    """Some files are wrong at first, land anew on their day and load again; a late older day changes nothing."""
    house = new_warehouse(spark, "k10a")
    base = scratch_path(spark, "landing")
    sources = {name: materialize(responses, name) for name, responses in everything(spark, sf_dir).items()}
    right = sources["dynamic_data"].where(F.col("doc").endswith("3"))
    # A larger value: a digit before each.
    wrong = right.withColumn("body", F.regexp_replace("body", r'":"(\d+\.)', '":"7$1'))
    land(base, sources | {"dynamic_data": sources["dynamic_data"].where(~F.col("doc").endswith("3")).union(wrong)})
    pipeline.run_pipeline(spark, base, house)
    land(base, {"dynamic_data": right})
    pipeline.run_pipeline(spark, base, house)
    land(base, {"dynamic_data": wrong}, DAY - datetime.timedelta(days=3))
    pipeline.run_pipeline(spark, base, house)
    return every_mart(house)


@register("l10_incremental_ingest", EVERY_MART)
def l10(spark, sf_dir):
    """All five sources landed in two batches, taken as a stream; a third run finds nothing."""
    house = new_warehouse(spark, "l10")
    base, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "checkpoint")
    sources = {name: materialize(responses, name) for name, responses in everything(spark, sf_dir).items()}
    late = F.pmod(F.xxhash64("doc"), F.lit(4)) == 0
    for part, day in ((~late, DAY), (late, DAY + datetime.timedelta(days=7))):
        land(base, {name: r if name == "domain" else r.where(part) for name, r in sources.items()}, day)
        ingest.ingest_available(spark, base, house, checkpoint)
    ingest.ingest_available(spark, base, house, checkpoint)
    return every_mart(house)


@register(
    "k11_mart_lineage",
    f"""WITH {ECONOMIC}, {TRADE_FACT},
    per_mart AS (
        SELECT year, indicator_key, COUNT(*) AS facts, SUM(value) AS amount FROM e_fact GROUP BY year, indicator_key
    ),
    chained AS (
        SELECT *, LAG(year) OVER (PARTITION BY indicator_key ORDER BY year) AS before FROM per_mart
    ),
    yearly AS ({_YEARLY})
    SELECT 'indicator_trend' AS mart, year, 'B' || regexp_extract(indicator_key, '([0-9]+)$', 1) AS item,
           'current' AS role, facts, CAST(1 AS BIGINT) AS files, CAST(amount AS DOUBLE) AS amount
    FROM per_mart
    UNION ALL
    SELECT 'indicator_trend', c.year, 'B' || regexp_extract(c.indicator_key, '([0-9]+)$', 1), 'previous',
           p.facts, 1, CAST(p.amount AS DOUBLE)
    FROM chained c JOIN per_mart p ON p.indicator_key = c.indicator_key AND p.year = c.before
    UNION ALL
    SELECT 'trade_trend', year, trade_flow, 'current', COUNT(*), COUNT(DISTINCT port_key), CAST(SUM(usd) AS DOUBLE)
    FROM yearly GROUP BY year, trade_flow""",
)
def k11_marts(spark, sf_dir):
    """Rows of two marts traced to their facts and the landed files of these."""
    house = new_warehouse(spark, "k11m")
    base = scratch_path(spark, "landing")
    land(base, everything(spark, sf_dir))
    pipeline.run_pipeline(spark, base, house)
    files = pipeline.loaded_files(house)

    def traced(mart: str, item: Column) -> DataFrame:
        found = lineage.trace_mart(house, mart, files)
        return found.groupBy(F.lit(mart).alias("mart"), "year", item.alias("item"), "role").agg(
            F.count(F.lit(1)).alias("facts"), F.count_distinct("doc").alias("files"),
            F.sum("amount").cast("double").alias("amount"),
        )

    trend = traced("indicator_trend", F.concat(F.lit("B"), F.col("indicator_key").cast("int")))
    return trend.unionByName(traced("trade_trend", F.col("trade_flow")))


@register(
    "k11_lineage",
    f"""WITH {ECONOMIC_FACT}
    SELECT year, region_key, indicator_key, indicator_key AS dataset, CAST(value AS DOUBLE) AS value
    FROM e_fact""",
)
def k11(spark, sf_dir):
    """Every loaded value traced to the landed file it came from."""
    house = new_warehouse(spark, "k11")
    landed = landing.read_landed(spark, landed_wide(spark, sf_dir), "dynamic_data")
    staged = staging.stage(landed.select("doc", "body"), adapters.region_codes(spark, sf_dir))
    data = pipeline.write_staging(house, staged.data)
    pipeline.load_fact_economic(house, data.where(F.col("value").isNotNull()))
    fact = house.table("warehouse", "fact_economic")
    traced = pipeline.trace(fact, data).join(landed.select("doc", "dataset"), "doc")
    return traced.select("year", "region_key", "indicator_key", "dataset", "value")


def summarised(spark: SparkSession, sf_dir: str, label: str) -> Warehouse:
    """Facts loaded in two batches, of which the second corrects a region of one year of the first.

    The summaries are built after the first and follow the second.
    """
    house = new_warehouse(spark, label)
    house.create_tables()
    star = adapters.economic_star(spark, sf_dir)
    for name in ("dim_date", "dim_region", "dim_indicator"):
        house.upsert(getattr(star, name), name)
    fact = materialize(star.fact, "fact")
    early, corrected = F.col("year") < 1995, (F.col("year") == 1993) & F.col("region_key").isin("3", "7")
    value = F.when(corrected, F.col("value") * 2 + 1).otherwise(F.col("value")).cast("decimal(20,6)")
    house.upsert(fact.where(early).withColumn("value", value), "fact_economic", update=["value"])
    refresh.build_marts(house)
    summaries.build(house)
    house.upsert(fact.where(~early | corrected), "fact_economic", update=["value"])
    refresh.refresh_marts(house)
    return house


@register(
    "a08_merged_moments",
    f"""WITH {OBSERVED}
    SELECT indicator_name, region_name, COUNT(*) AS years_observed, ROUND(AVG(value), 6) AS avg_value,
           ROUND(STDDEV_SAMP(CAST(value AS DOUBLE)), 6) AS stddev_value,
           {growth_sql('MAX(value)', 'MIN(value)')} AS total_change_pct
    FROM obs GROUP BY indicator_name, region_name""",
)
def a08_merged(spark, sf_dir):
    """Level and spread of every series merged from stored moments of the years."""
    return summaries.long_term_trend(summarised(spark, sf_dir, "a08"))


@register(
    "a12_merged_moments",
    f"""WITH {OBSERVED}
    SELECT indicator_name, region_name, ROUND(AVG(value), 6) AS mean_value,
           ROUND(STDDEV_SAMP(CAST(value AS DOUBLE)), 6) AS stddev_value,
           ROUND(STDDEV_SAMP(CAST(value AS DOUBLE)) / NULLIF(AVG(CAST(value AS DOUBLE)), 0) * 100, 2)
               AS coefficient_of_variation
    FROM obs GROUP BY indicator_name, region_name HAVING COUNT(*) > 1""",
)
def a12_merged(spark, sf_dir):
    """Volatility of every series merged from stored moments of the years."""
    return summaries.volatility(summarised(spark, sf_dir, "a12"))


@register("m03_merged_regions", f"WITH {OVERVIEW_SQL} SELECT * FROM overview")
def m03_merged(spark, sf_dir):
    """The overview from stored totals and bitmaps of regions."""
    return summaries.economic_overview(summarised(spark, sf_dir, "m03"))


@register(
    "m03_regions_of_years",
    f"""WITH {ECONOMIC}
    SELECT indicator_key, COUNT(DISTINCT region_key) AS region_count
    FROM e_fact JOIN e_region USING (region_key) WHERE year BETWEEN 1993 AND 1996 GROUP BY indicator_key""",
)
def m03_span(spark, sf_dir):
    """Distinct regions of a span of years from the stored bitmaps of each."""
    return summaries.reporting_regions(summarised(spark, sf_dir, "m03r"), 1993, 1996)
