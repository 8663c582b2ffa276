"""Data quality checks and reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbung.functions.storage import materialize
from lumbung.operators import model, quality, staging
from lumbung.schemas import DIMENSIONS
from lumbung.sources import responses as parsers
from registry import adapters
from registry.adapters import ECONOMIC, ECONOMIC_FACT, MESSY
from registry.catalog import register

# Every check of the messy frame in SQL, one row each.
CHECKS = f"""
{MESSY},
numbers AS (
    SELECT *, TRY_CAST(year AS DOUBLE) AS y, TRY_CAST(value AS DOUBLE) AS v FROM messy
),
counters AS (
    SELECT COUNT(*) AS n, COUNT(*) - COUNT(variable_id) + COUNT(*) - COUNT(region_id)
               + COUNT(*) - COUNT(year) + COUNT(*) - COUNT(value) AS missing,
           COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM messy)) AS duplicates,
           COUNT(*) FILTER (v IS NULL AND value IS NOT NULL) AS broken,
           COUNT(*) FILTER (y IS NULL) AS bad_years,
           COUNT(*) FILTER (y < 1900 OR y > 2200) AS far_years,
           COUNT(*) FILTER (v IS NULL) AS no_values, COUNT(*) FILTER (v < 0) AS negative,
           COUNT(*) FILTER (region_id IS NULL OR CAST(region_id AS INTEGER) >= 50) AS foreign_regions
    FROM numbers
),
checks AS (
    SELECT UNNEST([
        {{'check': 'context', 'status': 'INFO', 'bad_rows': 0}},
        {{'check': 'required_columns', 'status': 'PASS', 'bad_rows': 0}},
        {{'check': 'empty_dataset', 'status': CASE WHEN n = 0 THEN 'FAIL' ELSE 'PASS' END, 'bad_rows': 0}},
        {{'check': 'missing_values', 'status': CASE WHEN missing > 0 THEN 'FAIL' ELSE 'PASS' END,
          'bad_rows': missing}},
        {{'check': 'duplicates', 'status': CASE WHEN duplicates > 0 THEN 'FAIL' ELSE 'PASS' END,
          'bad_rows': duplicates}},
        {{'check': 'numeric_value', 'status': CASE WHEN broken > 0 THEN 'FAIL' ELSE 'PASS' END,
          'bad_rows': broken}},
        {{'check': 'period', 'status': CASE WHEN bad_years + far_years > 0 THEN 'FAIL' ELSE 'PASS' END,
          'bad_rows': bad_years + far_years}},
        {{'check': 'negative_values',
          'status': CASE WHEN no_values > 0 THEN 'SKIP' WHEN negative > 0 THEN 'WARN' ELSE 'PASS' END,
          'bad_rows': CASE WHEN no_values > 0 THEN 0 ELSE negative END}},
        {{'check': 'region_codes', 'status': CASE WHEN foreign_regions > 0 THEN 'FAIL' ELSE 'PASS' END,
          'bad_rows': foreign_regions}}
    ], recursive := true) FROM counters
)"""


def checked(spark, sf_dir) -> DataFrame:
    """All checks of the messy frame; regions below 50 are allowed."""
    allowed = spark.range(50).select(F.col("id").cast("string").alias("region_code"))
    return quality.validate(
        adapters.messy_staging(spark, sf_dir), context="events", allowed_regions=allowed
    ).select("check", "status", "bad_rows")


@register("q01_validate", f"WITH {CHECKS} SELECT * FROM checks")
def q01(spark, sf_dir):
    return checked(spark, sf_dir)


def _one_check(name: str, check: str):
    @register(name, f"WITH {CHECKS} SELECT * FROM checks WHERE \"check\" = '{check}'")
    def query(spark, sf_dir):
        return checked(spark, sf_dir).where(F.col("check") == check)

    return query


q03 = _one_check("q03_empty_dataset", "empty_dataset")
q04 = _one_check("q04_missing_values", "missing_values")
q05 = _one_check("q05_duplicates", "duplicates")
q06 = _one_check("q06_numeric", "numeric_value")
q07 = _one_check("q07_period", "period")
q08 = _one_check("q08_region_codes", "region_codes")


@register(
    "q02_required_columns",
    """SELECT 'required_columns' AS "check", 'FAIL' AS status, 1 AS bad_rows, COUNT(*) AS events
    FROM events""",
)
def q02(spark, sf_dir):
    """A frame without its value column; the rows it would have had are counted beside it."""
    frame = adapters.messy_staging(spark, sf_dir).drop("value")
    rows = frame.agg(F.count(F.lit(1)))
    return (
        quality.validate(frame).select("check", "status", "bad_rows")
        .withColumn("events", rows.scalar())
    )


@register(
    "q09_negative_values",
    f"""WITH {MESSY}
    SELECT 'negative_values' AS "check", 'WARN' AS status,
           COUNT(*) FILTER (value[1] = '-') AS bad_rows FROM messy""",
)
def q09(spark, sf_dir):
    """Signed values only, where the check counts instead of skipping."""
    frame = adapters.messy_staging(spark, sf_dir)
    numbers = frame.withColumn("value", F.regexp_replace("value", "n/a", "0"))
    checks = quality.validate(numbers).select("check", "status", "bad_rows")
    return checks.where(F.col("check") == "negative_values")


@register(
    "q09b_passed",
    f"WITH {CHECKS} SELECT bool_and(status <> 'FAIL') AS passed FROM checks",
)
def q09b(spark, sf_dir):
    return quality.passed(checked(spark, sf_dir))


@register(
    "q10_gate",
    f"""WITH {CHECKS}
    SELECT COUNT(*) FILTER (status = 'FAIL') > 0 AS stopped, MAX(n) AS rows
    FROM checks, counters""",
)
def q10(spark, sf_dir):
    """Whether the gate stops the messy frame."""
    try:
        quality.gate(checked(spark, sf_dir).withColumn("details", F.lit("")))
        stopped = False
    except quality.QualityError:
        stopped = True
    rows = adapters.table(spark, sf_dir, "events").agg(F.count(F.lit(1)).alias("rows"))
    return rows.select(F.lit(stopped).alias("stopped"), "rows")


@register(
    "q11_referential_integrity",
    f"""WITH {ECONOMIC_FACT}
    SELECT 'region_key' AS foreign_key,
           COUNT(DISTINCT region_key) FILTER (CAST(region_key AS INTEGER) >= 20) AS orphan_keys,
           COUNT(*) FILTER (CAST(region_key AS INTEGER) >= 20) AS orphan_rows FROM e_fact
    UNION ALL SELECT 'indicator_key', 0, 0
    UNION ALL SELECT 'date_key', 0, 0""",
)
def q11(spark, sf_dir):
    """Against a region dimension that lacks the last nations."""
    star = adapters.stored_star(spark, sf_dir)
    regions = star.dim_region.where(F.col("region_key").cast("int") < 20)
    return quality.referential_integrity(
        star.fact,
        {
            "region_key": (regions, "region_key"),
            "indicator_key": (star.dim_indicator, "indicator_key"),
            "date_key": (star.dim_date, "date_key"),
        },
    )


@register(
    "q12_constraints",
    """SELECT 'unique(region_key)' AS rule, 0 AS violations
    UNION ALL
    SELECT 'unique(region_code)', COUNT(*)
    FROM (SELECT c_nationkey FROM customer GROUP BY 1 HAVING COUNT(*) > 1)
    UNION ALL SELECT 'not_null(region_key)', 0
    UNION ALL SELECT 'not_null(region_code)', 0
    UNION ALL SELECT 'not_null(region_name)', COUNT(*) FROM customer WHERE c_mktsegment = 'BUILDING'""",
)
def q12(spark, sf_dir):
    """Customers as regions whose code repeats and whose name is missing in one segment."""
    customers = adapters.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("region_key"),
        F.col("c_nationkey").cast("string").alias("region_code"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_name")).alias("region_name"),
    )
    return quality.constraints(customers, DIMENSIONS["dim_region"])


@register(
    "q13_load_verification",
    f"""WITH {ECONOMIC_FACT}
    SELECT 'fact_economic' AS table_name, COUNT(*) AS rows, 'PASS' AS status FROM e_fact
    UNION ALL SELECT 'dim_date', COUNT(DISTINCT year), 'PASS' FROM e_fact
    UNION ALL SELECT 'dim_region', COUNT(*), 'PASS' FROM nation
    UNION ALL SELECT 'dim_indicator', COUNT(DISTINCT p_brand), 'PASS' FROM part""",
)
def q13(spark, sf_dir):
    star = adapters.stored_star(spark, sf_dir)
    tables = {
        "fact_economic": star.fact,
        "dim_date": model.build_dim_date(star.fact),
        "dim_region": star.dim_region,
        "dim_indicator": star.dim_indicator,
    }
    return quality.load_verification(spark, tables)


def _fact_and_staged(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """The fact from the tables, and the same observations staged from their responses."""
    fact = materialize(adapters.economic_fact(spark, sf_dir), "fact")
    parsed = parsers.parse_statistics(adapters.wide_responses(spark, sf_dir, fact))
    staged = staging.observations(parsed, adapters.region_codes(spark, sf_dir))
    return fact, materialize(staged.where(F.col("value").isNotNull()), "staged")


@register(
    "q14_value_mismatches",
    f"""WITH {ECONOMIC_FACT}
    SELECT year, region_key, indicator_key, CAST(value + 1 AS DOUBLE) AS value,
           CAST(value AS DOUBLE) AS staged_value FROM e_fact WHERE region_key = '7'""",
)
def q14(spark, sf_dir):
    """One region's fact values are off by one."""
    fact, staged = _fact_and_staged(spark, sf_dir)
    wrong = F.when(F.col("region_key") == "7", F.col("value") + 1).otherwise(F.col("value"))
    return quality.value_mismatches(fact.withColumn("value", wrong), staged)


@register(
    "q15_reconciliation",
    f"""WITH {ECONOMIC_FACT}
    SELECT 'total_difference' AS "check", 'PASS' AS status, 0.0 AS amount
    UNION ALL SELECT 'null_rows', 'FAIL', CAST(COUNT(*) AS DOUBLE) FROM e_fact WHERE region_key = '7'
    UNION ALL SELECT 'invalid_dates', 'PASS', 0.0
    UNION ALL SELECT 'unmatched_indicators', 'PASS', 0.0
    UNION ALL SELECT 'unmatched_regions', 'FAIL', 2.0""",
)
def q15(spark, sf_dir):
    """One region's key is lost in the fact: a missing key and an unknown (NULL) one."""
    fact, staged = _fact_and_staged(spark, sf_dir)
    lost = F.when(F.col("region_key") != "7", F.col("region_key"))
    return quality.reconciliation(fact.withColumn("region_key", lost), staged)
