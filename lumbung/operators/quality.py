"""Data quality checks: one row per check with status, number of offending rows and details.

Statuses are PASS, FAIL, WARN, INFO and SKIP; only FAIL fails a run.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbung.functions.columns import constant_rows, numeric, period_date_key
from lumbung.schemas import MONEY, TableSpec

RESULT_COLUMNS = ("check", "status", "bad_rows", "details")

# What is checked unless the caller says otherwise, and the valid years.
REQUIRED_COLUMNS = ("variable_id", "region_id", "year", "value")
NUMERIC_COLUMNS = ("value",)
YEAR_RANGE = (1900, 2200)
SHOWN_OFFENDERS = 10

_NUMBER = T.DoubleType()


class QualityError(Exception):
    """The data may not be loaded."""


def validate(
    df: DataFrame,
    context: str | None = None,
    required: Sequence[str] = REQUIRED_COLUMNS,
    numeric_columns: Sequence[str] = NUMERIC_COLUMNS,
    allowed_regions: DataFrame | Sequence[str] | None = None,
) -> DataFrame:
    """All checks of a staged frame.

    Equal rows are merged first, map side, which counts duplicates and leaves every other
    check one weighted row per distinct row. Then a single aggregate computes all counters.
    `allowed_regions` is a list of codes or a DataFrame with the column `region_code`.
    """
    spark = df.sparkSession
    first = [("context", "INFO", 0, context)] if context else []
    missing = [column for column in required if column not in df.columns]
    if missing:
        failed = ("required_columns", "FAIL", len(missing), f"missing columns {missing}")
        return constant_rows(spark, RESULT_COLUMNS, [*first, failed])
    first.append(
        ("required_columns", "PASS", 0, f"all required columns present: {list(required)}")
    )

    numeric_columns = [column for column in numeric_columns if column in df.columns]
    distinct = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    counters = distinct.agg(_repeated(), *_counters(df, required, numeric_columns, F.col("_n")))
    result = _reported(counters, df.columns, required, numeric_columns)
    if _given(allowed_regions) and "region_id" in df.columns:
        result = result.unionByName(region_check(df, allowed_regions))
    return constant_rows(spark, RESULT_COLUMNS, first).unionByName(result)


def _given(allowed: DataFrame | Sequence[str] | None) -> bool:
    """Whether regions are restricted; an empty list restricts nothing."""
    return isinstance(allowed, DataFrame) or bool(allowed)


def _reported(
    counters: DataFrame, columns: Sequence[str], required: Sequence[str], numeric_columns: Sequence[str]
) -> DataFrame:
    """The checks that one row of counters stands for."""
    checks = [
        *_table_checks(required),
        *[_numeric_check(column) for column in numeric_columns],
        *([_period_check()] if "year" in columns else []),
        *([_negative_check()] if "value" in columns else []),
    ]
    # Nothing but the emptiness check is reported for an empty dataset.
    kept = F.filter(
        F.array(*checks),
        lambda c: (F.col("_rows") > 0) | (c["check"] == "empty_dataset"),
    )
    return counters.select(F.inline(kept))


def _repeated() -> Column:
    """Rows beyond the first of equal ones, of groups of `_n`."""
    return F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("_duplicates")


def _absent(df: DataFrame, column: str) -> Column:
    missing = F.col(column).isNull()
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        missing = missing | F.isnan(column)
    return missing


def _counters(
    df: DataFrame, required: Sequence[str], numeric_columns: Sequence[str], weight: Column
) -> list[Column]:
    """Counters of rows that stand for `weight` rows each."""

    def weighted(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, weight)), F.lit(0))

    counters = [
        F.coalesce(F.sum(weight), F.lit(0)).alias("_rows"),
        *[weighted(_absent(df, column)).alias(f"_null_{column}") for column in required],
    ]
    for column in numeric_columns:
        broken = numeric(F.col(column), _NUMBER).isNull() & ~_absent(df, column)
        counters.append(weighted(broken).alias(f"_broken_{column}"))
    if "year" in df.columns:
        year = numeric(F.col("year"), _NUMBER)
        low, high = YEAR_RANGE
        counters += [
            weighted(year.isNull()).alias("_bad_years"),
            weighted((year < low) | (year > high)).alias("_far_years"),
            F.min(year).cast("int").alias("_first_year"),
            F.max(year).cast("int").alias("_last_year"),
        ]
    if "value" in df.columns:
        value = numeric(F.col("value"), _NUMBER)
        counters += [
            weighted(value.isNull()).alias("_no_values"),
            weighted(value < 0).alias("_negative"),
        ]
    return counters


def _check(name: str, status: Column, bad: Column, details: Column) -> Column:
    return F.struct(
        F.lit(name).alias("check"),
        status.alias("status"),
        bad.cast("long").alias("bad_rows"),
        details.alias("details"),
    )


def _pass_or_fail(name: str, bad: Column, passed: Column, failed: Column) -> Column:
    return _check(
        name,
        F.when(bad > 0, "FAIL").otherwise("PASS"),
        bad,
        F.when(bad > 0, failed).otherwise(passed),
    )


def _table_checks(required: Sequence[str]) -> list[Column]:
    rows, duplicates = F.col("_rows"), F.col("_duplicates")
    nulls = [F.col(f"_null_{column}") for column in required]
    missing = sum(nulls[1:], nulls[0])
    by_column = F.array_join(
        F.filter(
            F.array(*[
                F.when(count > 0, F.concat_ws(": ", F.lit(column), count))
                for column, count in zip(required, nulls)
            ]),
            lambda text: text.isNotNull(),
        ),
        ", ",
    )
    return [
        _check(
            "empty_dataset",
            F.when(rows == 0, "FAIL").otherwise("PASS"),
            F.lit(0),
            F.when(rows == 0, "no rows at all").otherwise(
                F.format_string("%d rows", rows)
            ),
        ),
        _pass_or_fail(
            "missing_values", missing, F.lit("every required column is filled"),
            F.format_string("%d required values are NULL (%s)", missing, by_column),
        ),
        _pass_or_fail(
            "duplicates", duplicates, F.lit("all rows differ"),
            F.format_string("%d rows repeat another", duplicates),
        ),
    ]


def _numeric_check(column: str) -> Column:
    broken = F.col(f"_broken_{column}")
    return _pass_or_fail(
        f"numeric_{column}", broken, F.lit("every value is a number"),
        F.format_string("%d values are no numbers", broken),
    )


def _period_check() -> Column:
    bad, far = F.col("_bad_years"), F.col("_far_years")
    return _pass_or_fail(
        "period", bad + far,
        F.format_string("years %d to %d", "_first_year", "_last_year"),
        F.format_string("%d years cannot be read, %d lie outside the calendar", bad, far),
    )


def _negative_check() -> Column:
    skipped, negative = F.col("_no_values") > 0, F.col("_negative")
    return _check(
        "negative_values",
        F.when(skipped, "SKIP").when(negative > 0, "WARN").otherwise("PASS"),
        F.when(skipped, 0).otherwise(negative),
        F.when(skipped, "not checked, as some values are no numbers")
        .when(negative > 0, F.format_string(
            "%d values are below zero", negative))
        .otherwise("no value is below zero"),
    )


def region_check(rows: DataFrame, allowed: DataFrame | Sequence[str]) -> DataFrame:
    """Rows whose region is not allowed, with the first offending codes in code order.

    A NULL region is an offender; an empty dataset gives no check.
    """
    by_region = rows.groupBy(F.col("region_id").cast("string").alias("region_id")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    if isinstance(allowed, DataFrame):
        codes = allowed.select(F.col("region_code").cast("string").alias("region_id")).distinct()
        marked = by_region.join(codes.withColumn("_known", F.lit(True)), "region_id", "left")
        marked = marked.withColumn("_known", F.coalesce("_known", F.lit(False)))
    else:
        known = F.col("region_id").isin([str(code) for code in allowed])
        marked = by_region.withColumn("_known", F.coalesce(known, F.lit(False)))
    # The offenders to show are the smallest codes: a bounded top list, not a collected set.
    shown = (
        marked.where(~F.col("_known"))
        .select(F.coalesce("region_id", F.lit("None")).alias("region_id"))
        .orderBy("region_id")
        .limit(SHOWN_OFFENDERS)
        .agg(F.array_join(F.sort_array(F.collect_list("region_id")), ", ").alias("codes"))
    )
    totals = marked.agg(
        F.coalesce(F.sum(F.when(~F.col("_known"), F.col("_n"))), F.lit(0)).alias("_bad"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("_all"),
    ).withColumn("codes", shown.scalar())
    bad = F.col("_bad")
    check = _pass_or_fail(
        "region_codes", bad, F.lit("every region is known"),
        F.format_string("%d rows have an unknown region, such as %s", bad, "codes"),
    )
    return totals.where(F.col("_all") > 0).select(F.inline(F.array(check)))


# Verdict and gate


def passed(results: DataFrame) -> DataFrame:
    """One row: does no check FAIL?"""
    return results.agg(F.coalesce(F.bool_and(F.col("status") != "FAIL"), F.lit(True)).alias("passed"))


def summary(results: DataFrame) -> str:
    """Readable report; the results hold one row per check."""
    checks = results.collect()
    verdict = "FAILED" if any(check["status"] == "FAIL" for check in checks) else "PASSED"
    lines = [f"  [{check['status']}] {check['check']}: {check['details']}" for check in checks]
    return "\n".join(["Quality checks:", *lines, f"Result: {verdict}"])


def gate(results: DataFrame) -> list[str]:
    """Raise QualityError on any FAIL, with one evaluation; returns warnings."""
    checks = results.collect()
    failed = [f"{c['check']}: {c['details']}" for c in checks if c["status"] == "FAIL"]
    if failed:
        raise QualityError("; ".join(failed))
    return [f"{c['check']}: {c['details']}" for c in checks if c["status"] == "WARN"]


def mapping_check(staged: DataFrame) -> DataFrame:
    """FAIL without staged rows, WARN where every region is NULL."""
    counted = staged.agg(F.count(F.lit(1)).alias("rows"), F.count("region_id").alias("mapped"))
    return counted.select(F.inline(F.array(_mapping_check(F.col("rows"), F.col("mapped")))))


def _mapping_check(rows: Column, mapped: Column) -> Column:
    return _check(
        "region_mapping",
        F.when(rows == 0, "FAIL").when(mapped == 0, "WARN").otherwise("PASS"),
        rows - mapped,
        F.when(rows == 0, "nothing was staged")
        .when(mapped == 0, "no row has a region")
        .otherwise(F.format_string("%d of %d rows have a region", mapped, rows)),
    )


def trade_checks(records: DataFrame) -> DataFrame:
    """Checks of trade records before a load: periods and key columns FAIL, amounts WARN.

    A record whose period has no date key, or that lacks a key column, would be inserted anew by
    every load.
    """
    return _trade_reported(records.agg(*_trade_counters()))


def _trade_counters() -> list[Column]:
    keys = ("trade_type", "commodity_code", "country_code", "port_code")
    keyless = F.greatest(F.lit(False), F.lit(False), *[F.col(key).isNull() for key in keys])

    def unread(name: str) -> Column:
        return F.col(name).isNotNull() & numeric(F.col(name), MONEY).isNull()

    return [
        F.count_if(period_date_key(F.col("period")).isNull()).alias("periods"),
        F.count_if(keyless).alias("keys"),
        F.count_if(unread("value_usd") | unread("net_weight_kg")).alias("amounts"),
    ]


def _trade_reported(counters: DataFrame) -> DataFrame:
    checks = [
        _check(
            name,
            F.when(F.col(column) > 0, bad).otherwise("PASS"),
            F.col(column),
            F.format_string(f"%d records {what}", F.col(column)),
        )
        for name, column, bad, what in (
            ("trade_period", "periods", "FAIL", "have a period that cannot be read"),
            ("trade_keys", "keys", "FAIL", "lack a flow, product, country or port"),
            ("trade_amounts", "amounts", "WARN", "have an amount that is no number"),
        )
    ]
    return counters.select(F.inline(F.array(*checks)))


# Checks of rows while they are written


class CountedWrite:
    """Rows whose counters are gathered by the one action that writes `rows`.

    Nothing may be shuffled between `rows` and the files: in the stage that writes, a task counts
    once however often it is tried, in an earlier one it would count again after a lost executor.
    """

    def __init__(self, df: DataFrame, counters: Sequence[Column]):
        self._counted = Observation()
        self.rows = df.observe(self._counted, *counters)

    def values(self) -> dict[str, int | None]:
        """The counters by name, once the rows are written."""
        return self._counted.get

    def columns(self) -> list[Column]:
        """The same as constant columns."""
        return [F.lit(count).cast("long").alias(name) for name, count in self.values().items()]


def count_observations(staged: DataFrame) -> CountedWrite:
    """Staged observations with the counters of `validate` and `mapping_check`."""
    return CountedWrite(staged, _counters(staged, REQUIRED_COLUMNS, NUMERIC_COLUMNS, F.lit(1)))


def written_checks(counted: CountedWrite, written: DataFrame, context: str | None = None) -> DataFrame:
    """What `mapping_check` and `validate` say of observations that have just been written.

    Rows that repeat another are no matter of one row, so those are grouped once more, from `written`,
    the written rows in the columns that tell them apart.
    """
    repeats = written.groupBy(*written.columns).agg(F.count(F.lit(1)).alias("_n")).agg(_repeated())
    counters = repeats.select("*", *counted.columns())
    mapped = F.col("_rows") - F.col("_null_region_id")
    known = written.sparkSession.range(0, 1, 1, 1).select(*counted.columns())
    mapping = known.select(F.inline(F.array(_mapping_check(F.col("_rows"), mapped))))
    first = [("context", "INFO", 0, context)] if context else []
    first.append(("required_columns", "PASS", 0, f"all required columns present: {list(REQUIRED_COLUMNS)}"))
    return _stacked([
        mapping, constant_rows(written.sparkSession, RESULT_COLUMNS, first),
        _reported(counters, written.columns, REQUIRED_COLUMNS, NUMERIC_COLUMNS),
    ])


def count_trade(records: DataFrame) -> CountedWrite:
    """Trade records with the counters of `trade_checks`."""
    return CountedWrite(records, _trade_counters())


def written_trade_checks(spark: SparkSession, counted: CountedWrite) -> DataFrame:
    """What `trade_checks` says of records that have just been written; reads no record."""
    return _trade_reported(spark.range(0, 1, 1, 1).select(*counted.columns()))


# Warehouse checks


def orphans(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Fact keys without a dimension row and how many fact rows carry each.

    Keys are merged before the join, so a key that many rows share travels once. A NULL key
    refers to nothing and is no orphan.
    """
    keys = (
        fact.where(F.col(fact_key).isNotNull())
        .groupBy(F.col(fact_key).alias("key"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return keys.join(dim.select(F.col(dim_key).alias("key")), "key", "left_anti")


def referential_integrity(
    fact: DataFrame, references: Mapping[str, tuple[DataFrame, str]]
) -> DataFrame:
    """Orphan keys and rows per foreign key."""
    parts = [
        orphans(fact, dim, column, dim_key).agg(
            F.lit(column).alias("foreign_key"),
            F.count(F.lit(1)).alias("orphan_keys"),
            F.coalesce(F.sum("rows"), F.lit(0)).alias("orphan_rows"),
        )
        for column, (dim, dim_key) in references.items()
    ]
    return _stacked(parts)


def _stacked(parts: Sequence[DataFrame]) -> DataFrame:
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    return table


def repeated_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; rows with a NULL in the key are distinct."""
    whole = df
    for column in key:
        whole = whole.where(F.col(column).isNotNull())
    return whole.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def constraints(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Violations of NOT NULL, primary key and unique keys of a table."""
    parts = [
        repeated_keys(df, key).agg(
            F.lit(f"unique({', '.join(key)})").alias("rule"),
            F.count(F.lit(1)).alias("violations"),
        )
        for key in ([spec.key] if spec.key else []) + list(spec.unique)
    ]
    if spec.required:
        nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in spec.required])
        pairs = F.array(*[
            F.struct(F.lit(f"not_null({c})").alias("rule"), F.col(c).alias("violations"))
            for c in spec.required
        ])
        parts.append(nulls.select(F.inline(pairs)))
    return _stacked(parts)


def load_verification(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of each loaded table; a table without rows fails."""
    counts = [
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows"))
        for name, df in tables.items()
    ]
    return _stacked(counts).withColumn(
        "status", F.when(F.col("rows") > 0, "PASS").otherwise("FAIL")
    )


# Reconciliation


def _last_staged(staged: DataFrame, order: str | Column | None) -> DataFrame:
    """One staged value per grain: the last by `order`, or the greatest without one."""
    value = F.max("value") if order is None else F.max_by("value", order)
    return staged.groupBy("year", "region_id", "variable_id").agg(value.alias("staged_value"))


def value_mismatches(
    fact: DataFrame, staged: DataFrame, order: str | Column | None = "ordinal"
) -> DataFrame:
    """Fact rows that differ from their staged value at six decimals, or have none.

    Both sides have one row per grain, so the join cannot fan out.
    """
    source = _last_staged(staged, order).withColumnsRenamed(
        {"region_id": "region_key", "variable_id": "indicator_key"}
    )
    return (
        fact.select("year", "region_key", "indicator_key", "value")
        .join(source, ["year", "region_key", "indicator_key"], "left")
        .where(~F.round("value", 6).eqNullSafe(F.round("staged_value", 6)))
    )


def reconciliation(fact: DataFrame, staged: DataFrame) -> DataFrame:
    """Fact against the staged rows it came from, as checks.

    Totals agree, both sides have the same indicators and regions, the fact has no NULL and
    every date key is the first of January of a valid year.
    """
    low, high = YEAR_RANGE
    day, year = F.col("date_key") % 10000, F.floor(F.col("date_key") / 10000)
    valid_date = (day == 101) & year.between(low, high)
    grain = ["date_key", "region_key", "indicator_key", "value"]
    any_null = F.greatest(*[F.col(c).isNull() for c in grain])
    in_fact = fact.agg(
        F.coalesce(F.sum("value"), F.lit(0)).alias("total"),
        F.count_if(any_null).alias("nulls"),
        F.count_if(~F.coalesce(valid_date, F.lit(False))).alias("dates"),
    )
    staged_total = staged.agg(F.coalesce(F.sum("value"), F.lit(0)))
    difference = F.round(F.col("total"), 6) - F.round(staged_total.scalar(), 6)

    def result(name: str, bad: Column) -> Column:
        return F.struct(
            F.lit(name).alias("check"),
            F.when(bad == 0, "PASS").otherwise("FAIL").alias("status"),
            bad.cast("double").alias("amount"),
        )

    checks = in_fact.select(
        F.inline(F.array(
            result("total_difference", difference),
            result("null_rows", F.col("nulls")),
            result("invalid_dates", F.col("dates")),
        ))
    )
    key_sets = [
        _key_difference(fact, staged, "indicator_key", "variable_id"),
        _key_difference(fact, staged, "region_key", "region_id"),
    ]
    return _stacked([checks, *[
        keys.select(F.inline(F.array(result(name, F.col("missing")))))
        for name, keys in zip(("unmatched_indicators", "unmatched_regions"), key_sets)
    ]])


def _key_difference(fact: DataFrame, staged: DataFrame, fact_key: str, staged_key: str) -> DataFrame:
    """Number of keys that only one side has."""
    left = fact.select(F.col(fact_key).cast("string").alias("key"), F.lit(1).alias("side"))
    right = staged.select(F.col(staged_key).cast("string").alias("key"), F.lit(2).alias("side"))
    sides = left.unionByName(right).groupBy("key").agg(F.bit_or("side").alias("sides"))
    return sides.agg(F.count_if(F.col("sides") != 3).alias("missing"))
