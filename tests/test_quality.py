from __future__ import annotations

import pytest

from conftest import REGION_CODES, responses, rows, wide_response
from lumbung.operators import model, quality, staging
from lumbung.schemas import DIMENSIONS

VALID = [("145", "1100", "2023", "12.5"), ("145", "1200", "2023", "48.25"), ("145", "1300", "2023", "7.75")]


def frame(spark, data=VALID, names="variable_id region_id year value"):
    return spark.createDataFrame(data, ", ".join(f"{n} string" for n in names.split()))


def statuses(results):
    return {row["check"]: row["status"] for row in results.collect()}


def changed(index, position, value):
    data = [list(row) for row in VALID]
    data[index][position] = value
    return [tuple(row) for row in data]


def test_valid_data_passes(spark):
    results = quality.validate(frame(spark), context="var=145")
    assert statuses(results) == {
        "context": "INFO", "required_columns": "PASS", "empty_dataset": "PASS",
        "missing_values": "PASS", "duplicates": "PASS", "numeric_value": "PASS",
        "period": "PASS", "negative_values": "PASS",
    }
    assert rows(quality.passed(results)) == [(True,)]
    text = quality.summary(results)
    assert "Quality checks" in text and "Result: PASSED" in text
    assert "years 2023 to 2023" in text and "3 rows" in text


def test_missing_column_stops_the_checks(spark):
    results = quality.validate(frame(spark).drop("value"))
    assert statuses(results) == {"required_columns": "FAIL"}
    with pytest.raises(quality.QualityError, match="value"):
        quality.gate(results)


def test_empty_dataset_stops_the_checks(spark):
    results = quality.validate(frame(spark, []), allowed_regions=["1100"])
    assert statuses(results) == {"required_columns": "PASS", "empty_dataset": "FAIL"}


@pytest.mark.parametrize(
    "data, check, status, bad",
    [
        (changed(0, 3, None), "missing_values", "FAIL", 1),
        ([*VALID, VALID[0], VALID[0]], "duplicates", "FAIL", 2),
        (changed(1, 3, "not_a_number"), "numeric_value", "FAIL", 1),
        (changed(1, 3, "NaN"), "numeric_value", "FAIL", 1),
        (changed(1, 2, "invalid"), "period", "FAIL", 1),
        (changed(1, 2, "1850"), "period", "FAIL", 1),
        (changed(0, 3, "-3.5"), "negative_values", "WARN", 1),
        (changed(0, 3, "x"), "negative_values", "SKIP", 0),
    ],
)
def test_one_broken_rule(spark, data, check, status, bad):
    got = {r["check"]: (r["status"], r["bad_rows"]) for r in quality.validate(frame(spark, data)).collect()}
    assert got[check] == (status, bad)


def test_warnings_do_not_fail_the_gate(spark):
    warnings = quality.gate(quality.validate(frame(spark, changed(0, 3, "-1"))))
    assert len(warnings) == 1 and "negative" in warnings[0]


@pytest.mark.parametrize("as_table", [False, True])
def test_region_codes(spark, as_table):
    def allowed(codes):
        return spark.createDataFrame([(c,) for c in codes], "region_code string") if as_table else codes

    data = [*VALID, ("1", None, "2023", "1"), VALID[2]]
    result = quality.validate(frame(spark, data), allowed_regions=allowed(["1100", "1200"]))
    check = [r for r in result.collect() if r["check"] == "region_codes"][0]
    assert (check["status"], check["bad_rows"]) == ("FAIL", 3)
    assert "1300, None" in check["details"]
    fine = quality.validate(frame(spark), allowed_regions=allowed(["1100", "1200", "1300"]))
    assert statuses(fine)["region_codes"] == "PASS"


def test_missing_values_counts_nan(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", float("nan")), ("c", None)], "k string, value double")
    result = quality.validate(df, required=["k", "value"], numeric_columns=[])
    check = [r for r in result.collect() if r["check"] == "missing_values"][0]
    assert check["bad_rows"] == 2 and check["details"] == "2 required values are NULL (value: 2)"


def test_mapping_check(spark):
    df = frame(spark, [("1", None, "2020", "1")])
    assert rows(quality.mapping_check(df), "status") == [("WARN",)]
    assert rows(quality.mapping_check(frame(spark, [])), "status") == [("FAIL",)]
    assert rows(quality.mapping_check(frame(spark)), "status") == [("PASS",)]


def test_orphans_and_referential_integrity(spark):
    fact = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "region_key string")
    dim = spark.createDataFrame([("a",)], "region_key string")
    assert rows(quality.orphans(fact, dim, "region_key", "region_key")) == [("b", 2)]
    found = quality.referential_integrity(fact, {"region_key": (dim, "region_key")})
    assert rows(found) == [("region_key", 1, 2)]


def test_constraints(spark):
    data = [("1", "1", "a"), ("1", "2", None), ("3", None, "c")]
    df = spark.createDataFrame(data, "region_key string, region_code string, region_name string")
    found = dict(rows(quality.constraints(df, DIMENSIONS["dim_region"])))
    assert found == {
        "unique(region_key)": 1, "unique(region_code)": 0, "not_null(region_key)": 0,
        "not_null(region_code)": 1, "not_null(region_name)": 1,
    }


def test_reconciliation_of_the_fixture(spark):
    staged = staging.stage(responses(spark, wide_response()), REGION_CODES).data
    fact = model.build_fact_economic(staged)
    assert quality.value_mismatches(fact, staged).count() == 0
    assert set(rows(quality.reconciliation(fact, staged), "status")) == {("PASS",)}
    from pyspark.sql import functions as F

    wrong = fact.withColumn("value", F.when(F.col("region_key") == "1100", 1).otherwise(F.col("value")))
    assert quality.value_mismatches(wrong, staged).count() == 3
    got = {r[0]: r[1] for r in rows(quality.reconciliation(wrong, staged))}
    assert got["total_difference"] == "FAIL" and got["unmatched_regions"] == "PASS"
    assert dict(rows(quality.load_verification(spark, {"a": fact, "b": fact.limit(0)}), "table_name", "status")) == {
        "a": "PASS", "b": "FAIL",
    }
