from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lumbung.functions import columns
from lumbung.schemas import VALUE


def value_of(spark, expression, text):
    df = spark.createDataFrame([(text,)], "x string")
    return df.select(expression(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "period, key",
    [("2023", 20230101), ("2023-01", 20230101), ("2023-01-01", 20230101), ("2023-8-15", 20230815),
     (" 2023-02\n", 20230201), ("", 0), (None, 0), ("2023-13", 20231301), ("x", None), ("2023-x", None)],
)
def test_period_date_key(spark, period, key):
    assert value_of(spark, columns.period_date_key, period) == key


@pytest.mark.parametrize(
    "text, number",
    [("1", 1), (" 1.5\t", Decimal("1.5")), ("1e2", 100), (".5", Decimal("0.5")), ("-7.", -7),
     ("NaN", None), ("Infinity", None), ("1d", None), ("1,5", None), ("", None), (None, None),
     ("1" * 15, None), ("0.1234567", Decimal("0.123457"))],
)
def test_lenient_decimal(spark, text, number):
    assert value_of(spark, lambda c: columns.numeric(c, VALUE), text) == number


@pytest.mark.parametrize("text", ["NaN", "Infinity", "1d", "0x1", None])
def test_lenient_double_takes_only_numbers(spark, text):
    assert value_of(spark, lambda c: columns.numeric(c, columns.T.DoubleType()), text) is None


@pytest.mark.parametrize("text, year", [("2020", 2020), (" 2020 ", 2020), ("2020.0", 2020), ("2020.5", None), ("x", None)])
def test_whole_year(spark, text, year):
    assert value_of(spark, columns.whole_year, text) == year


@pytest.mark.parametrize("text", ["  GDP \n", "gdp", "\x1cGdp\t"])
def test_match_name(spark, text):
    assert value_of(spark, columns.match_name, text) == "gdp"


def test_empty_names_never_match(spark):
    assert value_of(spark, columns.match_name, " \t") is None


@pytest.mark.parametrize("wanted, found", [(None, True), ("", True), ("a, b", True), ("a", False), (["b"], True)])
def test_lists(spark, wanted, found):
    assert value_of(spark, lambda c: columns.listed(c, wanted), "b") is found
