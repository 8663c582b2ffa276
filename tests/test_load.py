from __future__ import annotations

import itertools
from decimal import Decimal

import pytest

from conftest import rows
from lumbung.operators.load import Warehouse
from lumbung.schemas import WAREHOUSE_TABLES

_ids = itertools.count()


@pytest.fixture
def warehouse(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path), f"t{next(_ids)}_")
    yield house
    house.drop_schemas()


FACT = "date_key int, region_key string, indicator_key string, value decimal(20,6), year int, n int"


def fact(spark, data):
    return spark.createDataFrame(
        [(year * 10000 + 101, region, "145", Decimal(value), year, n) for n, (year, region, value) in enumerate(data)],
        FACT,
    )


def values(house):
    return sorted(rows(house.table("warehouse", "fact_economic"), "year", "region_key", "value"))


def test_tables_are_created_once_with_their_types(spark, warehouse):
    warehouse.create_tables()
    for name, spec in WAREHOUSE_TABLES.items():
        found = warehouse.table("warehouse", name).schema
        assert [(f.name, f.dataType) for f in found] == [(f.name, f.dataType) for f in spec.schema]
    warehouse.create_tables()
    assert warehouse.is_empty("warehouse", "fact_trade")
    assert not warehouse.exists("warehouse", "fact_other")


def test_upsert_inserts_updates_and_repeats(spark, warehouse):
    first = fact(spark, [(2020, "a", "1"), (2020, "b", "2"), (2021, "a", "3")])
    assert warehouse.upsert(first, "fact_economic", update=["value"], ordinal="n") == 3
    before = {r["region_key"]: r["loaded_at"] for r in warehouse.table("warehouse", "fact_economic").where("year = 2020").collect()}
    second = fact(spark, [(2020, "a", "9"), (2020, "c", "7"), (2020, "c", "8"), (2022, "a", "5")])
    for _ in range(2):
        assert warehouse.upsert(second, "fact_economic", update=["value"], ordinal="n") == 4
        assert values(warehouse) == [
            (2020, "a", 9), (2020, "b", 2), (2020, "c", 8), (2021, "a", 3), (2022, "a", 5),
        ]
    after = {r["region_key"]: r["loaded_at"] for r in warehouse.table("warehouse", "fact_economic").where("year = 2020").collect()}
    assert after["a"] == before["a"]
    keys = rows(warehouse.table("warehouse", "fact_economic"), "fact_key")
    assert len(set(keys)) == 5


def test_untouched_years_are_not_rewritten(spark, warehouse):
    warehouse.upsert(fact(spark, [(2020, "a", "1"), (2021, "a", "2")]), "fact_economic")

    def files(year):
        table = warehouse.table("warehouse", "fact_economic").where(f"year = {year}")
        return {r[0] for r in table.select("_metadata.file_path").collect()}

    old = {year: files(year) for year in (2020, 2021)}
    warehouse.upsert(fact(spark, [(2021, "b", "3")]), "fact_economic")
    assert files(2020) == old[2020]
    assert not files(2021) & old[2021]


def test_empty_update_list_keeps_existing_and_first_rows(spark, warehouse):
    warehouse.upsert(fact(spark, [(2020, "a", "1")]), "fact_economic")
    batch = fact(spark, [(2020, "a", "9"), (2020, "b", "5"), (2020, "b", "6")])
    assert warehouse.upsert(batch, "fact_economic", update=[], ordinal="n") == 3
    assert values(warehouse) == [(2020, "a", 1), (2020, "b", 5)]


def test_partial_update_of_a_dimension(spark, warehouse):
    schema = "region_key string, region_code string, region_name string, province_name string, n int"
    warehouse.upsert(spark.createDataFrame([("1", "1", "old", "p", 0)], schema), "dim_region", ordinal="n")
    batch = [("1", "1", "new", "q", 1), ("2", "2", "x", "first", 2), ("2", "2", "y", "last", 3)]
    warehouse.upsert(
        spark.createDataFrame(batch, schema), "dim_region", update=["region_name"], ordinal="n"
    )
    got = rows(warehouse.table("warehouse", "dim_region"), "region_key", "region_name", "province_name")
    assert sorted(got) == [("1", "new", "p"), ("2", "y", "first")]


def test_defaults_of_absent_columns(spark, warehouse):
    df = spark.createDataFrame([("1", "GDP")], "indicator_key string, indicator_name string")
    warehouse.upsert(df, "dim_indicator")
    assert rows(warehouse.table("warehouse", "dim_indicator"), "aggregation_method", "unit") == [("SUM", None)]


def test_null_key_rows_are_always_inserted(spark, warehouse):
    schema = (
        "date_key int, product_key string, country_key string, port_key string, trade_type string, "
        "value_usd decimal(20,2), year int"
    )
    data = [
        (20230101, "p", "c", None, "ekspor", Decimal(1), 2023),
        (20230101, "p", "c", "x", "ekspor", Decimal(2), 2023),
        (None, "p", "c", "x", "ekspor", Decimal(3), None),
    ]
    df = spark.createDataFrame(data, schema)
    for run in (1, 2):
        assert warehouse.upsert(df, "fact_trade") == 3
        got = rows(warehouse.table("warehouse", "fact_trade"), "value_usd")
        assert sorted(int(v) for (v,) in got) == sorted([2] + [1, 3] * run)


def test_null_in_a_required_key_is_an_error(spark, warehouse):
    bad = fact(spark, [(2020, None, "1")])
    with pytest.raises(Exception, match="region_key violates"):
        warehouse.upsert(bad, "fact_economic", ordinal="n")


def test_empty_batch_changes_nothing(spark, warehouse):
    assert warehouse.upsert(fact(spark, []), "fact_economic") == 0
    warehouse.upsert(fact(spark, [(2020, "a", "1")]), "fact_economic")
    assert warehouse.upsert(fact(spark, []), "fact_economic") == 0
    assert values(warehouse) == [(2020, "a", 1)]


def test_load_modes_truncate_and_mart(spark, warehouse):
    df = spark.createDataFrame([(1,), (2,)], "x int")
    warehouse.load(df, "staging", "numbers")
    warehouse.load(df, "staging", "numbers")
    assert warehouse.row_count("staging", "numbers") == 4
    warehouse.load(df, "staging", "numbers", "replace")
    assert warehouse.row_count("staging", "numbers") == 2
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        warehouse.load(df, "staging", "numbers", "fail")
    warehouse.truncate("staging", "numbers")
    assert warehouse.is_empty("staging", "numbers")
    warehouse.build_mart(df, "m")
    warehouse.build_mart(df.limit(1), "m")
    assert warehouse.row_count("mart", "m") == 1
