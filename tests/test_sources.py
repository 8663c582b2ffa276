from __future__ import annotations

import datetime as dt
import json
from pathlib import Path

import pytest

from conftest import REGION_CODES, responses, rows, wide_response
from lumbung.operators import staging
from lumbung.sources import landing
from lumbung.sources import responses as parsers

TRADE = [
    ("ekspor", "70010000", "AA", "P-ONE", "2023", "5100.25", "9000.00"),
    ("ekspor", "70010000", "BB", "P-ONE", "2023", "2400.50", "4000.00"),
]


def trade_body(records):
    names = ("jenis", "kode_barang", "kode_negara", "kode_pelabuhan", "periode", "nilai", "berat_bersih")
    return json.dumps({"status": "200", "data": [dict(zip(names, r)) for r in records]})


@pytest.mark.parametrize(
    "body, expected",
    [
        ({"data": [{"page": 1}, [{"domain_id": "1100", "domain_name": "Aceh"},
                                 {"domain_id": "1200", "domain_name": "Sumut"}]]},
         [("1100", "Aceh"), ("1200", "Sumut")]),
        ({"data": [{"kode": "1100", "nama": "Aceh"}, {"x": 1}, {"kode": "1200", "nama": "Sumut"}]},
         [("1100", "Aceh"), ("1200", "Sumut")]),
        ([{"domain_id": "", "kode": "1100", "nama": "Aceh"}], [("1100", "Aceh")]),
        # The first nested list replaces what came before it and ends the search.
        ({"data": [{"kode": "1", "nama": "a"}, [{"kode": "2", "nama": "b"}], [{"kode": "3"}]]},
         [("2", "b")]),
        ({"data": []}, []),
        ({"status": "200"}, []),
    ],
)
def test_region_list_shapes(spark, body, expected):
    got = parsers.region_records(responses(spark, json.dumps(body))).orderBy("position")
    assert rows(got, "region_code", "region_name") == expected


def test_plain_variables_and_content(spark):
    body = wide_response(
        vervar=[{"id": "1", "label": "a", "description": "d", "unit": "u"}],
        datacontent=[["2023", "1", "2"], [], ["2024", "3"]],
    )
    parsed = parsers.parse_statistics(responses(spark, body))
    assert rows(parsers.variables(parsed), "variable_id", "variable_name") == [("145", "Output")]
    assert rows(parsers.vertical_variables(parsed)) == [("doc0", 0, "1", "a", "d", "u")]
    assert rows(parsers.content_rows(parsed), "year", "values", "region_names") == [
        ("2023", ["1", "2"], "Output by region"), ("2024", ["3"], "Output by region"),
    ]


def test_trade_records_keep_text(spark):
    got = rows(parsers.trade_records(responses(spark, trade_body(TRADE))).orderBy("position"))
    assert got[0] == (
        "doc0", 0, "ekspor", "70010000", None, "AA", None, "P-ONE", None, "2023", "5100.25",
        "9000.00",
    )
    assert len(got) == 2
    assert rows(parsers.trade_records(responses(spark, '{"data": []}'))) == []


def test_trade_selection(spark):
    records = parsers.trade_records(responses(spark, trade_body(TRADE)))
    assert parsers.select_trade(records, "ekspor", "2023").count() == 2
    assert parsers.select_trade(records, "ekspor", country_code="BB").count() == 1
    assert parsers.select_trade(records, "impor").count() == 0


def test_glossary_and_dataset_records(spark):
    glossary = json.dumps({"data": [{"id": "G1", "nama_indikator": "Output", "konsep": "k"}]})
    got = rows(parsers.glossary_records(responses(spark, glossary)))
    assert got == [("doc0", 0, "G1", "Output", "k", None, None, None, None, None)]
    dataset = json.dumps({"data": [{"id": "1", "judul": "a"}, {"id": "2", "judul": "b"}]})
    docs = responses(spark, dataset, '{"data": []}')
    assert rows(parsers.dataset_records(docs, first_only=True), "table_id", "title") == [("1", "a")]
    assert parsers.dataset_records(docs).count() == 2


def test_observation_selection_by_lists(spark):
    staged = staging.stage(responses(spark, wide_response()), REGION_CODES).data
    assert parsers.select_observations(staged, "145", "2020, 2022").count() == 8
    assert parsers.select_observations(staged, "145,9").count() == 12
    assert parsers.select_observations(staged, vervar="1").count() == 0


def test_landing_keeps_the_last_response_of_a_day(spark, tmp_path):
    base = str(tmp_path / "landing")
    schema = "source string, dataset string, landed_on date, body string, n int"
    day = dt.date(2024, 3, 5)
    first = [
        ("dynamic_data", "0145", day, wide_response(status="old"), 1),
        ("dynamic_data", "0145", day, wide_response(status="new"), 2),
        ("domain", "prov", day, '{"data": []}', 3),
    ]
    landing.land_responses(spark.createDataFrame(first, schema), base, "n")
    landed = landing.read_landed(spark, base)
    assert sorted(rows(landed, "source", "dataset", "year", "month", "day")) == [
        ("domain", "prov", 2024, 3, 5), ("dynamic_data", "0145", 2024, 3, 5),
    ]
    body = landing.read_landed(spark, base, "dynamic_data").first()["body"]
    assert json.loads(body) == json.loads(wide_response(status="new"))

    again = [("domain", "prov", day, '{"data": [1]}', 1)]
    landing.land_responses(spark.createDataFrame(again, schema), base, "n")
    assert json.loads(landing.read_landed(spark, base, "domain").first()["body"]) == {"data": [1]}
    assert landing.read_landed(spark, base).count() == 2
    listed = landing.list_landed(spark, base, "dynamic_data")
    assert rows(listed, "dataset", "year") == [("0145", 2024)]


def test_plain_tree_of_multi_line_files(spark, tmp_path):
    folder = Path(tmp_path / "raw" / "dynamic_data" / "pdrb" / "2024" / "03" / "05")
    folder.mkdir(parents=True)
    (folder / "response.json").write_text(wide_response())
    base = str(tmp_path / "raw")
    landed = landing.read_landed(spark, base, plain_tree=True)
    assert rows(landed, "source", "dataset", "year", "month", "day") == [
        ("dynamic_data", "pdrb", 2024, 3, 5)
    ]
    assert staging.stage(landed, REGION_CODES).data.count() == 12
    assert landing.list_landed(spark, base, plain_tree=True).count() == 1


def test_missing_landing_area_is_empty(spark, tmp_path):
    missing = str(tmp_path / "none")
    assert landing.read_landed(spark, missing).count() == 0
    assert landing.list_landed(spark, missing).count() == 0


def test_level_and_domain_filters(spark):
    landed = spark.createDataFrame(
        [("a", "domain", "prov", '[{"kode": "1100", "nama": "Aceh"}]'),
         ("b", "domain", "kab", '[{"kode": "1101", "nama": "Simeulue"}, {"kode": "1201", "nama": "Nias"}]')],
        "doc string, source string, dataset string, body string",
    )
    kab = parsers.regions_of_level(landed, "kab")
    assert rows(kab, "region_code", "level") == [("1101", "kab"), ("1201", "kab")]
    assert rows(parsers.regions_for_domain(kab, "1100"), "region_code") == [("1101",)]
    assert parsers.regions_for_domain(kab, "0000").count() == 2
    with pytest.raises(ValueError):
        parsers.regions_of_level(landed, "city")
