from __future__ import annotations

import json
from decimal import Decimal

from conftest import REGION_CODES, responses, rows, wide_response
from lumbung.operators import staging
from lumbung.sources.responses import parse_statistics


def observe(spark, body, codes=None):
    return staging.observations(parse_statistics(responses(spark, body)), codes)


def test_wide_rows_map_values_to_regions_by_position(spark):
    got = rows(
        observe(spark, wide_response(), REGION_CODES).orderBy("ordinal"),
        "variable_id", "vervar_id", "region_id", "year", "value", "period_type",
    )
    assert len(got) == 12
    assert got[0] == ("145", None, "1100", 2020, Decimal("40.250000"), None)
    assert got[1][2:5] == ("1200", 2020, Decimal("310.500000"))
    assert got[-1][2:5] == ("1400", 2022, Decimal("8.000000"))


def test_without_region_codes_all_rows_stay_with_null_region(spark):
    got = rows(observe(spark, wide_response()), "region_id")
    assert got == [(None,)] * 12


def test_values_beyond_the_region_list_have_no_region(spark):
    got = rows(observe(spark, wide_response(), REGION_CODES[:3]).where("year = 2020"), "region_id")
    assert sorted(got, key=str) == [("1100",), ("1200",), ("1300",), (None,)]


def test_vertical_variables_alternate_within_a_region(spark):
    body = wide_response(
        vervar=[{"id": "1", "label": "a", "unit": "u"}, {"id": "2", "label": "b"}],
        datacontent=[["2020", "11", "12", "23", "24"]],
    )
    got = rows(observe(spark, body, ["1100", "1200"]).orderBy("ordinal"), "region_id", "vervar_id", "value")
    assert got == [
        ("1100", "1", 11), ("1100", "2", 12), ("1200", "1", 23), ("1200", "2", 24),
    ]


def test_bad_rows_are_skipped_and_bad_values_become_null(spark):
    body = wide_response(
        datacontent=[["2020", "x", "1e2", " 7 ", "NaN"], [], "no row", None, ["20x", 5, None]]
    )
    got = rows(observe(spark, body, REGION_CODES).orderBy("ordinal"), "year", "region_id", "value")
    assert got == [
        (2020, "1100", None), (2020, "1200", 100), (2020, "1300", 7), (2020, "1400", None),
        (None, "1100", 5), (None, "1200", None),
    ]


KEYED = {
    "var": [{"val": 192, "label": "Miskin", "unit": "Persen", "subj": "Sosial", "def": "d"}],
    "turvar": [{"val": 432, "label": "Kota"}, {"val": 433, "label": "Desa"}],
    "tahun": [{"val": 117, "label": "2017"}, {"val": 122, "label": "x"}, {"val": 122, "label": "2022"}],
    "turtahun": [{"val": 61, "label": "Semester 1"}, {"val": 63, "label": "Tahunan"}],
    "datacontent": {
        "210019243212262": 5.46,
        "110019243211761": 8.123456,
        "110019243211763": 8,
        "1100192432117": 1,
        "110019243299964": None,
    },
}


def test_keyed_content_is_decoded_in_source_order(spark):
    got = rows(
        observe(spark, json.dumps(KEYED)).orderBy("ordinal"),
        "variable_id", "vervar_id", "region_id", "year", "value", "period_type",
    )
    assert got == [
        ("192", "432", "2100", 2022, Decimal("5.460000"), "62"),
        ("192", "432", "1100", 2017, Decimal("8.123456"), "Semester 1"),
        ("192", "432", "1100", 2017, Decimal("8.000000"), "Tahunan"),
        # Unknown ids stand for themselves.
        ("192", "432", "1100", 999, None, "64"),
    ]


def test_both_formats_in_one_input(spark):
    parsed = parse_statistics(responses(spark, wide_response(), json.dumps(KEYED), "{}", "broken"))
    data = staging.observations(parsed, REGION_CODES)
    assert sorted(rows(data.groupBy("doc").count())) == [("doc0", 12), ("doc1", 4)]


def test_metadata_of_each_format_and_of_neither(spark):
    parsed = parse_statistics(responses(spark, wide_response(), json.dumps(KEYED), "{}"))
    got = rows(staging.table_metadata(parsed).orderBy("doc"))
    assert got[0] == (
        "doc0", "77", "T-7", "Output by region", "Economy", "Million credits", "Yearly",
    )
    assert got[1] == ("doc1", "192", None, "Miskin", "Sosial", "Persen", None)
    assert got[2] == ("doc2", None, None, None, None, None, None)


def test_variable_definitions_of_each_format(spark):
    staged = staging.stage(responses(spark, wide_response(), json.dumps(KEYED)))
    assert rows(staged.variables.orderBy("doc")) == [
        ("doc0", 0, "145", "Output", "Constant prices"), ("doc1", 0, "192", "Miskin", "d"),
    ]
    assert rows(staged.vertical_variables.orderBy("position"), "vervar_id", "vervar_name") == [
        ("432", "Kota"), ("433", "Desa"),
    ]


def test_labels_keep_the_last_of_equal_ids(spark):
    parsed = parse_statistics(responses(spark, json.dumps(KEYED)))
    assert sorted(rows(staging.year_labels(parsed), "year_id", "year_label")) == [
        ("117", "2017"), ("122", "2022"),
    ]
    assert sorted(rows(staging.period_labels(parsed), "period_id", "period_label")) == [
        ("61", "Semester 1"), ("63", "Tahunan"),
    ]


def test_selecting_a_period_type_before_the_fact(spark):
    data = observe(spark, json.dumps(KEYED))
    assert staging.select_dimension(data, period_type="Tahunan").count() == 1
    assert staging.select_dimension(data, vervar_id="432").count() == 4
