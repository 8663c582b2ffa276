"""Parsers of landed responses.

Input is a DataFrame with the columns `doc` (which response) and `body` (its JSON text).
Records come out with `doc` and `position`, their place in the response, from which every
later "last one wins" is decided.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumbung.functions.columns import first_filled, listed, strip

# Source field -> our column, in the order of the result.
TRADE_FIELDS = {
    "jenis": "trade_type",
    "kode_barang": "commodity_code",
    "nama_barang": "commodity_name",
    "kode_negara": "country_code",
    "nama_negara": "country_name",
    "kode_pelabuhan": "port_code",
    "nama_pelabuhan": "port_name",
    "periode": "period",
    "nilai": "value_usd",
    "berat_bersih": "net_weight_kg",
}
GLOSSARY_FIELDS = {
    "id": "glossary_id",
    "nama_indikator": "indicator_name",
    "konsep": "concept",
    "definisi": "definition",
    "klasifikasi": "classification",
    "ukuran": "measure",
    "satuan": "unit",
    "sumber_data": "data_source",
}
DATASET_FIELDS = {
    "id": "table_id",
    "kode": "table_code",
    "judul": "title",
    "subjek": "subject",
    "satuan": "unit",
    "periode": "frequency",
}
REGION_LEVELS = ("prov", "kab", "kec", "desa")

# A statistics response. The content field is a list of rows here; responses that key their
# values have an object in its place, which this schema leaves NULL.
_HEADER = """
    variable array<struct<id string, label string, description string>>,
    var array<struct<val string, label string, unit string, subj string, def string, id string,
                     description string>>,
    vervar array<struct<id string, label string, description string, unit string>>,
    turvar array<struct<val string, label string, unit string, id string, description string>>,
    tahun array<struct<val string, label string>>,
    turtahun array<struct<val string, label string>>,
    infotabel struct<tabel struct<id string, kode string, nama string, subjek string,
                                  satuan string, periode string>>,
    datacontent array<array<string>>
"""
_KEYED = "datacontent map<string,string>"
_LOOSE = "datacontent array<string>"


def parse_statistics(responses: DataFrame) -> DataFrame:
    """Header fields, `content_rows` and `content_keyed` of statistics responses.

    One parse serves row content; only keyed or malformed content is parsed again.
    """
    parsed = responses.withColumn("_r", F.from_json("body", _HEADER))
    content = F.col("_r.datacontent")
    keyed = F.when(content.isNull(), F.from_json("body", _KEYED)["datacontent"])
    parsed = parsed.withColumn("content_keyed", keyed)
    # A list with elements that are no rows: keep the rows.
    elements = F.from_json("body", _LOOSE)["datacontent"]
    rows = F.transform(
        F.filter(elements, lambda e: F.startswith(F.ltrim(e), F.lit("["))),
        lambda e: F.from_json(e, "array<string>"),
    )
    loose = F.when(content.isNull() & F.col("content_keyed").isNull(), rows)
    others = [c for c in responses.columns if c != "body"]
    return parsed.select(
        *others, "_r.variable", "_r.var", "_r.vervar", "_r.turvar", "_r.tahun", "_r.turtahun",
        F.col("_r.infotabel.tabel").alias("tabel"),
        F.coalesce(content, loose).alias("content_rows"),
        "content_keyed",
    )


def variables(parsed: DataFrame) -> DataFrame:
    """Variable definitions of row responses."""
    return parsed.select("doc", F.posexplode("variable").alias("position", "v")).select(
        "doc", "position",
        F.col("v.id").alias("variable_id"),
        F.col("v.label").alias("variable_name"),
        F.col("v.description").alias("variable_description"),
    )


def vertical_variables(parsed: DataFrame) -> DataFrame:
    """Vertical variable definitions of row responses."""
    return parsed.select("doc", F.posexplode("vervar").alias("position", "v")).select(
        "doc", "position",
        F.col("v.id").alias("vervar_id"),
        F.col("v.label").alias("vervar_name"),
        F.col("v.description").alias("vervar_description"),
        F.col("v.unit").alias("vervar_unit"),
    )


def content_rows(parsed: DataFrame) -> DataFrame:
    """Rows as they are: year, values in order, table name; empty rows are skipped."""
    row = F.col("row")
    return (
        parsed.select(
            "doc",
            F.coalesce("tabel.nama", F.lit("")).alias("region_names"),
            F.posexplode("content_rows").alias("position", "row"),
        )
        .where(F.size(row) > 0)
        .select(
            "doc", "position",
            row[0].alias("year"),
            F.slice(row, F.lit(2), F.size(row) - 1).alias("values"),
            "region_names",
        )
    )


def _records(responses: DataFrame, fields: dict[str, str], first_only: bool = False) -> DataFrame:
    kept = [c for c in responses.columns if c != "body"]
    schema = ", ".join(f"{name} string" for name in fields)
    data = F.from_json("body", f"data array<struct<{schema}>>")["data"]
    if first_only:
        data = F.slice(data, 1, 1)
    return (
        responses.select(*kept, F.posexplode(data).alias("position", "record"))
        .select(*kept, "position", *[F.col(f"record.{f}").alias(c) for f, c in fields.items()])
    )


def trade_records(responses: DataFrame) -> DataFrame:
    """Trade records; amounts stay text."""
    return _records(responses, TRADE_FIELDS)


def glossary_records(responses: DataFrame) -> DataFrame:
    return _records(responses, GLOSSARY_FIELDS)


# The field that holds what a source delivers, and its kinds of JSON.
PAYLOADS = {
    "dynamic_data": ("$.datacontent", ("ARRAY", "OBJECT")),
    "foreign_trade": ("$.data", ("ARRAY",)),
    "glossary": ("$.data", ("ARRAY",)),
    "simdasi": ("$.data", ("ARRAY",)),
}
REGION_SOURCE = "domain"


def rejection(source: Column, body: Column) -> Column:
    """Why a response of a source cannot be read; NULL where it can.

    It is empty, no JSON, or JSON without the payload that the parsers of its source look for. Of
    other sources only the first two are known.
    """
    parsed = F.try_parse_json(body)

    def kind(path: str) -> Column:
        return F.schema_of_variant(F.try_variant_get(parsed, path, "variant"))

    def lacks(path: str, kinds: tuple[str, ...]) -> Column:
        found = [F.startswith(kind(path), F.lit(name)) for name in kinds]
        return ~F.coalesce(F.greatest(F.lit(False), F.lit(False), *found), F.lit(False))

    reason = F.when(body.isNull() | (strip(body) == ""), "empty").when(parsed.isNull(), "no JSON")
    for name, (path, kinds) in PAYLOADS.items():
        reason = reason.when((source == name) & lacks(path, kinds), f"no {path.removeprefix('$.')}")
    listed_regions = ~lacks("$", ("ARRAY",)) | ~lacks("$.data", ("ARRAY",))
    return reason.when((source == REGION_SOURCE) & ~listed_regions, "no region list")


def rejected(responses: DataFrame) -> DataFrame:
    """Responses that no parser can read, with the reason; the other columns as they are.

    Without a column `source`, whether a response is JSON is all that is asked.
    """
    kept = [c for c in responses.columns if c != "body"]
    source = F.col("source") if "source" in responses.columns else F.lit(None).cast("string")
    reason = rejection(source, F.col("body"))
    return responses.select(*kept, reason.alias("reason")).where(F.col("reason").isNotNull())


def dataset_records(responses: DataFrame, first_only: bool = False) -> DataFrame:
    """Dataset metadata: all entries of each response, or only the first of each."""
    return _records(responses, DATASET_FIELDS, first_only)


def region_records(responses: DataFrame) -> DataFrame:
    """Regions of a list response.

    The list is the response itself or its `data`. The first nested list is the region list;
    without one, the entries that have a code field are.
    """
    items = F.from_json(
        F.coalesce(F.get_json_object("body", "$.data"), F.col("body")), "array<string>"
    )

    def coded(item: Column) -> Column:
        return F.arrays_overlap(
            F.json_object_keys(item), F.array(F.lit("domain_id"), F.lit("kode"))
        )

    nested = F.get(F.filter(items, lambda i: F.startswith(i, F.lit("["))), F.lit(0))
    regions = F.coalesce(F.from_json(nested, "array<string>"), F.filter(items, coded))
    kept = [c for c in responses.columns if c != "body"]
    record = F.from_json(
        "item", "domain_id string, domain_name string, kode string, nama string"
    )
    return (
        responses.select(*kept, F.posexplode(regions).alias("position", "item"))
        .where(F.startswith("item", F.lit("{")))
        .withColumn("r", record)
        .select(
            *kept, "position",
            first_filled(F.col("r.domain_id"), F.col("r.kode")).alias("region_code"),
            first_filled(F.col("r.domain_name"), F.col("r.nama")).alias("region_name"),
        )
    )


# Selections: what a caller of the source service would ask it for


def regions_of_level(landed: DataFrame, level: str) -> DataFrame:
    """Regions of one level; the dataset of a landed region list names its level."""
    if level not in REGION_LEVELS:
        raise ValueError(f"level must be one of {', '.join(REGION_LEVELS)}, got {level}")
    lists = landed.where((F.col("source") == "domain") & (F.col("dataset") == level))
    return region_records(lists.select("doc", "body")).withColumn("level", F.lit(level))


def regions_for_domain(regions: DataFrame, domain: str, national: str = "0000") -> DataFrame:
    """Regions whose code lies under a domain; all of them for the national domain."""
    if not domain or domain == national:
        return regions
    return regions.where(F.startswith("region_code", F.lit(domain[:2])))


def select_observations(
    staged: DataFrame,
    variable: str | None = None,
    periods: str | None = None,
    vervar: str | None = None,
    domain: str | None = None,
) -> DataFrame:
    """Staged observations of comma-separated variables, years and vertical variables."""
    years = None if not periods else [int(p) for p in periods.split(",")]
    selected = staged.where(
        listed(F.col("variable_id"), variable)
        & listed(F.col("year"), years)
        & listed(F.col("vervar_id"), vervar)
    )
    return selected if domain is None else selected.where(F.col("domain") == domain)


def select_trade(
    records: DataFrame, trade_type: str = "ekspor", period: str = "", **extra: str
) -> DataFrame:
    """Trade records of one type, optionally of one period and of further column values."""
    return select_metadata(
        records.where(F.col("trade_type") == trade_type),
        **({"period": period} if period else {}), **extra,
    )


def select_metadata(records: DataFrame, **wanted: str) -> DataFrame:
    """Glossary or dataset records whose columns have the wanted values."""
    for column, value in wanted.items():
        records = records.where(F.col(column) == value)
    return records
