"""Statistics responses to long observations.

Row content is ``[year, value, value, ...]``, one value per region of the domain's list, or per
region and vertical variable. Keyed content is an object whose 15-digit keys spell region,
variable, vertical variable, year and period type. Both become one row per value.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumbung.functions.columns import first_filled, numeric, whole_year
from lumbung.schemas import VALUE
from lumbung.sources.responses import parse_statistics

# Parts of a content key and their widths.
KEY_PARTS = {"region": 4, "variable": 3, "vervar": 3, "year": 3, "period": 2}
KEY_LENGTH = sum(KEY_PARTS.values())


class Staged(NamedTuple):
    metadata: DataFrame
    variables: DataFrame
    vertical_variables: DataFrame
    data: DataFrame
    described: DataFrame


def stage(responses: DataFrame, region_codes: Sequence[str] | Column | None = None) -> Staged:
    """All staging results of raw responses (doc, body)."""
    parsed = parse_statistics(responses)
    return Staged(
        table_metadata(parsed),
        staged_variables(parsed),
        staged_vertical_variables(parsed),
        observations(parsed, region_codes),
        described_variables(parsed),
    )


def _filled(array: str) -> Column:
    return F.coalesce(F.size(array), F.lit(0)) > 0


# Our column, field of the table block, field of the first variable.
METADATA_FIELDS = (
    ("table_id", "id", "val"),
    ("table_code", "kode", None),
    ("table_name", "nama", "label"),
    ("subject", "subjek", "subj"),
    ("unit", "satuan", "unit"),
    ("frequency", "periode", None),
)


def _metadata() -> dict[str, Column]:
    """Table block if it has any known field, else the first variable, else NULLs."""
    table, first = F.col("tabel"), F.get("var", F.lit(0))
    has_table = F.coalesce(*[table[field] for _, field, _ in METADATA_FIELDS]).isNotNull()
    return {
        name: F.when(has_table, table[field])
        .otherwise(F.lit(None).cast("string") if other is None else first[other])
        .alias(name)
        for name, field, other in METADATA_FIELDS
    }


def table_metadata(parsed: DataFrame) -> DataFrame:
    """One row per response with what it says about its table."""
    return parsed.select("doc", *_metadata().values())


def _variable_defs() -> Column:
    plain = F.transform(
        "variable",
        lambda v: F.struct(
            v["id"].alias("id"), v["label"].alias("name"), v["description"].alias("description")
        ),
    )
    short = F.transform(
        "var",
        lambda v: F.struct(
            first_filled(v["id"], v["val"]).alias("id"),
            v["label"].alias("name"),
            first_filled(v["description"], v["def"]).alias("description"),
        ),
    )
    return F.when(_filled("variable"), plain).otherwise(short)


def _vervar_defs() -> Column:
    def entry(v: Column, key: Column) -> Column:
        return F.struct(
            key.alias("id"), v["label"].alias("name"),
            v["description"].alias("description"), v["unit"].alias("unit"),
        )

    return F.when(
        _filled("vervar"), F.transform("vervar", lambda v: entry(v, v["id"]))
    ).otherwise(F.transform("turvar", lambda v: entry(v, first_filled(v["id"], v["val"]))))


def described_variables(parsed: DataFrame) -> DataFrame:
    """Variable definitions beside the metadata of the table they stand in, from one pass."""
    metadata = [F.col(name) for name, _, _ in METADATA_FIELDS]
    exploded = parsed.select(
        "doc", *_metadata().values(), F.posexplode(_variable_defs()).alias("position", "v")
    )
    return exploded.select(
        "doc", "position", F.col("v.id").alias("variable_id"), F.col("v.name").alias("variable_name"),
        *metadata,
    )


def staged_variables(parsed: DataFrame) -> DataFrame:
    """Variable definitions of either format."""
    return parsed.select("doc", F.posexplode(_variable_defs()).alias("position", "v")).select(
        "doc", "position",
        F.col("v.id").alias("variable_id"),
        F.col("v.name").alias("variable_name"),
        F.col("v.description").alias("variable_description"),
    )


def staged_vertical_variables(parsed: DataFrame) -> DataFrame:
    """Vertical variable definitions of either format."""
    return parsed.select("doc", F.posexplode(_vervar_defs()).alias("position", "v")).select(
        "doc", "position",
        F.col("v.id").alias("vervar_id"),
        F.col("v.name").alias("vervar_name"),
        F.col("v.description").alias("vervar_description"),
        F.col("v.unit").alias("vervar_unit"),
    )


def _labels(array: str) -> Column:
    """Map of id to label; of equal ids the last one holds."""
    entries = F.col(array)

    def is_last(entry: Column, index: Column) -> Column:
        later = F.slice(entries, index + 2, F.size(entries))
        return entry["val"].isNotNull() & ~F.exists(later, lambda o: o["val"] == entry["val"])

    return F.map_from_entries(F.filter(entries, is_last))


def _label_or_id(labels: Column, key: Column) -> Column:
    known = F.coalesce(F.map_contains_key(labels, key), F.lit(False))
    return F.when(known, F.try_element_at(labels, key)).otherwise(key)


def year_labels(parsed: DataFrame) -> DataFrame:
    """Year id and label of keyed responses."""
    return parsed.select("doc", F.explode(_labels("tahun")).alias("year_id", "year_label"))


def period_labels(parsed: DataFrame) -> DataFrame:
    """Period type id and label of keyed responses."""
    return parsed.select("doc", F.explode(_labels("turtahun")).alias("period_id", "period_label"))


def decode_key(key: Column) -> dict[str, Column]:
    """Parts of a content key; meaningful only for keys of KEY_LENGTH characters."""
    parts, start = {}, 1
    for name, width in KEY_PARTS.items():
        parts[name] = F.substring(key, start, width)
        start += width
    return parts


def _cells() -> Column:
    """Every value of a response with what locates it, in source order."""
    keyed = F.transform(
        F.map_entries("content_keyed"),
        lambda e: F.struct(
            e["key"].alias("key"), F.lit(None).cast("string").alias("year"),
            F.lit(0).alias("place"), e["value"].alias("value"),
        ),
    )
    rows = F.filter("content_rows", lambda r: F.size(r) > 0)
    wide = F.transform(
        rows,
        lambda r: F.transform(
            F.slice(r, F.lit(2), F.size(r) - 1),
            lambda v, i: F.struct(
                F.lit(None).cast("string").alias("key"), r[0].alias("year"),
                i.alias("place"), v.alias("value"),
            ),
        ),
    )
    return F.when(F.col("content_keyed").isNotNull(), keyed).otherwise(F.flatten(wide))


def observations(
    parsed: DataFrame, region_codes: Sequence[str] | Column | None = None
) -> DataFrame:
    """One row per value.

    `region_codes` lists the regions that the values of a row belong to, in order: a list for
    all responses, or an array column of `parsed`. Without it, and for values beyond its end,
    the region is NULL. The result carries `ordinal`, the place of the value in its source.
    """
    if region_codes is None:
        codes = F.lit(None).cast("array<string>")
    elif isinstance(region_codes, Column):
        codes = region_codes
    else:
        codes = F.array(*[F.lit(str(code)) for code in region_codes]).cast("array<string>")

    others = [c for c in ("domain", "source_key") if c in parsed.columns]
    exploded = (
        parsed.withColumn("_codes", codes)
        .withColumn("_variable", F.get(_variable_defs(), F.lit(0))["id"])
        .withColumn("_vervars", F.transform(_vervar_defs(), lambda v: v["id"]))
        .withColumn("_years", _labels("tahun"))
        .withColumn("_periods", _labels("turtahun"))
        .withColumn("table_id", _metadata()["table_id"])
        .select(
            "doc", *others, "table_id", "_codes", "_variable", "_vervars", "_years", "_periods",
            F.posexplode(_cells()).alias("_place", "_cell"),
        )
    )
    key = F.col("_cell.key")
    keyed = key.isNotNull()
    part = decode_key(key)
    place = F.col("_cell.place")
    vervars = F.coalesce(F.size("_vervars"), F.lit(0))
    has_vervars = vervars > 0
    region_place = F.when(has_vervars, F.floor(place / vervars).cast("int")).otherwise(place)
    vervar = F.when(has_vervars, F.get("_vervars", place % vervars))
    year = F.when(keyed, _label_or_id(F.col("_years"), part["year"])).otherwise(F.col("_cell.year"))
    return exploded.where(~keyed | (F.length(key) == KEY_LENGTH)).select(
        "doc",
        *others,
        F.when(keyed, part["variable"]).otherwise(F.col("_variable")).alias("variable_id"),
        F.when(keyed, part["vervar"]).otherwise(vervar).alias("vervar_id"),
        F.when(keyed, part["region"])
        .otherwise(F.get("_codes", region_place))
        .alias("region_id"),
        whole_year(year).alias("year"),
        numeric(F.col("_cell.value"), VALUE).alias("value"),
        F.when(keyed, _label_or_id(F.col("_periods"), part["period"])).alias("period_type"),
        "table_id",
        F.struct(F.col("doc"), F.col("_place").alias("place")).alias("ordinal"),
    )


def select_dimension(
    staged: DataFrame, vervar_id: str | None = None, period_type: str | None = None
) -> DataFrame:
    """Observations of one vertical variable or period type, before the fact drops both."""
    if vervar_id is not None:
        staged = staged.where(F.col("vervar_id") == vervar_id)
    if period_type is not None:
        staged = staged.where(F.col("period_type") == period_type)
    return staged
