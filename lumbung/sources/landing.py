"""Raw landing area: one JSON response per source, dataset and day.

Two layouts are read. The one written here is partitioned,
``source=/dataset=/year=/month=/day=``, so a source filter prunes directories. A tree of plain
folders ``{source}/{dataset}/{YYYY}/{MM}/{DD}/response.json`` is read as it stands.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LANDED_SCHEMA = (
    "doc string, source string, dataset string, year int, month int, day int, body string"
)
LISTING_SCHEMA = (
    "doc string, source string, dataset string, year int, month int, day int, length long, modified timestamp"
)
PARTITIONS = ("source", "dataset", "year", "month", "day")

# File name and path pattern of the plain tree.
PLAIN_FILE = "response.json"
_PLAIN_PATH = r"([^/]+)/([^/]+)/(\d{4})/(\d{2})/(\d{2})/response\.json$"
_FILE_SCHEMA = (
    "path string, modificationTime timestamp, length long, content binary, "
    "source string, dataset string, year int, month int, day int"
)


def land_responses(
    responses: DataFrame, base: str, ordinal: str | Column | None = None
) -> None:
    """Write responses (source, dataset, landed_on, body), replacing those of the same day.

    Several responses for one source, dataset and day stop the write, unless `ordinal` orders
    them; then the last one is kept.
    """
    # Raw line breaks carry no meaning in JSON; without them one response is one line.
    rows = responses.select(
        "source",
        "dataset",
        F.year("landed_on").alias("year"),
        F.month("landed_on").alias("month"),
        F.dayofmonth("landed_on").alias("day"),
        F.regexp_replace("body", r"[\r\n]+", " ").alias("body"),
        *([] if ordinal is None else [_column(ordinal).alias("_ordinal")]),
    )
    if ordinal is not None:
        rows = rows.groupBy(*PARTITIONS).agg(F.max_by("body", "_ordinal").alias("body"))
    else:
        several = F.raise_error(
            F.concat(F.lit("several responses of one day without an order: "), F.concat_ws("/", *PARTITIONS))
        )
        rows = rows.groupBy(*PARTITIONS).agg(
            F.count(F.lit(1)).alias("_n"), F.first("body").alias("body")
        ).select(*PARTITIONS, F.when(F.col("_n") == 1, F.col("body")).otherwise(several.cast("string")).alias("body"))
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITIONS)
        .text(base)
    )


def _column(ordinal: str | Column) -> Column:
    return F.col(ordinal) if isinstance(ordinal, str) else ordinal


def file_name() -> Column:
    """File of a row as `doc`, spelled as a listing spells it: the metadata escapes its characters."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))).alias("doc")


def read_landed(
    spark: SparkSession, base: str, source: str | None = None, plain_tree: bool = False
) -> DataFrame:
    """Landed responses with their place; `doc` is the file each one came from."""
    try:
        if plain_tree:
            return _read_plain(spark, base, source)
        rows = (
            spark.read.schema("value string, source string, dataset string, year int, month int, day int")
            .text(base, wholetext=True)
        )
        rows = rows if source is None else rows.where(F.col("source") == source)
        return rows.select(file_name(), *PARTITIONS, F.col("value").alias("body"))
    except AnalysisException as error:
        return _empty_if_missing(spark, error, LANDED_SCHEMA)


def _read_plain(spark: SparkSession, base: str, source: str | None) -> DataFrame:
    rows = (
        spark.read.text(
            base if source is None else f"{base}/{source}",
            wholetext=True,
            recursiveFileLookup=True,
            pathGlobFilter=PLAIN_FILE,
        )
        .select(file_name(), F.col("value").alias("body"))
    )
    return rows.select("doc", *_path_parts(F.col("doc"), _PLAIN_PATH), "body")


def _path_parts(path: Column, pattern: str) -> list[Column]:
    texts = [F.regexp_extract(path, pattern, i + 1) for i in range(len(PARTITIONS))]
    kinds = ("string", "string", "int", "int", "int")
    return [
        F.nullif(text, F.lit("")).cast(kind).alias(name)
        for text, kind, name in zip(texts, kinds, PARTITIONS)
    ]


def landed_day(doc: Column) -> Column:
    """Day of a landed file as YYYYMMDD, from its place in either layout; 0 for other files."""
    def number(pattern: str, group: int = 1) -> Column:
        return F.coalesce(F.regexp_extract(doc, pattern, group).try_cast("int"), F.lit(0))

    partitioned = [number(rf"/{part}=(\d+)(?:/|$)") for part in ("year", "month", "day")]
    plain = [number(_PLAIN_PATH, group) for group in (3, 4, 5)]
    days = [y * 10000 + m * 100 + d for y, m, d in (partitioned, plain)]
    return F.greatest(*days)


def list_landed(
    spark: SparkSession, base: str, source: str | None = None, plain_tree: bool = False
) -> DataFrame:
    """Landed files in path order with length and time of change, found without reading them."""
    reader = spark.read.format("binaryFile")
    seen = ("length", F.col("modificationTime").alias("modified"))
    try:
        if plain_tree:
            files = reader.load(base, recursiveFileLookup=True, pathGlobFilter=PLAIN_FILE)
            placed = files.select(
                F.col("path").alias("doc"), *_path_parts(F.col("path"), _PLAIN_PATH), *seen
            )
        else:
            files = reader.schema(_FILE_SCHEMA).load(base)
            placed = files.select(F.col("path").alias("doc"), *PARTITIONS, *seen)
    except AnalysisException as error:
        return _empty_if_missing(spark, error, LISTING_SCHEMA)
    if source is not None:
        placed = placed.where(F.col("source") == source)
    return placed.orderBy("doc")


def _empty_if_missing(spark: SparkSession, error: AnalysisException, schema: str) -> DataFrame:
    if error.getCondition() != "PATH_NOT_FOUND":
        raise error
    return spark.createDataFrame([], schema)
