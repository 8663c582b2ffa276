"""The whole flow: landed responses, staging, quality gate, star schema, marts, verification.

Both ways in, a run over what has landed (`run_pipeline`) and the stream (`streaming.ingest`), take
responses in once and hand them to `load_responses`.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.functions.columns import period_date_key
from lumbung.functions.storage import discard, scratch_path
from lumbung.operators import model, quality, staging
from lumbung.operators.load import Warehouse
from lumbung.plans.lineage import trace
from lumbung.plans.refresh import build_marts, refresh_marts
from lumbung.sources import landing
from lumbung.sources import responses as parsers

__all__ = ["build_marts", "refresh_marts", "run_pipeline", "load_responses", "trace", "extraction_summary"]

log = logging.getLogger(__name__)

# Landed sources by what they hold.
STATISTICS, REGIONS, TRADE = "dynamic_data", "domain", "foreign_trade"
DATASETS, GLOSSARY = "simdasi", "glossary"

VERIFIED_TABLES = ("fact_economic", "dim_date", "dim_region", "dim_indicator")


# Columns of the record of loaded files; `scope` tells the selections of different runs apart, length,
# modified and content (a digest) one state of a file from another.
LOADED_FILES = (
    "source_key long, doc string, scope string, length long, modified timestamp, content string, "
    "loaded_at timestamp"
)
_STATE = ("length", "modified", "content")


@dataclass
class PipelineResult:
    staged_rows: int
    warnings: list[str]
    row_counts: dict[str, int]
    loaded: dict[str, int] = field(default_factory=dict)
    rejected: int = 0
    refreshed: dict[str, list[int]] = field(default_factory=dict)


@dataclass
class Loaded:
    staged_rows: int = 0
    warnings: list[str] = field(default_factory=list)
    rows: dict[str, int] = field(default_factory=dict)


def run_pipeline(
    spark: SparkSession,
    landing_dir: str,
    warehouse: Warehouse,
    domain: str = "0000",
    variables: str | None = None,
    periods: str | None = None,
    plain_tree: bool = False,
    skip_rejected: bool = False,
) -> PipelineResult:
    """Load every landed response that no run of this selection has loaded, and refresh the marts.

    Days are loaded in landing order, so that of equal keys the last landed wins, also against what
    earlier runs have loaded. A file whose content has changed since it was loaded counts as new, one
    that was only written again does not. Raises QualityError before anything reaches the warehouse
    layer: also for responses that cannot be parsed, unless `skip_rejected` leaves them out; then each
    run tries them again. Either way they stand in the staging table `rejected_responses` with the
    reason. A missing region list leaves regions NULL, which the gate rejects; missing metadata leaves
    its dimensions empty. A run that finds nothing new loads nothing and leaves every mart as it is.
    """
    landed = landing.read_landed(spark, landing_dir, plain_tree=plain_tree)
    listing = landing.list_landed(spark, landing_dir, plain_tree=plain_tree)
    warehouse.create_tables()
    scope = f"{domain}|{variables or ''}|{periods or ''}"
    done = loaded_files(warehouse, scope)
    waiting = pending(listing, done)
    path = scratch_path(spark, "run")
    try:
        arrived = take_in(of_days(landed, waiting), waiting, path)
        known = F.col("content").eqNullSafe(F.col("known_content"))
        rejected = check_responses(warehouse, arrived.where(~known), skip_rejected)
        accepted = arrived.where(~known & F.col("reason").isNull())
        if done.isEmpty() and accepted.where(F.col("source") == STATISTICS).isEmpty() and not rejected:
            raise quality.QualityError("region_mapping: nothing was staged")
        regions = domain_regions(latest_landed(landed, listing), domain)
        loaded = load_responses(spark, warehouse, accepted, regions, domain, variables, periods)
        refreshed = refresh_marts(warehouse)
        record_loaded(warehouse, arrived.where(known | F.col("reason").isNull()), scope)
    finally:
        discard(spark, path)
    for warning in loaded.warnings:
        log.warning(warning)
    counts = {
        row["table_name"]: row["rows"]
        for row in quality.load_verification(
            spark, {t: warehouse.table("warehouse", t) for t in VERIFIED_TABLES}
        ).collect()
    }
    return PipelineResult(loaded.staged_rows, loaded.warnings, counts, loaded.rows, rejected, refreshed)


def take_in(responses: DataFrame, files: DataFrame, path: str) -> DataFrame:
    """Responses of the given files, read once: written with their digest and, if any, why they are rejected.

    What is checked, parsed and recorded afterwards is this copy, even if a file changes meanwhile.
    """
    rows = responses.join(files.select("doc", "length", "modified", "known_content"), "doc").select(
        "*", F.sha2(F.coalesce("body", F.lit("")), 256).alias("content"),
        parsers.rejection(F.col("source"), F.col("body")).alias("reason"),
    )
    rows.write.partitionBy("source").parquet(f"{path}/arrived")
    return rows.sparkSession.read.schema(rows.schema).parquet(f"{path}/arrived")


def loaded_files(warehouse: Warehouse, scope: str | None = None) -> DataFrame:
    """Files that runs have loaded, by `source_key`; the record outlives the staging tables."""
    if not warehouse.exists("staging", "loaded_files"):
        return warehouse.spark.createDataFrame([], LOADED_FILES)
    files = warehouse.table("staging", "loaded_files")
    return files if scope is None else files.where(F.col("scope") == scope)


def record_loaded(warehouse: Warehouse, files: DataFrame, scope: str) -> None:
    """Add files (doc, length, modified, content) to the record; one that is recorded twice does no harm."""
    rows = files.select(
        F.xxhash64("doc").alias("source_key"), "doc", F.lit(scope).alias("scope"), *_STATE,
        F.current_timestamp().alias("loaded_at"),
    )
    warehouse.load(rows, "staging", "loaded_files")


def pending(listing: DataFrame, done: DataFrame) -> DataFrame:
    """Landed files that are not loaded in the state they are in, with the digest of the loaded state."""
    known = done.groupBy("doc").agg(F.max_by(F.struct(*_STATE), "loaded_at").alias("_known"))
    same = F.col("_known.length").eqNullSafe(F.col("length")) & F.col("_known.modified").eqNullSafe(F.col("modified"))
    return (
        listing.join(known, "doc", "left")
        .where(F.col("_known").isNull() | ~same)
        .select(*listing.columns, F.col("_known.content").alias("known_content"))
    )


def of_days(landed: DataFrame, files: DataFrame) -> DataFrame:
    """The responses of the sources, datasets and days of `files`.

    The semi-join is on the partition columns, which lets Spark prune the other days.
    """
    days = files.select(*landing.PARTITIONS).distinct().where(F.col("year") > 0)
    return landed.join(days, list(landing.PARTITIONS), "left_semi")


def check_responses(warehouse: Warehouse, responses: DataFrame, skip_rejected: bool) -> int:
    """Store which responses cannot be read; an error unless they may be skipped."""
    found = responses.where("reason IS NOT NULL").select("source", "dataset", "doc", "reason")
    warehouse.load(found, "staging", "rejected_responses", "replace")
    broken = warehouse.table("staging", "rejected_responses")
    count = broken.count()
    if count and not skip_rejected:
        shown = [f"{row['doc']} ({row['reason']})" for row in broken.orderBy("doc").take(3)]
        raise quality.QualityError(f"{count} responses cannot be parsed: {', '.join(shown)}")
    return count


def load_responses(
    spark: SparkSession,
    warehouse: Warehouse,
    responses: DataFrame,
    regions: DataFrame,
    domain: str = "0000",
    variables: str | None = None,
    periods: str | None = None,
    codes: Column | None = None,
    apart: Column | None = None,
) -> Loaded:
    """Responses of any sources (source, doc, body) through gate and star schema, marts apart.

    Staged rows are counted while they are written, and the gate judges them before anyone can see them:
    unless all gates are passed, nothing is loaded and the staging tables stay as they were. With `apart`, a column of that value marks rows that
    would not pass: they are kept in `staging.rejected_observations` and `staging.rejected_trade`, and
    the others are loaded. Loading the same responses again changes nothing.
    """
    # One row per source.
    new = {row["source"] for row in responses.select("source").distinct().collect()}
    loaded = Loaded()
    data = records = staged = None
    written: list[Candidate] = []
    try:
        if STATISTICS in new:
            codes = ordered_codes(regions) if codes is None else codes
            staged = staging.stage(_of(responses, STATISTICS), codes)
            selected = parsers.select_observations(staged.data, variables, periods)
            written.append(stage_observations(warehouse, selected))
            data = written[-1].rows()
            if apart is None:
                checked = data.select("variable_id", "vervar_id", "region_id", "year", "value", "period_type")
                checks = quality.written_checks(written[-1].counted, checked, context=f"var={variables}")
                loaded.warnings += quality.gate(checks)
        if TRADE in new:
            written.append(stage_trade(warehouse, responses))
            records = written[-1].rows()
            if apart is None:
                loaded.warnings += quality.gate(quality.written_trade_checks(spark, written[-1].counted))
    except Exception:
        for candidate in written:
            candidate.withdraw()
        raise
    for candidate in written:
        candidate.publish()
    if apart is not None:
        if data is not None:
            whole = F.col("region_id").isNotNull() & F.col("year").isNotNull()
            lost = data.where(~whole).select("doc", "place", "variable_id", "region_id", "year", apart)
            _keep(warehouse, lost, "rejected_observations")
            data = data.where(whole)
        if records is not None:
            keyed = [F.col(c).isNotNull() for c in ("trade_type", "commodity_code", "country_code", "port_code")]
            whole = F.least(period_date_key(F.col("period")).isNotNull(), *keyed)
            lost = records.where(~whole).select("doc", "position", "trade_type", "commodity_code", "period", apart)
            _keep(warehouse, lost, "rejected_trade")
            records = records.where(whole)

    if DATASETS in new:
        loaded.rows["dim_dataset"] = load_datasets(warehouse, responses, periods)
    if GLOSSARY in new:
        loaded.rows["dim_glossary"] = load_glossary(warehouse, responses)
    if {STATISTICS, REGIONS} & new:
        dim_region = model.dim_region_for_domain(spark, domain, regions)
        loaded.rows["dim_region"] = warehouse.upsert(dim_region, "dim_region")
    if GLOSSARY in new:
        # New texts reach indicators of earlier loads.
        known = warehouse.table("warehouse", "dim_indicator")
        loaded.rows["dim_indicator"] = warehouse.upsert(enriched(warehouse, known), "dim_indicator")
    if data is not None:
        # Known from the write, unless rows were kept apart.
        loaded.staged_rows = written[0].counted.values()["_rows"] if apart is None else data.count()
        loaded.rows |= load_economic(warehouse, data, staged.described)
    if records is not None:
        loaded.rows |= load_trade(spark, warehouse, records)
    return loaded


def _keep(warehouse: Warehouse, rows: DataFrame, table: str) -> None:
    """Replace the rows of one batch in a table of what was left out."""
    warehouse.load(rows, "staging", table, "replace", partition_by=["batch"])


def latest_landed(landed: DataFrame, listing: DataFrame) -> DataFrame:
    """The responses of the latest day of every source and dataset.

    The days come from the file listing, which reads no content.
    """
    newest = (
        listing.groupBy("source", "dataset")
        .agg(F.max(F.struct("year", "month", "day")).alias("_newest"))
        .select("source", "dataset", "_newest.*")
        # A filter that keeps every row: it lets Spark prune the partitions of other days.
        .where(F.col("year") > 0)
    )
    return landed.join(newest, list(landing.PARTITIONS), "left_semi")


def domain_regions(landed: DataFrame, domain: str) -> DataFrame:
    """Regions that the values of a domain belong to: provinces, or a province's regencies."""
    national = not domain or domain == model.NATIONAL_CODE
    regions = parsers.regions_of_level(landed, "prov" if national else "kab")
    return parsers.regions_for_domain(regions, domain)


def ordered_codes(regions: DataFrame) -> Column:
    """Region codes in list order as one array; NULL without a list.

    The array is as long as one list response, which names every region of a level once.
    """
    pair = F.struct("doc", "position", F.col("region_code").alias("code"))
    codes = F.transform(F.sort_array(F.collect_list(pair)), lambda p: p["code"])
    return regions.agg(F.nullif(codes, F.array().cast("array<string>"))).scalar()


@dataclass
class Candidate:
    """A staging table that is written and counted, but that no reader finds before `publish`."""

    warehouse: Warehouse
    table: str
    order: str
    version: str
    counted: quality.CountedWrite

    def rows(self) -> DataFrame:
        written = self.warehouse.table("staging", self.version)
        return written.withColumn("ordinal", landing_order(self.order))

    def publish(self) -> None:
        self.warehouse.publish("staging", self.table, self.version, self.counted.rows.columns)

    def withdraw(self) -> None:
        self.warehouse.withdraw("staging", self.version)


def _candidate(warehouse: Warehouse, counted: quality.CountedWrite, table: str, order: str) -> Candidate:
    return Candidate(warehouse, table, order, warehouse.write_version(counted.rows, "staging", table), counted)


def stage_observations(warehouse: Warehouse, observed: DataFrame) -> Candidate:
    """Write staged observations, so that the gate and the loads read them instead of JSON."""
    rows = observed.select(
        F.xxhash64("doc", "ordinal.place").alias("staging_key"),
        "variable_id", "vervar_id", "region_id", "year", "value", "table_id",
        F.current_timestamp().alias("loaded_at"),
        "period_type",
        F.xxhash64("doc").alias("source_key"),
        "doc",
        F.col("ordinal.place").alias("place"),
    )
    return _candidate(warehouse, quality.count_observations(rows), "dynamic_data", "place")


def write_staging(warehouse: Warehouse, observed: DataFrame) -> DataFrame:
    """Staged observations, written and published without a gate."""
    candidate = stage_observations(warehouse, observed)
    candidate.publish()
    return candidate.rows()


def landing_order(place: str) -> Column:
    """Source order of rows with a `doc`: by the day it landed, then by file and place in it."""
    return F.struct(landing.landed_day(F.col("doc")).alias("day"), "doc", place)


def versioned(rows: DataFrame) -> DataFrame:
    """The landing day of each row's place in the source, by which loads tell older from newer."""
    return rows.withColumn("source_day", F.col("ordinal.day"))


def load_economic(warehouse: Warehouse, data: DataFrame, described: DataFrame) -> dict[str, int]:
    described = described.withColumn("ordinal", landing_order("position"))
    indicators = versioned(enriched(warehouse, model.dim_indicator_from_staged(described)))
    return {
        "dim_date": warehouse.upsert(model.build_dim_date(data), "dim_date"),
        "dim_indicator": warehouse.upsert(indicators, "dim_indicator", ordinal="ordinal"),
        "fact_economic": load_fact_economic(warehouse, data),
    }


def enriched(warehouse: Warehouse, indicators: DataFrame) -> DataFrame:
    """Indicators with the texts of the glossary as it is loaded so far."""
    order = F.struct("glossary_key", "glossary_id")
    return model.enrich_indicators(indicators, warehouse.table("warehouse", "dim_glossary"), order)


def load_datasets(warehouse: Warehouse, responses: DataFrame, periods: str | None) -> int:
    """Dataset metadata; of equal ids the last landed wins."""
    records = parsers.dataset_records(_of(responses, DATASETS)).withColumn("ordinal", landing_order("position"))
    return warehouse.upsert(versioned(model.build_dim_dataset(records, periods)), "dim_dataset", ordinal="ordinal")


def load_glossary(warehouse: Warehouse, responses: DataFrame) -> int:
    """Glossary entries; of equal ids the last landed wins."""
    records = parsers.glossary_records(_of(responses, GLOSSARY)).withColumn("ordinal", landing_order("position"))
    return warehouse.upsert(versioned(model.build_dim_glossary(records)), "dim_glossary", ordinal="ordinal")


def load_fact_economic(warehouse: Warehouse, data: DataFrame) -> int:
    """Upsert staged observations; of equal grains the last in source order wins.

    The value, the file it came from and its day are taken over together.
    """
    return warehouse.upsert(
        versioned(model.build_fact_economic(data)), "fact_economic", update=["value", "source_key"],
        ordinal="ordinal",
    )


def stage_trade(warehouse: Warehouse, landed: DataFrame) -> Candidate:
    """Write trade records, so that gate and loads do not parse them again."""
    parsed = parsers.trade_records(_of(landed, TRADE)).withColumn("source_key", F.xxhash64("doc"))
    return _candidate(warehouse, quality.count_trade(parsed), "trade_records", "position")


def load_trade(spark: SparkSession, warehouse: Warehouse, records: DataFrame) -> dict[str, int]:
    fact = versioned(model.build_fact_trade(records))
    products = records.select(
        F.col("commodity_code").alias("product_code"),
        F.col("commodity_name").alias("product_name"), "ordinal",
    )
    dates = model.build_dim_date_from_keys(fact)
    # A date that annual data has loaded already stays as it is.
    return {
        "trade_dates": warehouse.upsert(dates, "dim_date", update=[]),
        "dim_product": warehouse.upsert(versioned(model.build_dim_product(products)), "dim_product"),
        "dim_country": warehouse.upsert(versioned(model.build_dim_country(records)), "dim_country"),
        "dim_trade_flow": warehouse.upsert(model.build_dim_trade_flow(spark), "dim_trade_flow"),
        "fact_trade": warehouse.upsert(
            fact, "fact_trade", update=["value_usd", "net_weight_kg", "source_key"],
            ordinal="ordinal",
        ),
    }


def _of(landed: DataFrame, source: str) -> DataFrame:
    return landed.where(F.col("source") == source).select("doc", "body")


def extraction_summary(data: DataFrame) -> DataFrame:
    """What a load brought: national totals, the latest year by region, and counts.

    Long format: section, item, amount.
    """
    totals = data.groupBy(F.lit("national_value").alias("section"), F.col("year").cast("string").alias("item")).agg(
        F.round(F.sum("value"), 6).cast("double").alias("amount")
    )
    latest = data.where(F.col("year") == data.select(F.max("year")).scalar())
    regions = latest.groupBy(
        F.lit("latest_year_region_value").alias("section"), F.col("region_id").alias("item")
    ).agg(F.round(F.max_by("value", "ordinal"), 6).cast("double").alias("amount"))
    counts = data.agg(
        F.count(F.lit(1)).cast("double").alias("total_records"),
        F.count_distinct("region_id").cast("double").alias("regions"),
        F.count_distinct("year").cast("double").alias("years_available"),
        F.max("year").cast("double").alias("latest_year"),
    )
    names = ("total_records", "regions", "years_available", "latest_year")
    counted = counts.select(F.inline(F.array(*[
        F.struct(F.lit("count").alias("section"), F.lit(n).alias("item"), F.col(n).alias("amount"))
        for n in names
    ])))
    return totals.unionByName(regions).unionByName(counted)
