"""Incremental ingest: new landed responses of all sources through the whole flow, each file once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.functions.storage import discard, scratch_path
from lumbung.operators import model
from lumbung.operators.load import Warehouse
from lumbung.plans import pipeline
from lumbung.sources import landing
from lumbung.sources import responses as parsers

_STREAM_SCHEMA = (
    "value string, source string, dataset string, year int, month int, day int"
)


def landed_stream(
    spark: SparkSession, landing_dir: str, max_files: int | None = None
) -> DataFrame:
    """Landed responses of every source as a stream of whole files; `max_files` bounds a micro-batch."""
    reader = spark.readStream.format("text").schema(_STREAM_SCHEMA).option("wholetext", True)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(landing_dir).select(
        landing.file_name(), "source", "dataset", F.col("value").alias("body"),
        F.col("_metadata.file_size").alias("length"), F.col("_metadata.file_modification_time").alias("modified"),
    )


def ingest_available(
    spark: SparkSession,
    landing_dir: str,
    warehouse: Warehouse,
    checkpoint_dir: str,
    region_codes: Sequence[str] | Column | None = None,
    max_files: int | None = None,
    regions: DataFrame | None = None,
    rebuild_marts: bool = True,
    domain: str = "0000",
    periods: str | None = None,
) -> None:
    """Take what has landed since the last run through the whole flow, then stop.

    Every batch is split by source and upserted by key: statistics, trade, datasets, glossary entries
    and region lists; an existing row gives way only to one that landed on its day or later, so the
    order of batches does not matter. A batch that is run again after a failure leaves the tables as
    they were. Values map to `region_codes`, or else to the latest landed region list of `domain`;
    `regions` (region_code, region_name) are upserted besides. What cannot be loaded is stored with its
    file and the batch: responses in `staging.rejected_responses`, observations without region or year
    in `staging.rejected_observations`, trade records without a period or key in
    `staging.rejected_trade`, all replaced batch by batch. Marts are refreshed once, after the last
    batch, and only where batches have changed something.
    """

    def upsert(batch: DataFrame, batch_id: int) -> None:
        label = F.lit(f"batch {batch_id}").alias("batch")
        # A batch has a session of its own; it is read once and handed over to the warehouse's.
        path = scratch_path(spark, "batch")
        try:
            rows = batch.withColumns({
                "content": F.sha2(F.coalesce("body", F.lit("")), 256),
                "reason": parsers.rejection(F.col("source"), F.col("body")),
            })
            rows.write.partitionBy("source").parquet(f"{path}/arrived")
            arrived = spark.read.schema(rows.schema).parquet(f"{path}/arrived")
            rejected = arrived.where("reason IS NOT NULL").select("source", "dataset", "doc", "reason", label)
            warehouse.load(rejected, "staging", "rejected_responses", "replace", partition_by=["batch"])
            accepted = arrived.where("reason IS NULL")
            pipeline.load_responses(
                spark, warehouse, accepted, listed(), domain, periods=periods, codes=region_codes, apart=label
            )
            pipeline.record_loaded(warehouse, accepted, "stream")
        finally:
            discard(spark, path)

    def listed() -> DataFrame:
        """The regions of the domain by the lists landed so far."""
        lists = landing.read_landed(spark, landing_dir, pipeline.REGIONS)
        files = landing.list_landed(spark, landing_dir, pipeline.REGIONS)
        return pipeline.domain_regions(pipeline.latest_landed(lists, files), domain)

    warehouse.create_tables()
    if regions is not None:
        warehouse.upsert(model.build_dim_region(regions), "dim_region")
    query = (
        landed_stream(spark, landing_dir, max_files)
        .writeStream.foreachBatch(upsert)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if rebuild_marts:
        pipeline.refresh_marts(warehouse)
