"""Tables of the warehouse layers: creation, loads and the keyed idempotent upsert."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbung.functions.storage import discard, scratch_path
from lumbung.schemas import (
    LAYERS,
    STAGING_TABLES,
    WAREHOUSE_TABLES,
    EconomicStar,
    TableSpec,
    TradeStar,
)

# Suffix of the next version of a table while it is swapped in.
_NEXT = "__next"
# Between the name of a mart and that of one version of it.
_VERSION = "__v"
# Before the name of a table, that of the staging table of its changes.
_CHANGED = "changed_"
# What is kept of a fact's changes; of a dimension it is the key.
CHANGE_COLUMNS = {"fact_economic": ("indicator_key", "year"), "fact_trade": ("year",)}

WRITE_MODES = {"append": "append", "replace": "overwrite", "fail": "errorifexists"}


def any_null(columns: Sequence[str]) -> Column:
    return F.greatest(F.lit(False), F.lit(False), *[F.col(c).isNull() for c in columns])


class Merge:
    """INSERT .. ON CONFLICT of a batch into a table, as joins.

    `update` are the columns an existing row takes over: None for all but the key, an empty
    list to leave existing rows alone. Among batch rows with one key, the last by `ordinal`
    supplies the updated columns and the first the other columns of a new row. Rows with a
    NULL in the key conflict with nothing. Where the batch has the table's version column, that is
    updated as well, and an existing row gives way only to one of its own or a later version; a row
    without a version gives way to any, and one without a version replaces only such a row. Every
    result has the table's columns and `_n`, the number of batch rows merged into the row.
    """

    def __init__(
        self,
        source: DataFrame,
        spec: TableSpec,
        key: Sequence[str] | None = None,
        update: Sequence[str] | None = None,
        ordinal: str | Column | None = None,
    ):
        self.spec = spec
        self.key = list(key or spec.key)
        self.columns = [c for c in source.columns if c in spec.schema.names]
        self.others = [c for c in self.columns if c not in self.key]
        self.update = self.others if update is None else list(update)
        self.version = spec.version if spec.version in self.columns else None
        if self.update and self.version and self.version not in self.update:
            self.update.append(self.version)
        self.kept = [c for c in self.others if c not in self.update]
        # Without an order, equal keys are decided by their values.
        order = F.struct(*self.others) if ordinal is None else ordinal
        order = F.col(order) if isinstance(order, str) else order
        typed = [F.col(c).cast(spec.schema[c].dataType).alias(c) for c in self.columns]
        # In a struct, rows without a place come first and are not passed over.
        self.source = source.select(*typed, F.struct(order.alias("place")).alias("_order"))
        # A key that is NOT NULL throughout leaves no rows outside the keyed merge.
        self.keyed_only = set(self.key) <= set(spec.required)

    def batch(self) -> DataFrame:
        """One row per key: its first and its last batch row, and how many there are.

        A key that a large part of the batch shares is reduced in the map-side combine.
        """
        if self.keyed_only:
            fields = {f.name: f for f in self.spec.schema}
            rows = self.source.withColumns({c: _required(fields[c], F.col(c)) for c in self.key})
        else:
            rows = self.source.where(~any_null(self.key))
        present = F.lit(True).alias("_present")
        return rows.groupBy(*self.key).agg(
            F.min_by(F.struct(present, *self.kept), "_order").alias("_first"),
            F.max_by(F.struct(present, *self.update), "_order").alias("_last"),
            F.count(F.lit(1)).alias("_n"),
        )

    def new_rows(self, batch: DataFrame) -> DataFrame:
        """Rows of an empty table after the batch."""
        return batch.select(*[self._column(f, self._fresh(f)) for f in self.spec.schema], "_n")

    def merged_rows(self, target: DataFrame, batch: DataFrame) -> DataFrame:
        """Rows of the table after the batch."""
        names = self.spec.schema.names
        keyed = target if self.keyed_only else target.where(~any_null(self.key))
        old = keyed.withColumnsRenamed({c: f"_old_{c}" for c in names if c not in self.key})
        # Both sides have one row per key.
        joined = old.withColumn("_exists", F.lit(True)).join(batch, self.key, "full_outer")

        def value(field: T.StructField) -> Column:
            if field.name in self.key:
                return F.col(field.name)
            kept = F.col(f"_old_{field.name}")
            if field.name in self.update:
                taken = F.col("_n").isNotNull() & self._newer()
                return F.when(taken, F.col(f"_last.{field.name}")).otherwise(kept)
            return F.when(F.col("_exists").isNotNull(), kept).otherwise(self._fresh(field))

        rows = joined.select(*[self._column(f, value(f)) for f in self.spec.schema], "_n")
        if self.keyed_only:
            return rows
        untouched = target.where(any_null(self.key)).select(
            *names, F.lit(None).cast("long").alias("_n")
        )
        return rows.unionByName(untouched)

    def _newer(self) -> Column:
        """Whether the batch row may replace the existing one."""
        if not self.version or not self.update:
            return F.lit(True)
        old = F.col(f"_old_{self.version}")
        return F.coalesce(old.isNull() | (F.col(f"_last.{self.version}") >= old), F.lit(False))

    def changes(self, target: DataFrame, batch: DataFrame) -> DataFrame:
        """Keys of the batch rows that are new or change an existing row.

        `differs` is false where nothing but the version changes.
        """
        compared = [c for c in self.update if c not in self.key]
        old = target.select(*self.key, *[F.col(c).alias(f"_old_{c}") for c in compared])
        joined = batch.join(old.withColumn("_exists", F.lit(True)), self.key, "left")

        def other(column: str) -> Column:
            return ~F.col(f"_old_{column}").eqNullSafe(F.col(f"_last.{column}"))

        values = [other(c) for c in compared if c != self.version]
        new = F.col("_exists").isNull()
        value = F.greatest(F.lit(False), F.lit(False), *values) & self._newer()
        version = other(self.version) & self._newer() if self.version and compared else F.lit(False)
        return joined.select(*self.key, (new | value).alias("differs"), (new | value | version).alias("_any")).where(
            "_any"
        ).drop("_any")

    def keyless_rows(self) -> DataFrame:
        """Batch rows with a NULL in the key, to be inserted as they are."""

        def value(field: T.StructField) -> Column:
            given = field.name in self.columns
            return F.col(field.name) if given else self._generated(field)

        return self.source.where(any_null(self.key)).select(
            *[self._column(f, value(f)) for f in self.spec.schema],
            F.lit(1).cast("long").alias("_n"),
        )

    def _fresh(self, field: T.StructField) -> Column:
        """Value of a column in a newly inserted row."""
        given = field.name in self.columns
        return self.batch_value(field.name) if given else self._generated(field)

    def batch_value(self, name: str) -> Column:
        """What a reduced batch row says about a column."""
        if name in self.key:
            return F.col(name)
        return F.col(f"_last.{name}" if name in self.update else f"_first.{name}")

    def _generated(self, field: T.StructField) -> Column:
        if field.name == self.spec.surrogate:
            return F.xxhash64(*self.spec.key)
        if field.name == "loaded_at":
            return F.current_timestamp()
        return F.lit(dict(self.spec.defaults).get(field.name))

    def _column(self, field: T.StructField, value: Column) -> Column:
        return _required(field, value).cast(field.dataType).alias(field.name)


def _required(field: T.StructField, value: Column) -> Column:
    if field.nullable:
        return value
    message = F.lit(f"null value in column {field.name} violates its not-null constraint")
    return F.coalesce(value, F.raise_error(message).cast(field.dataType))


class Warehouse:
    """The layer databases of one warehouse.

    `location` is the folder of the databases, the session's default if it is None; `prefix`
    goes before the database names.
    """

    def __init__(self, spark: SparkSession, location: str | None = None, prefix: str = ""):
        self.spark = spark
        self.location = location
        self.prefix = prefix

    def name(self, layer: str, table: str) -> str:
        return f"{self.prefix}{layer}.{table}"

    def create_schemas(self, layers: Sequence[str] = LAYERS) -> None:
        for layer in layers:
            database = f"{self.prefix}{layer}"
            place = f" LOCATION '{self.location}/{database}'" if self.location else ""
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")

    def drop_schemas(self, layers: Sequence[str] = LAYERS) -> None:
        for layer in layers:
            self.spark.sql(f"DROP DATABASE IF EXISTS {self.prefix}{layer} CASCADE")

    def create_tables(self) -> None:
        """Create the typed tables that do not exist yet and check that the facts do."""
        self.create_schemas()
        for layer, tables in (("staging", STAGING_TABLES), ("warehouse", WAREHOUSE_TABLES)):
            for table, spec in tables.items():
                if not self.exists(layer, table):
                    empty = self.spark.createDataFrame([], _all_nullable(spec.schema))
                    self._write(empty, layer, table, "errorifexists", spec.partition_by)
        missing = [t for t in ("fact_economic", "fact_trade") if not self.exists("warehouse", t)]
        if missing:
            raise RuntimeError(f"tables missing in warehouse: {missing}")

    def exists(self, layer: str, table: str) -> bool:
        """Whether there is such a table; a swap that broke off half-way is finished first."""
        if self.spark.catalog.tableExists(self.name(layer, table)):
            return True
        following = self.name(layer, table + _NEXT)
        if not self.spark.catalog.tableExists(following):
            return False
        self.spark.sql(f"ALTER TABLE {following} RENAME TO {self.name(layer, table)}")
        return True

    def is_empty(self, layer: str, table: str) -> bool:
        return not self.exists(layer, table) or self.table(layer, table).isEmpty()

    def table(self, layer: str, table: str) -> DataFrame:
        self.exists(layer, table)
        return self.spark.table(self.name(layer, table))

    def row_count(self, layer: str, table: str) -> int:
        return self.table(layer, table).count()

    def truncate(self, layer: str, table: str) -> None:
        self.spark.sql(f"TRUNCATE TABLE {self.name(layer, table)}")

    def load(
        self,
        df: DataFrame,
        layer: str,
        table: str,
        if_exists: str = "append",
        partition_by: Sequence[str] = (),
    ) -> None:
        """Write a DataFrame as a table: append, replace, or fail if it exists."""
        self.create_schemas([layer])
        self._write(df, layer, table, WRITE_MODES[if_exists], partition_by)

    def _write(
        self, df: DataFrame, layer: str, table: str, mode: str, partition_by: Sequence[str] = (),
        by_partition: bool = True,
    ) -> None:
        writer = df.write.format("parquet").mode(mode)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
            if by_partition:
                # A table property from here on: an overwrite replaces the partitions it has rows for.
                writer = writer.option("partitionOverwriteMode", "dynamic")
        writer.saveAsTable(self.name(layer, table))

    def build_mart(self, df: DataFrame, mart: str) -> None:
        """Replace a mart by the current result of its query.

        A mart is a view of a table that holds one version. The new version is written in full
        before the view turns to it, so readers always find a whole mart, and a build that breaks
        off leaves the old one. A mart with a year is partitioned by it.
        """
        partition_by = [c for c in df.columns if c == "year"] if len(df.columns) > 1 else []
        if partition_by:
            # One writer for a year, several for a large one.
            df = df.hint("rebalance", F.col("year"))
            if "indicator_key" in df.columns:
                df = df.sortWithinPartitions("year", "indicator_key")
        self.publish("mart", mart, self.write_version(df, "mart", mart, partition_by), df.columns)

    def write_version(self, df: DataFrame, layer: str, table: str, partition_by: Sequence[str] = ()) -> str:
        """Write a version of a table, which nobody finds under the table's name before `publish`."""
        self.create_schemas([layer])
        version = f"{table}{_VERSION}{uuid.uuid4().hex}"
        self._write(df, layer, version, "errorifexists", partition_by)
        return version

    def publish(self, layer: str, table: str, version: str, columns: Sequence[str]) -> None:
        """Turn a table to a written version and drop the others, also those never published."""
        name, catalog = self.name(layer, table), self.spark.catalog
        columns = ", ".join(f"`{column}`" for column in columns)
        if catalog.tableExists(name) and catalog.getTable(name).tableType != "VIEW":
            self.spark.sql(f"DROP TABLE {name}")
        self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM {self.name(layer, version)}")
        for other in catalog.listTables(f"{self.prefix}{layer}"):
            if other.name.startswith(f"{table}{_VERSION}".lower()) and other.name != version.lower():
                self.withdraw(layer, other.name)

    def withdraw(self, layer: str, version: str) -> None:
        """Drop a version that is not to be published."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(layer, version)}")

    def replace_years(self, rows: DataFrame, mart: str, years: Sequence[int]) -> None:
        """Replace the partitions of these years of a stored mart; the others are not touched.

        `rows` holds everything the mart has for the years, which may come from the mart itself.
        """
        version = self._version_of(mart)
        columns = self.spark.table(version).columns
        rows = rows.where(F.col("year").isin(list(years))).select(*columns).hint("rebalance", F.col("year"))
        if "indicator_key" in columns:
            rows = rows.sortWithinPartitions("year", "indicator_key")
        rows.write.insertInto(version, overwrite=True)
        self.spark.catalog.refreshTable(self.name("mart", mart))

    def _version_of(self, mart: str) -> str:
        """The table that a mart is a view of."""
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name('mart', mart)}")
        text = described.where("col_name = 'View Text'").first()["data_type"]
        return text.rpartition(" FROM ")[2].strip()

    def upsert(
        self,
        df: DataFrame,
        table: str,
        key: Sequence[str] | None = None,
        update: Sequence[str] | None = None,
        ordinal: str | Column | None = None,
    ) -> int:
        """Insert or update rows of a warehouse table by key; returns the input rows.

        Repeating a load changes nothing. See `Merge` for the semantics. Of a partitioned
        table only the partitions that the batch touches are read and rewritten, any other is
        rewritten only if the batch changes it. What changes is noted before (see `changed`).
        """
        spec = WAREHOUSE_TABLES[table]
        merge = Merge(df, spec, key, update, ordinal)
        self.create_schemas(["warehouse"])
        if not self.exists("warehouse", table):
            empty = self.spark.createDataFrame([], _all_nullable(spec.schema))
            self._write(empty, "warehouse", table, "errorifexists", spec.partition_by)

        if self.is_empty("warehouse", table) and not self._has_marts():
            rows = merge.new_rows(merge.batch())
            if not merge.keyed_only:
                rows = rows.unionByName(merge.keyless_rows())
            return self._insert(rows, table, spec)

        # The batch is computed once: its partition values, its changes and its rows are all read.
        path = scratch_path(self.spark, "batch")
        merge.batch().write.parquet(f"{path}/rows")
        try:
            return self._merge(merge, self.spark.read.parquet(f"{path}/rows"), table, spec, path)
        finally:
            discard(self.spark, path)

    def _merge(self, merge: Merge, batch: DataFrame, table: str, spec: TableSpec, path: str) -> int:
        keyless = None if merge.keyed_only else merge.keyless_rows()
        if not spec.partition_by:
            merge.changes(self.table("warehouse", table), batch).write.parquet(f"{path}/changes")
            changed = self.spark.read.parquet(f"{path}/changes")
            if changed.isEmpty() and (keyless is None or keyless.isEmpty()):
                return batch.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
            self._note(changed.where("differs").select(*merge.key), table)
            rows = merge.merged_rows(self.table("warehouse", table), batch)
            if keyless is not None:
                rows = rows.unionByName(keyless)
            counted = Observation()
            rows = rows.observe(counted, F.coalesce(F.sum("_n"), F.lit(0)).alias("rows")).drop("_n")
            self._swap(rows, "warehouse", table)
            return counted.get["rows"]
        partition = spec.partition_by[0]
        noted = [c for c in CHANGE_COLUMNS[table] if c != partition]
        given = batch.select(*[merge.batch_value(c).alias(c) for c in (*noted, partition)])
        if keyless is not None:
            given = given.union(keyless.select(*noted, partition))
        self._note(given.distinct(), table)
        added = 0 if keyless is None else self._insert(keyless, table, spec)
        # At most one row per calendar year: periods are checked before.
        touched = [row[0] for row in batch.select(merge.batch_value(partition)).distinct().collect()]
        if not touched:
            return added
        known = F.col(partition).isin([value for value in touched if value is not None])
        in_batch = known | F.col(partition).isNull() if None in touched else known
        target = self.table("warehouse", table)
        if not added and target.isEmpty():
            return self._insert(merge.new_rows(batch), table, spec)
        return added + self._insert(merge.merged_rows(target.where(in_batch), batch), table, spec, replace=True)

    def _has_marts(self) -> bool:
        """Whether there are marts that have to follow a load; the first are built from everything."""
        database = f"{self.prefix}mart"
        return self.spark.catalog.databaseExists(database) and not self.spark.sql(f"SHOW VIEWS IN {database}").isEmpty()

    def _note(self, keys: DataFrame, table: str) -> None:
        """Keep what a load is about to change until the marts have followed it."""
        if self._has_marts():
            self.load(keys, "staging", _CHANGED + table)

    def changed(self, table: str) -> DataFrame | None:
        """What loads have changed in a table since the marts were last brought up to date."""
        name = _CHANGED + table
        return self.table("staging", name).distinct() if self.exists("staging", name) else None

    def forget_changes(self) -> None:
        for table in WAREHOUSE_TABLES:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name('staging', _CHANGED + table)}")

    def _insert(
        self, merged: DataFrame, table: str, spec: TableSpec, replace: bool = False
    ) -> int:
        """Append rows, or replace the partitions that the rows belong to."""
        counted = Observation()
        rows = merged.observe(counted, F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"))
        rows = rows.select(*spec.schema.names)
        name = self.name("warehouse", table)
        rows.write.insertInto(name, overwrite=replace)
        return counted.get["rows"]

    def _swap(self, rows: DataFrame, layer: str, table: str) -> None:
        """Write the next version of an unpartitioned table beside it, then put it in its place.

        The rows exist in full at every moment. Stopped between the two last steps, the next
        version stands under its own name, and `exists` gives it the table's name.
        """
        current, following = self.name(layer, table), self.name(layer, table + _NEXT)
        present = self.exists(layer, table)
        self.spark.sql(f"DROP TABLE IF EXISTS {following}")
        # Over whatever a write that broke off has left there.
        self._write(rows, layer, table + _NEXT, "overwrite")
        if present:
            self.spark.sql(f"DROP TABLE {current}")
        self.spark.sql(f"ALTER TABLE {following} RENAME TO {current}")

    def economic_star(self) -> EconomicStar:
        return EconomicStar(
            *[
                self.table("warehouse", t)
                for t in ("fact_economic", "dim_date", "dim_region", "dim_indicator")
            ]
        )

    def trade_star(self) -> TradeStar:
        return TradeStar(
            *[
                self.table("warehouse", t)
                for t in ("fact_trade", "dim_date", "dim_product", "dim_country", "dim_trade_flow")
            ]
        )


def _all_nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
