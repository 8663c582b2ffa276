"""Where intermediate results go: the shared folder that the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder named by spark.checkpoint.dir.

    Where that is unset, a fresh local folder serves a local session; executors on other machines
    could not see one, so there it is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    named = named or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    fresh = tempfile.mkdtemp(prefix="lumbung-")
    spark.sparkContext.setCheckpointDir(fresh)
    return fresh


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder that nothing has written to yet."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch path that nothing reads any more."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """The rows written once under the shared folder and read back.

    Cuts the lineage like a checkpoint. As a Parquet table it also keeps column pruning, and its
    size is known when the plans that read it choose their joins.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
