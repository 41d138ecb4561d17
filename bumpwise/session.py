"""Spark session and shared folders."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def build_session(
    app: str = "bumpwise", master: str | None = None, shuffle_partitions: int | None = None
) -> SparkSession:
    """A session with the settings the jobs count on; a cluster's own settings stay in force.

    Adaptive execution coalesces small shuffle partitions and splits skewed ones, so
    `shuffle_partitions` is only worth setting for small local runs.
    """
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC")
    if master:
        builder = (
            builder.master(master)
            .config("spark.ui.enabled", "false")
            .config("spark.driver.host", "127.0.0.1")
            .config("spark.driver.bindAddress", "127.0.0.1")
        )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, named by `spark.checkpoint.dir`.

    A local session without one gets a temporary folder; a cluster without one is an error,
    since files in a machine-local folder are lost with the machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    configured = configured or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="bumpwise-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def store(frame: DataFrame, name: str) -> tuple[DataFrame, int]:
    """A copy of `frame` in the shared folder, and its number of rows.

    It cuts the lineage where executors may be lost, and Spark knows the size of what it reads
    back, so it broadcasts the copy only if it is small enough.
    """
    spark, path, counted = frame.sparkSession, work_path(frame.sparkSession, name), Observation()
    frame.observe(counted, F.count(F.lit(1)).alias("n")).write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path), counted.get["n"]


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """One of the session's settings, for the jobs that run within."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def row_bytes(frame: DataFrame) -> Column:
    """About how many bytes a row takes: the length of its texts, and 8 for any other value."""
    texts = [field.name for field in frame.schema if isinstance(field.dataType, (T.StringType, T.BinaryType))]
    width = F.lit(8 * (len(frame.columns) - len(texts))).cast("long")
    for name in texts:
        width = width + F.coalesce(F.octet_length(name), F.lit(0))
    return width


def store_measured(frame: DataFrame, name: str) -> tuple[DataFrame, int, int]:
    """As `store`, with the bytes of the rows (`row_bytes`) too, counted while they are written."""
    spark, path, counted = frame.sparkSession, work_path(frame.sparkSession, name), Observation()
    measures = [F.count(F.lit(1)).alias("n"), F.sum(row_bytes(frame)).alias("bytes")]
    frame.observe(counted, *measures).write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path), counted.get["n"], counted.get["bytes"] or 0


def remove_path(spark: SparkSession, path: str) -> bool:
    """Remove a folder and all in it, in whatever file system it lies; False if it was not there."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """The names of the folders in `path`; none if it does not exist."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(place):
        return []
    return sorted(entry.getPath().getName() for entry in files.listStatus(place) if entry.isDirectory())
