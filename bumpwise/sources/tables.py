"""Tables the jobs read."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bumpwise.operators.facts import coerce_fact
from bumpwise.operators.keyed import attach_by_key
from bumpwise.operators.roads import made_once, parse_geojson_parts, parse_wkt_parts
from bumpwise.schema import ANOMALY_BY_DAY, MART_POINTER, SEGMENT, SENSOR_BY_DAY, STORED_FACT
from bumpwise.session import store


def scan_raw_partition(spark: SparkSession, path: str, day: str) -> DataFrame:
    """One day of the raw table, each trip as last delivered; a day without data is an error.

    Reads tables of plain `dt=<day>/` folders too.
    """
    rows = read_latest(spark, path, SENSOR_BY_DAY, day)
    if rows.isEmpty():
        raise ValueError(f"no data for dt={day} in {path}")
    return rows


def read_anomalies(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ANOMALY_BY_DAY).parquet(path)


def deliveries_path(path: str) -> str:
    """Where a stream notes the deliveries it has processed for the table at `path`."""
    return f"{path.rstrip('/')}-deliveries"


def read_stream_anomalies(spark: SparkSession, path: str, day: str | None = None) -> DataFrame:
    """Anomalies written by a stream, each trip as last delivered, even if that had none left."""
    return read_latest(spark, path, ANOMALY_BY_DAY, day, deliveries_path(path))


def _read_days(
    spark: SparkSession, path: str, schema: T.StructType, day: str | Sequence[str] | None
) -> DataFrame:
    """The table, or the folder of one day alone (empty if that does not exist), or of several days."""
    if day is None:
        return spark.read.schema(schema).parquet(path)
    if not isinstance(day, str):
        folders = [f"{path}/dt={one}" for one in day]
        return spark.read.schema(schema).option("basePath", path).parquet(*folders).filter(F.col("dt").isin(list(day)))
    try:
        folder = spark.read.schema(schema).option("basePath", path).parquet(f"{path}/dt={day}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    return folder.filter(F.col("dt") == day)


def read_latest(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    day: str | Sequence[str] | None = None,
    deliveries: str | None = None,
    keep_seq: bool = False,
) -> DataFrame:
    """A table written in batches, each trip as last delivered.

    Batches only add files (`dt=<day>/batch=<id>/`); of the deliveries of a trip on a day, the
    rows with the greatest `seq` (then batch) count; with `deliveries`, a table of all deliveries, that may be
    one without rows. A `day`, or several that exist, lists and reads these partitions alone. The trips delivered
    more than once are found when this is called, from the key columns, and stored: they are
    few, so the rows themselves need no shuffle, and no join at all where there are none.
    `keep_seq` adds the number of the delivery.
    """
    marks = [T.StructField("seq", T.LongType()), T.StructField("batch", T.StringType())]
    table = T.StructType(schema.fields + marks)
    keys = ("dt", "trip_id")
    # one delivery may have been stored by two queries over the same source: one batch counts
    delivery = F.struct("seq", F.coalesce("batch", F.lit("")).alias("batch"))
    rows = _read_days(spark, path, table, day).withColumn("_delivery", delivery)
    known = rows.select(*keys, "_delivery")
    if deliveries is not None:
        noted = T.StructType([f for f in table.fields if f.name in (*keys, "seq", "batch")])
        others = _read_days(spark, deliveries, noted, day).select(*keys, delivery.alias("_delivery"))
        known = known.unionByName(others)
    counted = known.groupBy(*keys).agg(
        F.min("_delivery").alias("_first"),
        F.max("_delivery").alias("_last"),
        F.count(F.lit(1)).alias("_rows"),
    )
    repeated, n_repeated = store(counted.filter("_first < _last").drop("_first"), "repeated")
    wanted = [*schema.names, *(["seq"] if keep_seq else [])]
    if n_repeated == 0:
        return rows.select(*wanted)
    return (
        attach_by_key(rows, repeated, keys, weight="_rows")
        .filter(F.col("_last").isNull() | (F.col("_delivery") == F.col("_last")))
        .select(*wanted)
    )


def read_segments_csv(spark: SparkSession, path: str) -> DataFrame:
    """Road segments from CSV with header, by declared types instead of inferred ones."""
    return spark.read.schema(SEGMENT).csv(path, header=True)


def read_links(
    spark: SparkSession,
    path: str,
    geometry: str = "geometry",
    encoding: str = "utf-8",
    link_id: str = "link_id",
    form: str = "wkt",
    file_format: str = "csv",
) -> DataFrame:
    """Road links with their lines as `parts`, and all points of these as `pts`.

    A link is a single line or several (MULTILINESTRING); both columns are NULL where it could not
    be read. The other attributes stay as they are.
    """
    if file_format == "csv":
        links = spark.read.csv(path, header=True, encoding=encoding, multiLine=False)
    else:
        links = spark.read.format(file_format).load(path)
    parse = {"wkt": parse_wkt_parts, "geojson": parse_geojson_parts}[form]
    read = made_once(links, "parts", parse(F.col(geometry))).withColumn("pts", F.flatten("parts"))
    return read.withColumnRenamed(link_id, "link_id")


def load_fact(
    spark: SparkSession,
    path: str,
    date: dt.date | str,
    merge_schema: bool = False,
) -> DataFrame:
    """All Parquet files under a prefix as facts of one day, whatever date they carry.

    `merge_schema` reads every file's footer; it is only needed when the files' columns differ.
    """
    try:
        raw = spark.read.parquet(
            path,
            pathGlobFilter="*.parquet",
            recursiveFileLookup=True,
            mergeSchema=merge_schema,
        )
    except AnalysisException as error:
        raise FileNotFoundError(f"no Parquet files under {path}") from error
    return coerce_fact(raw, date)


def read_if_there(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table as declared; without rows before its first write."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_fact(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored fact table; None before its first write."""
    try:
        return spark.read.schema(STORED_FACT).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def pointers_path(path: str) -> str:
    """Where the published versions of the marts under `path` are noted."""
    return f"{path.rstrip('/')}-current"


def current_versions(spark: SparkSession, path: str) -> DataFrame:
    """`mart`, `version`, `n_rows`: the version of each mart that was published last."""
    noted = read_if_there(spark, pointers_path(path), MART_POINTER)
    newest = F.max(F.struct("version", "n_rows")).alias("newest")
    return noted.groupBy("mart").agg(newest).select("mart", "newest.version", "newest.n_rows")


def read_mart(spark: SparkSession, path: str, mart: str) -> DataFrame:
    """A mart as last published; a refresh that failed or is under way does not show."""
    row = current_versions(spark, path).filter(F.col("mart") == mart).first()
    if row is None:
        raise FileNotFoundError(f"no version of {mart} was published in {path}")
    return spark.read.parquet(f"{path}/{mart}/{row['version']}")


def union_by_name(parts: Sequence[DataFrame]) -> DataFrame:
    """All rows of all parts, columns matched by name, absent ones NULL."""
    if not parts:
        raise ValueError("nothing to unite")
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole
