"""The library's input tables, derived from the given test tables.

One text per table serves both engines; only the placeholders differ. Every table is derived
from all rows of its source, so it grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SENSOR = """
SELECT event_id, {ms} AS timestamp, concat('T', CAST(user_id AS VARCHAR(20))) AS trip_id,
  concat('V', CAST(user_id % 20 AS VARCHAR(20))) AS vehicle_id,
  CAST(event_id % 11 AS DOUBLE) / 10 AS accel_x, CAST(event_id % 13 AS DOUBLE) / 10 AS accel_y,
  value / 5 AS accel_z,
  CAST(event_id % 17 AS DOUBLE) / 10 AS gyro_x, {k} / 10 AS gyro_y,
  CAST(event_id % 19 AS DOUBLE) / 10 AS gyro_z,
  CAST(event_id % 80 AS DOUBLE) AS velocity,
  CASE WHEN user_id % 29 = 0 OR event_id % 50 = 0 THEN CAST(126.9 AS DOUBLE)
       ELSE CAST(127.52 AS DOUBLE) + CAST((((event_id * 37) % 40) * 13) % 2600 AS DOUBLE) / 10000
            + CAST(0.0002 AS DOUBLE) + CAST(event_id % 21 - 10 AS DOUBLE) / 50000 END AS lon,
  CASE WHEN user_id % 31 = 0 OR event_id % 97 = 0 THEN CAST(50 AS DOUBLE)
       ELSE CAST(34.5 AS DOUBLE) + CAST((((event_id * 37) % 40) * 29) % 5700 AS DOUBLE) / 10000
            + CAST(0.00015 AS DOUBLE) + CAST(event_id % 19 - 9 AS DOUBLE) / 50000 END AS lat,
  CAST(event_id % 7 AS DOUBLE) AS hdop, CAST(event_id % 13 AS INT) AS satellites,
  CAST(CAST(ts AS DATE) AS VARCHAR(10)) AS dt
FROM {table}
"""

_SEGMENTS = """
SELECT CAST(p_partkey AS VARCHAR(20)) AS s_id, CAST(p_partkey % 25 AS VARCHAR(20)) AS link_id,
  CAST(127.52 AS DOUBLE) + CAST((p_partkey * 13) % 2600 AS DOUBLE) / 10000 AS start_lon,
  CAST(34.5 AS DOUBLE) + CAST((p_partkey * 29) % 5700 AS DOUBLE) / 10000 AS start_lat,
  CAST(127.52 AS DOUBLE) + CAST((p_partkey * 13) % 2600 AS DOUBLE) / 10000
    + CAST(0.0004 AS DOUBLE) AS end_lon,
  CAST(34.5 AS DOUBLE) + CAST((p_partkey * 29) % 5700 AS DOUBLE) / 10000
    + CAST(0.0003 AS DOUBLE) AS end_lat
FROM {table}
"""

_FACT = """
SELECT CAST(l_suppkey % 20 AS VARCHAR(20)) AS s_id,
  CAST(127.52 AS DOUBLE) + CAST(l_suppkey % 20 AS DOUBLE) / 100 AS centroid_lon,
  CAST(34.5 AS DOUBLE) + CAST(l_suppkey % 20 AS DOUBLE) / 50 AS centroid_lat,
  CAST(l_shipdate AS DATE) AS date, CAST(COUNT(*) AS INT) AS impact_count
FROM {table} GROUP BY 1, 2, 3, 4
"""

# one straight line from (x0, y0) to (x0 + len, y0); rows of 5,000 keep the grid near its origin
_LINKS = """
SELECT CAST(p_partkey AS VARCHAR(20)) AS link_id, CAST(p_partkey % 10 AS VARCHAR(20)) AS road_no,
  CAST(200000 AS DOUBLE) + CAST((p_partkey % 5000) * 10 AS DOUBLE) AS x0,
  CAST(250000 AS DOUBLE) + floor(CAST(p_partkey AS DOUBLE) / 5000) * 10 AS y0,
  CAST(p_size * 7 AS DOUBLE) AS len
FROM {table}
"""

_TEXTS = {
    "sensor": (_SENSOR, "events"),
    "segments": (_SEGMENTS, "part"),
    "fact": (_FACT, "lineitem"),
    "links": (_LINKS, "part"),
}
_SPARK = {
    "ms": "timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts) DIV 1000",
    "k": "k",
}
# a generator, so that filters on what is derived from it do not read the JSON again
_SPARK_SOURCES = {
    "events": "{source} LATERAL VIEW "
    "inline(array(struct(CAST(get_json_object(props, '$.k') AS DOUBLE) AS k))) AS k"
}
_DUCKDB = {
    "ms": "epoch_us(ts) // 1000",
    "k": "CAST(json_extract_string(props, '$.k') AS DOUBLE)",
}

# a message holds the records of one trip from one block of event ids, so at most this many
RECORDS_PER_MESSAGE = 10_000


def oracle_text(name: str) -> str:
    text, table = _TEXTS[name]
    return text.format(table=table, **_DUCKDB).strip()


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text, table = _TEXTS[name]
    source = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    origin = _SPARK_SOURCES.get(table, "{source}")
    return spark.sql(text.format(table=origin, **_SPARK), source=source)


def sensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "sensor")


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "segments")


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "fact")


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links with their line as `pts`, besides the adapter's x0, y0 and len."""
    table = _table(spark, sf_dir, "links")
    ends = F.array(
        F.struct(F.col("x0").alias("x"), F.col("y0").alias("y")),
        F.struct((F.col("x0") + F.col("len")).alias("x"), F.col("y0").alias("y")),
    )
    return table.withColumn("pts", ends)


def messages(
    spark: SparkSession, sf_dir: str, optional_keys: bool = True, by_day: bool = False
) -> DataFrame:
    """The sensor table as trip messages: `seq`, `value`.

    Trip ids are `<trip>-<block of event ids>`. Without `optional_keys` the records lack speed,
    hdop and satellites. With `by_day` a trip has a message for each of its days.
    """
    gps = {"lng": "lon", "lat": "lat"} | ({"hdop": "hdop", "sat": "satellites"} if optional_keys else {})
    record = F.struct(
        "event_id",
        F.col("timestamp").alias("ts"),
        F.array("accel_x", "accel_y", "accel_z").alias("acc"),
        F.array("gyro_x", "gyro_y", "gyro_z").alias("gyr"),
        *([F.col("velocity").alias("spd")] if optional_keys else []),
        F.struct(*(F.col(name).alias(key) for key, name in gps.items())).alias("gps"),
    )
    block = F.floor(F.col("event_id") / RECORDS_PER_MESSAGE)
    trips = (
        sensor(spark, sf_dir)
        .groupBy(F.concat_ws("-", "trip_id", block).alias("trip_id"), *(["dt"] if by_day else []))
        .agg(
            F.min("vehicle_id").alias("vin"),
            F.concat(F.min("dt"), F.lit("T00:00:00+09:00")).alias("start_time"),
            F.max("event_id").alias("seq"),
            F.sort_array(F.collect_list(record)).alias("records"),
        )
    )
    return trips.select(
        "seq", F.to_json(F.struct("trip_id", "vin", "start_time", "records")).alias("value")
    )


def envelopes(messages: DataFrame) -> DataFrame:
    """Messages as a stream source delivers them: `seq` and base64 `data`."""
    return messages.select(
        "seq", F.base64(F.encode("value", "UTF-8")).alias("data")
    )
