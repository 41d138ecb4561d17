"""Schemas of the tables the jobs read and write."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "boolean": T.BooleanType(),
}


def _fields(text: str) -> T.StructType:
    pairs = (field.split() for field in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


SENSOR_COLUMNS = (
    "timestamp", "trip_id", "vehicle_id",
    "accel_x", "accel_y", "accel_z",
    "gyro_x", "gyro_y", "gyro_z",
    "velocity", "lon", "lat", "hdop", "satellites",
)

ANOMALY_COLUMNS = SENSOR_COLUMNS + ("nor_accel_z", "nor_gyro_y", "impact_score")

_SENSOR_DDL = (
    "timestamp bigint, trip_id string, vehicle_id string, "
    "accel_x double, accel_y double, accel_z double, "
    "gyro_x double, gyro_y double, gyro_z double, "
    "velocity double, lon double, lat double, hdop double, satellites int"
)

SENSOR = _fields(_SENSOR_DDL)
SENSOR_BY_DAY = _fields(_SENSOR_DDL + ", dt string")
ANOMALY_BY_DAY = _fields(
    _SENSOR_DDL + ", nor_accel_z double, nor_gyro_y double, impact_score double, dt string"
)
MAPPED_BY_DAY = _fields(
    "timestamp bigint, trip_id string, lon double, lat double, s_id string, dt string"
)

SEGMENT = _fields(
    "s_id string, link_id string, start_lon double, start_lat double, end_lon double, end_lat double"
)

FACT_KEY = ("s_id", "date")
FACT_COLUMNS = ("s_id", "centroid_lon", "centroid_lat", "date", "impact_count")
FACT = _fields(
    "s_id string, centroid_lon double, centroid_lat double, date date, impact_count int"
)
STORED_FACT = _fields(
    "s_id string, centroid_lon double, centroid_lat double, date date, impact_count int, "
    "created_at timestamp, updated_at timestamp, month date"
)

COUNTERS = _fields("total bigint, processed bigint, filtered_out bigint, errors bigint")

# deliveries a stream has stored, and those that came after the watermark
DELIVERY_BY_DAY = _fields("trip_id string, seq bigint, dt string, batch string")
LATE_BY_DAY = _fields(_SENSOR_DDL + ", seq bigint, dt string, batch string")
FIRST_COUNTERS = _fields(
    "query string, number int, latest_day date, watermark date, messages bigint, "
    "stored bigint, known bigint, late bigint, undated bigint"
)

MART_POINTER = _fields("mart string, version string, n_rows bigint")

# what a micro-batch of counts came from
COUNT_LEDGER = _fields("source string, query string, number int, run bigint, rerun boolean, impacts bigint")

# one line of a message source: the payload is base64 text, the number orders redeliveries
ENVELOPE = _fields("seq bigint, data string")
