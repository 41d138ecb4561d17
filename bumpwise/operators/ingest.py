"""Trip messages (one JSON text per trip) to sensor readings.

Everything happens inside the message's own row: the records are an array that is built, checked
and filtered with array functions, so outcomes and counters need no grouping and a message is
only turned into rows (`readings`) once it is known to be kept.

Reading a value out of a variant costs some microseconds, so the records of a message that has every
key of every record, with plain JSON numbers, are read by a schema (`_quick_records`); any other
message is read key by key. Both ways give the same readings.

Read differently from a lenient JSON reader: texts with duplicate keys or with the bare words NaN
and Infinity are malformed, and a text in place of an array is not indexed by character.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bumpwise.functions.predicates import in_any_box, valid_reading
from bumpwise.options import DEFAULT_BOXES, Box, MissingDefaults, Ranges
from bumpwise.schema import SENSOR_COLUMNS

ERRORS, FILTERED_OUT, PROCESSED = "errors", "filtered_out", "processed"

_NUMBERS = ("BIGINT", "DOUBLE", "FLOAT")
_INT_MIN, _INT_MAX = -(2**31), 2**31 - 1
_BROKEN = "_broken"
_QUICK = (
    "records array<struct<ts: bigint, acc: array<double>, gyr: array<double>, spd: double, "
    f"gps: struct<lng: double, lat: double, hdop: double, sat: bigint>>>, {_BROKEN} string"
)
_STRICT = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": _BROKEN,
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}


def decode_payload(envelopes: DataFrame, column: str = "data") -> DataFrame:
    """Base64 payloads to JSON text in `value`; NULL where base64 or UTF-8 is broken."""
    text = F.try_validate_utf8(F.try_to_binary(F.col(column), F.lit("base64")).cast("string"))
    return envelopes.withColumn("value", text).drop(column)


def parse_trips(
    messages: DataFrame,
    ranges: Ranges = Ranges(),
    boxes: Iterable[Box] = DEFAULT_BOXES,
    defaults: MissingDefaults = MissingDefaults(),
) -> DataFrame:
    """Messages (`value`) to trips: `trip_id`, `vehicle_id`, `dt`, `n_valid`, `kept`, `outcome`.

    `kept` holds the valid readings inside a box. The outcome is `errors` for malformed text, a
    missing header key, no valid reading, or a kept reading that does not fit the table
    (`timestamp` not a number, `satellites` beyond int); `filtered_out` if no valid reading lies
    in a box; else `processed`. `dt` is the date as written in `start_time`, in its own zone.
    The other columns of `messages` are kept.
    """
    passed = [name for name in messages.columns if name != "value"]
    doc = F.col("_doc")
    # made once per message; a text that is no JSON has no document and is not read again
    made = messages.withColumn("_doc", F.try_parse_json("value")).withColumn(
        "_quick", F.when(doc.isNotNull(), F.from_json("value", _QUICK, _STRICT))
    )
    slow = F.transform(
        F.try_variant_get(doc, "$.records", "array<variant>"), lambda record: _reading(record, defaults)
    )
    parsed = made.select(
        *passed,
        F.try_variant_get(doc, "$.trip_id", "string").alias("trip_id"),
        F.try_variant_get(doc, "$.vin", "string").alias("vehicle_id"),
        F.substring(F.try_variant_get(doc, "$.start_time", "string"), 1, 10).alias("dt"),
        _kind(doc, "$.trip_id").alias("_trip_kind"),
        _kind(doc, "$.vin").alias("_vehicle_kind"),
        _kind(doc, "$.start_time").alias("_start_kind"),
        F.when(_is_quick(F.col("_quick")), _quick_records(F.col("_quick"))).otherwise(slow).alias("_all"),
    )
    valid = parsed.withColumn("_valid", F.filter("_all", lambda r: _is_valid(r, ranges)))
    kept = valid.withColumn(
        "_kept", F.filter("_valid", lambda r: in_any_box(boxes, r.__getitem__))
    )
    readable = (
        F.col("_trip_kind").isNotNull()
        & F.col("_vehicle_kind").isNotNull()
        & (F.col("_start_kind") == "STRING")
    )
    storable = F.col("_trip_kind").isin("STRING", "VOID") & F.col("_vehicle_kind").isin(
        "STRING", "VOID"
    )
    n_valid = F.greatest(F.size("_valid"), F.lit(0))
    outcome = (
        F.when(~F.coalesce(readable, F.lit(False)), ERRORS)
        .when(n_valid == 0, ERRORS)
        .when(F.size("_kept") == 0, FILTERED_OUT)
        .when(~storable | F.exists("_kept", lambda r: ~_is_storable(r)), ERRORS)
        .otherwise(PROCESSED)
    )
    trip = F.struct(
        "trip_id", "vehicle_id", "dt",
        n_valid.alias("n_valid"), F.col("_kept").alias("kept"), outcome.alias("outcome"),
    )
    # a generator is not moved across, so a later filter on the outcome does not parse again
    return kept.select(*passed, F.inline(F.array(trip)))


def readings(trips: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """The rows of the processed trips: `SENSOR_COLUMNS`, `dt`, and the `carry` columns."""
    rows = trips.filter(F.col("outcome") == PROCESSED).select(
        "trip_id", "vehicle_id", "dt", *carry, F.inline("kept")
    )
    return rows.withColumn("satellites", F.col("satellites").cast("int")).select(
        *SENSOR_COLUMNS, "dt", *carry
    )


def ingest_counters(trips: DataFrame) -> DataFrame:
    """One row: messages in total and by outcome."""
    return trips.agg(*outcome_counts())


def outcome_counts() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total"),
        *(
            F.count_if(F.col("outcome") == outcome).alias(outcome)
            for outcome in (PROCESSED, FILTERED_OUT, ERRORS)
        ),
    ]


def latest_deliveries(trips: DataFrame, order: str = "seq") -> DataFrame:
    """Of the processed trips sent more than once (same day and id), the last by `order`.

    `order` must be unique. The winners are found on the keys alone and matched on all three
    columns, so the copies of one trip spread over the shuffle.
    """
    processed = trips.filter(F.col("outcome") == PROCESSED)
    winners = processed.groupBy("dt", "trip_id").agg(F.max(order).alias("_last"))
    winners = winners.select(
        F.col("dt").alias("_dt"), F.col("trip_id").alias("_trip"), "_last"
    )
    same = (
        F.col("dt").eqNullSafe(F.col("_dt"))
        & F.col("trip_id").eqNullSafe(F.col("_trip"))
        & (F.col(order) == F.col("_last"))
    )
    return processed.join(winners, same, "left_semi")


def _kind(document: Column, path: str) -> Column:
    """Type name of the value at a path: NULL if absent, VOID if JSON null."""
    return F.schema_of_variant(F.try_variant_get(document, path, "variant"))


def _reading(record: Column, defaults: MissingDefaults) -> Column:
    """A record's fields, NULL where they cannot be read, and the kind of its time."""

    def number(path: str) -> Column:
        return F.try_variant_get(record, path, "double")

    def optional(path: str, kind: str, default: float) -> Column:
        absent = F.try_variant_get(record, path, "variant").isNull()
        return F.coalesce(
            F.try_variant_get(record, path, kind), F.when(absent, F.lit(default).cast(kind))
        )

    fields = {
        "timestamp": F.try_variant_get(record, "$.ts", "bigint"),
        "accel_x": number("$.acc[0]"),
        "accel_y": number("$.acc[1]"),
        "accel_z": number("$.acc[2]"),
        "gyro_x": number("$.gyr[0]"),
        "gyro_y": number("$.gyr[1]"),
        "gyro_z": number("$.gyr[2]"),
        "velocity": optional("$.spd", "double", defaults.speed),
        "lon": number("$.gps.lng"),
        "lat": number("$.gps.lat"),
        "hdop": optional("$.gps.hdop", "double", defaults.hdop),
        "satellites": optional("$.gps.sat", "bigint", defaults.satellites),
        "time_kind": _kind(record, "$.ts"),
    }
    return F.struct(*(value.alias(name) for name, value in fields.items()))


def _is_quick(quick: Column) -> Column:
    """Whether all records were read as they are: nothing broken, absent, null or of another type."""

    def whole(record: Column) -> Column:
        gps = record["gps"]
        single = (record["ts"], record["spd"], gps["lng"], gps["lat"], gps["hdop"], gps["sat"])
        axes = [F.get(record[name], F.lit(at)) for name in ("acc", "gyr") for at in range(3)]
        return reduce(Column.__and__, (value.isNotNull() for value in (*single, *axes)))

    broken = quick[_BROKEN].isNotNull()
    return F.coalesce(~broken & F.forall(quick["records"], whole), F.lit(False))


def _quick_records(quick: Column) -> Column:
    """As `_reading`, of records that are whole; an integer time is of the kind BIGINT."""

    def reading(record: Column) -> Column:
        gps = record["gps"]
        # a decimal has no negative zero
        number = lambda value: value + F.lit(0.0)
        axis = lambda name, at: number(F.get(record[name], F.lit(at)))
        fields = {
            "timestamp": record["ts"],
            "accel_x": axis("acc", 0),
            "accel_y": axis("acc", 1),
            "accel_z": axis("acc", 2),
            "gyro_x": axis("gyr", 0),
            "gyro_y": axis("gyr", 1),
            "gyro_z": axis("gyr", 2),
            "velocity": number(record["spd"]),
            "lon": number(gps["lng"]),
            "lat": number(gps["lat"]),
            "hdop": number(gps["hdop"]),
            "satellites": gps["sat"],
            "time_kind": F.lit("BIGINT"),
        }
        return F.struct(*(value.alias(name) for name, value in fields.items()))

    return F.transform(quick["records"], reading)


def _is_valid(reading: Column, ranges: Ranges) -> Column:
    """Every field is there, and those with a range are in it."""
    return (
        valid_reading(ranges, reading.__getitem__)
        & reading["hdop"].isNotNull()
        & reading["satellites"].isNotNull()
        & reading["time_kind"].isNotNull()
    )


def _is_storable(reading: Column) -> Column:
    """Time is a number or JSON null, and satellites fit an int."""
    kind = reading["time_kind"]
    number = kind.isin(*_NUMBERS) | kind.startswith("DECIMAL")
    timed = (kind == "VOID") | (number & reading["timestamp"].isNotNull())
    return timed & reading["satellites"].between(_INT_MIN, _INT_MAX)
