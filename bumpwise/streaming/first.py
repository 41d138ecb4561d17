"""First deliveries as a stream that loses no trip.

A micro-batch is split by the watermark. Trips of days within the last `delay_days` are stored as
first delivered; whether a trip is known is looked up in the table of stored deliveries, whose days
beyond the watermark are not read. Trips of earlier days, or without a readable day, cannot be
looked up cheaply; they go to a side table, and `merge_late` brings those that are really new into
the table. Both ways are counted per micro-batch.

The watermark of a micro-batch is the latest day of the micro-batches before it in the same query,
less the delay. It is read from their counters, so a micro-batch that runs again splits alike. A
query with a new checkpoint starts without a watermark; what an earlier query stored is known to it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bumpwise.operators.ingest import PROCESSED, parse_trips, readings
from bumpwise.operators.keyed import attach_by_key
from bumpwise.options import DEFAULT_BOXES, Box, Ranges
from bumpwise.schema import DELIVERY_BY_DAY, FIRST_COUNTERS, LATE_BY_DAY, SENSOR_COLUMNS
from bumpwise.session import remove_path, store, work_path
from bumpwise.sinks.tables import write_batch
from bumpwise.sources.tables import deliveries_path, read_if_there
from bumpwise.streaming.jobs import start_named

_KEYS = ("dt", "trip_id")
FIRST, LATE, UNDATED = "first", "late", "undated"


def late_path(path: str) -> str:
    """The side table of the trips that came too late for the table at `path`."""
    return f"{path.rstrip('/')}-late"


def counters_path(path: str) -> str:
    return f"{path.rstrip('/')}-first"


def stream_first_trips(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    delay_days: int = 2,
    ranges: Ranges = Ranges(),
    boxes: Iterable[Box] = DEFAULT_BOXES,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Messages (`seq`, `value`) into the raw table at `path`, each trip as first delivered.

    A row per micro-batch in `counters_path`: trips stored, known already, late and undated, and
    messages that were not processed.
    """

    def write(batch: DataFrame, name: str) -> None:
        spark = batch.sparkSession
        query, _, number = name.rpartition("-")
        limit = _watermark(spark, path, query, int(number), delay_days)
        seen = Observation()
        parsed = parse_trips(batch, ranges, boxes).observe(seen, F.count(F.lit(1)).alias("messages"))
        day = F.col("dt").try_cast("date")
        route = F.when(day.isNull(), UNDATED).when(day < F.lit(limit).cast("date"), LATE).otherwise(FIRST)
        held = work_path(spark, "trips")
        processed = parsed.filter(F.col("outcome") == PROCESSED).withColumns({"route": route, "day": day})
        processed.write.parquet(held)
        trips = spark.read.schema(processed.schema).parquet(held)
        beyond = trips.filter(F.col("route") != FIRST)
        write_batch(readings(beyond, carry=["seq"]), late_path(path), (*SENSOR_COLUMNS, "seq"), name)
        new, n_new = store(_unknown(spark, trips.filter(F.col("route") == FIRST), path, limit, name), "first-trips")
        write_batch(readings(new, carry=["seq"]), path, (*SENSOR_COLUMNS, "seq"), name)
        write_batch(new.select(*_KEYS, "seq"), deliveries_path(path), ("trip_id", "seq"), name)
        counts = {row["route"]: row["count"] for row in trips.groupBy("route").count().collect()}
        latest = trips.agg(F.max("day")).first()[0]
        in_time = counts.get(FIRST, 0)
        row = (
            query, int(number), latest, limit, seen.get["messages"] or 0, n_new, in_time - n_new,
            counts.get(LATE, 0), counts.get(UNDATED, 0),
        )
        spark.createDataFrame([row], FIRST_COUNTERS).write.mode("overwrite").parquet(
            f"{counters_path(path)}/batch={name}"
        )
        remove_path(spark, held)

    return start_named(messages, write, checkpoint, trigger)


def _watermark(spark: SparkSession, path: str, query: str, number: int, delay_days: int) -> dt.date | None:
    counters = read_if_there(spark, counters_path(path), FIRST_COUNTERS)
    before = counters.filter((F.col("query") == query) & (F.col("number") < number))
    latest = before.agg(F.max("latest_day")).first()[0]
    return latest and latest - dt.timedelta(days=delay_days)


def _unknown(spark: SparkSession, trips: DataFrame, path: str, limit: dt.date | None, name: str) -> DataFrame:
    """Of each trip that no other micro-batch has stored, the first delivery."""
    known = read_if_there(spark, deliveries_path(path), DELIVERY_BY_DAY).filter(F.col("batch") != name)
    if limit is not None:
        known = known.filter(F.col("dt") >= str(limit))
    trips = trips.drop("day", "route")
    firsts = trips.groupBy(*_KEYS).agg(F.min("seq").alias("seq"))
    # days are readable here; a null id is an id like any other
    new = firsts.alias("f").join(known.alias("k"), _same("f", "k"), "left_anti")
    same = _same("t", "n") & (F.col("t.seq") == F.col("n.seq"))
    return trips.alias("t").join(new.alias("n"), same, "left_semi")


def _same(left: str, right: str):
    return F.col(f"{left}.dt").eqNullSafe(F.col(f"{right}.dt")) & F.col(f"{left}.trip_id").eqNullSafe(
        F.col(f"{right}.trip_id")
    )


def merge_late(spark: SparkSession, path: str) -> dict[str, int]:
    """Late trips that the table at `path` does not have into it; returns how many were new or known.

    The deliveries are noted last, so a merge that broke off runs again under the same name and
    replaces what it wrote. Running it again adds nothing.
    """
    known = read_if_there(spark, deliveries_path(path), DELIVERY_BY_DAY)
    rows = read_if_there(spark, late_path(path), LATE_BY_DAY)
    # a delivery may have been stored by two queries: one copy of it counts
    delivery = F.struct("seq", "batch")
    of_trip = rows.groupBy(*_KEYS).agg(F.min(delivery).alias("_first"), F.count(F.lit(1)).alias("_rows"))
    of_trip, n_late = store(of_trip, "late-trips")
    new, n_new = store(of_trip.alias("f").join(known.alias("k"), _same("f", "k"), "left_anti"), "late-new")
    if n_new:
        merges = known.filter(F.col("batch").startswith(f"{LATE}-"))
        last = merges.agg(F.max(F.substring_index("batch", "-", -1).cast("int"))).first()[0]
        name = f"{LATE}-{(last or 0) + 1}"
        found = attach_by_key(rows, new, list(_KEYS), "_rows", how="inner")
        chosen = found.filter(delivery.eqNullSafe(F.col("_first")))
        write_batch(chosen, path, (*SENSOR_COLUMNS, "seq"), name)
        noted = new.select(*_KEYS, F.col("_first.seq").alias("seq"))
        write_batch(noted, deliveries_path(path), ("trip_id", "seq"), name)
    return {"new": n_new, "known": n_late - n_new}
