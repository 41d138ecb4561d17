"""The jobs as Structured Streaming queries.

Each writes through `foreachBatch` into batch folders named by the query and the micro-batch. A
query's id lives in its checkpoint: a micro-batch that runs again after a failure replaces its own
output, and a query with a checkpoint of its own never touches the folders of another one.
Statistics of a trip need no state: a trip arrives whole in one message.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bumpwise.operators.detect import DAY_TRIP, detect_anomalies, suspect_trips
from bumpwise.operators.ingest import (
    PROCESSED,
    outcome_counts,
    parse_trips,
    readings,
)
from bumpwise.operators.keyed import attach_by_key
from bumpwise.options import DEFAULT_BOXES, Box, ContextLimits, ImpactRule, Ranges
from bumpwise.schema import ANOMALY_COLUMNS, COUNT_LEDGER, COUNTERS
from bumpwise.session import remove_path, store, work_path
from bumpwise.sinks.tables import merge_into_fact, write_batch, write_raw
from bumpwise.sources.tables import deliveries_path


def stream_ingest(
    messages: DataFrame,
    raw_path: str,
    checkpoint: str,
    counters_path: str | None = None,
    ranges: Ranges = Ranges(),
    boxes: Iterable[Box] = DEFAULT_BOXES,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Messages (`seq`, `value`) into the raw table, with outcome counters per micro-batch."""

    def ingest(batch: DataFrame, name: str) -> None:
        # counted on the way to the table, so a message is parsed once
        counted = Observation()
        trips = parse_trips(batch, ranges, boxes).observe(counted, *outcome_counts())
        write_raw(trips, raw_path, name)
        if counters_path:
            counters = batch.sparkSession.createDataFrame([counted.get], COUNTERS)
            counters.write.mode("overwrite").parquet(f"{counters_path}/batch={name}")

    return start_named(messages, ingest, checkpoint, trigger)


def first_deliveries(
    messages: DataFrame,
    delay: str = "2 days",
    ranges: Ranges = Ranges(),
    boxes: Iterable[Box] = DEFAULT_BOXES,
) -> DataFrame:
    """Processed trips of a message stream, each only as first delivered.

    The other way to treat redeliveries: nothing is replaced later, at the price of state for
    the trips of the last `delay` (`stream_first_trips` keeps none and loses no trip). Trips whose `dt` is no date, and trips that arrive later than
    `delay`, cannot be told from redeliveries and are left to the raw table and its readers; the
    query's progress shows how many, as `unreadable_dates` of the observed metrics
    `first_deliveries` and as rows dropped by the watermark.
    """
    trips = parse_trips(messages, ranges, boxes).filter(F.col("outcome") == PROCESSED)
    dated = trips.withColumn("day", F.col("dt").try_cast("timestamp"))
    return (
        dated.observe("first_deliveries", F.count_if(F.col("day").isNull()).alias("unreadable_dates"))
        .filter(F.col("day").isNotNull())
        .withWatermark("day", delay)
        .dropDuplicatesWithinWatermark(["dt", "trip_id"])
        .drop("day")
    )


def stream_detect(
    messages: DataFrame,
    anomaly_path: str,
    checkpoint: str,
    rule: ImpactRule = ImpactRule(),
    limits: ContextLimits = ContextLimits(),
    ranges: Ranges = Ranges(),
    boxes: Iterable[Box] = DEFAULT_BOXES,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Messages into anomalies, judged by the batch operator on each micro-batch.

    The key and number of every processed delivery is written beside the anomalies, so that a trip
    delivered again without any anomaly clears those of its earlier deliveries
    (`read_stream_anomalies`).
    """

    def judge(batch: DataFrame, name: str) -> None:
        spark = batch.sparkSession
        # parsed once; what follows reads the columns it needs from the shared folder
        held = work_path(spark, "readings")
        parsed = readings(parse_trips(batch, ranges, boxes), carry=["seq"])
        parsed.write.parquet(held)
        rows = spark.read.schema(parsed.schema).parquet(held)
        deliveries = rows.groupBy("dt", "trip_id").agg(F.min("seq").alias("_first"), F.max("seq").alias("seq"), F.count(F.lit(1)).alias("_rows"))
        deliveries, _ = store(deliveries.filter("seq IS NOT NULL"), "deliveries")
        repeated, n_repeated = store(deliveries.filter("_first < seq").select("dt", "trip_id", F.col("seq").alias("_last"), "_rows"), "repeated")
        latest = rows.filter("seq IS NOT NULL")
        if n_repeated:
            latest = attach_by_key(latest, repeated, DAY_TRIP, "_rows").filter("_last IS NULL OR seq = _last").select(*rows.columns)
        write_batch(deliveries, deliveries_path(anomaly_path), ("trip_id", "seq"), name)
        suspects, _ = store(suspect_trips(latest, DAY_TRIP, rule, limits), "suspects")
        anomalies = detect_anomalies(latest, DAY_TRIP, rule, limits, suspects)
        write_batch(anomalies, anomaly_path, (*ANOMALY_COLUMNS, "seq"), name)
        remove_path(spark, held)

    return start_named(messages, judge, checkpoint, trigger)


def ledger_path(counts_path: str) -> str:
    """Where the micro-batches of the counts at `counts_path` are noted."""
    return f"{counts_path.rstrip('/')}-ledger"


def stream_daily_counts(
    mapped: DataFrame,
    counts_path: str,
    checkpoint: str,
    trigger: dict | None = None,
    source: str = "",
    rerun: bool = True,
) -> StreamingQuery:
    """Mapped impacts (`s_id`, `dt`, place and time) into counts per segment and day.

    Each micro-batch writes what it adds (`read_counts` sums it up), so a row counts however late
    it comes, and no state grows with the days. Rows whose `dt` is no date are kept as a count
    without a day.

    `source` names what is counted; several may share a folder and add up. A query with a new
    checkpoint reads its source from the start, so it stands for the source's earlier queries; with
    `rerun=False` it goes on where they ended, and adds to them. A ledger notes source, query and
    number of every micro-batch, also of those without rows.
    """
    run = time.time_ns()

    def count(batch: DataFrame, name: str) -> None:
        query, _, number = name.rpartition("-")
        counted = Observation()
        first = F.min(F.struct("timestamp", "trip_id", "lon", "lat")).alias("first")
        counts = (
            batch.filter(F.col("s_id").isNotNull())
            .groupBy("s_id", F.col("dt").try_cast("date").alias("date"))
            .agg(F.count(F.lit(1)).cast("int").alias("impact_count"), first)
        )
        marks = {"run": run, "query": query, "source": source, "rerun": rerun}
        counts.withColumns({key: F.lit(value) for key, value in marks.items()}).observe(
            counted, F.sum("impact_count").alias("n")
        ).write.mode("overwrite").parquet(f"{counts_path}/batch={name}")
        noted = [(source, query, int(number), run, rerun, counted.get["n"] or 0)]
        batch.sparkSession.createDataFrame(noted, COUNT_LEDGER).write.mode("overwrite").parquet(
            f"{ledger_path(counts_path)}/batch={name}"
        )

    return start_named(mapped, count, checkpoint, trigger)


def live_queries(ledger: DataFrame) -> DataFrame:
    """`query`, `n`: the queries whose counts stand, with the micro-batches they have.

    A query is dated by its first start, so one that stopped and went on is one query. Of a source,
    the last re-run counts and what was started after it.
    """
    queries = ledger.groupBy("source", "query").agg(
        F.min("run").alias("started"), F.bool_or("rerun").alias("rerun"), F.count(F.lit(1)).alias("n")
    )
    opened = queries.filter("rerun").groupBy(F.col("source").alias("_source")).agg(F.max("started").alias("_opened"))
    joined = queries.join(opened, F.col("source") == F.col("_source"), "left")
    return joined.filter(F.col("_opened").isNull() | (F.col("started") >= F.col("_opened"))).select("query", "n")


def latest_counts(updates: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """Counts per segment and day from the additions that `stream_daily_counts` wrote.

    Without a ledger, the queries are those that have rows in `updates`.
    """
    live = live_queries(updates if ledger is None else ledger)
    # a few queries hold all rows
    counted = attach_by_key(updates, live, ["query"], "n", how="inner")
    return (
        counted.filter(F.col("date").isNotNull())
        .groupBy("s_id", "date")
        .agg(F.sum("impact_count").cast("int").alias("impact_count"), F.min("first").alias("first"))
        .select(
            "s_id",
            F.col("first.lon").alias("centroid_lon"),
            F.col("first.lat").alias("centroid_lat"),
            "date",
            "impact_count",
        )
    )


def read_counts(spark: SparkSession, counts_path: str) -> DataFrame:
    """The counts of all sources in a folder, as they stand."""
    ledger = spark.read.schema(COUNT_LEDGER).parquet(ledger_path(counts_path))
    return latest_counts(spark.read.parquet(counts_path), ledger)


def merge_counts(updates: DataFrame, fact_path: str, ledger: DataFrame | None = None) -> None:
    """The streamed counts into the stored facts: the days they have are replaced as a whole.

    Days that only superseded queries have are replaced too, and so emptied. Running it again, or
    after late rows came, gives the facts of all rows so far.
    """
    days = [row["date"] for row in updates.select("date").distinct().collect() if row["date"]]
    merge_into_fact(latest_counts(updates, ledger), fact_path, mode="replace", days=sorted(days))


def start_named(
    stream: DataFrame,
    store: Callable[[DataFrame, str], None],
    checkpoint: str,
    trigger: dict | None,
) -> StreamingQuery:
    """Start a query that passes each micro-batch to `store` with its name."""
    query_id: list[str] = []
    known = threading.Event()

    def named(batch: DataFrame, number: int) -> None:
        known.wait()  # the id is there once `start` has returned
        store(batch, f"{query_id[0]}-{number}")

    writer = stream.writeStream.foreachBatch(named).option("checkpointLocation", checkpoint)
    query = writer.trigger(**(trigger or {"processingTime": "10 seconds"})).start()
    query_id.append(query.id)
    known.set()
    return query
