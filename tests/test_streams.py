from __future__ import annotations

import base64
import json

from bumpwise.operators.detect import detect_anomalies
from bumpwise.operators.facts import daily_segment_counts
from bumpwise.operators.ingest import parse_trips, readings
from bumpwise.options import ImpactRule
from bumpwise.schema import (
    ANOMALY_BY_DAY,
    COUNT_LEDGER,
    FIRST_COUNTERS,
    LATE_BY_DAY,
    MAPPED_BY_DAY,
    SENSOR_BY_DAY,
)
from bumpwise.session import remove_path
from bumpwise.sources.messages import message_stream, read_messages
from bumpwise.sinks.tables import append_to_fact, merge_into_fact
from bumpwise.sources.tables import deliveries_path, read_fact, read_latest, read_stream_anomalies
from bumpwise.streaming.first import counters_path, late_path, merge_late, stream_first_trips
from bumpwise.streaming.jobs import (
    first_deliveries,
    latest_counts,
    ledger_path,
    merge_counts,
    read_counts,
    stream_daily_counts,
    stream_detect,
    stream_ingest,
)

ONCE = {"availableNow": True}
RULE = ImpactRule(threshold=2.0)


def trip(name, n, day="2025-02-12", speed=60.0, lng=127.6):
    records = [
        {"ts": i, "acc": [0, 0, 40.0 if i == n - 1 else 0.1 * (i % 3)], "gyr": [0, 0.2 * (i % 2), 0],
         "spd": speed, "gps": {"lng": lng, "lat": 34.8, "hdop": 1.0, "sat": 8}}
        for i in range(n)
    ]
    return {"trip_id": name, "vin": "V", "start_time": f"{day}T08:00:00+09:00", "records": records}


def deliver(spark, folder, *messages):
    """One file per call, as a source would add them."""
    rows = [
        (seq, base64.b64encode((m if isinstance(m, str) else json.dumps(m)).encode()).decode())
        for seq, m in messages
    ]
    spark.createDataFrame(rows, "seq bigint, data string").coalesce(1).write.mode("append").json(folder)


def same(left, right):
    return content(left) == content(right)


def content(frame):
    return sorted(map(repr, frame.select(*sorted(frame.columns)).collect()))


def test_ingest_over_batches_with_redelivery_and_replay(spark, path_for):
    source, raw, counters = path_for("in"), path_for("raw"), path_for("counters")
    checkpoint = path_for("checkpoint")

    def run(checkpoint):
        stream = message_stream(spark, source, files_per_batch=1)
        stream_ingest(stream, raw, checkpoint, counters, trigger=ONCE).awaitTermination()

    deliver(spark, source, (1, trip("A", 5)), (2, "{bad"), (3, trip("far", 3, lng=126.9)))
    run(checkpoint)
    deliver(spark, source, (4, trip("A", 7, speed=70.0)), (5, trip("B", 4, day="2025-02-13")))
    deliver(spark, source, (6, trip("B", 4, day="2025-02-13")))
    run(checkpoint)

    latest = read_latest(spark, raw, SENSOR_BY_DAY)
    counts = {(r["dt"], r["trip_id"]): r["count"] for r in latest.groupBy("dt", "trip_id").count().collect()}
    assert counts == {("2025-02-12", "A"): 7, ("2025-02-13", "B"): 4}
    totals = spark.read.parquet(counters).selectExpr(
        "sum(total)", "sum(processed)", "sum(filtered_out)", "sum(errors)"
    ).first()
    assert tuple(totals) == (6, 4, 1, 1)

    # the whole source again under a new checkpoint: folders of its own, readers see the same
    before = content(latest)
    run(path_for("checkpoint"))
    assert content(read_latest(spark, raw, SENSOR_BY_DAY)) == before


def test_a_second_query_keeps_what_the_first_wrote(spark, path_for):
    raw, counters = path_for("raw"), path_for("counters")
    for name in ("A", "B"):
        source = path_for(f"in-{name}")
        deliver(spark, source, (1, trip(name, 5)))
        stream = message_stream(spark, source)
        stream_ingest(stream, raw, path_for("checkpoint"), counters, trigger=ONCE).awaitTermination()
    trips = read_latest(spark, raw, SENSOR_BY_DAY).select("trip_id").distinct().collect()
    assert sorted(row[0] for row in trips) == ["A", "B"]
    assert spark.read.parquet(counters).selectExpr("sum(total)").first()[0] == 2


def test_a_clean_redelivery_clears_old_anomalies(spark, path_for):
    source, anomalies, checkpoint = path_for("in"), path_for("anomalies"), path_for("checkpoint")
    calm = trip("A", 20)
    calm["records"] = calm["records"][:-1]
    for seq, message in ((1, trip("A", 20)), (2, calm)):
        deliver(spark, source, (seq, message))
        stream = message_stream(spark, source)
        stream_detect(stream, anomalies, checkpoint, RULE, trigger=ONCE).awaitTermination()
        assert read_stream_anomalies(spark, anomalies).count() == (1 if seq == 1 else 0)
    assert read_stream_anomalies(spark, anomalies, "2025-02-12").count() == 0
    assert read_stream_anomalies(spark, anomalies, "2025-02-13").count() == 0


def test_detection_reads_a_micro_batch_once(spark, path_for):
    """Also if it has the same trip twice; of these the last delivery is judged."""
    source, anomalies = path_for("in"), path_for("anomalies")
    calm = trip("A", 20)
    calm["records"] = calm["records"][:-1]
    deliver(spark, source, (1, trip("A", 20)), (2, calm), (3, trip("B", 20)), (4, trip("C", 20)), (5, trip("C", 20)))
    query = stream_detect(message_stream(spark, source), anomalies, path_for("checkpoint"), RULE, trigger=ONCE)
    query.awaitTermination()
    rows = read_stream_anomalies(spark, anomalies).select("trip_id").collect()
    assert sorted(row["trip_id"] for row in rows) == ["B", "C"]
    assert sum(progress["numInputRows"] for progress in query.recentProgress) == 5


def test_late_rows_and_bad_dates(spark, path_for):
    source, counts, table = path_for("in"), path_for("counts"), path_for("fact")
    parts = [[("2026-03-20", "A")], [("2026-03-13", "A"), ("20-03-2026", "A")], [("2026-03-13", "B")]]
    for number, part in enumerate(parts):
        rows = [(number, "T", 127.0, 34.0, s, d) for d, s in part]
        spark.createDataFrame(rows, MAPPED_BY_DAY).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(MAPPED_BY_DAY).parquet(source)
        stream_daily_counts(stream, counts, f"{source}-checkpoint", trigger=ONCE).awaitTermination()
        merge_counts(spark.read.parquet(counts), table)
    got = {(r["s_id"], str(r["date"])): r["impact_count"] for r in read_fact(spark, table).collect()}
    assert got == {("A", "2026-03-20"): 1, ("A", "2026-03-13"): 1, ("B", "2026-03-13"): 1}
    undated = spark.read.parquet(counts).filter("date IS NULL").selectExpr("sum(impact_count)")
    assert undated.first()[0] == 1

    # the source once more under a new checkpoint: its counts stand for the old ones
    stream = spark.readStream.schema(MAPPED_BY_DAY).parquet(source)
    stream_daily_counts(stream, counts, path_for("new"), trigger=ONCE).awaitTermination()
    assert latest_counts(spark.read.parquet(counts)).selectExpr("sum(impact_count)").first()[0] == 3


def test_replacing_a_day_can_empty_a_month(spark, path_for):
    table = path_for("fact")
    rows = spark.createDataFrame([("A", 127.0, 34.0, "2026-01-05", 2), ("A", 127.0, 34.0, "2026-02-05", 3)], "s_id string, centroid_lon double, centroid_lat double, date string, impact_count int")
    append_to_fact(rows.withColumn("date", rows["date"].cast("date")), table)
    none = read_fact(spark, table).filter("false").select("s_id", "centroid_lon", "centroid_lat", "date", "impact_count")
    merge_into_fact(none, table, mode="replace", days=["2026-01-05"])
    assert [str(r["date"]) for r in read_fact(spark, table).collect()] == ["2026-02-05"]


def test_stream_equals_batch(spark, path_for):
    source = path_for("in")
    deliver(spark, source, *((i, trip(f"T{i}", 8 + i)) for i in range(8)))
    deliver(spark, source, *((i, trip(f"T{i}", 8 + i, day="2025-02-13")) for i in range(8, 14)))
    raw, anomalies = path_for("raw"), path_for("anomalies")
    stream = message_stream(spark, source, files_per_batch=1)
    stream_ingest(stream, raw, path_for("c1"), trigger=ONCE).awaitTermination()
    stream_detect(stream, anomalies, path_for("c2"), RULE, trigger=ONCE).awaitTermination()

    rows = readings(parse_trips(read_messages(spark, source)))
    assert same(read_latest(spark, raw, SENSOR_BY_DAY), rows)
    found = read_latest(spark, anomalies, ANOMALY_BY_DAY)
    assert found.count() > 5
    assert same(found, detect_anomalies(rows, rule=RULE).select(*found.columns))


def test_running_counts_equal_batch_counts(spark, path_for):
    source, counts = path_for("in"), path_for("counts")
    days = [
        [("2026-03-01", "A", 5), ("2026-03-01", "A", 3), ("2026-03-02", "B", 1)],
        [("2026-03-02", "B", 0), ("2026-03-03", "A", 9), ("2026-03-01", "A", 1)],
        [("2026-03-03", "A", 2), ("2026-03-03", None, 2)],
    ]
    for number, day in enumerate(days):
        rows = [(t, f"T{number}", 127.0 + t, 34.0, s, d) for d, s, t in day]
        spark.createDataFrame(rows, MAPPED_BY_DAY).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(MAPPED_BY_DAY).parquet(source)
        stream_daily_counts(stream, counts, f"{source}-checkpoint", trigger=ONCE).awaitTermination()
    batch = daily_segment_counts(spark.read.schema(MAPPED_BY_DAY).parquet(source), date_from="dt")
    assert same(latest_counts(spark.read.parquet(counts)), batch)


def test_first_deliveries(spark, path_for):
    source, target, checkpoint = path_for("in"), path_for("first"), path_for("checkpoint")
    deliver(spark, source, (1, trip("A", 3)), (2, "{bad"), (3, trip("B", 4)))
    for later in ([], [(4, trip("A", 9)), (5, trip("C", 5))]):
        if later:
            deliver(spark, source, *later)
        stream = first_deliveries(message_stream(spark, source))
        query = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
        query.trigger(**ONCE).start(target).awaitTermination()
    rows = readings(spark.read.parquet(target)).groupBy("trip_id").count().collect()
    assert {row["trip_id"]: row["count"] for row in rows} == {"A": 3, "B": 4, "C": 5}


def impacts(spark, folder, *rows):
    """One file of mapped impacts (day, segment)."""
    table = [(n, "T", 127.0 + n, 34.0, s, d) for n, (d, s) in enumerate(rows)]
    spark.createDataFrame(table, MAPPED_BY_DAY).coalesce(1).write.mode("append").parquet(folder)


def count(spark, folder, counts, checkpoint, **options):
    stream = spark.readStream.schema(MAPPED_BY_DAY).parquet(folder)
    stream_daily_counts(stream, counts, checkpoint, trigger=ONCE, **options).awaitTermination()
    found = read_counts(spark, counts).collect()
    return {(r["s_id"], str(r["date"])): r["impact_count"] for r in found}


def test_sources_add_up_and_a_rerun_replaces_its_own(spark, path_for):
    a, b, counts = path_for("a"), path_for("b"), path_for("counts")
    impacts(spark, a, ("2026-03-01", "A"), ("2026-03-01", "A"), ("2026-03-01", "A"), ("2026-03-02", "B"))
    impacts(spark, b, ("2026-03-01", "A"), ("2026-03-01", "A"))
    first = path_for("first")
    assert count(spark, a, counts, first, source="a") == {("A", "2026-03-01"): 3, ("B", "2026-03-02"): 1}
    both = {("A", "2026-03-01"): 5, ("B", "2026-03-02"): 1}
    assert count(spark, b, counts, path_for("other"), source="b") == both
    # the first query goes on with its checkpoint
    impacts(spark, a, ("2026-03-01", "A"))
    more = both | {("A", "2026-03-01"): 6}
    assert count(spark, a, counts, first, source="a") == more
    # a full re-run of one source changes nothing, and leaves the other alone
    assert count(spark, a, counts, path_for("again"), source="a") == more


def test_a_query_that_goes_on_adds(spark, path_for):
    old, new, counts = path_for("old"), path_for("new"), path_for("counts")
    impacts(spark, old, ("2026-03-01", "A"), ("2026-03-01", "A"))
    impacts(spark, new, ("2026-03-01", "A"))
    count(spark, old, counts, path_for("c1"), source="a")
    assert count(spark, new, counts, path_for("c2"), source="a", rerun=False) == {("A", "2026-03-01"): 3}


def test_a_rerun_without_rows_empties_its_source(spark, path_for):
    full, none, counts, table = path_for("full"), path_for("none"), path_for("counts"), path_for("fact")
    impacts(spark, full, ("2026-03-01", "A"))
    count(spark, full, counts, path_for("c1"), source="a")
    merge_counts(spark.read.parquet(counts), table)
    assert read_fact(spark, table).count() == 1
    impacts(spark, none, ("2026-03-01", None))
    assert count(spark, none, counts, path_for("c2"), source="a") == {}
    ledger = spark.read.schema(COUNT_LEDGER).parquet(ledger_path(counts))
    merge_counts(spark.read.parquet(counts), table, ledger)
    assert read_fact(spark, table).count() == 0


def first_trips(spark, source, raw, checkpoint):
    stream = message_stream(spark, source, files_per_batch=1)
    stream_first_trips(stream, raw, checkpoint, 2, trigger=ONCE).awaitTermination()


def stored(spark, path):
    rows = spark.read.schema(LATE_BY_DAY).parquet(path).groupBy("dt", "trip_id", "seq").count().collect()
    return {(r["dt"], r["trip_id"], r["seq"]): r["count"] for r in rows}


def test_no_trip_is_lost_to_the_watermark(spark, path_for):
    source, raw, checkpoint = path_for("in"), path_for("raw"), path_for("checkpoint")
    deliver(spark, source, (1, trip("A", 3, day="2025-02-12")), (2, trip("A", 4, day="2025-02-12")), (3, "{bad"))
    deliver(spark, source, (4, trip("B", 4, day="2025-02-20")), (5, trip("A", 9, day="2025-02-12")))
    first_trips(spark, source, raw, checkpoint)
    deliver(
        spark, source, (6, trip("A", 5, day="2025-02-12")), (7, trip("C", 6, day="2025-02-17")),
        (8, trip("D", 7, day="2025-02-18")), (9, trip("B", 8, day="2025-02-20")), (10, trip("E", 3, day="20-02-2025")),
        (11, trip("C", 2, day="2025-02-17")),
    )
    first_trips(spark, source, raw, checkpoint)
    in_time = {("2025-02-12", "A", 1): 3, ("2025-02-20", "B", 4): 4, ("2025-02-18", "D", 8): 7}
    assert stored(spark, raw) == in_time
    late = {("2025-02-12", "A", 6): 5, ("2025-02-17", "C", 7): 6, ("20-02-2025", "E", 10): 3, ("2025-02-17", "C", 11): 2}
    assert stored(spark, late_path(raw)) == late
    totals = spark.read.schema(FIRST_COUNTERS).parquet(counters_path(raw)).selectExpr(
        "sum(messages)", "sum(stored)", "sum(known)", "sum(late)", "sum(undated)"
    ).first()
    # A's second delivery in one batch and later ones, and B's, are known; the bad message is in none
    assert tuple(totals) == (11, 3, 3, 3, 1)

    assert merge_late(spark, raw) == {"new": 2, "known": 1}
    whole = in_time | {("2025-02-17", "C", 7): 6, ("20-02-2025", "E", 10): 3}
    assert stored(spark, raw) == whole
    assert merge_late(spark, raw) == {"new": 0, "known": 3}
    assert stored(spark, raw) == whole
    assert read_latest(spark, raw, SENSOR_BY_DAY).count() == sum(whole.values())

    # the whole source again under a new checkpoint: every trip is known, or late
    first_trips(spark, source, raw, path_for("checkpoint"))
    merge_late(spark, raw)
    assert stored(spark, raw) == whole


def test_a_merge_that_broke_off_runs_again(spark, path_for):
    source, raw, checkpoint = path_for("in"), path_for("raw"), path_for("checkpoint")
    deliver(spark, source, (1, trip("A", 3, day="2025-02-20")))
    first_trips(spark, source, raw, checkpoint)
    deliver(spark, source, (2, trip("B", 4, day="2025-02-01")))
    first_trips(spark, source, raw, checkpoint)
    merge_late(spark, raw)
    whole = stored(spark, raw)
    # as if the merge had ended before it noted its deliveries
    remove_path(spark, f"{deliveries_path(raw)}/dt=2025-02-01/batch=late-1")
    assert merge_late(spark, raw) == {"new": 1, "known": 0}
    assert stored(spark, raw) == whole


def test_an_empty_stream_of_first_trips(spark, path_for):
    source, raw = path_for("in"), path_for("raw")
    deliver(spark, source, (1, "{bad"))
    first_trips(spark, source, raw, path_for("checkpoint"))
    assert merge_late(spark, raw) == {"new": 0, "known": 0}
    assert spark.read.schema(FIRST_COUNTERS).parquet(counters_path(raw)).first()["messages"] == 1
