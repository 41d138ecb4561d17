from __future__ import annotations

import base64
import copy
import json
import random

import pytest
from pyspark.sql import functions as F

from bumpwise.operators import ingest
from bumpwise.operators.ingest import (
    decode_payload,
    ingest_counters,
    latest_deliveries,
    parse_trips,
    readings,
)
from bumpwise.schema import SENSOR_BY_DAY
from bumpwise.sinks.tables import write_raw
from bumpwise.sources.tables import read_latest

RECORD = {
    "ts": 1000, "acc": [0, 0, 9.8], "gyr": [0, 0, 0], "spd": 60,
    "gps": {"lng": 127.6, "lat": 34.8, "hdop": 1.0, "sat": 8},
}
HEADER = {"trip_id": "T", "vin": "V", "start_time": "2025-02-12T00:10:00+09:00"}
ABSENT = object()
PROCESSED, FILTERED, ERRORS = "processed", "filtered_out", "errors"


def record(**changes) -> dict:
    changed = copy.deepcopy(RECORD)
    for key, value in changes.items():
        holder = changed
        if key in ("lng", "lat", "hdop", "sat"):
            holder = changed["gps"]
        if value is ABSENT:
            del holder[key]
        else:
            holder[key] = value
    return changed


def message(*records, **header) -> str:
    content = HEADER | {"records": list(records)} | header
    return json.dumps({k: v for k, v in content.items() if v is not ABSENT})


GOOD = record()
OUTSIDE = record(lng=126.9, lat=37.55)

# name -> (text, rows, outcome)
CASES = {
    "plain": (message(GOOD), 1, PROCESSED),
    "malformed": ("{bad", 0, ERRORS),
    "no text": (None, 0, ERRORS),
    "no vin": (message(GOOD, vin=ABSENT), 0, ERRORS),
    "no trip": (message(GOOD, trip_id=ABSENT), 0, ERRORS),
    "no start": (message(GOOD, start_time=ABSENT), 0, ERRORS),
    "null start": (message(GOOD, start_time=None), 0, ERRORS),
    "null vin": (message(GOOD, vin=None), 1, PROCESSED),
    "numeric trip": (message(GOOD, trip_id=5), 0, ERRORS),
    "records absent": (message(records=ABSENT), 0, ERRORS),
    "records empty": (message(), 0, ERRORS),
    "records null": (message(records=None), 0, ERRORS),
    "records object": (message(records={"a": 1}), 0, ERRORS),
    "record no object": (message("x", None, 3, GOOD), 1, PROCESSED),
    "speed absent": (message(record(spd=ABSENT)), 1, PROCESSED),
    "speed null": (message(record(spd=None)), 0, ERRORS),
    "hdop sat absent": (message(record(hdop=ABSENT, sat=ABSENT)), 1, PROCESSED),
    "hdop null": (message(record(hdop=None)), 0, ERRORS),
    "speed text": (message(record(spd="60.5")), 1, PROCESSED),
    "speed true": (message(record(spd=True)), 1, PROCESSED),
    "speed word": (message(record(spd="fast")), 0, ERRORS),
    "sat 7.9": (message(record(sat=7.9)), 1, PROCESSED),
    "sat '7'": (message(record(sat="7")), 1, PROCESSED),
    "sat '7.9'": (message(record(sat="7.9")), 0, ERRORS),
    "sat beyond int": (message(record(sat=3_000_000_000)), 0, ERRORS),
    "acc short": (message(record(acc=[0, 0])), 0, ERRORS),
    "acc long": (message(record(acc=[0, 0, 9.8, 5])), 1, PROCESSED),
    "lng absent": (message(record(lng=ABSENT)), 0, ERRORS),
    "gps absent": (message(record(gps=ABSENT)), 0, ERRORS),
    "acc 100": (message(record(acc=[0, 0, 100.0])), 1, PROCESSED),
    "acc 100.1": (message(record(acc=[0, 0, 100.1])), 0, ERRORS),
    "gyr 2000": (message(record(gyr=[0, 2000, 0])), 1, PROCESSED),
    "gyr 2000.1": (message(record(gyr=[0, 2000.1, 0])), 0, ERRORS),
    "speed 300": (message(record(spd=300)), 1, PROCESSED),
    "speed -0.1": (message(record(spd=-0.1)), 0, ERRORS),
    "corner low": (message(record(lng=127.52, lat=34.50)), 1, PROCESSED),
    "corner high": (message(record(lng=127.78, lat=35.07)), 1, PROCESSED),
    "outside": (message(OUTSIDE), 0, FILTERED),
    "invalid lng": (message(record(lng=140)), 0, ERRORS),
    "outside and in": (message(OUTSIDE, GOOD), 1, PROCESSED),
    "ts text": (message(record(ts="1000")), 0, ERRORS),
    "ts bool": (message(record(ts=True)), 0, ERRORS),
    "ts text outside": (message(record(ts="1000", lng=126.9, lat=37.55), GOOD), 1, PROCESSED),
    "ts text and good": (message(record(ts="1000"), GOOD), 0, ERRORS),
    "ts null": (message(record(ts=None)), 1, PROCESSED),
    "ts absent": (message(record(ts=ABSENT)), 0, ERRORS),
    "ts 1.5": (message(record(ts=1.5)), 1, PROCESSED),
}


@pytest.fixture(scope="module")
def trips(spark):
    rows = [(number, name, text) for number, (name, (text, _, _)) in enumerate(CASES.items())]
    return parse_trips(spark.createDataFrame(rows, "seq bigint, name string, value string"))


def test_outcomes_and_row_counts(trips):
    got = {row["name"]: row["outcome"] for row in trips.collect()}
    assert got == {name: outcome for name, (_, _, outcome) in CASES.items()}
    counts = {row["name"]: row["count"] for row in readings(trips, ["name"]).groupBy("name").count().collect()}
    assert counts == {name: rows for name, (_, rows, _) in CASES.items() if rows}


def test_only_whole_records_of_plain_numbers_are_read_by_schema(spark):
    rows = [(name, text) for name, (text, _, _) in CASES.items() if text and name != "malformed"]
    rows += [("empty", message()), ("quotes", message(GOOD).replace('"', "'")), ("nan", message(record(spd=float("nan"))))]
    frame = spark.createDataFrame(rows, "name string, value string")
    read = frame.withColumn("quick", F.from_json("value", ingest._QUICK, ingest._STRICT))
    quick = {row["name"] for row in read.filter(ingest._is_quick(F.col("quick"))).collect()}
    assert {"plain", "acc long", "sat beyond int", "outside", "numeric trip"} <= quick
    odd = ("speed absent", "speed null", "speed text", "speed true", "sat 7.9", "sat '7'", "ts text", "ts null", "ts 1.5", "quotes", "nan")
    assert not quick & {*odd, "record no object", "records null", "acc short", "gps absent"}


def test_both_ways_of_reading_records_agree(spark, monkeypatch):
    draw = random.Random(3)
    number = lambda: draw.choice([draw.uniform(-200, 200), draw.randrange(-5, 5), -0.0, 1e-7, 9.8, 0.1 + 0.2, 1e20])
    rows = []
    for seq in range(200):
        records = [
            record(ts=draw.randrange(-(2**62), 2**62), acc=[number() for _ in range(3)], gyr=[number() for _ in range(4)],
                   spd=abs(number()), hdop=number(), sat=draw.randrange(9), lng=draw.uniform(127.5, 127.8), lat=draw.uniform(34.4, 35.1))
            for _ in range(draw.randrange(5))
        ]
        rows.append((seq, message(*records)))
    rows.append((-1, message(GOOD).replace('"spd"', '"spd": 1, "spd"')))
    rows += [(-2 - at, text) for at, (text, _, _) in enumerate(CASES.values())]
    frame = spark.createDataFrame(rows, "seq bigint, value string")

    def found():
        trips = parse_trips(frame)
        return sorted(map(repr, trips.collect())), sorted(map(repr, readings(trips, ["seq"]).collect()))

    both = found()
    monkeypatch.setattr(ingest, "_is_quick", lambda quick: F.lit(False))
    slow = found()
    assert both == slow and len(slow[1]) > 50


def test_counters_add_up(trips):
    row = ingest_counters(trips).first()
    outcomes = [outcome for _, _, outcome in CASES.values()]
    assert row["total"] == len(CASES) == row[PROCESSED] + row[FILTERED] + row[ERRORS]
    assert (row[PROCESSED], row[FILTERED]) == (outcomes.count(PROCESSED), outcomes.count(FILTERED))


def test_values(trips):
    rows = {row["name"]: row for row in readings(trips, ["name"]).collect()}
    assert rows["plain"]["dt"] == "2025-02-12"
    assert (rows["plain"]["timestamp"], rows["plain"]["accel_z"]) == (1000, 9.8)
    assert rows["speed absent"]["velocity"] == 0.0
    assert (rows["hdop sat absent"]["hdop"], rows["hdop sat absent"]["satellites"]) == (99.0, 0)
    assert rows["speed text"]["velocity"] == 60.5
    assert rows["speed true"]["velocity"] == 1.0
    assert rows["sat 7.9"]["satellites"] == rows["sat '7'"]["satellites"] == 7
    assert rows["ts null"]["timestamp"] is None
    assert rows["ts 1.5"]["timestamp"] == 1
    assert rows["null vin"]["vehicle_id"] is None


def test_broken_payloads_are_errors(spark):
    payloads = [
        (1, base64.b64encode(message(GOOD).encode()).decode()),
        (2, "!!!"),
        (3, base64.b64encode(b"\xff\xfe").decode()),
        (4, None),
    ]
    decoded = decode_payload(spark.createDataFrame(payloads, "seq bigint, data string"))
    outcomes = [row["outcome"] for row in parse_trips(decoded).orderBy("seq").collect()]
    assert outcomes == [PROCESSED, ERRORS, ERRORS, ERRORS]


def test_last_delivery_wins_and_failed_ones_do_not_count(spark):
    texts = [
        (1, message(GOOD)),
        (2, message(record(spd=70), record(spd=71))),
        (3, message(OUTSIDE)),
        (4, message(GOOD, trip_id="other")),
        (5, message(GOOD, start_time="2025-02-13T00:00:00+09:00")),
    ]
    parsed = parse_trips(spark.createDataFrame(texts, "seq bigint, value string"))
    assert sorted(row["seq"] for row in latest_deliveries(parsed).collect()) == [2, 4, 5]


def test_raw_table_survives_redelivery_and_replay(spark, path_for):
    path = path_for("raw")

    def deliver(batch, *rows):
        frame = spark.createDataFrame(list(rows), "seq bigint, value string")
        write_raw(parse_trips(frame), path, batch)

    first = [(1, message(GOOD)), (2, message(GOOD)), (3, message(GOOD, trip_id="U"))]
    deliver(0, *first)
    deliver(0, *first)
    deliver(1, (4, message(record(spd=90), record(spd=91))))
    rows = read_latest(spark, path, SENSOR_BY_DAY, "2025-02-12")
    got = sorted((row["trip_id"], row["velocity"]) for row in rows.collect())
    assert got == [("T", 90.0), ("T", 91.0), ("U", 60.0)]


def test_text_is_parsed_once_however_it_is_filtered(spark, plan_of):
    frame = spark.createDataFrame([(1, message(GOOD))], "seq bigint, value string")
    plan = plan_of(readings(parse_trips(frame)))
    assert plan.count("parseJson") == 1
    assert "Python" not in plan and "Exchange" not in plan


def test_kept_readings_keep_their_order(spark):
    text = message(*(record(ts=ts) for ts in (3, 1, 2)))
    rows = readings(parse_trips(spark.createDataFrame([(text,)], "value string")))
    assert [row["timestamp"] for row in rows.select(F.col("timestamp")).collect()] == [3, 1, 2]
