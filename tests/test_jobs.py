from __future__ import annotations

import json
import random

from pyspark.sql import functions as F

from bumpwise.operators.ingest import parse_trips
from bumpwise.operators.nearest import build_segment_index
from bumpwise.plans.impacts import impact_counts, run_detection, run_mapping, run_serving
from bumpwise.schema import SEGMENT, SENSOR_BY_DAY
from bumpwise.sinks.tables import write_raw
from bumpwise.sources.tables import read_fact, read_latest

DAYS = ("2026-02-12", "2026-02-13")


def trip(number, day, rng, scale=1.0):
    records = [
        {"ts": i, "acc": [0, 0, scale * rng.gauss(0, 1) ** 3], "gyr": [0, rng.gauss(0, 1) ** 3, 0], "spd": 50,
         "gps": {"lng": 127.53 + 0.0004 * i, "lat": 34.6, "hdop": 1, "sat": 9}}
        for i in range(60)
    ]
    return {"trip_id": f"T{number}", "vin": "V", "start_time": f"{day}T01:00:00+09:00", "records": records}


def test_from_messages_to_marts(spark, path_for):
    rng = random.Random(11)
    raw, found, fact, marts = (path_for(name) for name in ("raw", "anomalies", "fact", "marts"))
    segments = [(f"{i:03d}", "L", x, 34.6, x + 0.0004, 34.6) for i in range(70) for x in [127.53 + 0.0004 * i]]
    index = build_segment_index(spark.createDataFrame(segments, SEGMENT))

    def deliver(batch, trips):
        rows = [(batch * 100 + n, json.dumps(t)) for n, t in enumerate(trips)]
        write_raw(parse_trips(spark.createDataFrame(rows, "seq bigint, value string")), raw, batch)

    deliver(1, [trip(n, day, rng) for n in range(6) for day in DAYS])
    deliver(2, [trip(0, DAYS[0], rng, 1.5), trip(1, DAYS[1], rng, 1.5)])

    for day in DAYS:
        counts = run_detection(spark, raw, found, day)
        assert counts["usable"] == 6 * 60 and counts["anomalies"] > 0
        run_mapping(spark, found, index, fact, day)

    direct = impact_counts(read_latest(spark, raw, SENSOR_BY_DAY), index)

    def content(frame):
        names = ("s_id", "date", "centroid_lon", "centroid_lat", "impact_count")
        return sorted(map(tuple, frame.select(*names).collect()))

    expected = content(direct)
    assert content(read_fact(spark, fact)) == expected

    run_mapping(spark, found, index, fact, DAYS[0], mode="replace")
    assert content(read_fact(spark, fact)) == expected
    run_mapping(spark, found, index, fact, DAYS[0])
    doubled = read_fact(spark, fact).agg(F.sum("impact_count")).first()[0]
    assert doubled == sum(row[4] * (2 if str(row[1]) == DAYS[0] else 1) for row in expected)

    status = run_serving(spark, fact, marts, as_of="2026-02-14").collect()
    assert {row["status"] for row in status} == {"ok"}
    priorities = next(row["location"] for row in status if row["mart"] == "repair_priority")
    assert spark.read.parquet(priorities).agg(F.sum("total_impacts")).first()[0] == doubled
