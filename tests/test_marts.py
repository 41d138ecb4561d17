from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from bumpwise.operators import lookups, marts
from bumpwise.operators.boxes import bbox_filter, bbox_semi_join
from bumpwise.options import Box
from bumpwise.schema import FACT
from bumpwise.sinks.tables import refresh_marts, write_fact
from bumpwise.plans.impacts import run_serving

D = dt.date


def fact(spark, *rows, lon=127.0):
    shaped = [(s, place[0] if place else lon, 34.0, day, n) for s, day, n, *place in rows]
    return spark.createDataFrame(shaped, FACT)


def test_risk_levels(spark):
    day = D(2026, 3, 1)
    table = fact(spark, *((str(n), day, n) for n in (3, 4, 5, 6)), ("null", day, None))
    got = {row["s_id"]: row["risk_level"] for row in marts.context(table).collect()}
    assert got == {"3": "normal", "4": "warning", "5": "warning", "6": "critical", "null": "normal"}


def test_context_order(spark):
    table = fact(spark, ("b", D(2026, 3, 1), 1), ("a", D(2026, 3, 1), 1), ("c", D(2026, 3, 2), 1))
    assert [row["s_id"] for row in marts.context(table).collect()] == ["c", "a", "b"]


def test_daily_summary(spark):
    table = fact(spark, *((str(n), D(2026, 3, 1), n) for n in (1, 4, 5, 6)), ("x", D(2026, 3, 2), 2))
    first, second = marts.daily_summary(table).collect()
    assert tuple(first) == (D(2026, 3, 2), 1, 2, 0, 0, 2, 2, 2.0)
    assert tuple(second) == (D(2026, 3, 1), 4, 16, 1, 2, 1, 6, 4.0)


def test_priority_score_and_window(spark):
    table = fact(
        spark,
        ("A", D(2026, 2, 28), 6), ("A", D(2026, 3, 1), 4), ("A", D(2026, 2, 27), 100),
        ("B", D(2026, 4, 9), 1),
    )
    rows = marts.repair_priority(table, "2026-03-30").collect()
    assert [(row["s_id"], row["priority_score"]) for row in rows] == [("A", 66.05), ("B", 1.0)]
    assert rows[0]["first_detected"] == D(2026, 2, 28) and rows[0]["detected_days"] == 2


def test_drifting_coordinates(spark):
    table = fact(spark, ("A", D(2026, 3, 1), 4, 127.1), ("A", D(2026, 3, 2), 6, 127.2))
    assert marts.repair_priority(table, "2026-03-10").count() == 2
    (row,) = marts.repair_priority_by_segment(table, "2026-03-10").collect()
    assert (row["centroid_lon"], row["priority_score"]) == (127.2, 66.05)


def test_top(spark):
    table = fact(spark, *((str(n), D(2026, 3, 1), n) for n in range(1, 9)))
    top = marts.top_priorities(table, 3, "2026-03-02")
    assert [row["s_id"] for row in top.collect()] == ["8", "7", "6"]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("gap", [1, 3])
def test_trend_counts_rows_not_days(spark, gap):
    start = D(2026, 1, 1)
    table = fact(spark, *(("A", start + dt.timedelta(days=gap * n), n) for n in range(9)))
    rows = marts.segment_trend(table).collect()[::-1]
    assert [row["rolling_7d_avg"] for row in rows] == [0, 0.5, 1, 1.5, 2, 2.5, 3, 4, 5]
    assert [row["week_over_week_change"] for row in rows] == [None] * 7 + [7, 7]


def test_trend_shuffles_once_for_its_windows(spark, plan_of, path_for):
    path = path_for("fact")
    fact(spark, ("A", D(2026, 1, 1), 1)).write.parquet(path)
    plan = plan_of(marts.segment_trend(spark.read.parquet(path)))
    assert plan.count("hashpartitioning(s_id") == 1 and plan.count("Window ") == 1


def test_one_failing_mart_does_not_stop_the_others(spark, path_for):
    table = fact(spark, ("A", D(2026, 3, 1), 4))
    chosen = {"bad": lambda frame: frame.select("no_such_column"), "context": marts.context}
    status = {row["mart"]: row for row in refresh_marts(table, path_for("marts"), chosen=chosen).collect()}
    assert status["bad"]["status"] == "failed" and "no_such_column" in status["bad"]["error"]
    assert (status["context"]["status"], status["context"]["n_rows"]) == ("ok", 1)
    assert spark.read.parquet(status["context"]["location"]).count() == 1


def test_serving_from_the_stored_facts(spark, path_for):
    path = path_for("fact")
    write_fact(fact(spark, ("A", D(2026, 3, 1), 4)), path)
    status = run_serving(spark, path, path_for("marts"), "2026-03-02").collect()
    assert {row["status"] for row in status} == {"ok"} and len(status) == 4
    with pytest.raises(FileNotFoundError):
        run_serving(spark, path_for("none"), path_for("marts"))


def test_lookups(spark):
    table = fact(
        spark, ("A", D(2026, 3, 1), 4, 127.1), ("A", D(2026, 3, 2), 1, 127.2), ("B", D(2026, 3, 2), 9, 127.3)
    )

    def keys(frame):
        return sorted((row["s_id"], row["date"].day) for row in frame.collect())

    assert keys(lookups.by_date_range(table, "2026-03-02", "2026-03-05")) == [("A", 2), ("B", 2)]
    assert keys(lookups.by_segment(table, "A")) == [("A", 1), ("A", 2)]
    assert keys(lookups.by_date_and_segment(table, D(2026, 3, 2), "B")) == [("B", 2)]
    assert keys(lookups.in_viewport(table, Box("v", 127.1, 127.2, 34.0, 34.0))) == [("A", 1), ("A", 2)]
    assert keys(lookups.with_impacts(table, 4)) == [("A", 1), ("B", 2)]
    assert keys(lookups.with_impacts(table, 4, 5)) == [("A", 1)]


def test_boxes(spark):
    places = [(0, 0.0, 0.0), (1, 127.5, 34.5), (2, 127.6, 34.6), (3, 127.75, 34.75), (4, 128.0, 34.6), (5, None, 34.6)]
    points = spark.createDataFrame(places, "id int, lon double, lat double")
    boxes = [Box("a", 127.5, 127.6, 34.5, 34.6), Box("b", 127.55, 127.9, 34.55, 34.75)]
    wanted = [1, 2, 3]
    assert sorted(row["id"] for row in bbox_filter(points, boxes).collect()) == wanted
    assert bbox_filter(points, []).count() == 0
    rows = [(b.min_lon, b.max_lon, b.min_lat, b.max_lat) for b in [*boxes, Box("wide", -20.0, 30.0, -10.0, 10.0), Box("none", 2.0, 1.0, 2.0, 1.0)]]
    table = spark.createDataFrame(rows, "min_lon double, max_lon double, min_lat double, max_lat double")
    assert sorted(row["id"] for row in bbox_semi_join(points, table).collect()) == [0, *wanted]
    assert bbox_semi_join(points, table).filter(F.col("id") == 2).count() == 1
