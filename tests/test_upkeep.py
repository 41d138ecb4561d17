"""Compaction of raw days and publication of marts, also when they end half-way."""

from __future__ import annotations

import datetime as dt
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from bumpwise.operators import marts
from bumpwise.plans import upkeep
from bumpwise.plans.upkeep import compact_raw, remove_old_marts
from bumpwise.schema import FACT, SENSOR_BY_DAY, SENSOR_COLUMNS
from bumpwise.session import remove_path, subfolders
from bumpwise.sinks.tables import refresh_marts, write_batch, write_by_day
from bumpwise.sources.tables import current_versions, read_latest, read_mart

DAYS = ("2026-01-01", "2026-01-02")


def deliver(spark, path, batch, *trips):
    """A batch of (trip, seq, rows) on both days."""
    parts = [(day, trip, seq, at) for day in DAYS for trip, seq, rows in trips for at in range(rows)]
    rows = spark.createDataFrame(parts, "dt string, trip_id string, seq bigint, timestamp bigint")
    missing = [name for name in SENSOR_COLUMNS if name not in rows.columns]
    whole = rows.withColumns({name: F.lit(None).cast(SENSOR_BY_DAY[name].dataType) for name in missing})
    write_batch(whole, path, (*SENSOR_COLUMNS, "seq"), batch)


def content(spark, path):
    return sorted(map(repr, read_latest(spark, path, SENSOR_BY_DAY).collect()))


def files(path):
    return len(list(Path(path).rglob("part-*.parquet")))


def three_batches(spark, path):
    deliver(spark, path, 1, ("A", 1, 3), ("B", 2, 2))
    deliver(spark, path, "later", ("A", 5, 4), ("C", 6, 1))
    deliver(spark, path, "again", ("A", 5, 4), ("B", 1, 9))


def test_compaction_keeps_what_readers_see(spark, path_for):
    path = path_for("raw")
    three_batches(spark, path)
    before, n_files = content(spark, path), files(path)
    done = sorted(map(tuple, compact_raw(spark, path).collect()))
    assert done == [(day, 3, 7) for day in DAYS]
    assert content(spark, path) == before
    assert files(path) < n_files and files(path) == 2
    # a day with one batch is left alone
    assert compact_raw(spark, path).count() == 0


@pytest.mark.parametrize(("at_once", "writes"), [(32, 1), (1, 2)])
def test_days_are_compacted_together(spark, path_for, monkeypatch, at_once, writes):
    path, calls = path_for("raw"), []
    three_batches(spark, path)
    before = content(spark, path)

    def write(*arguments):
        calls.append(arguments)
        write_by_day(*arguments)

    monkeypatch.setattr(upkeep, "write_by_day", write)
    done = compact_raw(spark, path, at_once=at_once).collect()
    assert sorted(map(tuple, done)) == [(day, 3, 7) for day in DAYS]
    assert len(calls) == writes and content(spark, path) == before


def test_deliveries_after_a_compaction_count(spark, path_for):
    path = path_for("raw")
    three_batches(spark, path)
    compact_raw(spark, path, [DAYS[0]])
    deliver(spark, path, 9, ("A", 7, 1), ("D", 8, 2))
    # an old batch that a stream writes again
    deliver(spark, path, "later", ("A", 5, 4), ("C", 6, 1))
    before = content(spark, path)
    assert compact_raw(spark, path, [DAYS[0]]).first()["batches"] == 3
    assert content(spark, path) == before
    compact_raw(spark, path)
    assert content(spark, path) == before
    names = subfolders(spark, f"{path}/dt={DAYS[0]}")
    assert len(names) == 1 and names[0].startswith("batch=!")


@pytest.mark.parametrize("removed", [0, 1, 2])
def test_a_compaction_that_ends_while_it_removes(spark, path_for, monkeypatch, removed):
    path = path_for("raw")
    three_batches(spark, path)
    before, calls = content(spark, path), []

    def remove(spark, folder):
        if len(calls) == removed:
            raise KeyboardInterrupt
        calls.append(folder)
        return remove_path(spark, folder)

    monkeypatch.setattr(upkeep, "remove_path", remove)
    with pytest.raises(KeyboardInterrupt):
        compact_raw(spark, path)
    monkeypatch.undo()
    assert content(spark, path) == before
    compact_raw(spark, path)
    assert content(spark, path) == before
    assert all(len(subfolders(spark, f"{path}/dt={day}")) == 1 for day in DAYS)


def test_a_compaction_that_ends_while_it_writes(spark, path_for):
    """A copy with a part of the rows, beside all originals, is not seen and goes with the next."""
    path, whole = path_for("raw"), path_for("whole")
    three_batches(spark, path)
    before = content(spark, path)
    shutil.copytree(path, whole)
    compact_raw(spark, whole)
    (copy,) = Path(f"{whole}/dt={DAYS[0]}").iterdir()
    part = spark.read.parquet(str(copy)).filter("trip_id = 'A' AND timestamp < 2")
    part.write.parquet(f"{path}/dt={DAYS[0]}/{copy.name}")
    assert content(spark, path) == before
    compact_raw(spark, path)
    assert content(spark, path) == before


def test_nothing_to_compact(spark, path_for):
    assert compact_raw(spark, path_for("none")).count() == 0


def facts(spark, count):
    rows = [("a", 127.0, 35.0, dt.date(2026, 1, day), count) for day in (1, 2)]
    return spark.createDataFrame(rows, FACT)


def broken(fact):
    return fact.withColumn("impact_count", F.raise_error(F.lit("broken")).cast("int"))


def test_readers_see_the_last_mart_that_was_finished(spark, path_for):
    path = path_for("marts")
    with pytest.raises(FileNotFoundError):
        read_mart(spark, path, "context")
    refresh_marts(facts(spark, 1), path, "2026-01-05")
    opened = read_mart(spark, path, "context")
    refresh_marts(facts(spark, 2), path, "2026-01-05")
    status = refresh_marts(facts(spark, 3), path, chosen={"context": broken, "daily_summary": marts.daily_summary})
    assert {r["mart"]: r["status"] for r in status.collect()} == {"context": "failed", "daily_summary": "ok"}
    counts = read_mart(spark, path, "context").select("impact_count").collect()
    assert [row[0] for row in counts] == [2, 2]
    assert read_mart(spark, path, "daily_summary").agg(F.sum("total_impacts")).first()[0] == 6
    assert opened.agg(F.sum("impact_count")).first()[0] == 2  # a reader keeps its version
    assert current_versions(spark, path).count() == 4


def test_old_versions_are_removed_and_running_ones_kept(spark, path_for):
    path = path_for("marts")
    for count in (1, 2):
        refresh_marts(facts(spark, count), path, "2026-01-05")
    running = f"{path}/context/99999999999999999999-running"
    facts(spark, 9).write.parquet(running)
    assert remove_old_marts(spark, path) == 4
    assert remove_old_marts(spark, path) == 0
    assert sorted(subfolders(spark, f"{path}/context"))[-1].endswith("running")
    assert read_mart(spark, path, "segment_trend").count() == 2
