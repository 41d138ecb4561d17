from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from bumpwise.operators import facts
from bumpwise.schema import FACT, MAPPED_BY_DAY
from bumpwise.sinks.tables import DuplicateKeys, append_to_fact, merge_into_fact, write_fact
from bumpwise.sources.tables import load_fact, read_fact, union_by_name

D1, D2 = dt.date(2026, 3, 1), dt.date(2026, 4, 2)


def fact(spark, *rows):
    """(s_id, date, count) with a place that depends on the count."""
    shaped = [(s, 127.0 + n, 34.0 + n, day, n) for s, day, n in rows]
    return spark.createDataFrame(shaped, FACT)


def content(frame):
    return sorted((r["s_id"], r["date"], r["centroid_lon"], r["impact_count"]) for r in frame.collect())


def test_daily_counts(spark):
    rows = [
        (5, "T1", 1.0, 2.0, "A", "2026-03-01"), (3, "T2", 3.0, 4.0, "A", "2026-03-01"),
        (3, "T1", 5.0, 6.0, "A", "2026-03-01"), (1, "T1", 7.0, 8.0, "A", "2026-03-02"),
        (1, "T1", 7.0, 8.0, None, "2026-03-02"),
    ]
    mapped = spark.createDataFrame(rows, MAPPED_BY_DAY)
    got = facts.daily_segment_counts(mapped, date_from="dt").orderBy("date").collect()
    assert [tuple(row) for row in got] == [
        ("A", 5.0, 6.0, dt.date(2026, 3, 1), 3), ("A", 7.0, 8.0, dt.date(2026, 3, 2), 1),
    ]
    stamped = facts.daily_segment_counts(mapped, as_of="2026-05-05").collect()
    assert [(row["date"], row["impact_count"]) for row in stamped] == [(dt.date(2026, 5, 5), 4)]
    today = facts.daily_segment_counts(mapped).select((F.col("date") == F.current_date())).first()
    assert today[0]
    assert tuple(facts.unmapped_count(mapped).first()) == (4, 1)


def test_merge(spark):
    base = fact(spark, ("A", D1, 3), ("C", D1, 9))
    delta = fact(spark, ("A", D1, 2), ("B", D1, 1))
    assert content(facts.merge_additive(base, delta)) == [
        ("A", D1, 129.0, 5), ("B", D1, 128.0, 1), ("C", D1, 136.0, 9),
    ]
    replaced = facts.merge_additive(base, delta, mode="replace")
    assert content(replaced) == [("A", D1, 129.0, 2), ("B", D1, 128.0, 1)]  # C is gone: its day is replaced
    emptied = facts.merge_additive(base, fact(spark), mode="replace", days=[D1])
    assert content(emptied) == []
    with pytest.raises(ValueError):
        facts.merge_additive(base, delta, mode="other")


def test_merge_is_associative_and_counts_repeated_keys(spark):
    parts = [fact(spark, ("A", D1, 3), ("B", D2, 1)), fact(spark, ("A", D1, 2)), fact(spark, ("B", D2, 4), ("C", D1, 1))]
    one, two, three = parts
    left = facts.merge_additive(facts.merge_additive(one, two), three)
    right = facts.merge_additive(one, union_by_name([two, three]))
    assert [row[3] for row in content(left)] == [row[3] for row in content(right)] == [5, 5, 1]
    doubled = facts.merge_additive(fact(spark), fact(spark, ("A", D1, 3), ("A", D1, 4)))
    assert content(doubled) == [("A", D1, 131.0, 7)]


def test_stored_merge_touches_only_its_months_and_stamps(spark, path_for):
    path = path_for("fact")
    then, now = (F.lit(day).cast("timestamp") for day in ("2020-01-01", "2021-01-01"))
    merge_into_fact(fact(spark, ("A", D1, 3), ("A", D2, 8)), path, now=then)
    files = spark.read.parquet(path).filter("month = '2026-04-01'").inputFiles()
    kept = [name for name in files if "month=2026-04-01" in name]
    merge_into_fact(fact(spark, ("A", D1, 2), ("B", D1, 1)), path, now=now)
    stored = read_fact(spark, path)
    assert content(stored) == [("A", D1, 129.0, 5), ("A", D2, 135.0, 8), ("B", D1, 128.0, 1)]
    assert set(kept) <= set(spark.read.parquet(path).inputFiles())
    stamps = {row["s_id"]: row["created_at"].year for row in stored.filter(F.col("date") == D1).collect()}
    assert stamps == {"A": 2020, "B": 2021}


def test_strict_append(spark, path_for):
    path = path_for("fact")
    append_to_fact(fact(spark, ("A", D1, 3)), path)
    append_to_fact(fact(spark, ("B", D1, 3)), path)
    with pytest.raises(DuplicateKeys, match="A, 2026-03-01"):
        append_to_fact(fact(spark, ("A", D1, 1), ("C", D1, 1)), path)
    with pytest.raises(DuplicateKeys, match="D, 2026-03-01"):
        append_to_fact(fact(spark, ("D", D1, 1), ("D", D1, 1)), path)
    with pytest.raises(ValueError, match="NULL"):
        append_to_fact(fact(spark, ("E", D1, 1)).withColumn("centroid_lon", F.lit(None).cast("double")), path)
    assert [row[0] for row in content(read_fact(spark, path))] == ["A", "B"]
    assert read_fact(spark, path).filter("created_at IS NULL OR updated_at IS NULL").count() == 0


def test_reading_one_month_prunes(spark, path_for, plan_of):
    from bumpwise.operators.lookups import by_date_range

    path = path_for("fact")
    write_fact(fact(spark, ("A", D1, 3), ("A", D2, 3)), path)
    found = by_date_range(read_fact(spark, path), "2026-03-01", "2026-03-31")
    assert [row["date"] for row in found.collect()] == [D1]
    assert "PartitionFilters: [isnotnull(month" in plan_of(found)


def raw(spark, **changes):
    row = {"s_id": "1", "centroid_lon": "127.5", "centroid_lat": "34.5", "date": "2026-03-01", "impact_count": "4"}
    row |= changes
    schema = ", ".join(f"{name} string" for name in row)
    return spark.createDataFrame([tuple(row.values())], schema)


def test_coercion(spark):
    assert tuple(facts.coerce_fact(raw(spark)).first()) == ("1", 127.5, 34.5, D1, 4)
    assert facts.coerce_fact(raw(spark, centroid_lon="x")).first()["centroid_lon"] is None
    assert facts.coerce_fact(raw(spark, date=None)).first()["date"] is None
    assert facts.coerce_fact(raw(spark, date="junk"), "2026-04-02").first()["date"] == D2
    for wrong in ({"impact_count": "x"}, {"impact_count": None}, {"impact_count": "3.5"}, {"date": "x"}):
        with pytest.raises(PySparkException):
            facts.coerce_fact(raw(spark, **wrong)).collect()
    with pytest.raises(ValueError, match="impact_count, s_id"):
        facts.coerce_fact(raw(spark).drop("s_id", "impact_count"))


def test_null_audit(spark):
    table = spark.createDataFrame([(1.0, None), (float("nan"), "a"), (None, "b")], "x double, y string")
    audit = {row["column"]: row["nulls"] for row in facts.null_audit(table, ["x", "y"]).collect()}
    assert audit == {"x": 2, "y": 1}


def test_load_fact_unites_files_and_stamps(spark, path_for):
    path = path_for("load")
    fact(spark, ("A", D1, 3)).write.parquet(f"{path}/one")
    fact(spark, ("B", D2, 4)).drop("date").write.parquet(f"{path}/two/dt=x")
    got = load_fact(spark, path, "2026-02-12").collect()
    assert {row["s_id"]: row["date"] for row in got} == {"A": dt.date(2026, 2, 12), "B": dt.date(2026, 2, 12)}
    with pytest.raises(FileNotFoundError):
        load_fact(spark, path_for("nothing"), "2026-02-12")


def test_months(spark):
    got = facts.monthly_counts(fact(spark, ("A", D1, 3), ("B", D1, 4), ("A", D2, 1))).orderBy("month").collect()
    assert [tuple(row) for row in got] == [(dt.date(2026, 3, 1), 2, 7), (dt.date(2026, 4, 1), 1, 1)]
