"""Tables the jobs write."""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from bumpwise.functions.curve import place_on_curve
from bumpwise.operators import marts
from bumpwise.operators.facts import append_conflicts, merge_additive
from bumpwise.operators.ingest import readings
from bumpwise.options import FactLayout, OutputFiles, RiskLevels
from bumpwise.schema import ANOMALY_COLUMNS, FACT_COLUMNS, FACT_KEY, MART_POINTER, SENSOR_COLUMNS, STORED_FACT
from bumpwise.session import row_bytes, store, store_measured
from bumpwise.sources.tables import pointers_path, read_fact

_SHOWN_KEYS = 10


def write_by_day(
    rows: DataFrame,
    path: str,
    columns: Sequence[str],
    partitions: Sequence[str] = ("dt",),
    files: OutputFiles | None = None,
) -> None:
    """Snappy Parquet under `dt=<day>/`, replacing the partitions that have rows.

    Rows of a day are brought together and split by size, so a long day becomes several files of
    a fair size. With `files`, the number of a day's files follows from its measured bytes, up to
    `files.per_day`; the rows are dealt among them by a hash.
    """
    wanted = rows.select(*columns, *partitions)
    if files is None:
        gathered = wanted.hint("rebalance", *partitions)
    else:
        gathered = _in_few_files(wanted, columns, partitions, files)
    (
        gathered.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*partitions)
        .parquet(path)
    )


def _in_few_files(
    rows: DataFrame, columns: Sequence[str], partitions: Sequence[str], files: OutputFiles
) -> DataFrame:
    """`rows` dealt out so that each partition is as many tasks, and so files, as its bytes ask for."""
    copy, _ = store(rows, "days")
    wanted = F.least(F.ceil(F.sum(row_bytes(copy)) / files.file_bytes), F.lit(files.per_day))
    sizes = copy.groupBy(*partitions).agg(F.greatest(wanted, F.lit(1)).cast("int").alias("_files"))
    # a row per day: the tasks of a day come after those of the days before it
    before = Window.orderBy(*partitions).rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("_files").over(before), F.lit(0)).cast("int").alias("_first")
    sizes, _ = store(sizes.select("*", first), "day-sizes")
    tasks = sizes.agg(F.sum("_files").alias("n")).first()["n"] or 1
    renamed = sizes.select("_files", "_first", *(F.col(name).alias(f"_{name}") for name in partitions))
    same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in partitions]
    joined = copy.join(F.broadcast(renamed), reduce(Column.__and__, same))
    task = F.col("_first") + F.pmod(F.xxhash64(*columns), F.col("_files")).cast("int")
    return joined.repartitionById(tasks, task).select(*rows.columns)


def write_anomalies(
    anomalies: DataFrame, path: str, day: str | None = None, files: OutputFiles = OutputFiles()
) -> None:
    """Anomalies by day. With `day`, that day is replaced even if it has no anomaly left."""
    if day is None:
        write_by_day(anomalies, path, ANOMALY_COLUMNS, files=files)
        return
    one_day = anomalies.filter(F.col("dt") == day).select(*ANOMALY_COLUMNS)
    copy, _, size = store_measured(one_day, "day")
    tasks = max(1, min(files.per_day, -(-size // files.file_bytes)))
    copy.repartition(tasks, F.xxhash64(*ANOMALY_COLUMNS)).write.mode("overwrite").option(
        "compression", "snappy"
    ).parquet(f"{path}/dt={day}")


def write_raw(trips: DataFrame, path: str, batch: int | str) -> None:
    """Readings of processed trips as one batch of the raw table (see `read_latest`).

    Writing the same batch again replaces it. A trip delivered again replaces its earlier rows
    for readers; nothing that is stored is read or rewritten for it.
    """
    write_batch(readings(trips, carry=["seq"]), path, (*SENSOR_COLUMNS, "seq"), batch)


def write_batch(rows: DataFrame, path: str, columns: Sequence[str], batch: int | str) -> None:
    numbered = rows.withColumn("batch", F.lit(str(batch)))
    write_by_day(numbered, path, columns, partitions=("dt", "batch"))


def write_segments(segments: DataFrame, path: str, file_format: str = "csv") -> None:
    options = {"header": "true"} if file_format == "csv" else {}
    segments.write.mode("overwrite").format(file_format).options(**options).save(path)


def write_fact(fact: DataFrame, path: str, mode: str = "append", layout: FactLayout = FactLayout()) -> None:
    """Facts by month, clustered for lookups. Stamps are added where the rows have none."""
    months = with_stamps(fact).withColumn("month", F.trunc("date", "MM")).select(*STORED_FACT.names)
    copy, _, size = store_measured(months, "facts")
    _write_clustered(copy, size, path, mode, layout)


def _write_clustered(
    months: DataFrame, size: int, path: str, mode: str, layout: FactLayout, levels: RiskLevels = RiskLevels()
) -> None:
    """A month's rows in the order of risk level, place on the curve, segment and day.

    Rows are dealt out by ranges of this order, into as many tasks as their bytes ask for, so a
    large month is written by many tasks and small months share one. Row groups then cover small
    areas of one risk level: a viewport or a range of counts skips the others by their minima and
    maxima. A segment lies in one place, so its rows lie in few row groups too; a Bloom filter
    tells which.
    """
    count = F.col("impact_count")
    band = F.when(count > levels.critical_above, 2).when(count > levels.warning_above, 1).otherwise(0)
    placed = months.withColumns(
        {"_band": band, "_place": place_on_curve(F.col("centroid_lon"), F.col("centroid_lat"))}
    )
    order = ["month", "_band", "_place", "s_id", "date"]
    tasks = max(1, -(-size // layout.file_bytes))
    (
        placed.repartitionByRange(tasks, *order)
        .sortWithinPartitions(*order)
        .select(*STORED_FACT.names)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("parquet.block.size", layout.row_group_bytes)
        .option("parquet.bloom.filter.enabled#s_id", "true")
        .option("parquet.bloom.filter.adaptive.enabled", "true")
        .partitionBy("month")
        .parquet(path)
    )


def with_stamps(fact: DataFrame, now: Column | None = None) -> DataFrame:
    """`created_at` and `updated_at`, now unless the rows have them."""
    stamp = F.current_timestamp() if now is None else now
    wanted = ("created_at", "updated_at")
    return fact.withColumns({name: stamp for name in wanted if name not in fact.columns})


def merge_into_fact(
    delta: DataFrame,
    path: str,
    mode: str = "add",
    now: Column | None = None,
    days: Sequence[dt.date | str] | None = None,
    layout: FactLayout = FactLayout(),
) -> None:
    """Merge counts into the stored facts (`merge_additive`), rewriting the months they touch.

    The merged months are written aside first: a table must not be overwritten while it is read,
    and if the second write is lost with an executor the first still holds the result. The delta
    is evaluated once. A month that a replacement leaves without a row is emptied.
    """
    spark = delta.sparkSession
    delta, _ = store(delta, "delta")
    stored = read_fact(spark, path)
    if stored is None:
        stored = spark.createDataFrame([], STORED_FACT)
    months = _months(delta) | {dt.date.fromisoformat(str(day)).replace(day=1) for day in days or ()}
    touched = stored.filter(F.col("month").isin(sorted(months)))
    before = _months(touched) if mode == "replace" else set()
    merged = with_stamps(merge_additive(touched.drop("month"), delta, mode, now, days), now)
    merged = merged.withColumn("month", F.trunc("date", "MM")).select(*STORED_FACT.names)
    staged, rows, size = store_measured(merged, "merged-months")
    left = _months(staged)
    if rows:
        _write_clustered(staged, size, path, "overwrite", layout)
    empty = spark.createDataFrame([], STORED_FACT).drop("month")
    for month in sorted(before - left):
        empty.write.mode("overwrite").parquet(f"{path}/month={month}")


def _months(fact: DataFrame) -> set[dt.date]:
    """The months with facts: a value per month of data."""
    months = fact.select(F.trunc("date", "MM").alias("m")).distinct().collect()
    return {row["m"] for row in months if row["m"] is not None}


class DuplicateKeys(ValueError):
    """Facts that are stored already, or twice in the rows to append."""


def append_to_fact(delta: DataFrame, path: str) -> None:
    """Append facts; a NULL, or a key that exists or repeats, is an error and nothing is written."""
    spark = delta.sparkSession
    delta, _ = store(delta, "delta")
    incomplete = delta.filter(
        " OR ".join(f"{name} IS NULL" for name in FACT_COLUMNS)
    )
    if not incomplete.isEmpty():
        raise ValueError("facts to append have NULL values")
    stored = read_fact(spark, path)
    if stored is None:
        stored = spark.createDataFrame([], STORED_FACT)
    same_months = stored.filter(F.col("month").isin(sorted(_months(delta))))
    found = append_conflicts(same_months, delta)
    conflicts = found.orderBy(*FACT_KEY).limit(_SHOWN_KEYS).collect()
    if conflicts:
        keys = ", ".join(f"({row['s_id']}, {row['date']})" for row in conflicts)
        raise DuplicateKeys(f"facts exist or repeat, among them: {keys}")
    write_fact(delta, path)


Mart = Callable[[DataFrame], DataFrame]


def standard_marts(as_of: dt.date | str | None = None) -> dict[str, Mart]:
    return {
        "context": marts.context,
        "daily_summary": marts.daily_summary,
        "repair_priority": lambda fact: marts.repair_priority(fact, as_of),
        "segment_trend": marts.segment_trend,
    }


def refresh_marts(
    fact: DataFrame,
    path: str,
    as_of: dt.date | str | None = None,
    chosen: Mapping[str, Mart] | None = None,
) -> DataFrame:
    """Rebuild the marts, each in a new folder; one that fails does not stop the others.

    A version is published last, by a row that names it (`read_mart` follows the newest), so until
    then, and if its refresh fails, the version before it is what readers see. Returns a row per
    mart: `mart`, `status` (ok or failed), `n_rows`, `location`, `error`.
    """
    spark = fact.sparkSession
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
    outcome = []
    for name, build in (chosen or standard_marts(as_of)).items():
        location = f"{path}/{name}/{version}"
        written = Observation()
        try:
            build(fact).observe(written, F.count(F.lit(1)).alias("n")).write.parquet(location)
            pointer = spark.createDataFrame([(name, version, written.get["n"])], MART_POINTER)
            pointer.coalesce(1).write.mode("append").parquet(pointers_path(path))
            outcome.append((name, "ok", written.get["n"], location, None))
        except Exception as error:  # noqa: BLE001
            outcome.append((name, "failed", None, None, str(error)))
    return spark.createDataFrame(
        outcome, "mart string, status string, n_rows bigint, location string, error string"
    )
