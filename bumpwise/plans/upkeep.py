"""Housekeeping of stored tables: compaction of raw days, removal of old marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bumpwise.schema import SENSOR_BY_DAY, SENSOR_COLUMNS
from bumpwise.session import remove_path, subfolders
from bumpwise.sinks.tables import write_by_day
from bumpwise.sources.tables import current_versions, read_latest

# sorts before the names of all other batches, and each compaction before the earlier ones: of two
# batches with the same delivery, readers take the one with the greater name
_PREFIX = "!"
_GENERATIONS = 10**12
DAYS_AT_ONCE = 32


def compact_raw(
    spark: SparkSession, path: str, days: Sequence[str] | None = None, at_once: int = DAYS_AT_ONCE
) -> DataFrame:
    """Rewrite the live deliveries of days as one batch each and remove the batches it stands for.

    Returns `dt, batches, n_rows` of the days compacted; days with a single batch are left alone.
    Readers see the same rows at any moment. The new batch holds copies of live deliveries under a
    name that gives way to the originals, so it counts only once these are gone, and they go only
    when it is complete. If the job ends half-way, what is left is either a batch that nothing
    depends on or some originals beside a whole copy; the next compaction clears both. Batches that
    arrive in the meantime are not touched. Only the folders listed at the start are removed.
    `at_once` days are rewritten by one job, so that it keeps all executors busy; originals and copies
    of so many days lie side by side meanwhile.
    """
    waiting = []
    for folder in subfolders(spark, path):
        day = folder.removeprefix("dt=")
        if not folder.startswith("dt=") or (days is not None and day not in days):
            continue
        batches = [name for name in subfolders(spark, f"{path}/{folder}") if name.startswith("batch=")]
        # a day whose name had to be escaped is no date; it is left as it is
        if len(batches) < 2 or "%" in day:
            continue
        earlier = [name.removeprefix(f"batch={_PREFIX}") for name in batches if name.startswith(f"batch={_PREFIX}")]
        waiting.append((day, f"{_PREFIX}{min(map(int, earlier), default=_GENERATIONS) - 1:013d}", batches))
    done = []
    for start in range(0, len(waiting), at_once):
        some = waiting[start : start + at_once]
        done += _compact_days(spark, path, some)
    return spark.createDataFrame(done, "dt string, batches int, n_rows bigint")


def _compact_days(
    spark: SparkSession, path: str, some: Sequence[tuple[str, str, list[str]]]
) -> list[tuple[str, int, int]]:
    """Days with the name of their new batch and those it stands for; returns what `compact_raw` does."""
    names = spark.createDataFrame([(day, name) for day, name, _ in some], "dt string, batch string")
    rows = read_latest(spark, path, SENSOR_BY_DAY, [day for day, _, _ in some], keep_seq=True)
    write_by_day(rows.join(F.broadcast(names), "dt"), path, (*SENSOR_COLUMNS, "seq"), ("dt", "batch"))
    # a day whose files hold no row has no new batch
    written = [f"{path}/dt={day}/batch={name}" for day, name, _ in some if f"batch={name}" in subfolders(spark, f"{path}/dt={day}")]
    counts = {}
    if written:
        stored = spark.read.schema(SENSOR_BY_DAY).option("basePath", path).parquet(*written)
        counts = {row["dt"]: row["count"] for row in stored.groupBy("dt").count().collect()}
    for day, _, batches in some:
        for batch in batches:
            remove_path(spark, f"{path}/dt={day}/{batch}")
    return [(day, len(batches), counts.get(day, 0)) for day, _, batches in some]


def remove_old_marts(spark: SparkSession, path: str) -> int:
    """Remove the versions of each mart that are older than the current one; returns how many.

    Versions are named by the time they were begun, so a refresh that is under way is not touched.
    Readers that still have an old version open lose it: run this when they are done.
    """
    removed = 0
    for row in current_versions(spark, path).collect():  # a row per mart
        for version in subfolders(spark, f"{path}/{row['mart']}"):
            if version < row["version"]:
                removed += remove_path(spark, f"{path}/{row['mart']}/{version}")
    return removed
