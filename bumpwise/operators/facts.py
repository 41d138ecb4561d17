"""Daily facts per segment: counting, checking, merging."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bumpwise.schema import FACT_COLUMNS, FACT_KEY

_STAMPS = ("created_at", "updated_at")


def daily_segment_counts(
    mapped: DataFrame, as_of: dt.date | str | None = None, date_from: str | None = None
) -> DataFrame:
    """Impacts per segment and day, with one impact's place as the segment-day's coordinate.

    The day is `as_of` (default: today) for all rows, or the column named by `date_from`. Points
    without a segment, or whose day cannot be read, are not counted (see `unmapped_count`). The coordinate is the first impact's, by time and trip.
    """
    if date_from is not None:
        day = F.col(date_from).try_cast("date")
    else:
        day = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    first = F.min(F.struct("timestamp", "trip_id", "lon", "lat")).alias("_first")
    return (
        mapped.filter(F.col("s_id").isNotNull() & day.isNotNull())
        .groupBy("s_id", day.alias("date"))
        .agg(F.count(F.lit(1)).cast("int").alias("impact_count"), first)
        .select(
            "s_id",
            F.col("_first.lon").alias("centroid_lon"),
            F.col("_first.lat").alias("centroid_lat"),
            "date",
            "impact_count",
        )
    )


def unmapped_count(mapped: DataFrame) -> DataFrame:
    """One row: points with and without a segment."""
    return mapped.agg(
        F.count("s_id").alias("mapped"), F.count_if(F.col("s_id").isNull()).alias("unmapped")
    )


def null_audit(table: DataFrame, columns: Sequence[str] = FACT_COLUMNS) -> DataFrame:
    """Missing values (NULL or NaN) per column, in one pass."""
    kinds = dict(table.dtypes)

    def missing(name: str) -> Column:
        value = F.col(name)
        return value.isNull() | F.isnan(value) if kinds[name] in ("double", "float") else value.isNull()

    counts = table.agg(*(F.count_if(missing(name)).alias(name) for name in columns))
    return counts.unpivot([], list(columns), "column", "nulls")


def coerce_fact(raw: DataFrame, date: dt.date | str | None = None) -> DataFrame:
    """Any table with the fact's columns in the fact's types; `date`, if given, stamps all rows.

    Coordinates that are no numbers become NULL; a count or date that cannot be read raises.
    """
    if date is not None:
        raw = raw.withColumn("date", F.lit(str(date)))
    missing = sorted(set(FACT_COLUMNS) - set(raw.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")

    def must_read(name: str, kind: str, null_allowed: bool) -> Column:
        value = F.col(name).try_cast(kind)
        unread = value.isNull() & (F.lit(not null_allowed) | F.col(name).isNotNull())
        message = F.concat(
            F.lit(f"{name} is not a valid {kind}: "),
            F.coalesce(F.col(name).cast("string"), F.lit("NULL")),
        )
        return F.when(unread, F.raise_error(message).cast(kind)).otherwise(value).alias(name)

    return raw.select(
        F.col("s_id").cast("string").alias("s_id"),
        F.col("centroid_lon").try_cast("double").alias("centroid_lon"),
        F.col("centroid_lat").try_cast("double").alias("centroid_lat"),
        must_read("date", "date", null_allowed=True),
        must_read("impact_count", "int", null_allowed=False),
    )


def merge_additive(
    base: DataFrame,
    delta: DataFrame,
    mode: str = "add",
    now: Column | None = None,
    days: Sequence[dt.date | str] | None = None,
) -> DataFrame:
    """`base` with `delta` merged in on (s_id, date).

    A known key takes the delta's coordinate and adds its count; a new key is inserted. With
    `mode="replace"` the delta stands for whole days: a known key takes the count too, and a key of
    these days that the delta lacks is removed. The days are those of the delta, or `days`, which
    lets a day without any impact be replaced. Rows of `delta` with the same key count together. If
    `base` has `created_at` and `updated_at`, new keys are stamped with `now` and known keys
    keep theirs.
    """
    if mode not in ("add", "replace"):
        raise ValueError(f"mode must be 'add' or 'replace', not {mode!r}")
    keys = list(FACT_KEY)
    changes = (
        delta.groupBy(*keys)
        .agg(
            F.sum("impact_count").alias("_count"),
            F.max(F.struct("centroid_lon", "centroid_lat")).alias("_place"),
        )
        .withColumn("_changed", F.lit(True))
    )
    known = base.withColumn("_known", F.lit(True))
    both = known.join(changes, keys, "full_outer")
    kept = F.coalesce("impact_count", F.lit(0)) if mode == "add" else F.lit(0)
    changed = F.col("_changed").isNotNull()
    if mode == "replace":
        if days is None:
            replaced = delta.select("date").distinct().withColumn("_day", F.lit(True))
            both = both.join(replaced, "date", "left").filter(changed | F.col("_day").isNull())
        else:
            given = F.col("date").isin([dt.date.fromisoformat(str(day)) for day in days])
            both = both.filter(changed | ~F.coalesce(given, F.lit(False)))

    def pick(new: Column, old: str) -> Column:
        return F.when(changed, new).otherwise(F.col(old)).alias(old)

    columns = [
        F.col("s_id"),
        pick(F.col("_place.centroid_lon"), "centroid_lon"),
        pick(F.col("_place.centroid_lat"), "centroid_lat"),
        F.col("date"),
        pick((kept + F.col("_count")).cast("int"), "impact_count"),
    ]
    if set(_STAMPS) <= set(base.columns):
        stamp = F.current_timestamp() if now is None else now
        columns += [
            F.when(F.col("_known").isNull(), stamp).otherwise(F.col(name)).alias(name)
            for name in _STAMPS
        ]
    return both.select(*columns)


def append_conflicts(base: DataFrame, delta: DataFrame) -> DataFrame:
    """Keys that forbid appending `delta`: more than once in it, or already in `base`."""
    keys = list(FACT_KEY)
    copies = delta.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    stored = base.select(*keys, F.lit(True).alias("_stored"))
    return (
        copies.join(stored, keys, "left")
        .withColumn("stored", F.col("_stored").isNotNull())
        .filter((F.col("copies") > 1) | F.col("stored"))
        .select(*keys, "copies", "stored")
    )


def monthly_counts(fact: DataFrame) -> DataFrame:
    """Rows and impacts per month partition."""
    return fact.groupBy(F.trunc("date", "MM").alias("month")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("impact_count").alias("impacts")
    )
