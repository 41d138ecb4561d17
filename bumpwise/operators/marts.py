"""The marts: what the dashboard shows, each derived from the daily facts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bumpwise.functions.scoring import priority_score, risk_level
from bumpwise.options import RiskLevels

WINDOW_DAYS = 30  # fixed value
TREND_ROWS = 7  # fixed value


def context(fact: DataFrame, levels: RiskLevels = RiskLevels()) -> DataFrame:
    """Every segment-day with its risk level, newest first."""
    return fact.select(
        "s_id", "centroid_lon", "centroid_lat", "date", "impact_count",
        risk_level(F.col("impact_count"), levels).alias("risk_level"),
    ).orderBy(F.desc("date"), "s_id")


def daily_summary(fact: DataFrame, levels: RiskLevels = RiskLevels()) -> DataFrame:
    """Segments and impacts per day, newest first."""
    count = F.col("impact_count")
    warning = (count > levels.warning_above) & (count <= levels.critical_above)
    return (
        fact.groupBy("date")
        .agg(
            F.count_distinct("s_id").alias("affected_segments"),
            F.sum(count).alias("total_impacts"),
            F.count_if(count > levels.critical_above).alias("critical_segments"),
            F.count_if(warning).alias("warning_segments"),
            F.min(count).alias("min_impacts"),
            F.max(count).alias("max_impacts"),
            F.round(F.avg(count), 2).alias("avg_impacts"),
        )
        .orderBy(F.desc("date"))
    )


def repair_priority(fact: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """Segments by urgency over the last 30 days, one row per segment and coordinate."""
    recent = _recent(fact, as_of)
    return (
        recent.groupBy("s_id", "centroid_lon", "centroid_lat")
        .agg(*_priority_measures())
        .select("s_id", "centroid_lon", "centroid_lat", *_PRIORITY_COLUMNS, _priority())
        .orderBy(F.desc("priority_score"), "s_id")
    )


def repair_priority_by_segment(fact: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """`repair_priority` with one row per segment, at its latest coordinate."""
    recent = _recent(fact, as_of)
    latest = F.max(F.struct("date", "centroid_lon", "centroid_lat")).alias("_latest")
    return (
        recent.groupBy("s_id")
        .agg(*_priority_measures(), latest)
        .select(
            "s_id",
            F.col("_latest.centroid_lon").alias("centroid_lon"),
            F.col("_latest.centroid_lat").alias("centroid_lat"),
            *_PRIORITY_COLUMNS,
            _priority(),
        )
        .orderBy(F.desc("priority_score"), "s_id")
    )


def top_priorities(
    fact: DataFrame, n: int = 20, as_of: dt.date | str | None = None
) -> DataFrame:
    """The `n` most urgent segments."""
    return repair_priority_by_segment(fact, as_of).limit(n)


def segment_trend(fact: DataFrame) -> DataFrame:
    """Each segment-day with the mean of its last 7 rows and the change from 7 rows before.

    Rows count, not days. (s_id, date) is the fact's key, so a window holds one row per day of
    history however the impacts are spread.
    """
    by_date = Window.partitionBy("s_id").orderBy("date")
    last_rows = by_date.rowsBetween(1 - TREND_ROWS, Window.currentRow)
    count = F.col("impact_count")
    return fact.select(
        "s_id", "centroid_lon", "centroid_lat", "date", "impact_count",
        F.round(F.avg(count).over(last_rows), 2).alias("rolling_7d_avg"),
        (count - F.lag(count, TREND_ROWS).over(by_date)).alias("week_over_week_change"),
    ).orderBy("s_id", F.desc("date"))


_PRIORITY_COLUMNS = (
    "total_impacts", "avg_daily_impacts", "detected_days", "first_detected", "last_detected",
)


def _recent(fact: DataFrame, as_of: dt.date | str | None) -> DataFrame:
    """Facts on or after the day 30 days before `as_of`; later days have no limit.

    On the stored table the month is compared too, so older partitions are not read.
    """
    day = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    first = F.date_sub(day, WINDOW_DAYS)
    recent = fact.filter(F.col("date") >= first)
    return recent.filter(F.col("month") >= F.trunc(first, "MM")) if "month" in fact.columns else recent


def _priority_measures() -> list[Column]:
    return [
        F.sum("impact_count").alias("total_impacts"),
        F.round(F.avg("impact_count"), 2).alias("avg_daily_impacts"),
        F.count_distinct("date").alias("detected_days"),
        F.min("date").alias("first_detected"),
        F.max("date").alias("last_detected"),
    ]


def _priority() -> Column:
    return priority_score(F.col("total_impacts"), F.col("detected_days")).alias("priority_score")
