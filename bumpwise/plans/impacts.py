"""The jobs from readings to repair priorities, composed from the operators."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from bumpwise.functions.predicates import valid_reading
from bumpwise.operators.boxes import bbox_filter
from bumpwise.operators.detect import DAY_TRIP, detect_anomalies, suspect_trips
from bumpwise.operators.facts import daily_segment_counts
from bumpwise.operators.marts import repair_priority_by_segment
from bumpwise.operators.nearest import SegmentIndex, nearest_segment
from bumpwise.options import DEFAULT_BOXES, Box, ContextLimits, ImpactRule, Ranges
from bumpwise.session import store
from bumpwise.sinks.tables import merge_into_fact, refresh_marts, write_anomalies
from bumpwise.sources.tables import read_anomalies, read_fact, scan_raw_partition


def monitored(
    sensor: DataFrame, ranges: Ranges = Ranges(), boxes: Iterable[Box] = DEFAULT_BOXES
) -> DataFrame:
    """Valid readings inside a monitored area."""
    return bbox_filter(sensor.filter(valid_reading(ranges)), boxes)


def map_impacts(anomalies: DataFrame, index: SegmentIndex) -> DataFrame:
    """The anomalies' places on the network. They are few, and stored before they are mapped,
    since mapping reads them more than once."""
    wanted = ("timestamp", "trip_id", "lon", "lat", "dt")
    places, _ = store(
        anomalies.select(*(name for name in wanted if name in anomalies.columns)), "places"
    )
    return nearest_segment(places, index)


def impact_counts(
    sensor: DataFrame,
    index: SegmentIndex,
    keys: Sequence[str] = DAY_TRIP,
    rule: ImpactRule = ImpactRule(),
    limits: ContextLimits = ContextLimits(),
) -> DataFrame:
    """Readings to impacts per segment and event day."""
    anomalies = detect_anomalies(monitored(sensor), keys, rule, limits)
    return daily_segment_counts(map_impacts(anomalies, index), date_from="dt")


def repair_priorities(
    sensor: DataFrame,
    index: SegmentIndex,
    as_of: dt.date | str,
    keys: Sequence[str] = DAY_TRIP,
    rule: ImpactRule = ImpactRule(),
) -> DataFrame:
    """Which segments to repair first, from readings alone."""
    return repair_priority_by_segment(impact_counts(sensor, index, keys, rule), as_of)


def run_detection(
    spark: SparkSession,
    raw_path: str,
    anomaly_path: str,
    day: str,
    rule: ImpactRule = ImpactRule(),
    limits: ContextLimits = ContextLimits(),
) -> dict[str, int]:
    """One day of readings to one day of anomalies; returns how many rows were seen and found.

    Two passes: the suspect trips from their few columns, then the readings of those trips. The
    counts are observed while the result is written.
    """
    seen, found = Observation(), Observation()
    rows = scan_raw_partition(spark, raw_path, day)
    suspects, _ = store(suspect_trips(rows, DAY_TRIP, rule, limits), "suspects")
    anomalies = detect_anomalies(rows, DAY_TRIP, rule, limits, suspects, seen, found)
    write_anomalies(anomalies, anomaly_path, day)
    return {"usable": seen.get.get("n", 0), "anomalies": found.get.get("n", 0)}


def run_mapping(
    spark: SparkSession,
    anomaly_path: str,
    index: SegmentIndex,
    fact_path: str,
    day: str,
    as_of: dt.date | str | None = None,
    mode: str = "add",
) -> dict[str, int]:
    """One day of anomalies into the daily facts, dated by the event day or by `as_of`.

    With `mode="replace"` the counts stand for the whole day, also if it has none left. Returns
    how many impacts were mapped, and how many have no segment or no readable day.
    """
    anomalies = read_anomalies(spark, anomaly_path).filter(F.col("dt") == day)
    mapped, _ = store(map_impacts(anomalies, index), "mapped")
    dated = {"date_from": "dt"} if as_of is None else {"as_of": as_of}
    days = [as_of or day] if mode == "replace" else None
    merge_into_fact(daily_segment_counts(mapped, **dated), fact_path, mode, days=days)
    readable = F.lit(True) if as_of is not None else F.col("dt").try_cast("date").isNotNull()
    counts = mapped.agg(
        F.count_if(F.col("s_id").isNotNull() & readable).alias("mapped"),
        F.count_if(F.col("s_id").isNull()).alias("unmapped"),
        F.count_if(F.col("s_id").isNotNull() & ~readable).alias("undated"),
    )
    return counts.first().asDict()


def run_serving(
    spark: SparkSession, fact_path: str, mart_path: str, as_of: dt.date | str | None = None
) -> DataFrame:
    """Rebuild the marts from the stored facts."""
    fact = read_fact(spark, fact_path)
    if fact is None:
        raise FileNotFoundError(f"no facts in {fact_path}")
    return refresh_marts(fact, mart_path, as_of)
