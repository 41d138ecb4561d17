"""Impact anomalies: readings that stand out within their own trip."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from bumpwise.functions.predicates import usable_context
from bumpwise.functions.scoring import impact_score, standardized
from bumpwise.operators.keyed import attach_by_key
from bumpwise.options import ContextLimits, ImpactRule

# days are judged alone: a trip that spans two `dt` partitions is two groups
DAY_TRIP = ("dt", "trip_id")
SENSOR_CHANNELS = ("accel_z", "gyro_y")


def context_filter(readings: DataFrame, limits: ContextLimits = ContextLimits()) -> DataFrame:
    return readings.filter(usable_context(limits))


def trip_statistics(
    readings: DataFrame,
    keys: Sequence[str] = DAY_TRIP,
    columns: Sequence[str] = SENSOR_CHANNELS,
) -> DataFrame:
    """One row per trip: `n` and mean, sample deviation and extremes of each column.

    All of these aggregate partially before the shuffle, so a long trip costs one row per task.
    """
    measures = [F.count(F.lit(1)).alias("n")]
    for name in columns:
        measures += [
            F.avg(name).alias(f"mean_{name}"),
            F.stddev_samp(name).alias(f"std_{name}"),
            F.min(name).alias(f"min_{name}"),
            F.max(name).alias(f"max_{name}"),
        ]
    return readings.groupBy(*keys).agg(*measures)


def with_trip_statistics(
    readings: DataFrame,
    keys: Sequence[str] = DAY_TRIP,
    columns: Sequence[str] = SENSOR_CHANNELS,
) -> DataFrame:
    """Each reading with the `mean_*` and `std_*` of its trip.

    A window over the trip would put all its readings in one task; statistics joined back by
    key do not, however long the trip is.
    """
    wanted = [f"{measure}_{name}" for name in columns for measure in ("mean", "std")]
    statistics = trip_statistics(readings, keys, columns).select(*keys, "n", *wanted)
    return attach_by_key(readings, statistics, keys, weight="n").drop("n")


def z_score(
    readings: DataFrame,
    keys: Sequence[str] = DAY_TRIP,
    columns: Sequence[str] = SENSOR_CHANNELS,
) -> DataFrame:
    """Each reading with `nor_<column>`, standardized within its trip."""
    attached = with_trip_statistics(readings, keys, columns)
    return attached.select(*readings.columns, *_standardized_columns(columns))


def suspect_trips(
    readings: DataFrame,
    keys: Sequence[str] = DAY_TRIP,
    rule: ImpactRule = ImpactRule(),
    limits: ContextLimits = ContextLimits(),
) -> DataFrame:
    """Statistics of the trips that can have an anomaly at all.

    A trip whose extremes cannot reach the threshold is left out: rounding is monotonic, so the
    score of its extremes bounds the score of each of its readings.
    """
    statistics = trip_statistics(context_filter(readings, limits), keys, rule.columns)
    if all(weight >= 0 for _, weight in rule.weights):
        statistics = statistics.filter(_highest_possible_score(rule) > rule.threshold)
    wanted = [f"{measure}_{name}" for name in rule.columns for measure in ("mean", "std")]
    return statistics.select(*keys, "n", *wanted)


def detect_anomalies(
    readings: DataFrame,
    keys: Sequence[str] = DAY_TRIP,
    rule: ImpactRule = ImpactRule(),
    limits: ContextLimits = ContextLimits(),
    suspects: DataFrame | None = None,
    seen: Observation | None = None,
    found: Observation | None = None,
) -> DataFrame:
    """Usable readings whose impact score exceeds the threshold, with `nor_*` and the score.

    Statistics are taken after the context filter, and only `suspect_trips` are looked at; a job
    may store those first and pass them here, so that few of them are broadcast and the readings
    are not shuffled. `seen` and `found` count the usable and the anomalous rows (`n`) while the
    result is computed, without a job of their own.
    """
    usable = context_filter(readings, limits)
    columns = rule.columns
    statistics = suspect_trips(readings, keys, rule, limits) if suspects is None else suspects

    counted = usable if seen is None else usable.observe(seen, F.count(F.lit(1)).alias("n"))
    scored = (
        attach_by_key(counted, statistics, keys, weight="n", how="inner")
        .select(*readings.columns, *_standardized_columns(columns))
        .withColumn("impact_score", impact_score(rule))
    )
    anomalies = scored.filter(F.col("impact_score") > rule.threshold)
    return anomalies if found is None else anomalies.observe(found, F.count(F.lit(1)).alias("n"))


def _standardized_columns(columns: Sequence[str]) -> list[Column]:
    return [
        standardized(F.col(c), F.col(f"mean_{c}"), F.col(f"std_{c}")).alias(f"nor_{c}")
        for c in columns
    ]


def _highest_possible_score(rule: ImpactRule) -> Column:
    def bound(name: str) -> Column:
        mean, std = F.col(f"mean_{name}"), F.col(f"std_{name}")
        return F.greatest(
            F.abs(standardized(F.col(f"min_{name}"), mean, std)),
            F.abs(standardized(F.col(f"max_{name}"), mean, std)),
        )

    return reduce(Column.__add__, (bound(name) * F.lit(weight) for name, weight in rule.weights))
