"""Row predicates on sensor readings.

Each takes `field`, which maps a column name to a Column, so the same predicate serves a table
(`F.col`) and an element of an array of readings (`element.__getitem__`).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from bumpwise.options import Box, ContextLimits, Ranges

Field = Callable[[str], Column]


def valid_reading(ranges: Ranges = Ranges(), field: Field = F.col) -> Column:
    """All of lon, lat, velocity, accel and gyro in their closed ranges; NULL and NaN are not.

    Plain comparisons, so a filter by it reaches the Parquet scan.
    """
    limits = {"lon": ranges.lon, "lat": ranges.lat, "velocity": ranges.speed}
    limits |= {f"accel_{axis}": ranges.accel for axis in "xyz"}
    limits |= {f"gyro_{axis}": ranges.gyro for axis in "xyz"}
    tests = (field(name).between(low, high) for name, (low, high) in limits.items())
    return reduce(Column.__and__, tests)


def in_any_box(
    boxes: Iterable[Box], field: Field = F.col, lon: str = "lon", lat: str = "lat"
) -> Column:
    """Inside at least one box, edges included. No box, no point."""
    inside = [
        field(lon).between(box.min_lon, box.max_lon) & field(lat).between(box.min_lat, box.max_lat)
        for box in boxes
    ]
    return reduce(Column.__or__, inside) if inside else F.lit(False)


def usable_context(limits: ContextLimits = ContextLimits()) -> Column:
    """Fast enough, precise enough, enough satellites; pushed down to Parquet."""
    return (
        (F.col("velocity") > limits.min_velocity)
        & (F.col("hdop") <= limits.max_hdop)
        & (F.col("satellites") >= limits.min_satellites)
    )
