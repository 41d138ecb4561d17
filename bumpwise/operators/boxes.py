"""Keeping the points inside monitored areas."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bumpwise.functions.predicates import in_any_box
from bumpwise.options import DEFAULT_BOXES, Box

_TILE_BITS = (10, 6, 2, -2)  # tiles with edges of 2**-bits degrees, small to large
_COORDINATES = ("min_lon", "max_lon", "min_lat", "max_lat")


def bbox_filter(points: DataFrame, boxes: Iterable[Box] = DEFAULT_BOXES) -> DataFrame:
    """Points in any of a few boxes, as a plain predicate."""
    return points.filter(in_any_box(boxes))


def bbox_semi_join(points: DataFrame, boxes: DataFrame) -> DataFrame:
    """Points in any box of a table (`min_lon, max_lon, min_lat, max_lat`), for many boxes.

    A box is cut into tiles about its own size, at most four unless it is larger than all tiles,
    so that a point only meets boxes near it, on equal tiles. Copies of a box count once, and a
    point in several boxes stays one point.
    """
    proper = (
        boxes.select(*_COORDINATES)
        .filter("min_lon <= max_lon AND min_lat <= max_lat")
        .distinct()
        .withColumn("_size", F.greatest(F.expr("max_lon - min_lon"), F.expr("max_lat - min_lat")))
    )
    tests = []
    for number, bits in enumerate(_TILE_BITS):
        scale = f"{2.0**bits!r}D"
        larger = f"_size > {2.0 ** -_TILE_BITS[number - 1]!r}D" if number else "true"
        smaller = f"_size <= {2.0**-bits!r}D" if bits != _TILE_BITS[-1] else "true"
        tests.append(
            f"""EXISTS (
  SELECT 1 FROM (
    SELECT *, explode(sequence(floor(min_lat * {scale}), floor(max_lat * {scale}))) AS _y FROM (
      SELECT *, explode(sequence(floor(min_lon * {scale}), floor(max_lon * {scale}))) AS _x
      FROM {{boxes}} WHERE {larger} AND {smaller})) b
  WHERE b._x = floor(p.lon * {scale}) AND b._y = floor(p.lat * {scale})
    AND p.lon BETWEEN b.min_lon AND b.max_lon AND p.lat BETWEEN b.min_lat AND b.max_lat)"""
        )
    return points.sparkSession.sql(
        "SELECT p.* FROM {points} p WHERE " + " OR ".join(tests), points=points, boxes=proper
    )
