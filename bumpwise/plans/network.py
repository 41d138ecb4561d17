"""The job from road links to road segments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bumpwise.functions.geodesy import TransverseMercator
from bumpwise.operators.roads import (
    SEGMENT_LENGTH,
    filter_links,
    links_in_metres,
    segment_endpoints,
    split_links,
)


def build_segments(
    links: DataFrame,
    column: str | None = None,
    value: object = None,
    length: float = SEGMENT_LENGTH,
    grid: TransverseMercator = TransverseMercator(),
    skip_unreadable: bool = False,
    in_degrees: bool = False,
) -> DataFrame:
    """Links (`pts` in metres) to WGS84 segments, optionally only links with an attribute.

    With `in_degrees` the points are lon and lat; they are brought to the grid, cut there and
    brought back.

    A link without a readable line is an error unless `skip_unreadable` (`unreadable_links` tells
    which those are).
    """
    chosen = links if column is None else filter_links(links, column, value)
    if in_degrees:
        chosen = links_in_metres(chosen, grid)
    if skip_unreadable:
        chosen = chosen.filter(F.col("pts").isNotNull())
    return segment_endpoints(split_links(chosen, length), grid)
