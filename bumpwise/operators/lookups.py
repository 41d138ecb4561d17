"""The dashboard's lookups on the daily facts.

Each is a plain filter. On the stored table a range of days reads its months only; a segment, a
viewport or a range of counts skips the row groups that cannot have any (see `write_fact`).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bumpwise.functions.predicates import in_any_box
from bumpwise.options import Box

Day = dt.date | str


def by_date_range(fact: DataFrame, first: Day, last: Day) -> DataFrame:
    return _in_months(fact, first, last).filter(F.col("date").between(_day(first), _day(last)))


def by_segment(fact: DataFrame, s_id: str) -> DataFrame:
    return fact.filter(F.col("s_id") == s_id)


def by_date_and_segment(fact: DataFrame, date: Day, s_id: str) -> DataFrame:
    return _in_months(fact, date, date).filter(
        (F.col("date") == _day(date)) & (F.col("s_id") == s_id)
    )


def in_viewport(fact: DataFrame, view: Box) -> DataFrame:
    return fact.filter(in_any_box([view], lon="centroid_lon", lat="centroid_lat"))


def with_impacts(fact: DataFrame, at_least: int, at_most: int | None = None) -> DataFrame:
    hit = F.col("impact_count") >= at_least
    return fact.filter(hit if at_most is None else hit & (F.col("impact_count") <= at_most))


def _in_months(fact: DataFrame, first: Day, last: Day) -> DataFrame:
    """On a table stored by `month`, read only the months asked for."""
    if "month" not in fact.columns:
        return fact
    return fact.filter(
        F.col("month").between(F.trunc(_day(first), "MM"), F.trunc(_day(last), "MM"))
    )


def _day(value: Day):
    return F.lit(str(value)).cast("date")
