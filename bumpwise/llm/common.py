"""Readers and small expressions that the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bumpwise.session import store

# fixed value: a word is a run of anything but ASCII white space
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame, name: str) -> DataFrame:
    """A copy in the shared folder: cuts the lineage and survives lost executors."""
    return store(frame, name)[0]


def fold(id_column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % folds


def lowered(text: Column) -> Column:
    """A-Z in lower case; every other character stays."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(text, upper, lower)


def word_count(text: Column) -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fresh(name: str, taken: list[str]) -> str:
    """`name`, with underscores before it until it clashes with no column of `taken`."""
    lower = {column.lower() for column in taken}
    while name.lower() in lower:
        name = f"_{name}"
    return name


def with_fixed(frame: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """`frame` with new columns that are computed once per row.

    They come from a generator of one row, so the optimizer neither inlines them where they are
    used (an array inlined into a lambda is built again for each element) nor pushes filters on
    them below their making.
    """
    made = F.struct(*[column.alias(name) for name, column in columns.items()])
    return frame.select("*", F.inline(F.array(made)))
