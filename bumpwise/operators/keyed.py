"""Joining a per-key table to rows when a few keys may hold most of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Keys served by broadcast. This bounds the broadcast, and any other key holds at most
# 1/HOT_KEYS of the rows, so no shuffle partition is dominated by one key.
HOT_KEYS = 4096
_SALTS = 1 << 20


def attach_by_key(
    rows: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    weight: str,
    how: str = "left",
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Add the columns of the `table` row with the same keys to each row, without key skew.

    `table` holds one row per key; `weight` is its column counting the rows of that key. The
    HOT_KEYS heaviest keys are broadcast and their rows are spread over the shuffle by a hash of
    `spread_by` (all columns unless given); the other rows meet `table` on the key itself, in a
    broadcast or a sort-merge join as Spark sees fit. NULL is a key like any other.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', not {how!r}")
    values = [name for name in table.columns if name not in keys]
    renamed = [F.col(name).alias(f"_key_{name}") for name in keys]
    hot = (
        table.orderBy(F.desc(weight), *keys)
        .limit(HOT_KEYS)
        .select(*renamed, F.struct(*values).alias("_hot"))
    )
    tagged = rows.join(F.broadcast(hot), _same_keys(keys), "left").drop(*_renamed(keys))
    tagged = tagged.withColumn(
        "_salt",
        F.when(F.col("_hot").isNull(), F.lit(0)).otherwise(
            F.pmod(F.xxhash64(*(spread_by or rows.columns)), F.lit(_SALTS)).cast("int") + 1
        ),
    )
    # weights are positive, so this is 0; written as a column so the salt stays a join key
    other = table.select(
        *renamed,
        F.least(F.col(weight), F.lit(0)).cast("int").alias("_key__salt"),
        F.struct(*values).alias("_other"),
    )
    joined = tagged.join(other, _same_keys([*keys, "_salt"]), "left")
    joined = joined.withColumn("_found", F.coalesce("_hot", "_other"))
    if how == "inner":
        joined = joined.filter(F.col("_found").isNotNull())
    return joined.select(*rows.columns, *(F.col(f"_found.{name}").alias(name) for name in values))


def _renamed(keys: Sequence[str]) -> list[str]:
    return [f"_key_{name}" for name in keys]


def _same_keys(keys: Sequence[str]) -> Column:
    return reduce(
        Column.__and__, (F.col(name).eqNullSafe(F.col(f"_key_{name}")) for name in keys)
    )
