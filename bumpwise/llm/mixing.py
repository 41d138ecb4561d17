"""Mixing sources to target weights by fitting word budgets with subset sums.

Each source has a budget in words. Whole passes over the source come first. What remains is
fitted on the histogram of exact document lengths: a floor of the same share of every length,
then the longest lengths that still fit, and for the rest a bounded-knapsack dynamic program over
the lengths that are left. The program says how many documents of each length to take; which ones
is decided by a seeded hash of the row.

Nulls: a null text has no words, a null source is a source of its own, ordered last. A document
without words is never taken. Repeated rows are documents of their own. An empty table gives an
empty result. Reruns agree, whatever the partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bumpwise.llm.common import stored, table, word_count

WEIGHTS = (1.0, 2.0, 3.0)
MOST_REPEATS = 3
SEED = "mix-1"
# the dynamic program fits what is left once the rest is below this many words
DP_WINDOW = 1 << 14
_SLICES = 1024


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """`source_key, source_size` -> with `target`: weighted shares, each at most 3 source sizes.

    Resharing the excess by weight until no source is above its cap ends at
    min(cap, level * weight) for the one level that uses up the total. Sources are few against
    rows, so the running sums over them are windows over one small table.
    """
    cycle = F.array(*[F.lit(float(weight)) for weight in weights])
    order = Window.orderBy(F.col("source_key.is_null"), F.encode(F.col("source_key.name"), "UTF-8"))
    place = (F.row_number().over(order) - 1) % len(weights) + 1
    every = Window.partitionBy()
    ratio_order = Window.orderBy("_ratio", "_place")
    upto = ratio_order.rowsBetween(Window.unboundedPreceding, -1)
    beyond = ratio_order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rows = (
        sizes.withColumn("_place", F.row_number().over(order))
        .withColumn("_weight", F.element_at(cycle, place.cast("int")))
        .withColumn("_cap", F.col("source_size").cast("double") * MOST_REPEATS)
        .withColumn("_ratio", F.col("_cap") / F.col("_weight"))
        .withColumn("_total", F.sum("source_size").over(every).cast("double"))
        .withColumn("_filled", F.coalesce(F.sum("_cap").over(upto), F.lit(0.0)))
        .withColumn("_open", F.sum("_weight").over(beyond))
        # the level if all sources before this one are at their cap and this and later ones are not
        .withColumn("_try", (F.col("_total") - F.col("_filled")) / F.col("_open"))
        .withColumn("_fits", F.col("_try") <= F.col("_ratio"))
        .withColumn("_level", F.min(F.when(F.col("_fits"), F.struct("_ratio", "_place", "_try"))).over(every)["_try"])
    )
    level = F.least(F.col("_cap"), F.col("_level") * F.col("_weight"))
    return rows.select("source_key", "source_size", F.coalesce(level, F.lit(0.0)).alias("target"))


def fit_counts(lengths: list[int], counts: list[int], budget: int) -> list[int]:
    """How many documents of each length to take, so that their words come nearest to `budget`.

    `lengths` are distinct and above zero. Never more than `counts`, and never above the budget.
    """
    total = sum(length * count for length, count in zip(lengths, counts, strict=True))
    if budget >= total:
        return list(counts)
    taken = [count * budget // total for count in counts]
    rest = budget - sum(length * n for length, n in zip(lengths, taken, strict=True))
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    for i in order:
        extra = min(counts[i] - taken[i], max(0, (rest - DP_WINDOW) // lengths[i]))
        taken[i] += extra
        rest -= extra * lengths[i]
    for i, extra in knapsack(lengths, [c - t for c, t in zip(counts, taken, strict=True)], rest):
        taken[i] += extra
    return taken


def knapsack(lengths: list[int], left: list[int], budget: int) -> list[tuple[int, int]]:
    """Bounded knapsack: (index, number) whose words are the largest sum not above `budget`.

    Copies are split into powers of two, reachable sums are the bits of one integer, and each sum
    remembers the first item that reached it. It stops once the budget itself is reached.
    """
    if budget <= 0:
        return []
    mask, reached, first = (1 << (budget + 1)) - 1, 1, {}
    for i in sorted(range(len(lengths)), key=lambda j: lengths[j]):
        most, part = min(left[i], budget // lengths[i]), 1
        while most > 0:
            n = min(part, most)
            new = ((reached << (n * lengths[i])) & mask) & ~reached
            reached |= new
            while new:
                low = new & -new
                first[low.bit_length() - 1] = (i, n)
                new ^= low
            most, part = most - n, part * 2
        if reached >> budget & 1:
            break
    at, chosen = reached.bit_length() - 1, []
    while at:
        i, n = first[at]
        chosen.append((i, n))
        at -= n * lengths[i]
    return chosen


def _fit_source(histogram: pd.DataFrame) -> pd.DataFrame:
    """The passes and picks of one source, from its histogram (one row per distinct length)."""
    histogram = histogram.sort_values("size")
    size, target = int(histogram["source_size"].iloc[0]), float(histogram["target"].iloc[0])
    passes = int(target // size) if size else 0
    rest = min(size, round(target - passes * size)) if size else 0
    picks = fit_counts(histogram["size"].tolist(), histogram["n"].tolist(), rest)
    return pd.DataFrame(
        {
            "source_key": histogram["source_key"],
            "size": histogram["size"],
            "passes": passes,
            "picks": picks,
        }
    )


def mix(
    documents: DataFrame,
    size: Column,
    weights: tuple[float, ...] = WEIGHTS,
    seed: str = SEED,
    carry: Sequence[str] = ("doc_id", "source"),
) -> DataFrame:
    """The columns `carry` of each row with `size, source_size, target, taken`, all in words.

    `size` counts the words of a row.
    """
    picked = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("source"), F.xxhash64("text"))
    rows = stored(
        documents.select(
            *carry,
            F.struct(F.col("source").isNull().alias("is_null"), F.coalesce("source", F.lit("")).alias("name")).alias("source_key"),
            size.alias("size"),
            picked.alias("_h"),
        ),
        "mix-rows",
    )
    slice_of = F.shiftrightunsigned("_h", 54).cast("int")
    sliced = stored(
        rows.groupBy("source_key", "size", slice_of.alias("_slice")).agg(F.count(F.lit(1)).alias("_n")),
        "mix-slices",
    )
    histogram = sliced.groupBy("source_key", "size").agg(F.sum("_n").alias("n"))
    sums = histogram.groupBy("source_key").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    plan = stored(targets(sums, weights), "mix-targets")
    fitted = stored(
        histogram.where("size > 0")
        .join(plan, "source_key")
        .groupBy("source_key")
        .applyInPandas(
            _fit_source,
            "source_key struct<is_null: boolean, name: string>, size long, passes int, picks long",
        ),
        "mix-picks",
    )
    # of the slices of a (source, length) in hash order: whole ones, then a part of one
    order = Window.partitionBy("source_key", "size").orderBy("_slice")
    before = F.coalesce(F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cut = (
        sliced.withColumn("_before", before)
        .join(fitted, ["source_key", "size"])
        .select(
            "source_key", "size", "_slice", "passes",
            F.greatest(F.lit(0), F.least(F.col("_n"), F.col("picks") - F.col("_before"))).alias("_from_slice"),
            "_n",
        )
    )
    placed = rows.withColumn("_slice", slice_of).join(
        cut, ["source_key", "size", "_slice"], "left"
    )
    whole = F.coalesce(F.col("_from_slice"), F.lit(0))
    settled = placed.where((whole == 0) | (whole == F.col("_n"))).withColumn(
        "_extra", F.when(whole > 0, 1).otherwise(0)
    )
    inside = Window.partitionBy("source_key", "size", "_slice").orderBy("_h", *[c for c in carry if c != "text"])
    split = placed.where((whole > 0) & (whole < F.col("_n"))).withColumn(
        "_extra", F.when(F.row_number().over(inside) <= F.col("_from_slice"), 1).otherwise(0)
    )
    copies = F.coalesce(F.col("passes"), F.lit(0)) + F.col("_extra")
    return (
        settled.unionByName(split)
        .join(plan, "source_key")
        .select(
            *carry,
            "size",
            F.col("source_size").cast("long").alias("source_size"),
            "target",
            (copies * F.col("size")).cast("long").alias("taken"),
        )
    )


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"), word_count(F.col("text")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")
