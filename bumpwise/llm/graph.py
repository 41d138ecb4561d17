"""Connected components of a table of links, by alternating star contraction.

Each round links the neighbours of a node to the smallest of them: first the larger ones (large
star), then the smaller ones (small star). The distances to the smallest node of a component shrink
until every node is linked to it and a round changes nothing. A round is one job whose result is
stored in the shared folder; no links come to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from bumpwise.llm.common import stored
from bumpwise.session import remove_path, work_path


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Links (a, b) with a < b -> the links of one star step.

    The neighbourhood of a node is never held together: its minimum is aggregated and joined back,
    over rows that are dealt out by node once.
    """
    turned = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    side = (links.unionByName(turned) if large else turned).repartition("a")
    least = side.groupBy("a").agg(F.min("b").alias("m"))
    kept = side.join(least, "a")
    if large:
        made = kept.where(F.col("b") > F.col("a")).select(F.least("m", "a").alias("a"), "b")
    else:
        # the smaller neighbours and the node itself go to the smallest of them
        own = F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b"))
        made = kept.select(F.col("m").alias("a"), own.alias("b"))
    return made.where("a < b").distinct()


def _marked(links: DataFrame) -> tuple[DataFrame, dict, str]:
    """A stored copy, its number of rows and a hash of them, taken while it was written, and its path."""
    seen, path = Observation(), work_path(links.sparkSession, "links")
    hashed = F.bit_xor(F.xxhash64("a", "b")).alias("hash")
    links.observe(seen, F.count(F.lit(1)).alias("n"), hashed).write.parquet(path)
    return links.sparkSession.read.schema(links.schema).parquet(path), dict(seen.get), path


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """`node, component` of all nodes in `links` (columns a, b, comparable values, no nulls).

    The component is the smallest node in it. Direction, repeats and self links do not matter.
    """
    ordered = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    own = ordered.where("a = b").select(F.col("a").alias("node")).distinct()
    own = stored(own, "alone")
    now, mark, path = _marked(ordered.where("a < b").distinct())
    for _ in range(most_rounds):
        last, done = mark, path
        if last["n"]:
            now, mark, path = _marked(_star(_star(now, True), False))
            remove_path(links.sparkSession, done)  # its round is over
        if mark == last:  # a round that changes nothing
            break
    else:
        raise RuntimeError("components did not settle")
    found = now.select(F.col("b").alias("node"), F.col("a").alias("component"))
    tops = now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    known = found.unionByName(tops)
    rest = own.join(known.select("node"), "node", "left_anti")
    return known.unionByName(rest.select("node", F.col("node").alias("component")))
