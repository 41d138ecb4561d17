"""Sharding by a hierarchical weighted hash tree.

A tree has regions, racks and shards. A row descends it: on each level every child draws an
exponential number from the hash of (level, child, key), divided by the child's weight, and the
smallest draw wins. A child is thus chosen in proportion to its weight, independent of its
siblings, so a change of weights moves rows only into or out of the subtrees whose weights changed.
A shard added as a region of its own takes rows only into itself.

Nulls: a null key is a key like any other, a null text has no bytes (its checksum is that of the
empty text). Equal keys, and so repeated rows, share a shard. Ties of draws go to the earlier child.
An empty table gives an empty result.
`place` returns its own columns only; `with_shard` keeps those of its input.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bumpwise.llm.common import fresh, stored, table

SHARDS = 24


@dataclass(frozen=True)
class Node:
    """A region, a rack or (without children) a shard; inner weights are the sums below."""

    name: str
    own_weight: float = 1.0
    children: tuple["Node", ...] = ()
    shard: int | None = None

    @property
    def weight(self) -> float:
        return sum(child.weight for child in self.children) if self.children else self.own_weight


def uniform_tree(regions: int = 2, racks: int = 3, shards: int = 4) -> Node:
    """A tree of equal shards, numbered from 0 in order."""
    number, top = 0, []
    for region in range(regions):
        middle = []
        for rack in range(racks):
            leaves = [
                Node(f"{region}/{rack}/{place}", 1.0, (), number + place) for place in range(shards)
            ]
            number += shards
            middle.append(Node(f"{region}/{rack}", 1.0, tuple(leaves)))
        top.append(Node(f"{region}", 1.0, tuple(middle)))
    return Node("root", 1.0, tuple(top))


def leaves(node: Node) -> list[Node]:
    return [leaf for child in node.children for leaf in leaves(child)] if node.children else [node]


def with_own_region(tree: Node, weight: float = 1.0) -> Node:
    """The tree with one more shard, in a rack and a region of its own."""
    name, number = str(len(tree.children)), max(leaf.shard for leaf in leaves(tree)) + 1
    shard = Node(f"{name}/0/0", weight, (), number)
    region = Node(name, 1.0, (Node(f"{name}/0", 1.0, (shard,)),))
    return Node(tree.name, tree.own_weight, (*tree.children, region))


def _levels(tree: Node) -> list[list[tuple[int, float, Node]]]:
    """Per level below the root: (place of the parent in the level above, weight, node)."""
    above, levels = [tree], []
    while any(node.children for node in above):
        if not all(node.children for node in above):
            raise ValueError("all shards must be equally deep")
        levels.append([(at, c.weight, c) for at, node in enumerate(above) for c in node.children])
        above = [node for _, _, node in levels[-1]]
    return levels


def with_shard(
    rows: DataFrame, tree: Node, key: Sequence[str], shard: str, seed: int = 0
) -> DataFrame:
    """`rows` with the shard of their key: on each level one draw per child of the node reached.

    A draw is -ln(u) / weight, with u in (0, 1) from 53 bits of the hash of child and key.
    """
    steps = fresh("_at", rows.columns)
    rows = rows.withColumn(at := f"{steps}0", F.lit(0))
    for depth, level in enumerate(_levels(tree)):
        children: dict[int, list[tuple[int, float, str]]] = {}
        for place, (parent, weight, node) in enumerate(level):
            if weight < 0 or not math.isfinite(weight):
                raise ValueError(f"weight of {node.name} must be finite and not below zero")
            children.setdefault(parent, []).append((place, weight, node.name))
        if any(sum(weight for _, weight, _ in group) <= 0 for group in children.values()):
            raise ValueError("a node needs a child with a weight above zero")
        draws = []
        for nth in range(max(map(len, children.values()))):
            # the nth child of whichever node was reached: its place, weight and name
            mine = [group[nth] if nth < len(group) else (0, 0.0, "") for _, group in sorted(children.items())]
            places, weights, names = (F.array(*map(F.lit, column)) for column in zip(*mine, strict=True))
            index = F.col(at) + 1
            weight = F.element_at(weights, index)
            named = F.concat(F.lit(f"{seed}:"), F.element_at(names, index))
            bits = F.shiftrightunsigned(F.xxhash64(named, *key), 11)
            draw = -F.log((bits.cast("double") + 0.5) / F.lit(2.0**53)) / weight
            draws.append(F.when(weight > 0, F.struct(draw, F.element_at(places, index).alias("place"))))
        best = F.array_min(F.array(*draws)) if len(draws) > 1 else draws[0]
        rows = rows.withColumn(f"{steps}{depth + 1}", best["place"]).drop(at)
        at = f"{steps}{depth + 1}"
    numbers = F.array(*[F.lit(leaf.shard) for leaf in leaves(tree)])
    return rows.withColumn(shard, F.element_at(numbers, F.col(at) + 1).cast("int")).drop(at)


def numbered(rows: DataFrame, by: str, order: list[str], slot: str) -> DataFrame:
    """Gapless numbers from 0 within `by`, without bringing a value's rows into one task.

    The rows are stored with the number of the task that wrote them; each (value, task) is ordered
    by itself, and starts at the sum of the counts of the tasks before it.
    """
    parted = stored(rows.withColumn("_task", F.spark_partition_id()), "shard-rows")
    counts = parted.groupBy(by, "_task").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(by).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(by, "_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_at"))
    inside = Window.partitionBy(by, "_task").orderBy(*order)
    placed = parted.withColumn("_in", F.row_number().over(inside) - 1)
    joined = placed.join(starts, [by, "_task"])
    return joined.withColumn(slot, (F.col("_at") + F.col("_in")).cast("long")).drop(
        "_task", "_n", "_at", "_in"
    )


def place(
    documents: DataFrame, tree: Node, grown: Node | None = None, seed: int = 0
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for each row of `documents`.

    Law `key`: doc_id and the tree decide. `slot` numbers the rows of a shard from 0.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = documents.select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    rows = with_shard(rows, tree, ["doc_id"], "shard", seed)
    if grown:
        rows = with_shard(rows, grown, ["doc_id"], "grown_shard", seed)
    else:
        rows = rows.withColumn("grown_shard", F.lit(None).cast("int"))
    return numbered(rows, "shard", ["doc_id", "text_crc32", "size"], "slot").select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = uniform_tree()
    if len(leaves(tree)) != SHARDS:
        raise ValueError("the default tree must hold the shards of the contract")
    return place(table(spark, sf_dir, "documents"), tree, with_own_region(tree))
