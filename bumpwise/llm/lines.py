"""Fuzzy line deduplication by MinHash, in native expressions only.

Lines (split at \\n, ASCII white space trimmed) are compared by the Jaccard similarity of their
character shingles. Equal lines are one node, named by a 64-bit hash. A node's signature is the
minima of `BANDS * ROWS` permutations (rotations and exclusive ors of one hash) over all its
shingles, by one rule for lines of any length and script. The shingles are dealt to `CLASSES` by
their hash, and a band's permutations put one class before all others, so a shingle counts for the
bands of its class alone; a line without shingles of a class has no bands of it. Different lines
are signed once each, from exploded shingles in generated code. Nodes that agree on a band are
candidates.

A band's nodes are not joined with each other at once: first each is compared with one of them,
links give components by distributed union-find, then the rest is compared across components. Two
nodes are first compared by sketches, bitmaps of their shingles' hashes: bits that only one of two
sketches has are shingles that the other lacks, which bounds the similarity from above. That loses
no link. What the bound leaves is verified exactly on all shingles. Across components the pairs
of a band are still met one by one, though only those within the bound become rows.

Of each component one line stays: that of the smallest (doc_id, place), ids that are null coming
last. Every other line of it is removed, also within a document.

Nulls: a null text has no lines and stays null. Lines without a word are never compared and stay.
Rows with equal id and text are one document and get one result. Texts are read whole. An empty
table gives an empty result. Other columns are kept as they are.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bumpwise.llm import sketch
from bumpwise.llm.common import WORD, fresh, stored, table, with_fixed
from bumpwise.llm.graph import components
from bumpwise.session import setting, store

SHINGLE = 9
PERCENT = 80
BANDS, ROWS = 8, 4
CLASSES = 4  # a power of two that divides BANDS
WIDE_WORDS = 64  # of 64 bits; a power of two
SEED = 7
GROUPS_BIT = 18  # signatures of a task, as a power of two, up to which they are kept in the faster map
SPACES = " \t\x0b\x0c\r"
BROADCAST_ROWS = 1_000_000  # of one or two numbers each


def _wide(line: Column) -> Column:
    """The line in four bytes a character, so that a shingle is cut out in constant time."""
    return F.encode(line, "UTF-32")


def _starts(wide: Column) -> Column:
    """The first bytes, from 1, of all overlapping shingles; a shorter line is one shingle."""
    return F.sequence(F.lit(1), F.greatest(F.lit(1), F.octet_length(wide) - (4 * SHINGLE - 1)), F.lit(4))


def _hashed(wide: Column, start: Column) -> Column:
    return F.xxhash64(F.substring(wide, start, F.lit(4 * SHINGLE)))


def _exploded(lines: DataFrame) -> DataFrame:
    """`node, h`: the hashes of all shingles of each line."""
    wide = lines.select("node", _wide(F.col("line")).alias("wide"))
    return wide.select("node", "wide", F.explode(_starts(F.col("wide"))).alias("start")).select(
        "node", _hashed(F.col("wide"), F.col("start")).alias("h")
    )


def _minima(hashed: Column) -> list[Column]:
    """One minimum per permutation; the rows of a band use rotations that are far apart."""
    draw, minima = random.Random(SEED), []
    for band in range(BANDS // CLASSES):
        for row in range(ROWS):
            turn, mask = 2 * band + 64 // ROWS * row, draw.getrandbits(31)
            turned = hashed
            if turn:
                turned = F.shiftleft(hashed, turn).bitwiseOR(F.shiftrightunsigned(hashed, 64 - turn))
            high = F.shiftright(turned, 32).cast("int").bitwiseXOR(F.lit(mask))
            minima.append(F.min(high).alias(f"m{band}_{row}"))
    return minima


def bands(lines: DataFrame) -> DataFrame:
    """`node, band` of lines (node, line), of which each node has one."""
    # classes by bits in the middle of the hash, sketches by its lowest ones
    signed = _exploded(lines).groupBy("node", F.shiftright("h", 20).bitwiseAND(F.lit(CLASSES - 1)).alias("class")).agg(*_minima(F.col("h")))
    keys = [
        F.xxhash64("class", F.lit(band), *[F.col(f"m{band}_{row}") for row in range(ROWS)])
        for band in range(BANDS // CLASSES)
    ]
    return signed.select("node", F.explode(F.array(*keys)).alias("band"))


def sketches(lines: DataFrame) -> DataFrame:
    """`node, n, bits, w0, w1, ...`: the number of shingles, repeats counted, and a bitmap of their
    hashes with the number of its bits."""
    counted = _exploded(lines).groupBy("node").agg(F.count(F.lit(1)).alias("n"), *sketch.bitmap("h"))
    return with_fixed(counted, {"bits": sketch.bits()})


def wide_sketches(lines: DataFrame) -> DataFrame:
    """`node, n, bits, words`: as `sketches`, of WIDE_WORDS words in one array."""
    word = F.shiftright("h", 6).bitwiseAND(F.lit(WIDE_WORDS - 1)).cast("int")
    by_word = _exploded(lines).groupBy("node", word.alias("word")).agg(
        F.count(F.lit(1)).alias("n"), F.bit_or(sketch.bit("h")).alias("held")
    )
    listed = by_word.groupBy("node").agg(
        F.sum("n").alias("n"), F.sum(F.bit_count("held")).alias("bits"), F.collect_list(F.struct("word", "held")).alias("held")
    )
    listed = with_fixed(listed, {"by_word": F.map_from_entries("held")})
    words = F.transform(F.sequence(F.lit(0), F.lit(WIDE_WORDS - 1)), lambda k: F.coalesce(F.try_element_at("by_word", k), F.lit(0).cast("long")))
    return listed.select("node", "n", "bits", words.alias("words"))


def _sketch(to: str) -> list[Column]:
    return [F.col(name).alias(f"{name}_{to}") for name in ("n", "bits", *sketch.NAMES)]


def _possible(x: str, y: str, both: Column) -> Column:
    """Whether sketches with so many bits in common leave two nodes similar enough: each bit that
    only one of them has is a shingle at least that the other lacks.

    At most `most` = both + least(n - bits) shingles are common, and the others are
    bits_x + bits_y - 2 * both at least; `both` is long, so it stands here once.
    """
    hidden = F.least(F.col(f"n_{x}") - F.col(f"bits_{x}"), F.col(f"n_{y}") - F.col(f"bits_{y}"))
    return both * (100 + PERCENT) >= (F.col(f"bits_{x}") + F.col(f"bits_{y}")) * PERCENT - hidden * (100 - PERCENT)


def _may_link(x: str, y: str) -> Column:
    return _possible(x, y, sketch.common(x, y))


def _lines(documents: DataFrame) -> DataFrame:
    """A row per line with a word: doc_id, the hash of the text, place, node, line."""
    placed = documents.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(F.split("text", "\n")).alias("place", "whole")
    )
    line = F.trim(F.col("whole"), F.lit(SPACES))
    return (
        placed.where(F.col("whole").rlike(WORD))
        .select("doc_id", "text_hash", "place", line.alias("line"))
        .withColumn("node", F.xxhash64("line"))
    )


def _linked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose shingles are similar enough."""
    side = lambda to: texts.select(F.col("node").alias(to), F.col("line").alias(f"line_{to}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    both = with_fixed(both.select("a", "b", "line_a", "line_b"), {f"wide_{to}": _wide(F.col(f"line_{to}")) for to in "ab"})

    def hashed(to: str) -> Column:
        # a variable of an outer lambda is read in place; a column of bytes is copied at each reading
        wide = F.col(f"wide_{to}")
        every = F.transform(F.array(wide), lambda held: F.transform(_starts(wide), lambda start: _hashed(held, start)))
        return F.array_distinct(F.get(every, F.lit(0)))

    both = with_fixed(both.select("a", "b", "wide_a", "wide_b"), {f"s_{to}": hashed(to) for to in "ab"})
    common = F.size(F.array_intersect("s_a", "s_b"))
    union = F.size("s_a") + F.size("s_b") - common
    return both.where(common.cast("long") * 100 >= union.cast("long") * PERCENT).select("a", "b")


def _within_bound(pairs: DataFrame, sketched: DataFrame) -> DataFrame:
    """The pairs (a, b) that their sketches leave possible."""
    side = lambda to: sketched.select(F.col("node").alias(to), *_sketch(to))
    return pairs.join(side("a"), "a").join(side("b"), "b").where(_may_link("a", "b")).select("a", "b")


def _within_wide_bound(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) that wider sketches leave possible; only nodes in a pair have one."""
    pairs = stored(pairs, "line-pairs")
    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))
    involved = _small(ends.distinct(), "line-paired")
    wide = stored(wide_sketches(texts.join(involved, "node", "left_semi")), "line-wide")
    side = lambda to: wide.select(F.col("node").alias(to), *[F.col(name).alias(f"{name}_{to}") for name in ("n", "bits", "words")])
    both = F.zip_with("words_a", "words_b", lambda p, q: F.bit_count(p.bitwiseAND(q)))
    both = F.aggregate(both, F.lit(0), lambda total, n: total + n)
    return pairs.join(side("a"), "a").join(side("b"), "b").where(_possible("a", "b", both)).select("a", "b")


def _small(frame: DataFrame, name: str) -> DataFrame:
    """A stored copy, sent to all executors if it has at most BROADCAST_ROWS rows.

    Larger ones are joined by a shuffle of both sides.
    """
    copy, n_rows = store(frame, name)
    return F.broadcast(copy) if n_rows <= BROADCAST_ROWS else copy


def _pair(x: str, y: str) -> tuple[Column, Column]:
    return F.least(x, y).alias("a"), F.greatest(x, y).alias("b")


def line_clusters(documents: DataFrame) -> DataFrame:
    """`node, component` of the lines that are similar to another, different line."""
    lines = _lines(documents)
    # equal lines become one before they move; all that follows is dealt by node already
    different = lines.groupBy("node").agg(F.min("line").alias("line"))
    # dealt out once, for the count and the join
    banded = bands(different).repartition("band")
    shared = banded.groupBy("band").agg(F.min("node").alias("leader"), F.max("node").alias("last")).where("leader < last")
    with setting(documents.sparkSession, "spark.sql.codegen.aggregate.fastHashMap.capacityBit", str(GROUPS_BIT)):
        candidates = stored(banded.join(shared.select("band", "leader"), "band"), "line-bands")
    involved = _small(candidates.select("node").distinct(), "line-involved")
    # one text per node; only nodes with a candidate
    texts = stored(
        lines.select("node", "line")
        .join(involved, "node", "left_semi")
        .groupBy("node")
        .agg(F.min("line").alias("line")),
        "line-texts",
    )
    sketched = stored(sketches(texts), "line-sketches")
    first = candidates.where("node != leader").select(*_pair("leader", "node")).distinct()
    links = stored(_linked(_within_bound(first, sketched), texts), "line-links")
    labels = stored(components(links), "line-components")

    placed = candidates.select("band", "node").join(labels, "node", "left")
    placed = placed.select("band", "node", F.coalesce("component", "node").alias("component"))
    mixed = placed.groupBy("band").agg(F.min("component").alias("l"), F.max("component").alias("h")).where("l < h")
    left = stored(placed.join(mixed.select("band"), "band").join(sketched, "node"), "line-open")
    x = left.select("band", F.col("node").alias("x"), F.col("component").alias("cx"), *_sketch("x"))
    y = left.select("band", F.col("node").alias("y"), F.col("component").alias("cy"), *_sketch("y"))
    met = x.alias("p").join(
        y.alias("q"), (F.col("p.band") == F.col("q.band")) & (F.col("cx") < F.col("cy")) & _may_link("x", "y")
    )
    rest = met.select(*_pair("x", "y")).distinct().join(first, ["a", "b"], "left_anti")
    more = stored(_linked(_within_wide_bound(rest, texts), texts), "line-links")
    if more.isEmpty():
        return labels
    return stored(components(links.unionByName(more)), "line-components")


def removed_lines(documents: DataFrame) -> DataFrame:
    """`doc_id, text_hash, place` of the lines to remove."""
    labels = line_clusters(documents)
    at = _lines(documents).select("doc_id", "text_hash", "place", "node").distinct()
    at = at.join(labels, "node", "left").select("doc_id", "text_hash", "place", F.coalesce("component", "node").alias("component"))
    at = stored(at, "line-places")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash", "place")
    kept = at.groupBy("component").agg(F.min(order).alias("kept"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return at.join(kept, "component").where(order != F.col("kept")).select("doc_id", "text_hash", "place")


def without_repeats(documents: DataFrame) -> DataFrame:
    """`documents` with their repeated lines removed, and `_n_lines`, `_n_removed`.

    Where `documents` has columns of these names, the new ones have one more underscore in front.
    """
    places, n_places = store(removed_lines(documents), "line-removed")
    taken = documents.columns
    key_id, key_hash, places_, split_ = (fresh(name, taken) for name in ("_key_id", "_key_hash", "_gone", "_split"))
    # a document's list is as long as its lines at most
    gone = places.groupBy(F.col("doc_id").alias(key_id), F.col("text_hash").alias(key_hash)).agg(
        F.collect_list("place").alias(places_)
    )
    gone = F.broadcast(gone) if n_places <= BROADCAST_ROWS else gone
    joined = documents.join(
        gone, F.col("doc_id").eqNullSafe(F.col(key_id)) & (F.xxhash64("text") == F.col(key_hash)), "left"
    )
    joined = with_fixed(joined, {split_: F.split("text", "\n")})
    worded = F.size(F.filter(split_, lambda line: line.rlike(WORD)))
    # linear in the lines, however many go
    kept = F.array_except(F.sequence(F.lit(0), F.size(split_) - 1), places_)
    kept = F.array_join(F.transform(kept, lambda place: F.get(split_, place)), "\n")
    text = F.when(F.col(places_).isNull(), F.col("text")).otherwise(kept)
    columns = [text.alias("text") if name == "text" else F.col(f"`{name}`") for name in taken]
    return joined.select(
        *columns,
        F.when(F.col("text").isNull(), 0).otherwise(worded).alias(fresh("_n_lines", taken)),
        F.when(F.col(places_).isNull(), 0).otherwise(F.size(places_)).alias(fresh("_n_removed", taken)),
    )


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    text = F.coalesce("text", F.lit("")).cast("binary")
    return cleaned.select(
        "doc_id",
        F.col("_n_lines").cast("long").alias("n_lines"),
        F.col("_n_removed").cast("long").alias("n_removed"),
        F.sha2(text, 256).alias("text_sha256"),
    )
