"""N-gram Jaccard join by grouped prefixes.

A document's set holds the distinct shingles of its words, as 64-bit hashes. Documents with equal
sets are one node. In the order (number of nodes that have the shingle, hash) two linked sets share
a shingle among the first of each (the prefix). Shingles that only one node has come first and can
match nothing, so they are counted but never leave the first step:

1. A set in which more shingles than a link leaves unmatched are its own links with nothing. Own
   shingles are counted in a share of the hashes first: a set that has too many there is done, and
   the text of no other document than the remaining ones is looked at again.
2. The remaining sets are split by hash into buckets, packed, and shuffled once. A bucket counts its
   shingles and returns those that at least two nodes have. All later steps work on these alone: they
   suffice for prefixes and for exact intersections. Of a hash the bucket's bits and 48 more are kept.
3. Nodes whose prefix has no shared shingle are done. Nodes with the same shared prefix and size
   are one group, and groups are joined on the shingles of their prefixes, with the size filter and
   the positional bound.
4. No list of groups is joined with itself at once. First the groups of the longest lists are
   compared with one group of the list, drawn by hash, and members with one member; the links found give components. Then
   the remaining candidates between different components are compared, each pair once: by sketches,
   bitmaps of the shared shingles, which bound the similarity from above, then exactly. Links
   inside a component cannot change the answer, so none that matters is left out.

Nulls: a null text, like a text without words, has the empty set and links with nothing. Fewer
words than a shingle make one shingle of all of them. A null id takes part; its component is the
smallest id that is not null. Repeated rows share their component. Texts are read whole. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, GroupedData, SparkSession
from pyspark.sql import functions as F

from bumpwise.llm import sketch
from bumpwise.llm.common import fresh, stored, table, with_fixed
from bumpwise.llm.graph import components
from bumpwise.llm.texts import lowered_texts
from bumpwise.session import store

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_CHUNK_BYTES = 1 << 20
_BYTES_PER_BUCKET = 1 << 23
_KEPT_BYTES = 6  # of a shingle's hash, after the bits that its bucket tells
_BROADCAST_ROWS = 1_000_000  # of one number each
_SAMPLED = 1.5  # times the share that a link may leave unmatched: the share of the hashes of the first step
_LED = 4  # most frequent shingles of a prefix whose lists are compared with one member first


@dataclass(frozen=True)
class Similarity:
    words: int = 4
    percent: int = 85


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingle_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    split = pc.ascii_split_whitespace(lowered_texts(texts))
    flat = split.flatten()
    # positions of the texts' words after the empty ones (at a text's edges) are dropped
    offsets = split.offsets.to_numpy()
    real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    edges = np.concatenate(([0], np.cumsum(real)))[offsets - offsets[0]]
    flat = flat.filter(pa.array(real))
    coded = flat.dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    values = hashes[coded.indices.to_numpy(zero_copy_only=False)] if len(coded) else np.empty(0, np.uint64)
    windows = np.zeros(max(0, len(values) - words + 1), np.uint64)
    for step in range(words):
        windows = windows * _MULTIPLIER + values[step : step + len(windows)]
    windows = _mixed(windows)
    sets = []
    for start, end in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        if end - start >= words:
            sets.append(np.unique(windows[start : end - words + 1]))
        elif end > start:
            short = np.uint64(end - start)
            for value in values[start:end]:
                short = np.uint64((int(short) * int(_MULTIPLIER) + int(value)) & 0xFFFFFFFFFFFFFFFF)
            sets.append(_mixed(np.array([short])))
        else:
            sets.append(np.empty(0, np.uint64))
    return sets


def _pieces(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Slices with at most about _CHUNK_BYTES of text, whole rows each."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(lengths) // _CHUNK_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts[:-1], cuts[1:], strict=True):
            if end > start:
                yield batch.slice(start, end - start)


def _name(shingles: np.ndarray) -> int:
    """The node of a set: a 64-bit digest of its sorted shingles."""
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes()))))


def _nodes(words: int, keep: list[str]) -> Callable:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches, "_text"):
            sets = shingle_sets(batch.column("_text"), words)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(name) for name in keep],
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_name(s) if len(s) else None for s in sets], pa.int64()),
                ],
                [*keep, "n_shingles", "node"],
            )

    return work


def _packed(words: int, bits: int, share: float = 1) -> Callable:
    """(bucket, nodes, sizes, counts, shingles): the sets of a piece, split by the first bits.

    Of the shingles only those in the first `share` of all hashes; sizes are those of whole sets.
    """
    last = np.uint64(int(min(share, 1) * 0xFFFF) << 48 | 0xFFFFFFFFFFFF)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches, "_text"):
            sets = {_name(s): s for s in shingle_sets(batch.column("_text"), words) if len(s)}
            names, whole = np.array(list(sets), np.int64), np.array([len(s) for s in sets.values()], np.int64)
            kept = [s[: np.searchsorted(s, last, "right")] for s in sets.values()]
            sizes = np.array([len(s) for s in kept], np.int64)
            shingles = np.concatenate([np.empty(0, np.uint64), *kept])
            # in the order of bucket and owner; the cost does not depend on the number of buckets
            bucket = shingles >> np.uint64(64 - bits)
            order = np.argsort(bucket, kind="stable")
            shingles, bucket = shingles[order], bucket[order]
            owner = np.repeat(np.arange(len(names)), sizes)[order]
            told = (shingles << np.uint64(bits)) >> np.uint64(64 - _kept_bits(bits))
            told = told.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_KEPT_BYTES]
            new_bucket = np.concatenate(([True], bucket[1:] != bucket[:-1]))[: len(bucket)]
            runs = np.flatnonzero(new_bucket | np.concatenate(([True], owner[1:] != owner[:-1]))[: len(bucket)])
            counts = np.diff(np.concatenate((runs, [len(bucket)])))
            starts = np.flatnonzero(new_bucket)
            ends = np.concatenate((starts[1:], [len(bucket)]))[: len(starts)]
            spans = np.searchsorted(runs, starts), np.searchsorted(runs, ends)
            rows = [
                (int(bucket[start]), names[owner[runs[a:b]]].tobytes(), whole[owner[runs[a:b]]].astype("<i4").tobytes(),
                 counts[a:b].astype("<i4").tobytes(), told[start:end].tobytes())
                for start, end, a, b in zip(starts.tolist(), ends.tolist(), *(x.tolist() for x in spans), strict=True)
            ]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["bucket", "nodes", "sizes", "counts", "shingles"],
            )

    return work


def _kept_bits(bits: int) -> int:
    """Of a hash, the bits that are kept after the `bits` that tell the bucket."""
    return min(8 * _KEPT_BYTES, 64 - bits)


def _counted(bucket: pa.Table) -> tuple[np.ndarray, ...]:
    """nodes and sizes of a bucket; its shingles in order, whose they are, and how many nodes have
    each different one."""
    joined = lambda name, kind: np.frombuffer(b"".join(bucket.column(name).to_pylist()), kind)
    nodes, sizes, counts = joined("nodes", np.int64), joined("sizes", "<i4"), joined("counts", "<i4")
    packed = joined("shingles", np.uint8).reshape(-1, _KEPT_BYTES)
    shingles = np.zeros((len(packed), 8), np.uint8)
    shingles[:, :_KEPT_BYTES] = packed
    shingles = shingles.view("<u8").ravel()
    first = np.zeros(len(nodes), bool)  # a node that came from several pieces counts once
    first[np.unique(nodes, return_index=True)[1]] = True
    kept = np.repeat(first, counts)
    shingles, owner = shingles[kept], np.repeat(np.flatnonzero(first), counts[first])
    order = np.argsort(shingles)
    shingles, owner = shingles[order], owner[order]
    starts = np.flatnonzero(np.concatenate(([True], shingles[1:] != shingles[:-1])))
    df = np.diff(np.concatenate((starts, [len(shingles)])))
    return nodes, sizes, shingles, owner, df


def _own(bits: int) -> Callable:
    """(part, nodes, sizes, own): of the bucket's nodes, how many shingles no other node has, if any,
    packed by the first bits of the nodes' names: a row per part, not one per node."""

    def work(bucket: pa.Table) -> pa.Table:
        nodes, sizes, _, owner, df = _counted(bucket)
        own = np.bincount(owner[np.repeat(df, df) == 1], minlength=len(nodes))
        some = np.flatnonzero(own)
        part = (nodes[some].view(np.uint64) >> np.uint64(64 - bits)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        some, part = some[order], part[order]
        starts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))[: len(part)])
        cut = lambda x, kind: pa.array([piece.astype(kind).tobytes() for piece in np.split(x, starts[1:])] if len(x) else [], pa.binary())
        columns = [pa.array(part[starts]), cut(nodes[some], "<i8"), cut(sizes[some], "<i4"), cut(own[some], "<i4")]
        return pa.table(columns, ["part", "nodes", "sizes", "own"])

    return work


def _done(percent: int) -> Callable:
    """(node): of a part's nodes, those with more shingles of their own than a link leaves unmatched."""

    def work(part: pa.Table) -> pa.Table:
        joined = lambda name, kind: np.frombuffer(b"".join(part.column(name).to_pylist()), kind)
        nodes, first, which = np.unique(joined("nodes", "<i8"), return_index=True, return_inverse=True)
        sizes = joined("sizes", "<i4")[first].astype(np.int64)
        own = np.bincount(which, joined("own", "<i4"), len(nodes))
        return pa.table({"node": pa.array(nodes[own >= sizes - (sizes * percent + 99) // 100 + 1])})

    return work


def _shared(bits: int) -> Callable:
    """(node, size, shingle, df) of a bucket's shingles that at least two nodes have."""

    def work(bucket: pa.Table) -> pa.Table:
        nodes, sizes, shingles, owner, df = _counted(bucket)
        several = np.repeat(df, df) > 1
        owner = owner[several]
        shingles |= np.uint64(bucket.column("bucket")[0].as_py()) << np.uint64(_kept_bits(bits))
        return pa.table(
            {
                "node": pa.array(nodes[owner]),
                "size": pa.array(sizes[owner].astype(np.int32)),
                "shingle": pa.array(shingles[several].view(np.int64)),
                "df": pa.array(np.repeat(df, df)[several].astype(np.int32)),
            }
        )

    return work


def _prefix(size: Column, percent: int) -> Column:
    """size - ceil(percent / 100 * size) + 1."""
    return size - F.floor((size * percent + 99) / F.lit(100)) + 1


def _fits(a: str, b: str, percent: int) -> Column:
    return (F.least(F.col(a), F.col(b)) * 100) >= (F.greatest(F.col(a), F.col(b)) * percent)


def sketches(nodes: DataFrame) -> DataFrame:
    """`node, size, n, bits, w0, w1, ...`: sizes, numbers of shared shingles, and their bitmaps with
    the numbers of their bits."""
    listed = nodes.select("node", "size", F.explode("shared").alias("shingle"))
    counted = listed.groupBy("node", "size").agg(F.count(F.lit(1)).alias("n"), *sketch.bitmap("shingle"))
    return with_fixed(counted, {"bits": sketch.bits()})


def _may_link(x: str, y: str, percent: int, counted: bool = False) -> Column:
    """Whether sketches leave two nodes similar enough: a bit that only one of them has is a shingle
    at least that the other lacks. With `counted`, columns named bits_x, bits_y hold their bits."""
    hidden = lambda to: F.col(f"n_{to}") - (F.col(f"bits_{to}") if counted else sketch.bits(f"_{to}"))
    most = sketch.common(x, y) + F.least(hidden(x), hidden(y))
    return most * (100 + percent) >= (F.col(f"size_{x}") + F.col(f"size_{y}")) * percent


def _linked(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose sets are similar enough, by exact intersection.

    Only the sets of nodes in a pair are moved, and dealt out once for both sides.
    """
    pairs = stored(pairs, "jaccard-pairs")
    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))
    involved, n_involved = store(ends.distinct(), "jaccard-involved")
    involved = F.broadcast(involved) if n_involved <= _BROADCAST_ROWS else involved
    sets = nodes.select("node", "size", "shared").join(involved, "node", "left_semi").repartition("node")
    side = lambda to: sets.select(F.col("node").alias(to), F.col("size").alias(f"size_{to}"), F.col("shared").alias(f"shared_{to}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    common = F.size(F.array_intersect("shared_a", "shared_b")).cast("long")
    union = F.col("size_a") + F.col("size_b") - common
    return both.where(common * 100 >= union * percent).select("a", "b")


def _bits(text_bytes: int) -> int:
    """Of the number of buckets for so much text."""
    return max(4, (max(1, text_bytes // _BYTES_PER_BUCKET) - 1).bit_length())


def _buckets(texts: DataFrame, words: int, bits: int, share: float = 1) -> GroupedData:
    shape = "bucket int, nodes binary, sizes binary, counts binary, shingles binary"
    return texts.mapInArrow(_packed(words, bits, share), shape).groupBy("bucket")


def open_texts(documents: DataFrame, placed: DataFrame, how: Similarity, text_bytes: int) -> tuple[DataFrame, int]:
    """The texts whose sets may link with another one, and about how many bytes they have.

    `placed` has `_key`, the hash of the text, `node` and `n_shingles` of all documents. Texts that
    go have more shingles of their own than a link leaves unmatched, and no other set needs them.
    """
    share = _SAMPLED * (100 - how.percent) / 100
    texts, left = documents.select(F.col("text").alias("_text")), placed.where("n_shingles > 0")
    if share < 1:
        bits = _bits(text_bytes)
        shape = "part int, nodes binary, sizes binary, own binary"
        own = _buckets(texts, how.words, bits, share).applyInArrow(_own(bits), shape)
        done = own.groupBy("part").applyInArrow(_done(how.percent), "node long")
        left = left.join(done, "node", "left_anti")
    keys, n_keys = store(left.groupBy("_key").agg(F.sum("n_shingles").alias("n")), "jaccard-open")
    part = (keys.agg(F.sum("n")).first()[0] or 0) / (placed.agg(F.sum("n_shingles")).first()[0] or 1)
    keys = F.broadcast(keys.select("_key")) if n_keys <= _BROADCAST_ROWS else keys.select("_key")
    return texts.join(keys, F.xxhash64("_text") == F.col("_key"), "left_semi"), int(text_bytes * part)


def similar_nodes(documents: DataFrame, placed: DataFrame, how: Similarity, text_bytes: int) -> DataFrame:
    """`node, component` of the nodes that link with another one; `placed` as for `open_texts`."""
    texts, text_bytes = open_texts(documents, placed, how, text_bytes)
    bits = _bits(text_bytes)
    shared = _buckets(texts, how.words, bits).applyInArrow(_shared(bits), "node long, size int, shingle long, df int")
    # a node's list is as long as its document at most
    listed = shared.groupBy("node", "size").agg(F.sort_array(F.collect_list(F.struct("df", "shingle"))).alias("ordered"))
    alone = F.col("size") - F.size("ordered")
    reach = _prefix(F.col("size"), how.percent) - alone
    nodes = stored(
        listed.where(reach > 0).select(
            "node",
            "size",
            alone.alias("alone"),
            F.transform("ordered", lambda x: x["shingle"]).alias("shared"),
            F.transform(F.slice("ordered", F.lit(1), reach.cast("int")), lambda x: x["shingle"]).alias("prefix"),
        ),
        "jaccard-nodes",
    )
    # equal (size, shared prefix): one group, named by its smallest node
    grouped = nodes.groupBy("size", "alone", "prefix").agg(F.min("node").alias("group"))
    members = stored(
        nodes.select("node", "size", "alone", "prefix").join(grouped, ["size", "alone", "prefix"]).select("node", "group"),
        "jaccard-members",
    )
    groups = stored(grouped, "jaccard-groups")
    postings = groups.select("group", "size", "alone", "prefix", F.posexplode("prefix").alias("place", "shingle"))
    ends = lambda to: postings.select(
        "shingle", F.col("group").alias(to), F.col("size").alias(f"size_{to}"),
    )
    total = F.col("size_a") + F.col("size_b")
    needed = F.floor((total * how.percent + 99 + how.percent) / F.lit(100 + how.percent))
    filtered = _fits("size_a", "size_b", how.percent) & (F.least("rest_a", "rest_b") >= needed)

    drawn = F.struct(F.xxhash64("group", "shingle").alias("h"), "group", "size", "alone", "place")
    led = postings.where(F.col("place") >= F.size("prefix") - _LED)
    leaders = led.groupBy("shingle").agg(F.min(drawn).alias("l"), F.count(F.lit(1)).alias("n")).where("n > 1")
    leaders = leaders.select(
        "shingle", F.col("l.group").alias("a"), F.col("l.size").alias("size_a"),
        (F.col("l.size") - F.col("l.alone") - F.col("l.place")).alias("rest_a"),
    )
    first = ends("b").join(leaders, "shingle").where((F.col("a") != F.col("b")) & _fits("size_a", "size_b", how.percent))
    first = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    in_b = members.select(F.col("group").alias("b"), F.col("node").alias("y"))
    in_a = members.select(F.col("group").alias("a"), F.col("node").alias("x"))
    pair = lambda x, y: (F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
    stars = (
        first.join(in_b, "b").select(*pair("a", "y"))
        .unionByName(first.join(in_a, "a").select(*pair("x", "b")))
        .unionByName(members.where("node != group").select(*pair("node", "group")))
        .where("a != b")
        .distinct()
    )
    links = stored(_linked(stars, nodes, how.percent), "jaccard-links")
    labels = stored(components(links), "jaccard-components")

    # what is left: pairs between different components
    placed = stored(
        members.join(labels, "node", "left").select("node", "group", F.coalesce("component", "node").alias("component")),
        "jaccard-placed",
    )
    spans = placed.groupBy("group").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    # with the shingles of the prefix before each place
    spread = groups.join(spans, "group").select(
        "group", "size", "alone", "low", "high", "prefix", F.posexplode("prefix").alias("place", "shingle")
    ).withColumn("before", F.slice("prefix", F.lit(1), F.col("place"))).drop("prefix")
    open_lists = spread.groupBy("shingle").agg(F.min("low").alias("l"), F.max("high").alias("h")).where("l < h").select("shingle")
    # dealt out once for both sides
    left = spread.join(open_lists, "shingle").repartition("shingle")
    ends = lambda to: left.select(
        "shingle", F.col("group").alias(to), F.col("size").alias(f"size_{to}"), F.col("before").alias(f"before_{to}"),
        (F.col("size") - F.col("alone") - F.col("place")).alias(f"rest_{to}"),
        F.col("low").alias(f"low_{to}"), F.col("high").alias(f"high_{to}"),
    )
    settled = (F.col("low_a") == F.col("high_b")) & (F.col("high_a") == F.col("low_b")) & (F.col("low_a") == F.col("low_b"))
    # the pair is taken at the first shingle that both prefixes have, where the bound is tightest
    across = (
        ends("a").alias("s").join(
            ends("b").alias("t"),
            (F.col("s.shingle") == F.col("t.shingle")) & (F.col("a") < F.col("b")) & filtered & ~settled
            & ~F.arrays_overlap("before_a", "before_b"),
        ).select("a", "b")
    )
    inside = spans.where("low < high").select(F.col("group").alias("a"), F.col("group").alias("b"))
    sketched = sketches(nodes).withColumnRenamed("node", "of")
    marked = stored(placed.join(sketched, F.col("node") == F.col("of")).drop("of"), "jaccard-sketches")
    side = lambda to, node: marked.select(
        F.col("group").alias(to), F.col("node").alias(node), F.col("component").alias(f"c_{node}"),
        *[F.col(name).alias(f"{name}_{node}") for name in ("size", "n", "bits", *sketch.NAMES)],
    )
    rest = (
        across.unionByName(inside)
        .join(side("a", "x"), "a")
        .join(
            side("b", "y").withColumnRenamed("b", "_b"),
            (F.col("b") == F.col("_b")) & (F.col("c_x") != F.col("c_y")) & ((F.col("a") != F.col("b")) | (F.col("x") < F.col("y")))
            & _may_link("x", "y", how.percent, counted=True),
        )
        .select(*pair("x", "y"))
        .distinct()
    )
    more = stored(_linked(rest, nodes, how.percent), "jaccard-links")
    if more.isEmpty():
        return labels
    return stored(components(links.unionByName(more)), "jaccard-components")


def jaccard_components(
    documents: DataFrame, keep: dict[str, Column], how: Similarity = Similarity()
) -> DataFrame:
    """`keep` (name -> expression) with `n_shingles, node, cluster` for each row of `documents`.

    `node` names the set (null if empty) and `cluster` the component of linked sets.
    """
    key = fresh("_key", list(keep))
    rows = documents.select(F.col("text").alias("_text"), *[c.alias(n) for n, c in keep.items()], F.xxhash64("text").alias(key))
    shape = "".join(f"`{n}` {t}, " for n, t in rows.dtypes if n != "_text")
    placed = stored(
        rows.mapInArrow(_nodes(how.words, [*keep, key]), f"{shape}n_shingles long, node long"),
        "jaccard-rows",
    )
    size = documents.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    found = similar_nodes(documents, placed.withColumnRenamed(key, "_key"), how, size)
    return placed.join(found, "node", "left").select(
        *[F.col(f"`{n}`") for n in keep], "n_shingles", "node", F.coalesce("component", "node").alias("cluster")
    )


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stored(
        jaccard_components(table(spark, sf_dir, "documents"), {"doc_id": F.col("doc_id")}), "jaccard-clusters"
    )
    # an empty set links with nothing: it stays under its own id
    least = rows.where("cluster is not null").groupBy("cluster").agg(F.min("doc_id").alias("least"))
    return rows.join(least, "cluster", "left").select(
        "doc_id", "n_shingles", F.when(F.col("cluster").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id")
    )
