"""Prefix trie of conversations by a splitter skeleton.

A turn is a mark: 16 bytes of the hash of its role and text, and 4 bytes for its length in code
points. A conversation is its marks in a row, so the conversations of a node stand together in byte
order. Equal conversations are one row with its smallest id, their number and a hash of their ids.

These rows are dealt to shards by range; the splitters come from a bounded sample. A node whose
conversations lie in more than one shard is a prefix of a splitter (a string between two strings
with a common prefix has that prefix too), so the trie of the splitters, the skeleton, holds them
all. It is sent to the tasks. A shard is read in order with one open node per depth: nodes outside
the skeleton are finished there, those of the skeleton give partial sums, which one aggregation per
skeleton node combines. Nodes come out children first; read backwards, in the same task, they come
parents first, which tells each its parent without a join. Memory grows with the depth only.

The ids of equal conversations are sorted by range, joined to pieces of text, and hashed piece by
piece: SHA-256 takes its input in order, so the ids of one node stream through one task, which holds
a piece at a time.

Limits: a conversation is one row, 20 bytes per turn. Splitters are cut to `SAMPLE_BYTES` over the
sample; splitters that are equal then are one.

Nulls: a null role or text is empty; a null turn comes first; rows without conv_id belong to no
conversation. Ties of turn go by the mark, so repeated rows are turns that follow each other. Empty
texts are turns of length 0. An empty table has no nodes. Only the four columns named are read, so
further columns cannot clash. Negative ids: `conv_id % 100` keeps the sign.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bumpwise.llm.common import stored, table

MARK = 20
SHARD_TURNS = 1 << 13
MOST_SHARDS = 4096
SAMPLE_BYTES = 16 << 20
_SAMPLED_PER_SHARD = 16
_PIECE = 1 << 16
_BATCH = 1 << 13

NODES = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string"
)
_OPEN = (
    "at long, depth int, skeleton int, conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved long, ends string"
)
_EMPTY = hashlib.sha256(b"").hexdigest()


def _mark(role: Column, text: Column) -> Column:
    """Hash of role and text and the length of the text, as 40 hexadecimal digits."""
    whole = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary")
    return F.concat(F.substring(F.sha2(whole, 256), 1, 32), F.lpad(F.hex(F.char_length(text)), 8, "0"))


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, turns: the marks of each conversation in the order of its turns."""
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("role", "text"))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", _mark(role, text).alias("mark")
    )
    ordered = F.sort_array(F.collect_list(F.struct("turn", "mark")))
    grouped = rows.groupBy("conv_id").agg(ordered.alias("turns"))
    return grouped.select("conv_id", F.col("turns.mark").alias("turns"))


def rebuilt(turns: DataFrame, group: int = 100, most: int = 5) -> DataFrame:
    """Conversations that share their first turns with the first one of their group of ids.

    The first h turns are those of conversation c - c % group (none if it is absent), with
    h = crc32(c) % (most + 1); c's own turns follow from its turn h + 1 on.
    """
    own = stored(turns, "trie-turns")
    head = own.where(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("_first"), F.slice("turns", 1, most).alias("_head")
    )
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)
    joined = own.withColumn("_first", F.col("conv_id") - F.col("conv_id") % group).join(head, "_first", "left")
    first = F.slice(F.coalesce("_head", F.array().cast("array<string>")), F.lit(1), shared.cast("int"))
    rest = F.slice("turns", (shared + 1).cast("int"), F.greatest(F.size("turns"), F.lit(0)))
    return joined.select("conv_id", F.concat(first, rest).alias("turns"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, id) -> (key, first id, the ids as text), a run of a key in bounded pieces."""

    def batch(rows):
        return pa.RecordBatch.from_pylist(rows, pa.schema([("key", pa.binary()), ("first", pa.int64()), ("ids", pa.string())]))

    rows, key, ids = [], None, []
    for given in batches:
        for now, conv in zip(given.column(0).to_pylist(), given.column(1).to_pylist(), strict=True):
            if (now != key or len(ids) >= _PIECE) and ids:
                rows.append({"key": key, "first": ids[0], "ids": ",".join(map(str, ids))})
                ids = []
            key = now
            ids.append(conv)
            if len(rows) >= _BATCH or (rows and len(rows[-1]["ids"]) > _PIECE):
                yield batch(rows)
                rows = []
    if ids:
        rows.append({"key": key, "first": ids[0], "ids": ",".join(map(str, ids))})
    if rows:
        yield batch(rows)


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in the order of key and first id -> one hash per key."""

    def batch(rows):
        return pa.RecordBatch.from_pylist(rows, pa.schema([("key", pa.binary()), ("ends", pa.string())]))

    rows, key, state = [], None, None
    for given in batches:
        for now, ids in zip(given.column(0).to_pylist(), given.column(2).to_pylist(), strict=True):
            if now == key:
                state.update(b"," + ids.encode())
                continue
            if state:
                rows.append({"key": key, "ends": state.hexdigest()})
            key, state = now, hashlib.sha256(ids.encode())
            if len(rows) >= _BATCH:
                yield batch(rows)
                rows = []
    if state:
        rows.append({"key": key, "ends": state.hexdigest()})
    if rows:
        yield batch(rows)


def _distinct_paths(turns: DataFrame) -> DataFrame:
    """path, conv_id (the smallest), n, ends: one row per distinct conversation."""
    path = F.unhex(F.array_join("turns", ""))
    rows = turns.select("conv_id", path.alias("path"))
    rows = stored(rows.withColumn("key", F.unhex(F.sha2("path", 256))), "trie-paths")
    paths = rows.groupBy("key", "path").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n"))
    ids = rows.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    pieces = ids.mapInArrow(_pieces, "key binary, first long, ids string")
    ends = pieces.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_hashes, "key binary, ends string")
    return stored(paths.join(ends, "key").drop("key"), "trie-distinct")


def _splitters(paths: DataFrame, n_paths: int, shards: int) -> list[bytes]:
    """At most `shards` - 1 paths, cut to whole marks, that part the rows about evenly."""
    if shards < 2:
        return []
    every = max(1, n_paths // (shards * _SAMPLED_PER_SHARD))
    sample = paths.where(F.pmod(F.xxhash64("path"), F.lit(every)) == 0)
    marks = max(1, SAMPLE_BYTES // (MARK * max(1, sample.count())))
    found = sorted(bytes(row[0]) for row in sample.select(F.substring("path", 1, marks * MARK)).collect())
    return sorted({found[len(found) * nth // shards] for nth in range(1, shards)} - {b""}) if found else []


def _skeleton(splitters: list[bytes]) -> list[tuple[int, bytes, list[int]]]:
    """(parent, mark, ancestors and itself) of each node of the splitters' trie, the root first."""
    nodes: list[tuple[int, bytes, list[int]]] = [(-1, b"", [0])]
    known: dict[tuple[int, bytes], int] = {}
    for path in splitters:
        at = 0
        for start in range(0, len(path), MARK):
            step = (at, path[start : start + MARK])
            if step not in known:
                known[step] = len(nodes)
                nodes.append((*step, [*nodes[at][2], len(nodes)]))
            at = known[step]
    return nodes


def _dealt(splitters) -> Callable:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limits = splitters.value
        for batch in batches:
            shard = [bisect.bisect_right(limits, path) for path in batch.column("path").to_pylist()]
            yield batch.append_column("shard", pa.array(shard, pa.int32()))

    return work


class _Node:
    __slots__ = ("mark", "skeleton", "conv_id", "n_convs", "children", "leaves", "saved", "ends")

    def __init__(self, mark: bytes, skeleton: int):
        self.mark, self.skeleton, self.conv_id, self.ends = mark, skeleton, None, None
        self.n_convs = self.children = self.leaves = self.saved = 0


def _finish(node: _Node, above: _Node | None) -> None:
    """Closes a node and adds its sums to the node above."""
    if node.skeleton < 0:
        node.leaves += not node.children
        node.saved += (node.n_convs - 1) * int.from_bytes(node.mark[16:], "big")
        above.children += 1
    if above:
        above.leaves += node.leaves
        above.saved += node.saved
        above.n_convs += node.n_convs
        if above.conv_id is None or node.conv_id < above.conv_id:
            above.conv_id = node.conv_id


def _walk(skeleton) -> Callable:
    """Sorted distinct paths of a shard -> its nodes, children before parents."""

    def rows(batches):
        steps = {(parent, mark): at for at, (parent, mark, _) in enumerate(skeleton.value)}
        open_: list[_Node] = []
        at = 0
        for batch in batches:
            columns = (batch.column(name).to_pylist() for name in ("path", "conv_id", "n", "ends"))
            for path, conv_id, n, ends in zip(*columns, strict=True):
                if not open_:
                    open_.append(_Node(b"", 0))
                shared, depth = 0, len(path) // MARK
                while shared < depth and shared + 1 < len(open_):
                    if open_[shared + 1].mark != path[shared * MARK : (shared + 1) * MARK]:
                        break
                    shared += 1
                while len(open_) > shared + 1:
                    yield at, *_closed(open_)
                    at += 1
                for nth in range(shared, depth):
                    mark = path[nth * MARK : (nth + 1) * MARK]
                    open_.append(_Node(mark, steps.get((open_[-1].skeleton, mark), -1)))
                node = open_[-1]
                node.n_convs, node.ends = node.n_convs + n, ends
                node.conv_id = conv_id if node.conv_id is None else min(node.conv_id, conv_id)
        while open_:
            yield at, *_closed(open_)
            at += 1

    names = [field.split()[0] for field in _OPEN.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int32(), *[pa.int64()] * 5, pa.string()]
    return lambda batches: _in_batches(rows(batches), pa.schema(list(zip(names, kinds, strict=True))))


def _closed(open_: list[_Node]) -> tuple:
    node = open_.pop()
    _finish(node, open_[-1] if open_ else None)
    return (
        len(open_), node.skeleton, node.conv_id, node.n_convs, node.children, node.leaves, node.saved, node.ends
    )


def _in_batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= _BATCH:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _with_parents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of a shard, parents first -> the same with their parent's conv_id or skeleton node."""
    above: list[tuple[int | None, int]] = []
    for batch in batches:
        parents, skeletons = [], []
        columns = (batch.column(name).to_pylist() for name in ("depth", "skeleton", "conv_id"))
        for depth, skeleton, conv_id in zip(*columns, strict=True):
            parent = above[depth - 1] if depth else (None, -1)
            parents.append(parent[0])
            skeletons.append(parent[1])
            del above[depth:]
            above.append((None, skeleton) if skeleton >= 0 else (conv_id, -1))
        yield batch.append_column("parent", pa.array(parents, pa.int64())).append_column(
            "above", pa.array(skeletons, pa.int32())
        )


def prefix_trie(turns: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The nodes of the trie of `turns` (conv_id, turns as of `turns_of`; one row per conv_id), as NODES."""
    spark = turns.sparkSession
    paths = _distinct_paths(turns)
    size = paths.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("path")).alias("bytes")).first()
    shards = min(MOST_SHARDS, 1 + (size["bytes"] or 0) // (MARK * shard_turns))
    splitters = _splitters(paths, size["n"], shards)
    nodes = _skeleton(splitters)
    context = spark.sparkContext
    dealt = paths.mapInArrow(_dealt(context.broadcast(splitters)), "path binary, conv_id long, n long, ends string, shard int")
    sorted_ = dealt.repartitionById(len(splitters) + 1, F.col("shard")).sortWithinPartitions("path")
    walked = sorted_.mapInArrow(_walk(context.broadcast(nodes)), _OPEN).sortWithinPartitions(F.desc("at"))
    found = stored(walked.mapInArrow(_with_parents, f"{_OPEN}, parent long, above int"), "trie-nodes")
    tops = _reduced(spark, nodes, found.where("skeleton >= 0"))
    # bounded by the skeleton: fewer than shards x marks of a splitter
    names = F.broadcast(tops.select(F.col("skeleton").alias("above"), F.col("conv_id").alias("_parent")))
    inner = found.where("skeleton < 0").join(names, "above", "left").select(
        "conv_id",
        F.col("depth").cast("long").alias("depth"),
        F.coalesce("parent", "_parent").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.lit(_EMPTY)).alias("ends_sha256"),
    )
    return inner.unionByName(tops.drop("skeleton"))


def _reduced(spark: SparkSession, nodes: list[tuple[int, bytes, list[int]]], parts: DataFrame) -> DataFrame:
    """The skeleton's nodes from the partial sums of the shards."""
    inside = [0] * len(nodes)
    for parent, _, _ in nodes[1:]:
        inside[parent] += 1
    rows = [
        (at, parent, int.from_bytes(mark[16:], "big"), inside[at], above)
        for at, (parent, mark, above) in enumerate(nodes)
    ]
    known = spark.createDataFrame(rows, "skeleton int, parent int, length long, inside long, path array<int>")
    sums = parts.groupBy("skeleton").agg(
        F.min("conv_id").alias("conv_id"),
        F.first("depth").cast("long").alias("depth"),
        F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved").alias("saved"),
        F.coalesce(F.max("ends"), F.lit(_EMPTY)).alias("ends_sha256"),
    )
    own = sums.join(known, "skeleton").withColumn("n_children", F.col("n_children") + F.col("inside"))
    own = stored(own, "trie-skeleton")
    # what the skeleton's own nodes add to each of their ancestors
    added = own.select(
        F.explode("path").alias("skeleton"),
        (F.col("n_children") == 0).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("length")).alias("spared"),
    )
    added = added.groupBy("skeleton").agg(F.sum("leaf").alias("leaf"), F.sum("spared").alias("spared"))
    parents = own.select(F.col("skeleton").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    done = own.join(added, "skeleton").join(parents, "parent", "left").select(
        "skeleton",
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        (F.col("n_leaves") + F.col("leaf")).alias("n_leaves"),
        (F.col("saved") + F.col("spared")).alias("saved_tokens"),
        "ends_sha256",
    )
    return stored(done, "trie-tops")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(rebuilt(turns_of(table(spark, sf_dir, "conversations"))))


# h: the checksum of the id's digits, eight steps per byte
_STEP = "CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END"
_CRC = (
    "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda d: ord(d)::BIGINT)), "
    f"lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda v, z: {_STEP})), 4294967295::BIGINT)"
)
OP12_SQL = f"""
WITH own AS (
  SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce("text", '')}} ORDER BY turn NULLS FIRST, role, "text") AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
marked AS (SELECT *, ({_CRC}) % 6 AS h FROM own),
seqs AS (
  SELECT m.conv_id, list_concat(coalesce(b.turns[1:m.h], []), m.turns[m.h + 1:]) AS turns
  FROM marked m LEFT JOIN own b ON b.conv_id = m.conv_id - m.conv_id % 100),
members AS (SELECT conv_id, len(turns) AS size, unnest(range(0, len(turns) + 1)) AS depth, turns FROM seqs),
keyed AS (SELECT conv_id, depth, size, CASE WHEN depth = 0 THEN [] ELSE turns[1:depth] END AS path FROM members),
nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (size = depth), '')) AS ends_sha256,
         (count(*) - 1) * coalesce(length(any_value(path)[depth]."text"), 0) AS spared
  FROM keyed GROUP BY path, depth),
linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id
  FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1
   AND p.path = CASE WHEN n.depth <= 1 THEN [] ELSE n.path[1:n.depth - 1] END),
children AS (
  SELECT CASE WHEN depth <= 1 THEN [] ELSE path[1:depth - 1] END AS path, depth - 1 AS depth, count(*) AS n_children
  FROM nodes WHERE depth > 0 GROUP BY 1, 2),
full_nodes AS (
  SELECT l.*, coalesce(c.n_children, 0) AS n_children
  FROM linked l LEFT JOIN children c ON c.depth = l.depth AND c.path = l.path),
ups AS (SELECT unnest(range(0, depth + 1)) AS up, path, spared, n_children FROM full_nodes),
sums AS (
  SELECT CASE WHEN up = 0 THEN [] ELSE path[1:up] END AS path, up AS depth,
         sum((n_children = 0)::INT) AS n_leaves, sum(spared) AS saved_tokens
  FROM ups GROUP BY 1, 2)
SELECT f.conv_id, f.depth::BIGINT AS depth, f.parent_conv_id, f.n_convs, f.n_children,
       s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, f.ends_sha256
FROM full_nodes f JOIN sums s ON s.depth = f.depth AND s.path = f.path
"""
