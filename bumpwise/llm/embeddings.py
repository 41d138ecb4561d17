"""Embedding near-duplicates by a subspace pigeonhole join.

Vectors are scaled to length 1, where cosine >= c means squared distance <= 2 - 2c. They are
rotated onto the principal axes of all vectors and split into low-dimensional blocks. Squared
distances add up over the blocks, so of a linked pair at least one block stays within its share
of the budget; the shares are in proportion to the blocks' variances.

Equal vectors are one node with a multiplicity before any comparison. Nodes are sorted by the side
of the widest axes on which they lie and packed into tiles, one row each. Tiles meet in pairs, each
pair once, straight from the stored table: no copy of a vector is shuffled for it, so disk stays in
proportion to the input. Tiles whose boxes are farther apart than the budget do not meet, and
chunks of tiles are compared only in blocks whose boxes leave the block's share. Where that are few
blocks, the pairs within a share are looked for block by block; else one product over all blocks is
cheaper, and all squared distances are compared at once. What that leaves is verified by the cosine of the
original vectors in double precision. A task returns the number of links of each node and a spanning
forest of the links, never the pairs.

Where vectors are spread evenly in all directions no box is far from another, and time grows with
the square of the different vectors; memory and disk do not.

Vectors of different lengths cannot be alike; each length that several different vectors have is
joined by itself, with a rotation of its own.

Nulls: vectors that are null, zero, or hold null or non-finite components link with nothing. A null id takes part; its component is the smallest id that is not
null. Repeated rows are vectors of their own, linked with each other. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bumpwise.llm.common import stored, table
from bumpwise.llm.graph import components
from bumpwise.session import setting

COSINE = 0.9
BLOCK_DIMENSIONS = 8
TILE = 8192  # vectors of a tile at most
_TILE_BYTES = 1 << 22
_LEAST_TILE, _TILES = 256, 64  # few vectors make smaller tiles, for the sake of many tasks
_TILES_A_FILE, _FILES = 8, 200
_CHUNK = 256
_FEW = 2  # blocks that are looked through one by one; more are cheaper in one product
_KEPT_TILES = 12  # that a task holds unpacked
_SLACK = 1e-9  # covers rounding of the rotated distances; the cosine itself decides
_ROUGH = 1e-4  # the same for the first look, in single precision


def _units(flat: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in double precision."""
    rows = flat.astype(np.float64)
    rows = rows / np.maximum(np.abs(rows).max(axis=1, keepdims=True), 1e-300)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(-1, width)


def _moments(width: int) -> Callable:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            if batch.num_rows:
                units = _units(_matrix(batch.column("vector"), width))
                total += units.T @ units
        places = pa.array(np.arange(width * width, dtype=np.int32))
        yield pa.RecordBatch.from_arrays([places, pa.array(total.ravel())], ["place", "value"])

    return work


def rotation(nodes: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(axes as columns, variance along each), widest first, from the second moments of all."""
    sums = nodes.select("vector").mapInArrow(_moments(width), "place int, value double")
    rows = sums.groupBy("place").agg(F.sum("value").alias("value")).collect()
    moments = np.zeros(width * width)
    for row in rows:
        moments[row["place"]] = row["value"]
    variances, axes = np.linalg.eigh(moments.reshape(width, width))
    return axes[:, ::-1], np.maximum(variances[::-1], 0)


def blocks_of(variances: np.ndarray, dimensions: int) -> list[np.ndarray]:
    """The axes of each block, dealt so that the blocks' variances are alike."""
    count = -(-len(variances) // dimensions)
    return [np.arange(start, len(variances), count) for start in range(count)]


def _turned(width: int, axes: np.ndarray) -> Callable:
    """(node, copies, vector, side): the sides of the widest axes on which vectors lie, as bits."""
    signs = min(width, 62)
    worth = 1 << np.arange(signs - 1, -1, -1, dtype=np.int64)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                turned = _units(_matrix(batch.column("vector"), width)) @ axes[:, :signs]
                given = [batch.column(name) for name in ("node", "copies", "vector")]
                yield pa.RecordBatch.from_arrays([*given, pa.array((turned > 0) @ worth)], ["node", "copies", "vector", "side"])

    return work


def _packed(width: int, axes: np.ndarray, kind: str, size: int) -> Callable:
    """(tile, nodes, copies, vectors, low, high): tiles of the rows in their order, with the boxes
    around the rotated vectors. A tile is named by its first node."""

    def tile(rows: pa.Table) -> pa.RecordBatch:
        flat = rows.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(kind)
        turned = _units(flat.reshape(-1, width)) @ axes
        nodes, copies = (rows.column(name).to_numpy().astype("<i8") for name in ("node", "copies"))
        columns = [
            pa.array(nodes[:1]), pa.array([nodes.tobytes()], pa.binary()), pa.array([copies.tobytes()], pa.binary()),
            pa.array([flat.tobytes()], pa.binary()), pa.array([turned.min(axis=0).tolist()]), pa.array([turned.max(axis=0).tolist()]),
        ]
        return pa.RecordBatch.from_arrays(columns, ["tile", "nodes", "copies", "vectors", "low", "high"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_held = [], 0
        for batch in batches:
            start = 0
            while start < batch.num_rows:
                part = batch.slice(start, size - n_held)
                held, n_held, start = [*held, part], n_held + part.num_rows, start + part.num_rows
                if n_held == size:
                    yield tile(pa.Table.from_batches(held))
                    held, n_held = [], 0
        if n_held:
            yield tile(pa.Table.from_batches(held))

    return work


class _Tile:
    """Unpacked vectors of a tile, and the boxes around its chunks."""

    def __init__(self, nodes: bytes, copies: bytes, vectors: bytes, width: int, kind: str, axes: np.ndarray):
        self.nodes, self.copies = np.frombuffer(nodes, "<i8"), np.frombuffer(copies, "<i8")
        self.units = _units(np.frombuffer(vectors, kind).reshape(-1, width))
        self.turned = self.units @ axes
        self.rough = self.turned.astype(np.float32)
        starts = np.arange(0, len(self.nodes), _CHUNK)
        self.low, self.high = np.minimum.reduceat(self.turned, starts), np.maximum.reduceat(self.turned, starts)


def _open_blocks(x: _Tile, y: _Tile, blocks: list[np.ndarray], budgets: np.ndarray) -> np.ndarray:
    """For chunks of two tiles and each block, whether a linked pair may stay within its share there;
    no block is open for chunks that are too far apart in all blocks together."""
    gaps = np.empty((len(x.low), len(y.low), len(blocks)))
    for k, (low, high) in enumerate(zip(x.low, x.high, strict=True)):
        gap = np.maximum(np.maximum(low - y.high, y.low - high), 0) ** 2
        for number, block in enumerate(blocks):
            gaps[k, :, number] = gap[:, block].sum(axis=1)
    near = gaps.sum(axis=2) <= budgets.sum() + _SLACK
    return (gaps <= budgets + _SLACK) & near[:, :, None]


def _near(x: _Tile, some: slice, y: _Tile, there: np.ndarray, still: np.ndarray, blocks: list[np.ndarray], budgets: np.ndarray, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j) that may link, of a chunk of one tile and the chunks `there` of the other. `still` has
    the open blocks of these. A pair may come more than once."""

    def rows_of(chunks: np.ndarray) -> np.ndarray | slice:
        if len(chunks) and chunks[-1] - chunks[0] == len(chunks) - 1:  # no gap: nothing is copied
            return slice(int(chunks[0]) * _CHUNK, min((int(chunks[-1]) + 1) * _CHUNK, len(y.nodes)))
        rows = (chunks[:, None] * _CHUNK + np.arange(_CHUNK)).ravel()
        return rows[rows < len(y.nodes)]

    def found(close: np.ndarray, rows: np.ndarray | slice) -> tuple[np.ndarray, np.ndarray]:
        i, j = np.divmod(np.flatnonzero(close), close.shape[1])
        return i + some.start, j + rows.start if isinstance(rows, slice) else rows[j]

    count = still.sum(axis=1)
    if len(many := there[count > _FEW]):
        rows = rows_of(many)
        yield found(x.rough[some] @ y.rough[rows].T >= np.float32(cosine - _ROUGH), rows)
    for number, block in enumerate(blocks):
        if len(one := there[(count <= _FEW) & still[:, number]]):
            rows = rows_of(one)
            left, right = x.rough[some][:, block], y.rough[rows][:, block]
            apart = (left**2).sum(axis=1)[:, None] + (right**2).sum(axis=1) - 2 * (left @ right.T)
            yield found(apart <= np.float32(budgets[number] + _ROUGH), rows)


def _links_between(x: _Tile, y: _Tile, blocks: list[np.ndarray], budgets: np.ndarray, cosine: float) -> pa.RecordBatch:
    """(node, to, links) of two tiles, or of a tile with itself."""
    same, n_x = x is y, len(x.nodes)
    nodes = x.nodes if same else np.concatenate((x.nodes, y.nodes))
    links, label = np.zeros(len(nodes), np.int64), np.arange(len(nodes))
    opened = _open_blocks(x, y, blocks, budgets)
    for k in range(len(opened)):
        some = slice(k * _CHUNK, min((k + 1) * _CHUNK, n_x))
        there = np.flatnonzero(opened[k].any(axis=1))
        there = there[there >= k] if same else there  # of a tile with itself, each pair once
        pairs = [np.empty(0, np.int64)]
        for i, j in _near(x, some, y, there, opened[k][there], blocks, budgets, cosine):
            if same:
                i, j = i[i < j], j[i < j]
            good = np.empty(len(i), bool)
            for at in range(0, len(i), 65_536):
                part = slice(at, at + 65_536)
                good[part] = np.einsum("ij,ij->i", x.units[i[part]], y.units[j[part]]) >= cosine
            pairs.append(i[good] * len(y.nodes) + j[good])
        i, j = np.divmod(np.concatenate(pairs) if len(pairs) < 3 else np.unique(np.concatenate(pairs)), len(y.nodes))
        if not len(i):
            continue
        to = j if same else j + n_x
        # whole numbers, exact in double precision
        links += np.bincount(i, y.copies[j], len(nodes)).astype(np.int64) + np.bincount(to, x.copies[i], len(nodes)).astype(np.int64)
        label = _joined(label, i, to)
    linked = np.flatnonzero(links)
    return pa.RecordBatch.from_arrays(
        [pa.array(nodes[linked]), pa.array(nodes[label[linked]]), pa.array(links[linked])], ["node", "to", "links"]
    )


def _joined(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels (each the smallest place of its component) after the links between i and j."""
    a, b = label[i], label[j]
    low, high = np.minimum(a, b), np.maximum(a, b)
    parent = np.arange(len(label))

    def top(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    # different labels that meet are few; links inside a component need no step of their own
    for code in np.unique(low[low < high] * len(label) + high[low < high]).tolist():
        p, q = top(code // len(label)), top(code % len(label))
        if p != q:
            parent[max(p, q)] = min(p, q)
    while (parent[parent] != parent).any():
        parent = parent[parent]
    return parent[label]


def _compare(width: int, kind: str, axes: np.ndarray, blocks: list[np.ndarray], budgets: np.ndarray, cosine: float) -> Callable:
    """(node, to, links) of pairs of tiles."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, _Tile] = {}

        def tile(batch: pa.RecordBatch, row: int, to: str) -> _Tile:
            name = batch.column(f"tile_{to}")[row].as_py()
            if name not in kept:
                if len(kept) >= _KEPT_TILES:
                    del kept[next(iter(kept))]
                held = [batch.column(f"{column}_{to}")[row].as_buffer() for column in ("nodes", "copies", "vectors")]
                kept[name] = _Tile(*held, width, kind, axes)
            return kept[name]

        for batch in batches:
            for row in range(batch.num_rows):
                yield _links_between(tile(batch, row, "a"), tile(batch, row, "b"), blocks, budgets, cosine)

    return work


def _tile_rows(n_nodes: int, width: int, item: int) -> int:
    """Vectors of a tile: so many that tasks are many, and bounded by bytes."""
    return max(1, min(TILE, _TILE_BYTES // (width * item), max(_LEAST_TILE, -(-n_nodes // _TILES))))


def tiles(nodes: DataFrame, n_nodes: int, width: int, axes: np.ndarray) -> DataFrame:
    """A row per tile (`_packed`), stored; each node is in one of them."""
    vector = dict(nodes.dtypes)["vector"]
    kind = "<f4" if vector == "array<float>" else "<f8"
    size = _tile_rows(n_nodes, width, int(kind[2]))
    files = max(1, min(_FILES, -(-n_nodes // (size * _TILES_A_FILE))))
    placed = nodes.select("node", "copies", "vector").mapInArrow(
        _turned(width, axes), f"node long, copies long, vector {vector}, side long"
    )
    placed = placed.repartitionByRange(files, "side", "node").sortWithinPartitions("side", "node")
    shape = "tile long, nodes binary, copies binary, vectors binary, low array<double>, high array<double>"
    return stored(placed.drop("side").mapInArrow(_packed(width, axes, kind, size), shape), "vector-tiles")


def _meet(tiled: DataFrame, cosine: float) -> DataFrame:
    """Pairs of tiles whose boxes are not too far apart, each once, read from the stored table."""
    side = lambda to: tiled.select(*[F.col(name).alias(f"{name}_{to}") for name in tiled.columns])
    below = lambda low, high: F.zip_with(low, high, lambda p, q: F.greatest(p - q, F.lit(0.0)))
    gaps = F.zip_with(below("low_a", "high_b"), below("low_b", "high_a"), lambda p, q: p * p + q * q)  # one of them is 0
    apart = F.aggregate(gaps, F.lit(0.0), lambda total, gap: total + gap)
    near = (F.col("tile_a") <= F.col("tile_b")) & (apart <= F.lit(2 - 2 * cosine + _SLACK))
    return side("a").join(side("b"), near).drop("low_a", "high_a", "low_b", "high_b")


def _links(nodes: DataFrame, n_nodes: int, width: int, cosine: float) -> DataFrame:
    """(node, to, links) of vectors of one length, stored: number of links and a spanning forest."""
    axes, variances = rotation(nodes, width)
    blocks = blocks_of(variances, BLOCK_DIMENSIONS)
    shares = np.array([variances[block].sum() for block in blocks]) + 1e-12 * max(variances.sum(), 1e-300)
    budgets = (2 - 2 * cosine) * shares / shares.sum()
    kind = "<f4" if dict(nodes.dtypes)["vector"] == "array<float>" else "<f8"
    met = _meet(tiles(nodes, n_nodes, width, axes), cosine)
    # a row is two tiles: a batch holds few of them
    with setting(nodes.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch", "2"):
        return stored(met.mapInArrow(_compare(width, kind, axes, blocks, budgets, cosine), "node long, to long, links long"), "vector-links")


def near_duplicates(
    vectors: DataFrame, id_column: str, vector_column: str, cosine: float = COSINE
) -> DataFrame:
    """`vec_id, n_links, component_id, kept` for each row of `vectors`."""
    rows = vectors.select(F.col(id_column).alias("vec_id"), F.col(vector_column).alias("vector"))
    if dict(rows.dtypes)["vector"] != "array<float>":
        rows = rows.withColumn("vector", F.col("vector").cast("array<double>"))
    zero = F.lit(0).cast("float" if dict(rows.dtypes)["vector"] == "array<float>" else "double")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = finite & F.exists("vector", lambda x: x != 0)
    named = F.when(F.coalesce(usable, F.lit(False)), F.transform("vector", lambda x: x + zero))
    # equal vectors are one node, named by a 64-bit hash of the components (0.0 for -0.0)
    rows = rows.select("vec_id", named.alias("vector"))
    name = F.xxhash64(F.size("vector"), "vector")
    rows = rows.withColumn("node", F.when(F.col("vector").isNotNull(), name))
    nodes = stored(
        rows.where("node is not null").groupBy("node").agg(
            F.first("vector").alias("vector"), F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least")
        ),
        "vector-nodes",
    )
    rows = stored(rows.select("vec_id", "node"), "vector-rows")
    lengths = nodes.groupBy(F.size("vector").alias("n")).count().orderBy("n").collect()  # a row per length
    met = rows.sparkSession.createDataFrame([], "node long, to long, links long")
    for width, count in ((row["n"], row["count"]) for row in lengths if row["count"] > 1):
        same = nodes if len(lengths) == 1 else nodes.where(F.size("vector") == width)
        met = met.unionByName(_links(same, count, width, cosine))
    counts = met.groupBy("node").agg(F.sum("links").alias("links"))
    clusters = stored(components(met.select(F.col("node").alias("a"), F.col("to").alias("b"))), "vector-components")
    ends = (
        nodes.select("node", "copies", "least")
        .join(counts, "node", "left")
        .join(clusters, "node", "left")
        .select("node", F.coalesce("component", "node").alias("component"), "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    )
    ends = stored(ends, "vector-ends")
    least = ends.groupBy("component").agg(F.min("least").alias("smallest"))
    final = ends.join(least, "component").select("node", "links", "smallest")
    answered = rows.select("vec_id", "node").join(final, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("smallest"))
    return answered.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
