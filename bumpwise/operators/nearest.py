"""Nearest road segment of each point: exact, without a distance limit.

Distance is Euclidean in degrees to the segment's midpoint; ties go to the smaller `s_id`.

The network is indexed once (`build_segment_index`) as two tables:

* `blocks`: for each grid cell with a midpoint in it or next to it, the midpoints of its 3 x 3
  cells. A nearest midpoint found there closer than a cell edge is the nearest of all.
* `nodes`: the grid at ever coarser levels as a tree. A node with few midpoints lists them, any
  other lists its child cells with the exact bounds of their midpoints. Where a cell of the
  finest common level is crowded, it alone is parted further, until its leaves are short.

A point first looks up its block, one equi-join. Positions this does not settle (far from the
network, or in crowded cells) are made distinct and descend the tree: each round opens the cells
that can still hold the nearest midpoint. Every list in both tables is bounded by construction,
so no group grows with the data, and no point is compared with midpoints it could rule out.

Cell edges are powers of two, so cell numbers are exact; all bounds are compared as computed, and
rounding is monotonic, so pruning never loses a tie.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from bumpwise.operators.keyed import attach_by_key
from bumpwise.session import store, work_path

BLOCK_BITS = 10  # block cells have an edge of 2**-10 degrees, about 100 m
FINEST_BITS = 16  # common to all midpoints: cells of about 1.5 m
DEEPEST_BITS = 52  # of crowded cells; distinct coordinates in degrees lie apart here
STEP_BITS = 3  # a cell has at most 64 children
LIST_LIMIT = 64  # midpoints a node lists itself; more are split among its children
FAN_OUT = 1 << (2 * STEP_BITS)
ROOT = -1000  # the level of the root, whose children are the (at most FAN_OUT) coarsest cells

_CELL_LIMIT = 1 << 60
_BLOCK_EDGE_SQUARED = 2.0 ** (-2 * BLOCK_BITS)

_ENTRY = (
    "struct<x1: double, x2: double, y1: double, y2: double, "
    "bits: int, cx: bigint, cy: bigint, s_id: string>"
)
_NODE_SCHEMA = (
    "bits int, cx bigint, cy bigint, n bigint, "
    f"x1 double, x2 double, y1 double, y2 double, entries array<{_ENTRY}>"
)
_STATE_SCHEMA = (
    "lon double, lat double, n bigint, bound double, best struct<d2: double, s_id: string>, "
    "open array<struct<bits: int, cx: bigint, cy: bigint>>"
)
_NO_BEST = "CAST(NULL AS struct<d2: double, s_id: string>)"
_SAME_NODE = "node.bits = _bits AND node.cx = _cx AND node.cy = _cy"
_BLOCK_SCHEMA = f"cx bigint, cy bigint, near array<{_ENTRY}>"


@dataclass(frozen=True)
class SegmentIndex:
    """The index tables under `path`; `rounds` is the depth of the tree."""

    path: str
    top_bits: int
    rounds: int

    def blocks(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(_BLOCK_SCHEMA).parquet(f"{self.path}/blocks")

    def nodes(self, spark: SparkSession) -> DataFrame:
        return _read_nodes(spark, self.path)


def segment_midpoints(segments: DataFrame) -> DataFrame:
    return segments.select(
        "s_id",
        ((F.col("start_lon") + F.col("end_lon")) / 2).alias("mid_lon"),
        ((F.col("start_lat") + F.col("end_lat")) / 2).alias("mid_lat"),
    )


def build_segment_index(segments: DataFrame, path: str | None = None) -> SegmentIndex:
    """Index a road network under `path` (a fresh folder; by default in the shared one).

    Runs one small job per level. An index serves every job on the same network version, so
    build it when the network changes and `open_segment_index` it otherwise.
    """
    spark = segments.sparkSession
    path = path or work_path(spark, "segment-index")
    located = segment_midpoints(segments).filter(_finite("mid_lon") & _finite("mid_lat"))
    # copies of a midpoint can only differ in s_id, and the smallest wins
    positions = located.groupBy("mid_lon", "mid_lat").agg(F.min("s_id").alias("s_id"))

    bits = FINEST_BITS
    _write_nodes(_finest_level(positions, path), path, bits)
    while True:
        level = _read_nodes(spark, path, bits)
        cells = level.count()
        if bits <= BLOCK_BITS and cells <= FAN_OUT:
            break
        bits -= STEP_BITS
        _write_nodes(_parents(level, bits), path, bits)
    _write_nodes(_root(level), path, ROOT)
    _blocks(_read_nodes(spark, path, BLOCK_BITS)).write.parquet(f"{path}/blocks")
    return open_segment_index(spark, path)


def open_segment_index(spark: SparkSession, path: str) -> SegmentIndex:
    """An index built earlier."""
    fullest = dict(
        _read_nodes(spark, path).groupBy("bits").agg(F.max("n")).collect()  # a row per level
    )
    top_bits = min((bits for bits in fullest if bits != ROOT), default=BLOCK_BITS)
    rounds, parent = 0, ROOT
    if ROOT in fullest:
        rounds = 1
        while fullest[parent] > LIST_LIMIT:
            parent = top_bits if parent == ROOT else parent + STEP_BITS
            if parent not in fullest:
                break
            rounds += 1
    return SegmentIndex(path, top_bits, rounds)


def nearest_segment(points: DataFrame, index: SegmentIndex) -> DataFrame:
    """Each point (`lon`, `lat`, any other columns) with the `s_id` of its nearest segment.

    A point without finite coordinates gets NULL. The positions that need the tree are settled
    when this is called, so `points` is read once here and again by the result: pass a stored
    table rather than a long computation.
    """
    spark = points.sparkSession
    columns = points.columns
    has_place = _finite("lon") & _finite("lat")

    # rows without a place spread over cell numbers no block has
    nowhere = F.pmod(F.xxhash64(*columns), F.lit(_CELL_LIMIT)) + F.lit(4 * _CELL_LIMIT)
    celled = points.withColumns(
        {
            "_cx": F.when(has_place, _cell(F.col("lon"), BLOCK_BITS)).otherwise(nowhere),
            "_cy": F.when(has_place, _cell(F.col("lat"), BLOCK_BITS)).otherwise(nowhere),
        }
    )
    blocks = index.blocks(spark).select(
        F.col("cx").alias("_cx"), F.col("cy").alias("_cy"), "near"
    )
    looked_up = celled.join(blocks, ["_cx", "_cy"], "left").select(
        *columns,
        F.expr(_nearest_of("near")).alias("_best"),
    )
    settled = F.coalesce(F.col("_best.d2") < _BLOCK_EDGE_SQUARED, F.lit(False))
    near = looked_up.filter(settled | ~has_place).select(
        *columns, F.when(has_place, F.col("_best.s_id")).alias("s_id")
    )
    unsettled = looked_up.filter(~settled & has_place)
    positions = unsettled.groupBy("lon", "lat").agg(
        F.count(F.lit(1)).alias("n"), F.min("_best.d2").alias("bound")
    )
    found = _descend(positions, index)
    if found is None:
        return near
    rest = attach_by_key(
        unsettled.select(*columns), found, ["lon", "lat"], weight="n", spread_by=columns
    )
    return near.unionByName(rest.select(*columns, "s_id"))


def _descend(positions: DataFrame, index: SegmentIndex) -> DataFrame | None:
    """Distinct positions (`lon`, `lat`, `n`, `bound`) with the `s_id` of the nearest midpoint.

    `bound` is a squared distance within which a midpoint is known, if any. None if there is no
    position. Each round is written to the shared folder, which cuts the lineage and tells from
    the write itself whether any node is still open.
    """
    spark = positions.sparkSession
    nodes = index.nodes(spark)
    folder = work_path(spark, "nearest-rounds")
    step, state = 0, _first_nodes(positions, nodes, index)
    while True:
        progress = Observation()
        state.observe(
            progress,
            F.count(F.lit(1)).alias("positions"),
            F.coalesce(F.sum(F.size("open")), F.lit(0)).alias("open"),
        ).write.parquet(f"{folder}/{step}")
        if progress.get["positions"] == 0:
            return None
        state = spark.read.schema(_STATE_SCHEMA).parquet(f"{folder}/{step}")
        if progress.get["open"] == 0:
            return state.select("lon", "lat", "n", F.col("best.s_id").alias("s_id"))
        step, state = step + 1, _open_nodes(state, nodes, index)


def _first_nodes(positions: DataFrame, nodes: DataFrame, index: SegmentIndex) -> DataFrame:
    """Positions with the nodes to open first.

    The finest cell around a position that has midpoints bounds the distance of the nearest one.
    The search starts from the cells within that bound, at the finest level where they are at
    most 3 x 3; a position with no midpoint in its wider surroundings starts at the root.
    """
    levels = range(index.top_bits + STEP_BITS, BLOCK_BITS + 1, STEP_BITS)
    root = f"array(struct({ROOT} AS bits, 0L AS cx, 0L AS cy))"
    if not levels:
        return positions.select(
            "lon", "lat", "n", "bound", F.expr(_NO_BEST).alias("best"), F.expr(root).alias("open")
        )
    around = F.array(
        *(
            F.struct(
                F.lit(bits).alias("bits"),
                _cell(F.col("lon"), bits).alias("cx"),
                _cell(F.col("lat"), bits).alias("cy"),
            )
            for bits in levels
        )
    )
    boxes = nodes.filter(F.col("bits").isin(list(levels))).select(
        F.col("bits").alias("_bits"), F.col("cx").alias("_cx"), F.col("cy").alias("_cy"),
        F.struct("x1", "x2", "y1", "y2").alias("e"),
    )
    bounded = (
        positions.select("*", F.explode(around).alias("node"))
        .join(boxes, F.expr(_SAME_NODE), "left")
        .groupBy("lon", "lat")
        .agg(
            F.first("n").alias("n"),
            F.least(F.min("bound"), F.min(F.expr(_HIGHEST))).alias("bound"),
        )
    )
    # wide enough that rounding cannot cut off a midpoint at the bound
    reach = "(sqrt(bound) * 1.000000001D + 0.000000001D)"
    start = F.expr(root)
    for bits in levels:  # the finest level that fits comes last and is taken first
        span = [
            f"sequence(floor(({axis} - {reach}) * {2.0**bits!r}D), floor(({axis} + {reach}) * {2.0**bits!r}D))"
            for axis in ("lon", "lat")
        ]
        cells = (
            f"flatten(transform({span[0]}, x -> transform({span[1]}, y -> "
            f"struct({bits} AS bits, x AS cx, y AS cy))))"
        )
        start = F.when(F.expr(f"{reach} <= {2.0**-bits!r}D"), F.expr(cells)).otherwise(start)
    return bounded.select(
        "lon", "lat", "n", "bound", F.expr(_NO_BEST).alias("best"), start.alias("open")
    )


def _open_nodes(state: DataFrame, nodes: DataFrame, index: SegmentIndex) -> DataFrame:
    """One round: replace the open nodes of each position by their still possible entries.

    The root and the level below it are on the way of every distant position: these nodes, at
    most FAN_OUT + 1 with at most FAN_OUT entries, are broadcast.
    """
    keyed = nodes.select(
        *(F.col(name).alias(f"_{name}") for name in ("bits", "cx", "cy", "entries"))
    )
    upper = F.col("_bits").isin(ROOT, index.top_bits)
    same = F.expr(_SAME_NODE)
    opened = (
        # a row without a node keeps the position, even if all its open nodes are ruled out
        state.select("*", F.expr("explode(array_append(open, NULL)) AS node"))
        .join(F.broadcast(keyed.filter(upper)), same, "left")
        .select(*state.columns, "node", F.col("_entries").alias("_upper"))
        .join(keyed.filter(~upper), same, "left")
        .select("*", F.expr("explode_outer(coalesce(_upper, _entries)) AS e"))
        .select("lon", "lat", "n", "bound", "best", "e", F.expr(f"{_LOWEST} AS low"))
        .filter("e IS NULL OR bound IS NULL OR low <= bound")
    )
    gathered = opened.groupBy("lon", "lat").agg(
        F.first("n").alias("n"),
        F.least(F.min("bound"), F.min(F.expr(_HIGHEST))).alias("bound"),
        F.min(
            F.least("best", F.expr("CASE WHEN e.s_id IS NOT NULL THEN struct(low AS d2, e.s_id AS s_id) END"))
        ).alias("best"),
        F.collect_list(
            F.expr("CASE WHEN e.bits IS NOT NULL THEN struct(low, e.bits AS bits, e.cx AS cx, e.cy AS cy) END")
        ).alias("cells"),
    )
    still = F.expr(
        "transform(filter(cells, c -> c.low <= bound), c -> struct(c.bits AS bits, c.cx AS cx, c.cy AS cy))"
    )
    return gathered.select("lon", "lat", "n", "bound", "best", still.alias("open"))


def _squares(dx: str, dy: str) -> str:
    return f"({dx} * {dx} + {dy} * {dy})"


# least and greatest squared distance from (lon, lat) to the bounds of entry `e`; for a midpoint
# both are the distance to it
_LOWEST = _squares(
    "greatest(e.x1 - lon, lon - e.x2, 0D)",
    "greatest(e.y1 - lat, lat - e.y2, 0D)",
)
_HIGHEST = _squares(
    "greatest(abs(lon - e.x1), abs(lon - e.x2))",
    "greatest(abs(lat - e.y1), abs(lat - e.y2))",
)


def _nearest_of(midpoints: str) -> str:
    """The least (d2, s_id) of an array of midpoints."""
    distance = _squares("(e.x1 - lon)", "(e.y1 - lat)")
    return f"array_min(transform({midpoints}, e -> struct({distance} AS d2, e.s_id AS s_id)))"


def _finest_level(positions: DataFrame, path: str) -> DataFrame:
    """The nodes of the finest common level; crowded ones are written with the levels below them.

    The positions of crowded cells are parted on a finer grid until no cell of it has more than
    LIST_LIMIT of them. They stay dealt out by rows: a cell may hold most of them.
    """
    spark = positions.sparkSession
    x, y = (_cell(F.col(name), FINEST_BITS).alias(alias) for name, alias in (("mid_lon", "cx"), ("mid_lat", "cy")))
    counts = positions.groupBy(x, y).agg(F.count(F.lit(1)).alias("crowd"))
    crowded, n_crowded = store(counts.filter(F.col("crowd") > LIST_LIMIT), "crowded-cells")
    if n_crowded == 0:
        return _leaves(positions, FINEST_BITS)
    marked = attach_by_key(positions.select("*", x, y), crowded, ["cx", "cy"], "crowd")
    marked, _ = store(marked.drop("cx", "cy"), "marked-positions")
    inside = marked.filter(F.col("crowd").isNotNull())
    bits = FINEST_BITS
    while True:
        bits += STEP_BITS
        cells = inside.groupBy(_cell(F.col("mid_lon"), bits), _cell(F.col("mid_lat"), bits)).count()
        if bits >= DEEPEST_BITS or (cells.agg(F.max("count")).first()[0] or 0) <= LIST_LIMIT:
            break
    _write_nodes(_leaves(inside, bits), path, bits)
    while bits > FINEST_BITS + STEP_BITS:
        bits -= STEP_BITS
        _write_nodes(_parents(_read_nodes(spark, path, bits + STEP_BITS), bits), path, bits)
    above = _parents(_read_nodes(spark, path, bits), FINEST_BITS)
    return _leaves(marked.filter(F.col("crowd").isNull()), FINEST_BITS).unionByName(above.select("cx", "cy", "n", "x1", "x2", "y1", "y2", "entries"))


def _leaves(positions: DataFrame, bits: int) -> DataFrame:
    """Cells with at most LIST_LIMIT positions, which they list."""
    entry = F.struct(
        F.col("mid_lon").alias("x1"), F.col("mid_lon").alias("x2"),
        F.col("mid_lat").alias("y1"), F.col("mid_lat").alias("y2"),
        F.lit(None).cast("int").alias("bits"), F.lit(None).cast("bigint").alias("cx"),
        F.lit(None).cast("bigint").alias("cy"), F.col("s_id"),
    )
    return (
        positions.groupBy(
            _cell(F.col("mid_lon"), bits).alias("cx"),
            _cell(F.col("mid_lat"), bits).alias("cy"),
        )
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("mid_lon").alias("x1"), F.max("mid_lon").alias("x2"),
            F.min("mid_lat").alias("y1"), F.max("mid_lat").alias("y2"),
            F.collect_list(entry).alias("entries"),
        )
    )


def _parents(level: DataFrame, bits: int) -> DataFrame:
    """Nodes one level up: at most FAN_OUT children each."""
    return level.groupBy(
        F.shiftright("cx", STEP_BITS).alias("cx"), F.shiftright("cy", STEP_BITS).alias("cy")
    ).agg(*_node_measures())


def _root(level: DataFrame) -> DataFrame:
    """The one node above the coarsest level, which has at most FAN_OUT cells."""
    root = level.agg(*_node_measures()).filter(F.col("n") > 0)
    return root.withColumns(
        {"cx": F.lit(0).cast("bigint"), "cy": F.lit(0).cast("bigint")}
    )


def _node_measures() -> list[Column]:
    child = F.struct("x1", "x2", "y1", "y2", "bits", "cx", "cy", F.lit(None).cast("string").alias("s_id"))
    listed = F.flatten(F.collect_list(F.when(F.col("n") <= LIST_LIMIT, F.col("entries"))))
    return [
        F.sum("n").alias("n"),
        F.min("x1").alias("x1"), F.max("x2").alias("x2"),
        F.min("y1").alias("y1"), F.max("y2").alias("y2"),
        F.when(F.sum("n") <= LIST_LIMIT, listed)
        .otherwise(F.collect_list(child).cast(f"array<{_ENTRY}>"))
        .alias("entries"),
    ]


def _blocks(level: DataFrame) -> DataFrame:
    """Per cell the midpoints of its 3 x 3 cells, at most 9 lists; none if one is crowded."""
    around = F.array(*(F.lit(step).cast("bigint") for step in (-1, 0, 1)))
    spread = level.select("*", F.explode(around).alias("dx")).select(
        "*", F.explode(around).alias("dy")
    )
    blocks = spread.groupBy(
        (F.col("cx") + F.col("dx")).alias("cx"), (F.col("cy") + F.col("dy")).alias("cy")
    ).agg(
        F.max("n").alias("fullest"),
        F.flatten(F.collect_list(F.when(F.col("n") <= LIST_LIMIT, F.col("entries")))).alias("near"),
    )
    return blocks.filter(F.col("fullest") <= LIST_LIMIT).drop("fullest")


def _write_nodes(nodes: DataFrame, path: str, bits: int) -> None:
    nodes.select("cx", "cy", "n", "x1", "x2", "y1", "y2", "entries").write.parquet(
        f"{path}/nodes/bits={bits}"
    )


def _read_nodes(spark: SparkSession, path: str, bits: int | None = None) -> DataFrame:
    nodes = spark.read.schema(_NODE_SCHEMA).parquet(f"{path}/nodes")
    return nodes if bits is None else nodes.filter(F.col("bits") == bits)


def _cell(coordinate: Column, bits: int) -> Column:
    number = F.floor(coordinate * (2.0**bits))
    return F.greatest(F.least(number, F.lit(_CELL_LIMIT)), F.lit(-_CELL_LIMIT))


def _finite(name: str) -> Column:
    return F.coalesce(F.abs(F.col(name)) < float("inf"), F.lit(False))
