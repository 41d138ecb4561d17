from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from bumpwise.operators import nearest
from bumpwise.operators.nearest import (
    build_segment_index,
    nearest_segment,
    open_segment_index,
    segment_midpoints,
)
from bumpwise.schema import SEGMENT


def network(spark, midpoints):
    """Segments of no length, so a segment's midpoint is its place."""
    rows = [(s_id, "L", x, y, x, y) for s_id, x, y in midpoints]
    return spark.createDataFrame(rows, SEGMENT)


def points(spark, places):
    rows = [(i, *place) for i, place in enumerate(places)]
    return spark.createDataFrame(rows, "id bigint, lon double, lat double")


def brute_force(midpoints, places):
    answer = {}
    for number, (lon, lat) in enumerate(places):
        usable = lon is not None and lat is not None and math.isfinite(lon) and math.isfinite(lat)
        answer[number] = (
            min(((x - lon) * (x - lon) + (y - lat) * (y - lat), s_id) for s_id, x, y in midpoints)[1]
            if usable
            else None
        )
    return answer


def mapped(frame):
    rows = frame.collect()
    assert len({row["id"] for row in rows}) == len(rows)
    return {row["id"]: row["s_id"] for row in rows}


def test_midpoint(spark):
    rows = spark.createDataFrame([("a", "L", 1.0, 2.0, 2.0, 4.0)], SEGMENT)
    assert segment_midpoints(rows).first() == ("a", 1.5, 3.0)


def road(rng, n, lon, lat):
    """Midpoints about 50 m apart along a bent line."""
    found = []
    for i in range(n):
        lon += rng.uniform(0.0003, 0.0006)
        lat += rng.uniform(-0.0003, 0.0004)
        found.append((f"{i:05d}", round(lon, 6), round(lat, 6)))
    return found


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    midpoints = road(rng, 700, 127.5, 34.6)
    # copies of a place, and a crowded spot of 400 places in one small cell
    midpoints += [(f"d{i}", midpoints[5][1], midpoints[5][2]) for i in range(100)]
    midpoints += [(f"c{i}", 127.6 + (i % 20) * 1e-6, 34.65 + (i // 20) * 1e-6) for i in range(400)]
    places = [
        (x + rng.gauss(0, 0.0002), y + rng.gauss(0, 0.0002))
        for _, x, y in rng.sample(midpoints, 250)
    ]
    places += [(127.6 + rng.random() * 4e-5, 34.65 + rng.random() * 4e-5) for _ in range(60)]
    places += [(rng.uniform(127.4, 128), rng.uniform(34.4, 35)) for _ in range(60)]
    places += [(rng.uniform(-180, 180), rng.uniform(-90, 90)) for _ in range(30)]
    places += [(10.0, 10.0)] * 100 + [(None, 34.6), (127.5, None), (float("nan"), 34.6)]
    places += [(float("inf"), 34.6), (-0.0, 0.0), (0.0, -0.0), (1e6, -1e6)]
    index = build_segment_index(network(spark, midpoints))
    got = mapped(nearest_segment(points(spark, places), index))
    assert got == brute_force(midpoints, places)


def test_equals_brute_force_with_shuffled_joins_and_small_lists(spark, shuffled_joins, monkeypatch):
    monkeypatch.setattr(nearest, "LIST_LIMIT", 3)
    rng = random.Random(7)
    midpoints = [(f"s{i}", rng.uniform(127, 128), rng.uniform(34, 35)) for i in range(300)]
    midpoints += [(f"e{i}", rng.uniform(127, 127.01), rng.uniform(34, 34.01)) for i in range(300)]
    places = [(rng.uniform(126, 129), rng.uniform(33, 36)) for _ in range(150)]
    places += [(rng.uniform(127, 127.01), rng.uniform(34, 34.01)) for _ in range(150)]
    index = build_segment_index(network(spark, midpoints))
    assert index.rounds > 3
    got = mapped(nearest_segment(points(spark, places), index))
    assert got == brute_force(midpoints, places)


def test_ties_go_to_the_smaller_id(spark):
    midpoints = [("b", 127.0, 34.0), ("a", 127.25, 34.0), ("c", 127.0, 34.0), ("z", 127.125, 34.125)]
    places = [(127.125, 34.0), (127.0, 34.0), (127.125, -40.0), (127.1250001, 34.0)]
    index = build_segment_index(network(spark, midpoints))
    got = mapped(nearest_segment(points(spark, places), index))
    assert got == brute_force(midpoints, places) == {0: "a", 1: "b", 2: "a", 3: "a"}


def test_a_tie_across_the_block_edge_is_seen(spark):
    """A midpoint exactly one cell edge away may tie with one outside the 3 x 3 block."""
    edge = 2.0**-nearest.BLOCK_BITS
    midpoints = [("b", 127.0 + edge, 34.0), ("a", 127.0 - edge, 34.0)]
    places = [(127.0, 34.0)]
    index = build_segment_index(network(spark, midpoints))
    assert mapped(nearest_segment(points(spark, places), index)) == {0: "a"}


def test_point_far_from_every_segment_is_mapped(spark):
    midpoints = [("near", 127.0, 34.0), ("far", 127.0, 36.0)]
    index = build_segment_index(network(spark, midpoints))
    assert mapped(nearest_segment(points(spark, [(127.0, 29.0)]), index)) == {0: "near"}


def test_empty_network_and_empty_points(spark):
    index = build_segment_index(network(spark, []))
    assert mapped(nearest_segment(points(spark, [(127.0, 34.0)]), index)) == {0: None}
    index = build_segment_index(network(spark, [("a", 1.0, 1.0)]))
    assert mapped(nearest_segment(points(spark, []), index)) == {}


def test_index_can_be_opened_again(spark, path_for):
    path = path_for("index")
    midpoints = road(random.Random(4), 300, 127.5, 34.6)
    built = build_segment_index(network(spark, midpoints), path)
    assert open_segment_index(spark, path) == built
    assert built.blocks(spark).selectExpr("max(size(near))").first()[0] <= 9 * nearest.LIST_LIMIT
    assert built.nodes(spark).selectExpr("max(size(entries))").first()[0] <= nearest.LIST_LIMIT


def test_points_near_the_network_take_one_equi_join(spark, plan_of):
    midpoints = road(random.Random(4), 300, 127.5, 34.6)
    index = build_segment_index(network(spark, midpoints))
    near = nearest_segment(points(spark, [(x, y) for _, x, y in midpoints]), index)
    plan = plan_of(near)
    assert plan.count("Join") == 1
    for slow in ("Python", "CartesianProduct", "NestedLoop"):
        assert slow not in plan


def test_unplaced_rows_spread(spark, shuffled_joins):
    """Rows without coordinates do not share a join key."""
    midpoints = road(random.Random(4), 50, 127.5, 34.6)
    index = build_segment_index(network(spark, midpoints))
    places = [(None, None)] * 400
    result = nearest_segment(points(spark, places), index)
    from pyspark.sql import functions as F

    sizes = [row["count"] for row in result.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 400 and max(sizes) < 200


def test_a_cell_opened_in_vain_keeps_the_midpoint_found_before(spark, monkeypatch):
    """The bounds of a cell may be nearer than the best midpoint while none of its midpoints is."""
    monkeypatch.setattr(nearest, "LIST_LIMIT", 1)
    edge = 2.0**-nearest.BLOCK_BITS
    rng = random.Random(9)
    midpoints = []
    for i in range(256):  # wide cells that list one midpoint, next to wide cells with a pair in one cell
        x, y = 127 + 8 * edge * (i % 16), 34 + 8 * edge * (i // 16)
        if i % 2:
            y += edge * rng.randrange(8)
            midpoints += [(f"a{i}", x + 0.1 * edge, y + 0.9 * edge), (f"b{i}", x + 0.9 * edge, y + 0.1 * edge)]
        else:
            midpoints.append((f"c{i}", x + rng.uniform(4, 7.9) * edge, y + rng.uniform(0, 7.9) * edge))
    places = [(127 + rng.uniform(-8, 136) * edge, 34 + rng.uniform(-8, 136) * edge) for _ in range(4000)]
    index = build_segment_index(network(spark, midpoints))
    got = mapped(nearest_segment(points(spark, places), index))
    assert got == brute_force(midpoints, places)


def test_a_crowd_within_a_metre(spark):
    """Far more midpoints in one cell of the finest common level than a node may list."""
    n = 100_000
    crowd = spark.range(n).select(
        F.format_string("c%06d", "id").alias("s_id"), F.lit("L").alias("link_id"),
        (F.lit(127.5) + F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10**9)) * 1e-14).alias("start_lon"),
        (F.lit(34.5) + F.pmod(F.xxhash64("id", F.lit(2)), F.lit(10**9)) * 1e-14).alias("start_lat"),
    )
    crowd = crowd.select("*", F.col("start_lon").alias("end_lon"), F.col("start_lat").alias("end_lat"))
    rng = random.Random(4)
    others = [(f"o{i:03d}", 127.5 + rng.uniform(-0.01, 0.01), 34.5 + rng.uniform(-0.01, 0.01)) for i in range(200)]
    whole = crowd.unionByName(network(spark, others)).repartition(6)
    index = build_segment_index(whole)
    longest = index.nodes(spark).agg(F.max(F.size("entries"))).first()[0]
    assert longest <= nearest.LIST_LIMIT
    places = [(127.5 + rng.uniform(0, 1e-5), 34.5 + rng.uniform(0, 1e-5)) for _ in range(60)]
    places += [(127.5 + rng.uniform(-0.02, 0.02), 34.5 + rng.uniform(-0.02, 0.02)) for _ in range(40)]
    places += [(127.0, 30.0), (127.5, 34.5), (float("nan"), 1.0)]
    mids = whole.select("s_id", "start_lon", "start_lat").collect()
    order = sorted((row[0], row[1], row[2]) for row in mids)
    ids, xs, ys = zip(*order, strict=True)
    xs, ys = np.array(xs), np.array(ys)
    wanted = {}
    for at, (lon, lat) in enumerate(places):
        distance = (xs - lon) * (xs - lon) + (ys - lat) * (ys - lat)
        wanted[at] = ids[int(distance.argmin())] if math.isfinite(lon) else None
    assert mapped(nearest_segment(points(spark, places), index)) == wanted
    reopened = open_segment_index(spark, index.path)
    assert reopened == index and mapped(nearest_segment(points(spark, places), reopened)) == wanted


def test_a_crowd_of_copies_is_one_position(spark):
    same = [(f"{i:04d}", 127.5, 34.5) for i in range(500)] + [("x", 127.500001, 34.5)]
    index = build_segment_index(network(spark, same))
    assert mapped(nearest_segment(points(spark, [(127.5, 34.5), (128.0, 34.5)]), index)) == {0: "0000", 1: "x"}


def test_two_crowds_of_different_depth(spark):
    rng = random.Random(8)
    wide = [(f"a{i:03d}", 10.0 + rng.random() * 1e-5, 20.0 + rng.random() * 1e-5) for i in range(300)]
    deep = [(f"b{i:03d}", -10.0 - i * 2.0**-48, -20.0) for i in range(300)]
    mids = wide + deep
    index = build_segment_index(network(spark, mids))
    assert index.nodes(spark).agg(F.max(F.size("entries"))).first()[0] <= nearest.LIST_LIMIT
    places = [(10.0 + rng.random() * 1e-5, 20.0 + rng.random() * 1e-5) for _ in range(30)]
    places += [(-10.0 - i * 2.0**-48, -20.0) for i in range(0, 300, 17)] + [(0.0, 0.0)]
    assert mapped(nearest_segment(points(spark, places), index)) == brute_force(mids, places)
