from __future__ import annotations

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from bumpwise.functions.geodesy import TransverseMercator
from bumpwise.operators import roads
from bumpwise.operators.roads import (
    links_in_metres,
    ordered_by_link,
    parse_geojson_parts,
    parse_wkt_parts,
    segments_by_link,
    split_links,
    with_place,
)
from bumpwise.plans.network import build_segments
from bumpwise.schema import SEGMENT
from bumpwise.sinks.tables import write_segments
from bumpwise.sources.tables import read_links, read_segments_csv

LINKS = "link_id string, pts array<struct<x double, y double>>"


def links(spark, **lines):
    return spark.createDataFrame(list(lines.items()), LINKS)


def pieces(spark, length=50.0, **lines):
    rows = roads.split_links(links(spark, **lines), length).orderBy("s_id").collect()
    return {row["s_id"]: [(p["x"], p["y"]) for p in row["pts"]] for row in rows}


@pytest.mark.parametrize(("length", "count", "last"), [(120, 3, 20), (100, 2, 50), (10, 1, 10), (0, 0, None)])
def test_straight_lines(spark, length, count, last):
    got = pieces(spark, L=[(0.0, 0.0), (float(length), 0.0)])
    assert list(got) == [f"L_{i:04d}" for i in range(count)]
    if count:
        (x1, _), (x2, _) = list(got.values())[-1]
        assert (x2 - x1, x2) == (last, length)


def test_corner_is_kept(spark):
    got = pieces(spark, L=[(0.0, 0.0), (30.0, 0.0), (30.0, 40.0)])
    assert got == {
        "L_0000": [(0, 0), (30, 0), (30, 20)],
        "L_0001": [(30, 20), (30, 40)],
    }


def test_a_mark_on_a_vertex_and_repeated_vertices(spark):
    got = pieces(spark, L=[(0.0, 0.0), (0.0, 0.0), (50.0, 0.0), (50.0, 0.0), (100.0, 0.0)])
    assert got == {"L_0000": [(0, 0), (50, 0)], "L_0001": [(50, 0), (100, 0)]}


def test_lines_without_length_have_no_pieces(spark):
    assert pieces(spark, L=[(1.0, 1.0), (1.0, 1.0)], M=[(1.0, 1.0)], N=[]) == {}
    with pytest.raises(ValueError):
        roads.split_links(links(spark, L=[(0.0, 0.0), (1.0, 0.0)]), 0)


def test_every_copy_of_a_link_is_cut(spark):
    line = [(0.0, 0.0), (120.0, 0.0)]
    twice = links(spark, L=line).unionByName(links(spark, L=line))
    assert roads.split_links(twice).count() == 6


def test_a_link_without_a_line_is_an_error_unless_taken_out(spark):
    some = links(spark, L=[(0.0, 0.0), (60.0, 0.0)], O=None)
    with pytest.raises(Exception, match="no readable line: link O"):
        roads.split_links(some).collect()
    assert [row["link_id"] for row in roads.unreadable_links(some).collect()] == ["O"]
    assert build_segments(some, skip_unreadable=True).count() == 2


@pytest.mark.parametrize("seed", range(3))
def test_pieces_cover_the_line(spark, seed):
    rng = random.Random(seed)
    line = [(0.0, 0.0)]
    for _ in range(40):
        line.append((line[-1][0] + rng.uniform(-30, 60), line[-1][1] + rng.uniform(-30, 60)))
    got = pieces(spark, 37.5, L=line)
    total = sum(math.dist(a, b) for a, b in zip(line, line[1:]))
    lengths = [sum(math.dist(a, b) for a, b in zip(p, p[1:])) for p in got.values()]
    assert len(got) == math.ceil(total / 37.5)
    assert math.isclose(sum(lengths), total, rel_tol=1e-12)
    assert all(math.isclose(length, 37.5, rel_tol=1e-9) for length in lengths[:-1])
    parts = list(got.values())
    assert all(a[-1] == pytest.approx(b[0], abs=1e-9) for a, b in zip(parts, parts[1:]))
    kept = {tuple(p) for part in parts for p in part}
    assert set(line) <= kept


def test_ids_are_padded_and_never_cut(spark):
    rows = spark.createDataFrame([("L", 7), ("L", 12345)], "link string, n bigint")
    got = rows.select(roads.segment_id(F.col("link"), F.col("n"))).collect()
    assert [row[0] for row in got] == ["L_0007", "L_12345"]


def forward(lon, lat, grid=TransverseMercator()):
    """Degrees to metres, for the round trip."""
    f = 1 / grid.inverse_flattening
    e = math.sqrt(f * (2 - f))
    phi, lam = math.radians(lat), math.radians(lon - grid.lon_origin)
    tau = math.sinh(math.asinh(math.tan(phi)) - e * math.atanh(e * math.sin(phi)))
    xi = math.atan2(tau, math.cos(lam))
    eta = math.asinh(math.sin(lam) / math.hypot(tau, math.cos(lam)))
    x = eta + sum(a * math.cos(2 * j * xi) * math.sinh(2 * j * eta) for j, a in enumerate(grid.alpha, 1))
    y = xi + sum(a * math.sin(2 * j * xi) * math.cosh(2 * j * eta) for j, a in enumerate(grid.alpha, 1))
    return grid.false_easting + grid.radius * x, grid.false_northing + grid.radius * (y - grid.origin_arc)


def test_projection_round_trip(spark):
    rng = random.Random(5)
    places = [(rng.uniform(124, 132), rng.uniform(33, 43)) for _ in range(200)]
    rows = [(*place, *forward(*place)) for place in places]
    table = spark.createDataFrame(rows, "lon0 double, lat0 double, x double, y double")
    worst = roads.reproject(table).selectExpr("max(abs(lon - lon0))", "max(abs(lat - lat0))").first()
    assert max(worst) < 1e-9


def test_projection_origin(spark):
    table = spark.createDataFrame([(200000.0, 600000.0)], "x double, y double")
    row = roads.reproject(table).first()
    assert (row["lon"], round(row["lat"], 9)) == (127.0, 38.0)


def test_geometry_texts(spark):
    texts = [
        ("LINESTRING (1 2, 3.5 -4e1)", [(1.0, 2.0), (3.5, -40.0)]),
        (" linestring z(1 2 9,3 4 9, 5 6 9)", [(1.0, 2.0), (3.0, 4.0), (5.0, 6.0)]),
        ("LINESTRING EMPTY", None),
        ("LINESTRING (1 2)", None),
        ("LINESTRING (1 2, x 3)", None),
        ("POINT (1 2)", None),
        (None, None),
    ]
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "i int, t string")
    got = rows.select("i", roads.parse_wkt(F.col("t")).alias("p")).orderBy("i").collect()
    assert [row["p"] and [tuple(p) for p in row["p"]] for row in got] == [want for _, want in texts]
    jsons = [
        ('{"type":"LineString","coordinates":[[1,2],[3,4,5]]}', [(1.0, 2.0), (3.0, 4.0)]),
        ('{"type":"Point","coordinates":[1,2]}', None),
        ("nonsense", None),
    ]
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(jsons)], "i int, t string")
    got = rows.select("i", roads.parse_geojson(F.col("t")).alias("p")).orderBy("i").collect()
    assert [row["p"] and [tuple(p) for p in row["p"]] for row in got] == [want for _, want in jsons]


def test_network_from_file_to_csv(spark, path_for):
    source, target = path_for("links"), path_for("segments")
    rows = [
        ("10", "863", "LINESTRING (200000 600000, 200000 600120)"),
        ("11", "1", "LINESTRING (200000 600000, 200000 600050)"),
    ]
    spark.createDataFrame(rows, "LINK_ID string, ROAD_NO string, geometry string").write.csv(source, header=True)
    network = read_links(spark, source, link_id="LINK_ID")
    segments = build_segments(network, "ROAD_NO", 863)
    write_segments(segments, target)
    got = read_segments_csv(spark, target).orderBy("s_id").collect()
    assert [row["s_id"] for row in got] == ["10_0000", "10_0001", "10_0002"]
    assert (got[0]["start_lon"], got[0]["start_lat"]) == (127.0, 38.0)
    assert got[0]["end_lat"] == got[1]["start_lat"] == round(got[0]["end_lat"], 6)
    with pytest.raises(ValueError, match="no link"):
        build_segments(network, "ROAD_NO", "2")


def test_segments_by_link(spark):
    rows = [("a_1", "a", 3.0, 0.0, 4.0, 0.0), ("a_0", "a", 1.0, 0.0, 2.0, 0.0), ("b_0", "b", 5.0, 0.0, 6.0, 0.0)]
    table = spark.createDataFrame(
        rows, "s_id string, link_id string, start_lon double, start_lat double, end_lon double, end_lat double"
    )
    got = {row["link_id"]: row for row in roads.segments_by_link(table).collect()}
    assert (got["a"]["n_segments"], got["a"]["first"]["s_id"], got["a"]["last"]["s_id"]) == (2, "a_0", "a_1")
    assert [row["s_id"] for row in roads.ordered_by_link(table).collect()] == ["a_0", "a_1", "b_0"]


# degrees, links of several lines, places of segments


def test_grid_round_trip_over_the_country(spark):
    grid = TransverseMercator(latitude_order=5)
    points = spark.range(0, 4000).select(
        (F.rand(3) * 8 + 124).alias("lon"), (F.rand(4) * 10 + 33).alias("lat")
    )
    x, y = grid.to_grid(F.col("lon"), F.col("lat"))
    there = points.select("lon", "lat", x.alias("x"), y.alias("y"))
    lon, lat = grid.to_lon_lat(F.col("x"), F.col("y"))
    back = there.select("lon", "lat", "x", "y", lon.alias("lon2"), lat.alias("lat2"))
    again = grid.to_grid(F.col("lon2"), F.col("lat2"))
    worst = back.agg(
        F.max(F.abs(F.col("lon") - F.col("lon2"))), F.max(F.abs(F.col("lat") - F.col("lat2"))),
        F.max(F.abs(again[0] - F.col("x"))), F.max(F.abs(again[1] - F.col("y"))),
    ).first()
    assert worst[0] < 1e-9 and worst[1] < 1e-9
    assert worst[2] < 1e-6 and worst[3] < 1e-6


@pytest.mark.parametrize(("order", "limit"), [(4, 2e-6), (5, 1e-6)])
def test_grid_round_trip_from_metres_near_the_road(spark, order, limit):
    grid = TransverseMercator(latitude_order=order)
    points = spark.range(0, 2000).select((F.rand(5) * 1e5 + 2e5).alias("x"), (F.rand(6) * 1e5 + 2e5).alias("y"))
    lon, lat = grid.to_lon_lat(F.col("x"), F.col("y"))
    x2, y2 = grid.to_grid(lon, lat)
    worst = points.agg(F.max(F.abs(x2 - F.col("x"))), F.max(F.abs(y2 - F.col("y")))).first()
    assert max(worst) < limit


def test_the_origin_and_places_without_an_image(spark):
    grid = TransverseMercator()
    rows = [(127.0, 38.0), (127.0, 90.5), (-60.0, 10.0), (float("nan"), 38.0), (None, 38.0), (487.0, 38.0)]
    x, y = grid.to_grid(F.col("lon"), F.col("lat"))
    found = spark.createDataFrame(rows, "lon double, lat double").select(x, y).collect()
    assert found[0][0] == pytest.approx(200000, abs=1e-6) and found[0][1] == pytest.approx(600000, abs=1e-6)
    assert [tuple(row) for row in found[1:]] == [(None, None)] * 5


def test_links_in_degrees_are_cut_in_metres(spark):
    grid = TransverseMercator()
    metres = [(200000.0, 250000.0), (200120.0, 250000.0), (200120.0, 250090.0)]
    frame = spark.createDataFrame([(i, *p) for i, p in enumerate(metres)], "i int, x double, y double")
    lon, lat = grid.to_lon_lat(F.col("x"), F.col("y"))
    corners = [tuple(r) for r in frame.select(lon, lat).orderBy("i").collect()]
    text = json.dumps({"type": "LineString", "coordinates": corners})
    links = spark.createDataFrame([("a", text)], "link_id string, geometry string")
    read = links.withColumn("parts", parse_geojson_parts(F.col("geometry"))).withColumn("pts", F.flatten("parts"))
    pieces = {r["s_id"]: r["pts"] for r in split_links(links_in_metres(read)).collect()}
    assert len(pieces) == 5  # 210 m
    ends = [(p["x"], p["y"]) for p in pieces["a_0002"]]
    wanted = [(200100.0, 250000.0), (200120.0, 250000.0), (200120.0, 250030.0)]
    assert all(a == pytest.approx(b, abs=1e-5) for a, b in zip(ends, wanted, strict=True))
    segments = build_segments(read, in_degrees=True).collect()
    assert len(segments) == 5 and all(124 < s["start_lon"] < 132 for s in segments)


def test_links_are_parsed_and_projected_once(spark, path_for, plan_of):
    path = path_for("links")
    links = spark.createDataFrame([("a", "LINESTRING (127 38, 127.001 38)")], "link_id string, geometry string")
    links.write.csv(path, header=True)
    for skip in (False, True):
        segments = build_segments(read_links(spark, path), in_degrees=True, skip_unreadable=skip)
        assert segments.count() == 2
        plan = plan_of(segments)
        # two mentions in each branch of the parser; of the projection one in each coordinate
        assert plan.count("MULTILINESTRING") <= 4
        assert plan.count("ATANH(") <= 8


def test_degrees_without_an_image_are_unreadable(spark):
    links = spark.createDataFrame([("a", "LINESTRING (127 38, 127 95)")], "link_id string, geometry string")
    read = links.withColumn("parts", parse_wkt_parts(F.col("geometry"))).withColumn("pts", F.flatten("parts"))
    assert links_in_metres(read).filter("pts IS NULL AND parts IS NULL").count() == 1
    assert build_segments(read, in_degrees=True, skip_unreadable=True).count() == 0
    with pytest.raises(Exception, match="no readable line: link a"):
        build_segments(read, in_degrees=True).collect()


MULTI = [
    ("MULTILINESTRING ((0 0, 30 0), (100 0, 130 0, 130 40))", [2, 3]),
    ("multilinestring z((0 0 1,30 0 2) , (100 0 1,130 0 2))", [2, 2]),
    ("LINESTRING (0 0, 1 1)", [2]),
    ("MULTILINESTRING ((0 0, 30 0), (100 0))", None),
    ("MULTILINESTRING ((0 0, 30 0), (100 0, x 0))", None),
    ("MULTILINESTRING EMPTY", None),
    ("MULTILINESTRING ((0 0, 30 0), EMPTY)", None),
    ("POINT (1 1)", None),
    (None, None),
]


def test_wkt_of_several_lines(spark):
    frame = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(MULTI)], "i int, t string")
    rows = frame.select("i", parse_wkt_parts(F.col("t")).alias("parts")).orderBy("i").collect()
    assert [r["parts"] and [len(p) for p in r["parts"]] for r in rows] == [sizes for _, sizes in MULTI]


def test_geojson_of_several_lines(spark):
    texts = [
        '{"type":"MultiLineString","coordinates":[[[0,0],[30,0]],[[100,0],[130,0],[130,40]]]}',
        '{"type":"LineString","coordinates":[[0,0],[1,1]]}',
        '{"type":"MultiLineString","coordinates":[[[0,0],[30,0]],[[1,1]]]}',
        '{"type":"MultiLineString","coordinates":[]}',
        '{"type":"Point","coordinates":[0,0]}',
        "no json",
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    rows = frame.select("i", parse_geojson_parts(F.col("t")).alias("parts")).orderBy("i").collect()
    assert [r["parts"] and [len(p) for p in r["parts"]] for r in rows] == [[2, 3], [2], None, None, None, None]


def test_several_lines_are_cut_under_one_running_length(spark):
    links = spark.createDataFrame([("m", MULTI[0][0]), ("z", "MULTILINESTRING ((5 5, 5 5), (0 0, 60 0), (60 0, 70 0))")], "link_id string, t string")
    read = links.withColumn("parts", parse_wkt_parts(F.col("t"))).withColumn("pts", F.flatten("parts"))
    pieces = {r["s_id"]: [(p["x"], p["y"]) for p in r["pts"]] for r in split_links(read).collect()}
    assert pieces == {
        # 100 m in all: the first piece ends one line and begins the next, both ends of the gap stay
        "m_0000": [(0, 0), (30, 0), (100, 0), (120, 0)],
        "m_0001": [(120, 0), (130, 0), (130, 40)],
        "z_0000": [(0, 0), (50, 0)],
        "z_0001": [(50, 0), (60, 0), (70, 0)],
    }


def test_pieces_beyond_four_digits_stay_in_order(spark):
    names = [f"a_{n:04d}" for n in (9998, 9999, 10000, 10001, 0)] + ["b", "a", None]
    rows = [(n, "L" if n != "b" else None, 0.0, 0.0, 0.0, 0.0) for n in names]
    frame = spark.createDataFrame(rows, SEGMENT)
    found = {(r["link_id"], r["s_id"]): r["place"] for r in with_place(frame).collect()}
    assert found == {
        (None, "b"): 0, ("L", None): 0, ("L", "a"): 1, ("L", "a_0000"): 2, ("L", "a_9998"): 3,
        ("L", "a_9999"): 4, ("L", "a_10000"): 5, ("L", "a_10001"): 6,
    }
    ordered = [r["s_id"] for r in ordered_by_link(frame.filter("s_id LIKE 'a\\_%'")).collect()]
    assert ordered == ["a_0000", "a_9998", "a_9999", "a_10000", "a_10001"]
    last = segments_by_link(frame.filter("link_id = 'L'")).first()["last"]
    assert last["s_id"] == "a_10001"


def test_a_link_that_lies_in_many_tasks(spark, shuffled_joins):
    frame = spark.range(0, 30_000).select(
        F.format_string("L_%04d", F.col("id")).alias("s_id"), F.lit("L").alias("link_id"),
        *(F.lit(0.0).alias(n) for n in ("start_lon", "start_lat", "end_lon", "end_lat")),
    )
    placed = with_place(frame.repartition(7))
    assert placed.filter(F.col("place") != F.substring_index("s_id", "_", -1).cast("long")).count() == 0
    assert placed.count() == 30_000
