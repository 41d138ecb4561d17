"""Road network: links to fixed-length segments with WGS84 end points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bumpwise.functions.geodesy import TransverseMercator
from bumpwise.session import store

SEGMENT_LENGTH = 50.0  # metres; fixed value
_DECIMALS = 6  # fixed value


def parse_wkt(text: Column) -> Column:
    """`LINESTRING (x y, x y)` to an array of points; a Z or M after x and y is dropped."""
    body = F.regexp_extract(text, r"(?i)^\s*LINESTRING\s*(?:ZM|Z|M)?\s*\(([^()]*)\)\s*$", 1)
    return _whole_line(_wkt_points(body))


def parse_wkt_parts(text: Column) -> Column:
    """A LINESTRING, or all lines of a MULTILINESTRING, to an array of arrays of points.

    One line that cannot be read makes the whole NULL: a link must not lose a part silently.
    """
    body = F.regexp_extract(
        text, r"(?i)^\s*MULTILINESTRING\s*(?:ZM|Z|M)?\s*\(\s*(\([^()]*\)(?:\s*,\s*\([^()]*\))*)\s*\)\s*$", 1
    )
    lines = F.regexp_extract_all(body, F.lit(r"\(([^()]*)\)"), F.lit(1))
    parts = F.transform(lines, lambda line: _whole_line(_wkt_points(line)))
    return F.when(body != "", _whole_parts(parts)).otherwise(_one_part(parse_wkt(text)))


def parse_geojson(text: Column) -> Column:
    """A GeoJSON LineString geometry to an array of points."""
    line = F.from_json(text, "type string, coordinates array<array<double>>")
    return F.when(line["type"] == "LineString", _whole_line(_pairs(line["coordinates"])))


def parse_geojson_parts(text: Column) -> Column:
    """A GeoJSON LineString, or all lines of a MultiLineString, to an array of arrays of points."""
    lines = F.from_json(text, "type string, coordinates array<array<array<double>>>")
    parts = F.transform(lines["coordinates"], lambda line: _whole_line(_pairs(line)))
    return F.when(lines["type"] == "MultiLineString", _whole_parts(parts)).otherwise(
        _one_part(parse_geojson(text))
    )


def links_in_metres(links: DataFrame, grid: TransverseMercator = TransverseMercator()) -> DataFrame:
    """Links whose `pts` (and `parts`) are lon and lat in degrees, with metres of the grid instead.

    A line with a point that has no image on the grid becomes NULL, so it counts as unreadable.
    """

    def projected(points: Column) -> Column:
        # in two steps: within a lambda nothing is shared, and the second reads the first's numbers often
        spheres = F.transform(points, lambda p: _pair("xi", "eta", grid.to_sphere(p["x"], p["y"])))
        return F.transform(spheres, lambda s: _pair("x", "y", grid.from_sphere(s["xi"], s["eta"])))

    if "parts" not in links.columns:
        return made_once(links, "pts", projected(F.col("pts"))).withColumn("pts", _whole_line(F.col("pts")))
    found = made_once(links, "parts", F.transform("parts", projected))
    found = found.withColumn("parts", _whole_parts(F.transform("parts", _whole_line)))
    return found.withColumn("pts", F.when(F.col("parts").isNotNull(), _whole_line(projected(F.col("pts")))))


def made_once(frame: DataFrame, name: str, value: Column) -> DataFrame:
    """`frame` with the column `name`, computed once per row.

    It passes through a generator of one row. The optimizer would else put a costly expression in
    each place where the column is used, and into the filters on it.
    """
    made, kept = f"_made_{name}", [F.col(f"`{other}`") for other in frame.columns if other != name]
    held = frame.withColumn(made, value)
    return held.select(*kept, F.inline(F.array(F.struct(F.col(made).alias(name)))))


def _pair(first: str, second: str, values: tuple[Column, Column]) -> Column:
    return F.struct(values[0].alias(first), values[1].alias(second))


def filter_links(links: DataFrame, column: str, value: object) -> DataFrame:
    """Links whose attribute equals the value, both read as text; none at all is an error."""
    chosen = links.filter(F.col(column).cast("string") == str(value))
    if chosen.isEmpty():
        raise ValueError(f"no link has {column} = {value}")
    return chosen


def unreadable_links(links: DataFrame) -> DataFrame:
    """Links whose geometry gave no line: malformed, missing, or of another type."""
    return links.filter(F.col("pts").isNull())


def segment_id(link_id: Column, number: Column) -> Column:
    """`<link>_<number>`, the number padded to four digits and never cut."""
    return F.format_string("%s_%04d", link_id, number)


def split_links(links: DataFrame, length: float = SEGMENT_LENGTH) -> DataFrame:
    """Links (`link_id`, `pts` in metres) cut every `length` metres: `s_id`, `link_id`, `pts`.

    The last piece may be shorter, a link without length has none, and interior vertices stay.
    Each straight stretch of a link is cut on its own at the marks it spans, so the work is
    linear in vertices and pieces. Every row is cut, copies of a link too. A link whose line could
    not be read (`pts` NULL) is an error; take out `unreadable_links` first to go on without.

    Links of several lines have these in `parts`, which then counts instead of `pts`. The lines are
    cut one after the other under one running length, so a piece may end one line and begin the
    next; gaps between lines have no length, and both of their ends are vertices of the piece.
    """
    if length <= 0:
        raise ValueError("length must be positive")
    message = F.concat(F.lit("no readable line: link "), F.coalesce(F.col("link_id").cast("string"), F.lit("NULL")))
    lines = F.col("parts") if "parts" in links.columns else F.when(F.col("pts").isNotNull(), F.array("pts"))
    unread = F.when(lines.isNull(), F.raise_error(message).cast("int")).otherwise(F.size(F.flatten(lines)))

    def stretches_of(line: Column) -> Column:
        after = F.slice(line, F.lit(2), F.greatest(F.size(line) - 1, F.lit(0)))
        # the last point has none after it
        pairs = F.zip_with(line, after, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        return F.filter(pairs, lambda pair: pair["b"].isNotNull())

    # copies of a row differ in this number alone
    numbered = links.select("link_id", lines.alias("parts"), unread.alias("n_points"), F.monotonically_increasing_id().alias("line_id"))
    stretches = numbered.filter(F.col("n_points") >= 2).select(
        "link_id", "line_id",
        F.posexplode(F.flatten(F.transform("parts", stretches_of))).alias("pos", "line"),
    )
    measured = stretches.select(
        "link_id", "line_id", "pos",
        F.col("line.a").alias("a"), F.col("line.b").alias("b"),
        F.hypot(
            F.col("line.b.x") - F.col("line.a.x"), F.col("line.b.y") - F.col("line.a.y")
        ).alias("long"),
    ).filter(F.col("long") > 0)
    # a window holds the vertices of one line, which come from one row
    upto = Window.partitionBy("link_id", "line_id").orderBy("pos")
    placed = measured.withColumn("end", F.sum("long").over(upto)).withColumn(
        "start", F.lag("end", 1, 0.0).over(upto)
    )
    first = F.floor(F.col("start") / length)
    last = F.ceil(F.col("end") / length) - 1
    cut = (
        placed.filter(last >= first)
        .select("*", F.explode(F.sequence(first, last)).alias("number"))
        .withColumn("from", F.greatest(F.col("start"), F.col("number") * length))
        .withColumn("to", F.least(F.col("end"), (F.col("number") + 1) * length))
        .select(
            "link_id", "line_id", "number", "pos",
            _between("from").alias("a"),
            _between("to").alias("b"),
        )
    )
    pieces = cut.groupBy("link_id", "line_id", "number").agg(
        F.sort_array(F.collect_list(F.struct("pos", "a", "b"))).alias("parts")
    )
    # a stretch that does not begin where the one before it ends lies behind a gap
    jumps = F.transform(
        "parts",
        lambda part, at: F.when(
            (at > 0) & (F.get(F.col("parts"), at - 1)["b"] != part["a"]), F.array(part["a"], part["b"])
        ).otherwise(F.array(part["b"])),
    )
    vertices = F.concat(F.array(F.col("parts")[0]["a"]), F.flatten(jumps))
    return pieces.select(
        segment_id(F.col("link_id"), F.col("number")).alias("s_id"), "link_id",
        vertices.alias("pts"),
    )


def reproject(
    points: DataFrame,
    x: str = "x",
    y: str = "y",
    grid: TransverseMercator = TransverseMercator(),
) -> DataFrame:
    """`points` with the `lon` and `lat` of its grid coordinates."""
    lon, lat = grid.to_lon_lat(F.col(x), F.col(y))
    return points.withColumns({"lon": lon, "lat": lat})


def segment_endpoints(
    pieces: DataFrame, grid: TransverseMercator = TransverseMercator()
) -> DataFrame:
    """Pieces in metres to road segments: end points in degrees, 6 decimals."""
    ends = {"start": F.element_at("pts", 1), "end": F.element_at("pts", -1)}
    columns = []
    for name, point in ends.items():
        lon, lat = grid.to_lon_lat(point["x"], point["y"])
        columns += [
            F.round(lon, _DECIMALS).alias(f"{name}_lon"),
            F.round(lat, _DECIMALS).alias(f"{name}_lat"),
        ]
    return pieces.select("s_id", "link_id", *columns)


def piece_number(s_id: Column) -> Column:
    """The number at the end of a segment's id, NULL without one; `a_10000` comes after `a_9999`."""
    return F.regexp_extract(s_id, r"_([0-9]+)$", 1).try_cast("decimal(38,0)")


def segments_by_link(segments: DataFrame) -> DataFrame:
    """Per link the number of its segments, and the first and last of them in order."""
    place = ("s_id", "start_lon", "start_lat", "end_lon", "end_lat")
    return segments.groupBy("link_id").agg(
        F.count(F.lit(1)).alias("n_segments"),
        F.min(F.struct(piece_number(F.col("s_id")).alias("number"), *place)).alias("first"),
        F.max(F.struct(piece_number(F.col("s_id")).alias("number"), *place)).alias("last"),
    )


def ordered_by_link(segments: DataFrame) -> DataFrame:
    """All segments, link by link in order, range-partitioned so a long link is spread too."""
    return segments.orderBy("link_id", piece_number(F.col("s_id")), "s_id")


def with_place(segments: DataFrame) -> DataFrame:
    """`segments` with `place`, their number from 0 on in the order of their link.

    Segments are dealt out by ranges of (link, piece), so a link may lie in many tasks, and are
    stored with the number of theirs. A task's part of a link is numbered by itself and starts at
    the sum of the parts before it: no task holds a whole link, and none a list of it.
    """
    order = ["link_id", "_number", "s_id"]
    numbered = segments.withColumn("_number", piece_number(F.col("s_id")))
    dealt = numbered.repartitionByRange(*order).withColumn("_task", F.spark_partition_id())
    dealt, _ = store(dealt, "segments-in-order")
    counts = dealt.groupBy("link_id", "_task").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("link_id").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col("link_id").alias("_link"), F.col("_task").alias("_part"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    inside = Window.partitionBy("link_id", "_task").orderBy("_number", "s_id")
    placed = dealt.withColumn("_in", F.row_number().over(inside) - 1)
    same = F.col("link_id").eqNullSafe(F.col("_link")) & (F.col("_task") == F.col("_part"))
    joined = placed.join(starts, same)
    return joined.select(*segments.columns, (F.col("_start") + F.col("_in")).cast("long").alias("place"))


def _whole_line(points: Column) -> Column:
    """The points if there are at least two and all are complete."""
    complete = F.forall(points, lambda p: p["x"].isNotNull() & p["y"].isNotNull())
    return F.when(complete & (F.size(points) >= 2), points)


def _whole_parts(parts: Column) -> Column:
    """The lines if there is at least one and all could be read."""
    return F.when((F.size(parts) >= 1) & F.forall(parts, lambda line: line.isNotNull()), parts)


def _one_part(line: Column) -> Column:
    return F.when(line.isNotNull(), F.array(line))


def _wkt_points(body: Column) -> Column:
    pairs = F.transform(F.split(body, ","), lambda pair: F.split(F.trim(pair), r"\s+"))
    return F.transform(
        pairs,
        lambda p: F.struct(
            F.get(p, F.lit(0)).try_cast("double").alias("x"),
            F.get(p, F.lit(1)).try_cast("double").alias("y"),
        ),
    )


def _pairs(coordinates: Column) -> Column:
    return F.transform(
        coordinates,
        lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y")),
    )


def _between(offset: str) -> Column:
    """The point of a stretch at a distance from the link's start; its ends exactly."""
    share = (F.col(offset) - F.col("start")) / F.col("long")

    def along(axis: str) -> Column:
        a, b = F.col("a")[axis], F.col("b")[axis]
        return (
            F.when(F.col(offset) == F.col("start"), a)
            .when(F.col(offset) == F.col("end"), b)
            .otherwise(a + (b - a) * share)
        )

    return F.struct(along("x").alias("x"), along("y").alias("y"))
