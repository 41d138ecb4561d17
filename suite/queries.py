"""A query per operator, over the given test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from bumpwise.functions.geodesy import TransverseMercator
from bumpwise.functions.predicates import valid_reading
from bumpwise.functions.scoring import impact_score as impact_score_of
from bumpwise.operators import facts, ingest, lookups, marts, roads
from bumpwise.operators.boxes import bbox_filter, bbox_semi_join
from bumpwise.operators.detect import (
    context_filter,
    detect_anomalies,
    with_trip_statistics,
    z_score,
)
from bumpwise.operators.nearest import (
    SegmentIndex,
    build_segment_index,
    nearest_segment,
    segment_midpoints,
)
from bumpwise.options import Box, ImpactRule
from bumpwise.plans.impacts import impact_counts, map_impacts, monitored, repair_priorities
from bumpwise.plans import upkeep
from bumpwise.plans.network import build_segments
from bumpwise.schema import (
    ANOMALY_COLUMNS,
    LATE_BY_DAY,
    MAPPED_BY_DAY,
    SENSOR_BY_DAY,
    SENSOR_COLUMNS,
)
from bumpwise.session import store, work_path
from bumpwise.sinks import tables as sinks
from bumpwise.sources import messages as message_sources
from bumpwise.sources import tables as sources
from bumpwise.streaming import first as firsts
from bumpwise.streaming import jobs as streams
from suite import adapters

# the adapters' trips span days, so trips are judged whole
TRIP = ("trip_id",)
LOWER_BAR = ImpactRule(threshold=1.5)
AS_OF_FACTS = "2001-11-04"
AS_OF_EVENTS = "2024-01-30"
ANYWHERE = (Box("anywhere", -180.0, 180.0, -90.0, 90.0),)
SCAN_DAY = "2024-01-15"
LOAD_DATE = "2026-02-12"
BASE_UNTIL, DELTA_FROM, DELTA_AGAIN_FROM = "1998-12-31", "1998-06-01", "2001-01-01"
VIEW = Box("view", 127.55, 127.65, 34.5, 34.8)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    """Register a query under its name; `_rows` tells it from the operator it calls."""
    QUERIES[run.__name__.removesuffix("_rows")] = run
    return run


@cache
def _index_of(application: str, sf_dir: str) -> SegmentIndex:
    spark = SparkSession.getActiveSession()
    return build_segment_index(adapters.segments(spark, sf_dir))


def network_index(spark: SparkSession, sf_dir: str) -> SegmentIndex:
    """The index of the network, built once per application: it serves all queries on it."""
    return _index_of(spark.sparkContext.applicationId, sf_dir)


def _rounded(table: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return table.withColumns({name: F.round(name, digits) for name in names})


# detection


@query
def valid_range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.sensor(spark, sf_dir).filter(valid_reading()).select("event_id", "lon", "lat")


@query
def bbox_filter_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bbox_filter(adapters.sensor(spark, sf_dir)).select("event_id", "lon", "lat")


@query
def bbox_filter_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A box around each segment."""
    margin = 0.00005
    boxes = adapters.segments(spark, sf_dir).select(
        (F.col("start_lon") - margin).alias("min_lon"), (F.col("end_lon") + margin).alias("max_lon"),
        (F.col("start_lat") - margin).alias("min_lat"), (F.col("end_lat") + margin).alias("max_lat"),
    )
    return bbox_semi_join(adapters.sensor(spark, sf_dir), boxes).select("event_id", "lon", "lat")


@query
def context_filter_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_filter(adapters.sensor(spark, sf_dir)).select(
        "event_id", "velocity", "hdop", "satellites"
    )


@query
def trip_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    usable = context_filter(adapters.sensor(spark, sf_dir))
    wanted = ("mean_accel_z", "std_accel_z", "mean_gyro_y", "std_gyro_y")
    rows = with_trip_statistics(usable.select("event_id", "trip_id", "accel_z", "gyro_y"), TRIP)
    return _rounded(rows.select("event_id", *wanted), *wanted)


@query
def z_score_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    usable = context_filter(adapters.sensor(spark, sf_dir))
    rows = z_score(usable.select("event_id", "trip_id", "accel_z", "gyro_y"), TRIP)
    return _rounded(rows.select("event_id", "nor_accel_z", "nor_gyro_y"), "nor_accel_z", "nor_gyro_y")


@query
def impact_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    usable = context_filter(adapters.sensor(spark, sf_dir))
    rows = z_score(usable.select("event_id", "trip_id", "accel_z", "gyro_y"), TRIP)
    scored = rows.select("event_id", impact_score_of().alias("impact_score"))
    return _rounded(scored, "impact_score")


def _anomalies(spark: SparkSession, sf_dir: str, rule: ImpactRule = ImpactRule()) -> DataFrame:
    return detect_anomalies(monitored(adapters.sensor(spark, sf_dir)), TRIP, rule)


@query
def detect_anomalies_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _anomalies(spark, sf_dir).select("event_id", *ANOMALY_COLUMNS)
    return _rounded(rows, "nor_accel_z", "nor_gyro_y", "impact_score")


@query
def write_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "anomalies")
    sinks.write_anomalies(_anomalies(spark, sf_dir, LOWER_BAR), path)
    rows = sources.read_anomalies(spark, path)
    return _rounded(rows, "nor_accel_z", "nor_gyro_y", "impact_score")


@query
def run_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usable and anomalous rows, observed while the anomalies are written."""
    usable, found = Observation(), Observation()
    rows = detect_anomalies(
        monitored(adapters.sensor(spark, sf_dir)), TRIP, seen=usable, found=found
    )
    sinks.write_anomalies(rows, work_path(spark, "anomalies"))
    return spark.createDataFrame(
        [(usable.get["n"], found.get["n"])], "usable bigint, anomalies bigint"
    )


# mapping and facts


@query
def segment_midpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment_midpoints(adapters.segments(spark, sf_dir))


@query
def nearest_segment_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = adapters.sensor(spark, sf_dir).select("event_id", "lon", "lat")
    return nearest_segment(points, network_index(spark, sf_dir)).select("event_id", "s_id")


@query
def mapping_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mapped and unmapped points when the northern ones have lost their longitude."""
    points = adapters.sensor(spark, sf_dir).select(
        "event_id", F.when(F.col("lat") < 50, F.col("lon")).alias("lon"), "lat"
    )
    return facts.unmapped_count(nearest_segment(points, network_index(spark, sf_dir)))


@query
def daily_segment_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impact_counts(
        adapters.sensor(spark, sf_dir), network_index(spark, sf_dir), TRIP, LOWER_BAR
    )


@query
def repair_priorities_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_priorities(
        adapters.sensor(spark, sf_dir), network_index(spark, sf_dir), AS_OF_EVENTS, TRIP, LOWER_BAR
    )


@query
def load_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts written under two folders, read back as one day's."""
    path = work_path(spark, "stage2")
    table = adapters.fact(spark, sf_dir)
    table.filter(F.col("date") <= BASE_UNTIL).write.parquet(f"{path}/a")
    table.filter(F.col("date") > BASE_UNTIL).drop("date").write.parquet(f"{path}/b/c")
    return sources.load_fact(spark, path, LOAD_DATE)


@query
def union_fact_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = adapters.fact(spark, sf_dir)
    early = table.filter(F.col("date") <= BASE_UNTIL)
    late = table.filter(F.col("date") > BASE_UNTIL).drop("centroid_lat")
    return sources.union_by_name([early, late])


def _uneven_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts as text, with gaps and coordinates that are no numbers."""
    return adapters.fact(spark, sf_dir).select(
        "s_id",
        F.when(F.col("s_id") == "3", "x").otherwise(F.col("centroid_lon").cast("string")).alias("centroid_lon"),
        F.when(F.col("impact_count") > 2, F.col("centroid_lat").cast("string")).alias("centroid_lat"),
        F.col("date").cast("string").alias("date"),
        F.col("impact_count").cast("string").alias("impact_count"),
    )


@query
def null_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.null_audit(_uneven_fact(spark, sf_dir))


@query
def coerce_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.coerce_fact(_uneven_fact(spark, sf_dir))


def _base_and_delta(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    table = adapters.fact(spark, sf_dir)
    delta = table.filter(F.col("date") >= DELTA_FROM).withColumn(
        "centroid_lon", F.col("centroid_lon") + 0.5
    )
    return table.filter(F.col("date") <= BASE_UNTIL), delta


@query
def merge_additive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.merge_additive(*_base_and_delta(spark, sf_dir))


@query
def merge_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.merge_additive(*_base_and_delta(spark, sf_dir), mode="replace")


@query
def merge_replace_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days counted again with fewer segments: the ones that vanished go from the stored table."""
    path = work_path(spark, "fact")
    base, delta = _base_and_delta(spark, sf_dir)
    sinks.append_to_fact(base, path)
    sinks.merge_into_fact(delta.filter("impact_count > 1"), path, mode="replace")
    return sources.read_fact(spark, path).drop("created_at", "updated_at", "month")


@query
def merge_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same merge on a stored table."""
    path = work_path(spark, "fact")
    base, delta = _base_and_delta(spark, sf_dir)
    sinks.append_to_fact(base, path)
    sinks.merge_into_fact(delta, path)
    return sources.read_fact(spark, path).drop("created_at", "updated_at", "month")


@query
def append_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, delta = _base_and_delta(spark, sf_dir)
    again = adapters.fact(spark, sf_dir).filter(F.col("date") >= DELTA_AGAIN_FROM)
    return facts.append_conflicts(base, delta.unionByName(again))


@query
def fact_month_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "fact")
    sinks.write_fact(adapters.fact(spark, sf_dir), path)
    stored = sources.read_fact(spark, path)
    return stored.groupBy("month").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("impact_count").alias("impacts")
    )


@query
def monthly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.monthly_counts(adapters.fact(spark, sf_dir))


# marts and lookups


@query
def mart_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.context(adapters.fact(spark, sf_dir))


@query
def mart_daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.daily_summary(adapters.fact(spark, sf_dir))


@query
def mart_repair_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.repair_priority(adapters.fact(spark, sf_dir), AS_OF_FACTS)


@query
def mart_repair_priority_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With coordinates that drift from day to day."""
    drifting = adapters.fact(spark, sf_dir).withColumn(
        "centroid_lon", F.col("centroid_lon") + F.dayofmonth("date") / 1000
    )
    rows = marts.repair_priority_by_segment(drifting, AS_OF_FACTS)
    return _rounded(rows, "centroid_lon")


@query
def mart_segment_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.segment_trend(adapters.fact(spark, sf_dir))


@query
def top_priorities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.top_priorities(adapters.fact(spark, sf_dir), 10, AS_OF_FACTS)


@query
def refresh_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = sinks.refresh_marts(
        adapters.fact(spark, sf_dir), work_path(spark, "marts"), AS_OF_FACTS
    )
    return status.select("mart", "status", "n_rows")


@query
def mart_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily summary that readers see when the refresh after it has failed."""
    path, fact = work_path(spark, "marts"), adapters.fact(spark, sf_dir)
    only = {"daily_summary": marts.daily_summary}
    sinks.refresh_marts(fact.limit(10), path, chosen=only)
    sinks.refresh_marts(fact, path, chosen=only)
    broken = {"daily_summary": lambda rows: marts.daily_summary(rows.withColumn("impact_count", F.raise_error(F.lit("x")).cast("int")))}
    sinks.refresh_marts(fact, path, chosen=broken)
    upkeep.remove_old_marts(spark, path)
    return sources.read_mart(spark, path, "daily_summary")


@query
def lookup_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.by_date_range(adapters.fact(spark, sf_dir), "1996-03-01", "1996-04-15")


@query
def lookup_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.by_segment(adapters.fact(spark, sf_dir), "7")


@query
def lookup_viewport(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.in_viewport(adapters.fact(spark, sf_dir), VIEW)


@query
def lookup_date_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.by_date_and_segment(adapters.fact(spark, sf_dir), "1995-08-09", "11")


@query
def lookup_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.with_impacts(adapters.fact(spark, sf_dir), 4)


def _stored_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The facts from their table, clustered for lookups."""
    path = work_path(spark, "fact")
    sinks.write_fact(adapters.fact(spark, sf_dir), path)
    return sources.read_fact(spark, path)


_STORED_ONLY = ("created_at", "updated_at", "month")


@query
def lookup_segment_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.by_segment(_stored_fact(spark, sf_dir), "7").drop(*_STORED_ONLY)


@query
def lookup_viewport_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.in_viewport(_stored_fact(spark, sf_dir), VIEW).drop(*_STORED_ONLY)


@query
def lookup_impact_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.with_impacts(_stored_fact(spark, sf_dir), 4).drop(*_STORED_ONLY)


@query
def lookup_date_range_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lookups.by_date_range(_stored_fact(spark, sf_dir), "1996-03-01", "1996-04-15")
    return found.drop(*_STORED_ONLY)


# ingest


def _readings(trips: DataFrame) -> DataFrame:
    return ingest.readings(trips)


@query
def parse_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _readings(ingest.parse_trips(adapters.messages(spark, sf_dir), boxes=ANYWHERE))


@query
def parse_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    bare = adapters.messages(spark, sf_dir, optional_keys=False)
    return _readings(ingest.parse_trips(bare, boxes=ANYWHERE))


@query
def trip_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = ingest.parse_trips(adapters.messages(spark, sf_dir))
    return trips.select("trip_id", "outcome", "n_valid", F.size("kept").alias("n_kept"))


@query
def ingest_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.ingest_counters(ingest.parse_trips(adapters.messages(spark, sf_dir)))


@query
def write_raw_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message twice in one batch, and all of them again in a later batch."""
    path = work_path(spark, "raw")
    messages, _ = store(adapters.messages(spark, sf_dir), "messages")
    again = messages.withColumn("seq", F.col("seq") + (1 << 40))
    sinks.write_raw(ingest.parse_trips(messages.unionByName(again)), path, batch=1)
    later = messages.withColumn("seq", F.col("seq") + (1 << 41))
    sinks.write_raw(ingest.parse_trips(later), path, batch=2)
    return sources.read_latest(spark, path, SENSOR_BY_DAY)


@query
def compact_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table after its days, with redelivered trips, were rewritten as one batch each."""
    path = work_path(spark, "raw")
    messages, _ = store(adapters.messages(spark, sf_dir), "messages")
    for batch in range(3):
        part = messages.filter(F.pmod("seq", F.lit(3)) >= batch).withColumn("seq", F.col("seq") + (batch << 40))
        sinks.write_raw(ingest.parse_trips(part), path, batch)
    upkeep.compact_raw(spark, path)
    return sources.read_latest(spark, path, SENSOR_BY_DAY)


@query
def scan_raw_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "raw-days")
    sinks.write_by_day(adapters.sensor(spark, sf_dir), path, SENSOR_COLUMNS)
    return sources.scan_raw_partition(spark, path, SCAN_DAY)


# roads


@query
def scan_segments_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "segments-csv")
    sinks.write_segments(adapters.segments(spark, sf_dir), path)
    return sources.read_segments_csv(spark, path)


@query
def write_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "segments")
    sinks.write_segments(adapters.segments(spark, sf_dir), path, "parquet")
    return spark.read.parquet(path)


@query
def segments_by_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = roads.segments_by_link(adapters.segments(spark, sf_dir))
    return rows.select(
        "link_id", "n_segments",
        F.col("first.s_id").alias("first_s_id"), F.col("first.start_lon").alias("first_lon"),
        F.col("last.s_id").alias("last_s_id"), F.col("last.end_lon").alias("last_lon"),
    )


def _line_ends(links: DataFrame) -> DataFrame:
    first, last = F.element_at("pts", 1), F.element_at("pts", -1)
    return links.select(
        "link_id", F.size("pts").alias("n_points"),
        first["x"].alias("x1"), first["y"].alias("y1"), last["x"].alias("x2"), last["y"].alias("y2"),
    )


@query
def parse_wkt_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "links-wkt")
    line = F.format_string(
        "LINESTRING (%s %s, %s %s)",
        *(F.col(name).cast("string") for name in ("x0", "y0", "x1", "y0")),
    )
    links = adapters.links(spark, sf_dir).withColumn("x1", F.col("x0") + F.col("len"))
    links.select("link_id", "road_no", line.alias("geometry")).write.csv(path, header=True)
    return _line_ends(sources.read_links(spark, path))


@query
def parse_geojson_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    geometry = F.to_json(
        F.struct(
            F.lit("LineString").alias("type"),
            F.transform("pts", lambda p: F.array(p["x"], p["y"])).alias("coordinates"),
        )
    )
    links = adapters.links(spark, sf_dir).select("link_id", geometry.alias("geometry"))
    return _line_ends(links.withColumn("pts", roads.parse_geojson(F.col("geometry"))))


@query
def filter_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roads.filter_links(adapters.links(spark, sf_dir), "road_no", 3).select(
        "link_id", "road_no", "len"
    )


@query
def split_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = roads.split_links(adapters.links(spark, sf_dir))
    first, last = F.element_at("pts", 1), F.element_at("pts", -1)
    rows = pieces.select(
        "s_id", "link_id", F.size("pts").alias("n_points"),
        first["x"].alias("x1"), first["y"].alias("y1"), last["x"].alias("x2"), last["y"].alias("y2"),
    )
    return _rounded(rows, "x1", "x2")


@query
def split_links_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces per link when every link is there twice."""
    links = adapters.links(spark, sf_dir)
    pieces = roads.split_links(links.unionByName(links))
    return pieces.groupBy("link_id").agg(F.count(F.lit(1)).alias("pieces"))


@query
def links_unreadable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many links have no line, where those of other roads are points."""
    path = work_path(spark, "links")
    links = adapters.links(spark, sf_dir)
    geometry = F.when(F.col("road_no") == "3", "LINESTRING (0 0, 1 1)").otherwise("POINT (0 0)")
    links.select("link_id", geometry.alias("geometry")).write.csv(path, header=True)
    return roads.unreadable_links(sources.read_links(spark, path)).agg(F.count(F.lit(1)).alias("unreadable"))


@query
def segment_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers from 0 up to beyond four digits."""
    links = adapters.links(spark, sf_dir)
    return links.select(
        "link_id", roads.segment_id(F.col("link_id"), F.col("link_id").cast("bigint") * 7).alias("s_id")
    )


@query
def reproject_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = roads.reproject(adapters.links(spark, sf_dir), "x0", "y0")
    return _rounded(rows.select("link_id", "lon", "lat"), "lon", "lat", digits=9)


@query
def segment_endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_segments(adapters.links(spark, sf_dir))


@query
def build_road_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_segments(adapters.links(spark, sf_dir), "road_no", "3")


@query
def project_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Degrees to grid metres, to the millimetre."""
    x, y = TransverseMercator().to_grid(F.col("lon"), F.col("lat"))
    points = adapters.sensor(spark, sf_dir).select("event_id", x.alias("x"), y.alias("y"))
    return _rounded(points, "x", "y", digits=3)


@query
def links_in_degrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links written as text in degrees, read, brought to metres, cut, and brought back."""
    path, grid = work_path(spark, "links-degrees"), TransverseMercator()
    ends = (("x0", F.col("x0")), ("x1", F.col("x0") + F.col("len") - 0.5))
    places = [[part.cast("string") for part in grid.to_lon_lat(x, F.col("y0"))] for _, x in ends]
    line = F.concat(F.lit("LINESTRING ("), F.concat_ws(", ", *(F.concat_ws(" ", *place) for place in places)), F.lit(")"))
    links = adapters.links(spark, sf_dir)
    links.select("link_id", line.alias("geometry")).write.csv(path, header=True)
    return build_segments(sources.read_links(spark, path), in_degrees=True)


@query
def split_multi_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of two lines with a gap between them, from WKT and from GeoJSON."""
    links = adapters.links(spark, sf_dir)
    middle, after = F.col("x0") + F.floor(F.col("len") / 3), F.col("x0") + F.floor(F.col("len") / 3) + 1000
    end = F.col("x0") + F.col("len") + 1000
    texts = [x.cast("string") for x in (F.col("x0"), middle, after, end)]
    wkt = F.format_string("MULTILINESTRING ((%s %s, %s %s), (%s %s, %s %s))", *(c for x in texts for c in (x, F.col("y0").cast("string"))))
    pairs = [F.array(x, "y0") for x in (F.col("x0"), middle, after, end)]
    geojson = F.to_json(F.struct(F.lit("MultiLineString").alias("type"), F.array(F.array(*pairs[:2]), F.array(*pairs[2:])).alias("coordinates")))
    pieces = []
    for form, text in (("wkt", wkt), ("geojson", geojson)):
        path = work_path(spark, f"links-{form}")
        links.select("link_id", text.alias("geometry")).write.parquet(path)
        cut = roads.split_links(sources.read_links(spark, path, form=form, file_format="parquet"))
        pieces.append(cut.withColumn("form", F.lit(form)))
    first, last = F.element_at("pts", 1), F.element_at("pts", -1)
    rows = pieces[0].unionByName(pieces[1]).select(
        "form", "s_id", "link_id", F.size("pts").alias("n_points"),
        first["x"].alias("x1"), last["x"].alias("x2"), last["y"].alias("y2"),
    )
    return _rounded(rows, "x1", "x2")


@query
def segments_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All segments and their place in their link, with pieces beyond 9999."""
    segments = adapters.segments(spark, sf_dir).withColumn(
        "s_id", roads.segment_id(F.col("link_id"), F.col("s_id").cast("bigint") * 53)
    )
    return roads.with_place(segments).select("link_id", "s_id", "place")


# streams


def _envelope_folder(spark: SparkSession, sf_dir: str) -> str:
    path = work_path(spark, "messages")
    adapters.envelopes(adapters.messages(spark, sf_dir)).write.json(path)
    return path


ONCE = {"availableNow": True}


@query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = work_path(spark, "raw")
    stream = message_sources.message_stream(spark, _envelope_folder(spark, sf_dir))
    streams.stream_ingest(
        stream, raw, work_path(spark, "stream"), trigger=ONCE
    ).awaitTermination()
    return sources.read_latest(spark, raw, SENSOR_BY_DAY)


@query
def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same source by two queries with checkpoints of their own, into one table."""
    raw = work_path(spark, "raw")
    stream = message_sources.message_stream(spark, _envelope_folder(spark, sf_dir))
    for name in ("first", "second"):
        streams.stream_ingest(stream, raw, work_path(spark, name), trigger=ONCE).awaitTermination()
    return sources.read_latest(spark, raw, SENSOR_BY_DAY)


@query
def stream_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    counters = work_path(spark, "counters")
    stream = message_sources.message_stream(spark, _envelope_folder(spark, sf_dir))
    streams.stream_ingest(
        stream, work_path(spark, "raw"), work_path(spark, "stream"), counters, trigger=ONCE
    ).awaitTermination()
    names = ("total", ingest.PROCESSED, ingest.FILTERED_OUT, ingest.ERRORS)
    return spark.read.parquet(counters).agg(*(F.sum(name).alias(name) for name in names))


@query
def stream_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "anomalies")
    stream = message_sources.message_stream(spark, _envelope_folder(spark, sf_dir))
    streams.stream_detect(
        stream, path, work_path(spark, "stream"), LOWER_BAR, trigger=ONCE
    ).awaitTermination()
    rows = sources.read_stream_anomalies(spark, path)
    return _rounded(rows, "nor_accel_z", "nor_gyro_y", "impact_score")


@query
def stream_daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, counts = work_path(spark, "mapped"), work_path(spark, "counts")
    mapped = map_impacts(_anomalies(spark, sf_dir, LOWER_BAR), network_index(spark, sf_dir))
    mapped.select(*MAPPED_BY_DAY.names).write.parquet(source)
    stream = spark.readStream.schema(MAPPED_BY_DAY).parquet(source)
    streams.stream_daily_counts(
        stream, counts, work_path(spark, "stream"), trigger=ONCE
    ).awaitTermination()
    return streams.latest_counts(spark.read.parquet(counts))


@query
def stream_two_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Impacts from two sources into one folder, and one of the sources once more from its start."""
    counts = work_path(spark, "counts")
    mapped = map_impacts(_anomalies(spark, sf_dir, LOWER_BAR), network_index(spark, sf_dir))
    table = work_path(spark, "mapped")
    odd = F.pmod(F.xxhash64(*MAPPED_BY_DAY.names), F.lit(2)) == 1
    parts = mapped.select(*MAPPED_BY_DAY.names, F.when(odd, "odd").otherwise("even").alias("side"))
    parts.write.partitionBy("side").parquet(table)
    for source, name in (("odd", "a"), ("even", "b"), ("odd", "c")):
        stream = spark.readStream.schema(MAPPED_BY_DAY).parquet(f"{table}/side={source}")
        streams.stream_daily_counts(
            stream, counts, work_path(spark, name), trigger=ONCE, source=source
        ).awaitTermination()
    return streams.read_counts(spark, counts)


LATE_FROM = "2024-01-15"


@query
def stream_late_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips of later days first, then all: which came in time, and which by the late route."""
    source, raw, checkpoint = (work_path(spark, name) for name in ("messages", "raw", "stream"))
    messages, _ = store(adapters.messages(spark, sf_dir, by_day=True), "trips-by-day")
    day = F.substring(F.get_json_object("value", "$.start_time"), 1, 10)
    again = messages.withColumn("seq", F.col("seq") + (1 << 40))
    for part in (messages.filter(day >= LATE_FROM), again):
        adapters.envelopes(part).write.mode("append").json(source)
        stream = message_sources.message_stream(spark, source)
        firsts.stream_first_trips(stream, raw, checkpoint, 2, trigger=ONCE).awaitTermination()
    firsts.merge_late(spark, raw)
    rows = spark.read.schema(LATE_BY_DAY).parquet(raw)
    late = F.col("batch").startswith("late-")
    return rows.groupBy("trip_id", "dt", late.alias("late")).agg(F.count(F.lit(1)).alias("n_rows"))
