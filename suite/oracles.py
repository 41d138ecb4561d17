"""The same queries as SQL for DuckDB, over the same test tables."""

from __future__ import annotations

import math

from suite import queries as q
from suite.adapters import RECORDS_PER_MESSAGE, oracle_text

_SENSOR_LIST = (
    "timestamp, trip_id, vehicle_id, accel_x, accel_y, accel_z, gyro_x, gyro_y, gyro_z, "
    "velocity, lon, lat, hdop, satellites"
)
_VALID = (
    "lon BETWEEN 124 AND 132 AND lat BETWEEN 33 AND 43 AND velocity BETWEEN 0 AND 300 "
    "AND accel_x BETWEEN -100 AND 100 AND accel_y BETWEEN -100 AND 100 "
    "AND accel_z BETWEEN -100 AND 100 AND gyro_x BETWEEN -2000 AND 2000 "
    "AND gyro_y BETWEEN -2000 AND 2000 AND gyro_z BETWEEN -2000 AND 2000"
)
_IN_BOX = "lon BETWEEN 127.52 AND 127.78 AND lat BETWEEN 34.50 AND 35.07"
_USABLE = "velocity > 5.0 AND hdop <= 5.0 AND satellites >= 4"
_FACT_LIST = "s_id, centroid_lon, centroid_lat, date, impact_count"


def _with(*tables: str, **steps: str) -> str:
    parts = [f"{name} AS (\n{oracle_text(name)}\n)" for name in tables]
    parts += [f"{name} AS (\n{text}\n)" for name, text in steps.items()]
    return "WITH " + ",\n".join(parts) + "\n"


def _r(value: str, digits: int) -> str:
    """Half away from zero on the decimal form, as Spark rounds doubles."""
    return f"CAST(round(CAST({value} AS DECIMAL(38, {digits + 6})), {digits}) AS DOUBLE)"


def _scores(source: str, trip: str = "trip_id") -> str:
    def z(name: str) -> str:
        window = f"OVER (PARTITION BY {trip})"
        return (
            f"CASE WHEN stddev_samp({name}) {window} IS NULL OR stddev_samp({name}) {window} = 0 "
            f"THEN 0.0 ELSE ({name} - avg({name}) {window}) / stddev_samp({name}) {window} END"
        )

    return (
        "SELECT *, abs(nor_accel_z) * 0.7::DOUBLE + abs(nor_gyro_y) * 0.3::DOUBLE AS impact_score FROM "
        f"(SELECT *, {z('accel_z')} AS nor_accel_z, {z('gyro_y')} AS nor_gyro_y "
        f"FROM {source} WHERE {_USABLE})"
    )


_MONITORED = f"SELECT * FROM sensor WHERE {_VALID} AND {_IN_BOX}"
_SCORE_LIST = ", ".join(
    f"{_r(name, 6)} AS {name}" for name in ("nor_accel_z", "nor_gyro_y", "impact_score")
)


def _anomalies(threshold: float) -> dict[str, str]:
    return {
        "monitored": _MONITORED,
        "scored": _scores("monitored"),
        "anomalies": f"SELECT * FROM scored WHERE impact_score > {threshold}",
    }


_MIDS = (
    "SELECT s_id, (start_lon + end_lon) / 2 AS mid_lon, (start_lat + end_lat) / 2 AS mid_lat "
    "FROM segments"
)


def _mapped(source: str) -> str:
    return f"""SELECT p.*, n.s_id FROM {source} p JOIN (
  SELECT event_id, (min(struct_pack(
    d := (mid_lon - lon) * (mid_lon - lon) + (mid_lat - lat) * (mid_lat - lat), s := s_id))).s AS s_id
  FROM {source}, mids WHERE lon IS NOT NULL AND lat IS NOT NULL GROUP BY event_id) n
USING (event_id)"""


_COUNTS = """SELECT s_id, CAST(dt AS DATE) AS date, lon AS centroid_lon, lat AS centroid_lat,
  CAST(n AS INT) AS impact_count
FROM (SELECT *, row_number() OVER (PARTITION BY s_id, dt ORDER BY timestamp, trip_id, lon, lat) AS k,
        count(*) OVER (PARTITION BY s_id, dt) AS n FROM mapped) WHERE k = 1"""


def _daily_counts() -> str:
    return _with("sensor", "segments", mids=_MIDS, **_anomalies(1.5), mapped=_mapped("anomalies"),
                 counts=_COUNTS)


def _priority(place: str, group: str) -> str:
    total, days = "sum(impact_count)", "count(DISTINCT date)"
    return f"""SELECT s_id, {place}, CAST({total} AS BIGINT) AS total_impacts,
  {_r('avg(impact_count)', 2)} AS avg_daily_impacts, {days} AS detected_days,
  min(date) AS first_detected, max(date) AS last_detected,
  {_r(f'{total} * {days} * (1 + ln(greatest({total}, 1)))', 2)} AS priority_score
FROM recent GROUP BY {group}"""


def _recent(source: str, as_of: str) -> str:
    return f"SELECT * FROM {source} WHERE date >= DATE '{as_of}' - INTERVAL 30 DAY"


_LATEST_PLACE = (
    "arg_max(centroid_lon, struct_pack(d := date, x := centroid_lon, y := centroid_lat)) AS centroid_lon, "
    "arg_max(centroid_lat, struct_pack(d := date, x := centroid_lon, y := centroid_lat)) AS centroid_lat"
)

# messages: the records of a trip from one block of event ids, dated by the first of them
_BLOCKS = f"""SELECT * EXCLUDE (trip_id, dt, vehicle_id),
  trip, trip AS trip_id, min(dt) OVER (PARTITION BY trip) AS dt,
  min(vehicle_id) OVER (PARTITION BY trip) AS vehicle_id
FROM (SELECT *, concat(trip_id, '-', CAST(event_id // {RECORDS_PER_MESSAGE} AS VARCHAR)) AS trip FROM sensor)"""
_KEPT = f"SELECT * FROM blocks WHERE {_VALID} AND {_IN_BOX}"
_OUTCOMES = f"""SELECT trip_id,
  CASE WHEN count(*) FILTER ({_VALID}) = 0 THEN 'errors'
       WHEN count(*) FILTER ({_VALID} AND {_IN_BOX}) = 0 THEN 'filtered_out'
       ELSE 'processed' END AS outcome,
  CAST(count(*) FILTER ({_VALID}) AS INT) AS n_valid,
  CAST(count(*) FILTER ({_VALID} AND {_IN_BOX}) AS INT) AS n_kept
FROM blocks GROUP BY trip_id"""
_COUNTERS = """SELECT count(*) AS total, count(*) FILTER (outcome = 'processed') AS processed,
  count(*) FILTER (outcome = 'filtered_out') AS filtered_out,
  count(*) FILTER (outcome = 'errors') AS errors FROM outcomes"""

_UNEVEN = """SELECT s_id, CASE WHEN s_id = '3' THEN 'x' ELSE CAST(centroid_lon AS VARCHAR) END AS centroid_lon,
  CASE WHEN impact_count > 2 THEN CAST(centroid_lat AS VARCHAR) END AS centroid_lat, date, impact_count
FROM fact"""


def _merged(count: str) -> str:
    base = f"SELECT * FROM fact WHERE date <= DATE '{q.BASE_UNTIL}'"
    delta = (
        "SELECT * REPLACE (centroid_lon + 0.5::DOUBLE AS centroid_lon) FROM fact "
        f"WHERE date >= DATE '{q.DELTA_FROM}'"
    )
    return _with("fact", base=base, delta=delta) + f"""SELECT s_id, date,
  coalesce(d.centroid_lon, b.centroid_lon) AS centroid_lon,
  coalesce(d.centroid_lat, b.centroid_lat) AS centroid_lat, CAST({count} AS INT) AS impact_count
FROM base b FULL OUTER JOIN delta d USING (s_id, date)"""


_ADDED = "coalesce(b.impact_count, 0) + coalesce(d.impact_count, 0)"

_PIECES = """SELECT link_id, k, x0 + k * 50.0::DOUBLE AS x1, y0 AS y1,
  least(x0 + len, x0 + (k + 1) * 50.0::DOUBLE) AS x2, y0 AS y2, printf('%s_%04d', link_id, k) AS s_id, road_no
FROM (SELECT *, unnest(range(CAST(ceil(len / 50) AS BIGINT))) AS k FROM links)"""


def _geographic(source: str, x: str, y: str, name: str, keep: str) -> dict[str, str]:
    """Steps that take metres of the central belt (EPSG:5186) to degrees."""
    a, f = 6378137.0, 1 / 298.257222101
    n, e = f / (2 - f), math.sqrt(f * (2 - f))
    radius = a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = [
        n / 2 - 2 / 3 * n**2 + 5 / 16 * n**3 + 41 / 180 * n**4,
        13 / 48 * n**2 - 3 / 5 * n**3 + 557 / 1440 * n**4,
        61 / 240 * n**3 - 103 / 140 * n**4,
        49561 / 161280 * n**4,
    ]
    beta = [
        n / 2 - 2 / 3 * n**2 + 37 / 96 * n**3 - 1 / 360 * n**4,
        1 / 48 * n**2 + 1 / 15 * n**3 - 437 / 1440 * n**4,
        17 / 480 * n**3 - 37 / 840 * n**4,
        4397 / 161280 * n**4,
    ]
    delta = [
        2 * n - 2 / 3 * n**2 - 2 * n**3 + 116 / 45 * n**4,
        7 / 3 * n**2 - 8 / 5 * n**3 - 227 / 45 * n**4,
        56 / 15 * n**3 - 136 / 35 * n**4,
        4279 / 630 * n**4,
    ]
    phi = math.radians(38)
    chi = math.atan(math.sinh(math.asinh(math.tan(phi)) - e * math.atanh(e * math.sin(phi))))
    arc = chi + sum(c * math.sin(2 * j * chi) for j, c in enumerate(alpha, 1))

    def series(terms: list[float], shape: str) -> str:
        return " + ".join(f"({c!r}::DOUBLE) * {shape.format(2 * j)}" for j, c in enumerate(terms, 1))

    return {
        f"{name}_plane": f"SELECT *, ({y} - 600000) / {radius!r}::DOUBLE + {arc!r}::DOUBLE AS xi, "
        f"({x} - 200000) / {radius!r}::DOUBLE AS eta FROM {source}",
        f"{name}_sphere": f"SELECT *, xi - ({series(beta, 'sin({0} * xi) * cosh({0} * eta)')}) AS xs, "
        f"eta - ({series(beta, 'cos({0} * xi) * sinh({0} * eta)')}) AS es FROM {name}_plane",
        f"{name}_conformal": f"SELECT *, asin(sin(xs) / cosh(es)) AS chi FROM {name}_sphere",
        name: f"SELECT {keep}, 127 + degrees(atan2(sinh(es), cos(xs))) AS {name}_lon, "
        f"degrees(chi + {series(delta, 'sin({0} * chi)')}) AS {name}_lat FROM {name}_conformal",
    }


def _plane(source: str, lon: str, lat: str, name: str, keep: str) -> dict[str, str]:
    """Steps that take degrees to metres of the central belt."""
    a, f = 6378137.0, 1 / 298.257222101
    n, e = f / (2 - f), math.sqrt(f * (2 - f))
    radius = a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = [
        n / 2 - 2 / 3 * n**2 + 5 / 16 * n**3 + 41 / 180 * n**4,
        13 / 48 * n**2 - 3 / 5 * n**3 + 557 / 1440 * n**4,
        61 / 240 * n**3 - 103 / 140 * n**4,
        49561 / 161280 * n**4,
    ]
    chi = 2 * math.atan(math.tan(math.radians(64)) * ((1 - e * math.sin(math.radians(38))) / (1 + e * math.sin(math.radians(38)))) ** (e / 2)) - math.pi / 2
    arc = chi + sum(c * math.sin(2 * j * chi) for j, c in enumerate(alpha, 1))

    def series(shape: str) -> str:
        return " + ".join(f"({c!r}::DOUBLE) * {shape.format(2 * j)}" for j, c in enumerate(alpha, 1))

    def atanh(value: str) -> str:
        return f"(0.5::DOUBLE * ln((1 + ({value})) / (1 - ({value}))))"

    return {
        f"{name}_chi": f"SELECT *, radians({lon} - 127) AS away, "
        f"sinh(asinh(tan(radians({lat}))) - {e!r}::DOUBLE * {atanh(f'{e!r}::DOUBLE * sin(radians({lat}))')}) AS tangent FROM {source}",
        f"{name}_ball": f"SELECT *, atan2(tangent, cos(away)) AS xs, "
        f"asinh(sin(away) / sqrt(tangent * tangent + cos(away) * cos(away))) AS es FROM {name}_chi",
        name: f"SELECT {keep}, 200000 + {radius!r}::DOUBLE * (es + {series('cos({0} * xs) * sinh({0} * es)')}) AS {name}_x, "
        f"600000 + {radius!r}::DOUBLE * (xs + {series('sin({0} * xs) * cosh({0} * es)')} - {arc!r}::DOUBLE) AS {name}_y FROM {name}_ball",
    }


def _degree_segments() -> str:
    steps = {"ends": "SELECT link_id, x0, y0, x0 + len - 0.5::DOUBLE AS x1 FROM links"}
    steps |= _geographic("ends", "x0", "y0", "from_", "link_id, x1, y0")
    steps |= _geographic("from_", "x1", "y0", "to_", "link_id, from__lon, from__lat")
    steps |= _plane("to_", "from__lon", "from__lat", "a", "link_id, to__lon, to__lat")
    steps |= _plane("a", "to__lon", "to__lat", "b", "link_id, a_x, a_y")
    steps["long"] = "SELECT *, sqrt((b_x - a_x) * (b_x - a_x) + (b_y - a_y) * (b_y - a_y)) AS size FROM b"
    steps["marks"] = "SELECT *, unnest(range(CAST(ceil(size / 50) AS BIGINT))) AS k FROM long"
    steps["cut"] = """SELECT link_id, printf('%s_%04d', link_id, k) AS s_id,
  a_x + (b_x - a_x) * k * 50 / size AS px, a_y + (b_y - a_y) * k * 50 / size AS py,
  a_x + (b_x - a_x) * least(1, (k + 1) * 50 / size) AS qx, a_y + (b_y - a_y) * least(1, (k + 1) * 50 / size) AS qy FROM marks"""
    steps |= _geographic("cut", "px", "py", "start", "s_id, link_id, qx, qy")
    steps |= _geographic("start", "qx", "qy", "end_", "s_id, link_id, start_lon, start_lat")
    names = (("start_lon", "start_lon"), ("start_lat", "start_lat"), ("end_lon", "end__lon"), ("end_lat", "end__lat"))
    ends = ", ".join(f"{_r(column, 6)} AS {name}" for name, column in names)
    return _with("links", **steps) + f"SELECT s_id, link_id, {ends} FROM end_"


# two lines with 1000 m between them: a place along both, and its x
_MULTI = {
    "two": "SELECT link_id, x0, y0, len, floor(len / 3) AS brk FROM links",
    "multi": """SELECT *, k * 50.0::DOUBLE AS p, least(len, (k + 1) * 50.0::DOUBLE) AS q
FROM (SELECT *, unnest(range(CAST(ceil(len / 50) AS BIGINT))) AS k FROM two)""",
}


def _segments_sql(where: str = "") -> str:
    steps = {"pieces": f"SELECT * FROM ({_PIECES}) {where}"}
    steps |= _geographic("pieces", "x1", "y1", "start", "s_id, link_id, x2, y2")
    steps |= _geographic("start", "x2", "y2", "end_", "s_id, link_id, start_lon, start_lat")
    ends = ", ".join(
        f"{_r(column, 6)} AS {name}"
        for name, column in (("start_lon", "start_lon"), ("start_lat", "start_lat"),
                             ("end_lon", "end__lon"), ("end_lat", "end__lat"))
    )
    return _with("links", **steps) + f"SELECT s_id, link_id, {ends} FROM end_"


_LINE_ENDS = "SELECT link_id, 2 AS n_points, x0 AS x1, y0 AS y1, x0 + len AS x2, y0 AS y2 FROM links"

ORACLES: dict[str, str] = {
    "valid_range_filter": _with("sensor") + f"SELECT event_id, lon, lat FROM sensor WHERE {_VALID}",
    "bbox_filter": _with("sensor") + f"SELECT event_id, lon, lat FROM sensor WHERE {_IN_BOX}",
    "bbox_filter_many": _with("sensor", "segments")
    + """SELECT event_id, lon, lat FROM sensor WHERE EXISTS (SELECT 1 FROM segments
WHERE lon BETWEEN start_lon - 0.00005::DOUBLE AND end_lon + 0.00005::DOUBLE
  AND lat BETWEEN start_lat - 0.00005::DOUBLE AND end_lat + 0.00005::DOUBLE)""",
    "context_filter": _with("sensor")
    + f"SELECT event_id, velocity, hdop, satellites FROM sensor WHERE {_USABLE}",
    "trip_stats": _with("sensor")
    + "SELECT event_id, "
    + ", ".join(
        f"{_r(f'{function}({column}) OVER (PARTITION BY trip_id)', 6)} AS {short}_{column}"
        for column in ("accel_z", "gyro_y")
        for function, short in (("avg", "mean"), ("stddev_samp", "std"))
    )
    + f" FROM sensor WHERE {_USABLE}",
    "z_score": _with("sensor", scored=_scores("sensor"))
    + f"SELECT event_id, {_r('nor_accel_z', 6)} AS nor_accel_z, {_r('nor_gyro_y', 6)} AS nor_gyro_y FROM scored",
    "impact_score": _with("sensor", scored=_scores("sensor"))
    + f"SELECT event_id, {_r('impact_score', 6)} AS impact_score FROM scored",
    "detect_anomalies": _with("sensor", **_anomalies(3.0))
    + f"SELECT event_id, {_SENSOR_LIST}, {_SCORE_LIST} FROM anomalies",
    "write_anomalies": _with("sensor", **_anomalies(1.5))
    + f"SELECT {_SENSOR_LIST}, dt, {_SCORE_LIST} FROM anomalies",
    "run_stats": _with("sensor", **_anomalies(3.0))
    + "SELECT (SELECT count(*) FROM scored) AS usable, (SELECT count(*) FROM anomalies) AS anomalies",
    "segment_midpoint": _with("segments", mids=_MIDS) + "SELECT * FROM mids",
    "nearest_segment": _with("sensor", "segments", mids=_MIDS, mapped=_mapped("sensor"))
    + "SELECT event_id, s_id FROM mapped",
    "mapping_coverage": _with("sensor")
    + "SELECT count(*) FILTER (lat < 50) AS mapped, count(*) FILTER (lat >= 50) AS unmapped FROM sensor",
    "daily_segment_counts": _daily_counts() + "SELECT * FROM counts",
    "repair_priorities_end_to_end": _daily_counts()
    + f", recent AS ({_recent('counts', q.AS_OF_EVENTS)})\n"
    + _priority(_LATEST_PLACE, "s_id"),
    "load_fact": _with("fact")
    + f"SELECT * REPLACE (DATE '{q.LOAD_DATE}' AS date) FROM fact",
    "union_fact_parts": _with("fact")
    + f"""SELECT * FROM fact WHERE date <= DATE '{q.BASE_UNTIL}' UNION ALL
SELECT * REPLACE (NULL::DOUBLE AS centroid_lat) FROM fact WHERE date > DATE '{q.BASE_UNTIL}'""",
    "null_audit": _with("fact", uneven=_UNEVEN)
    + " UNION ALL ".join(
        f"SELECT '{name}' AS \"column\", count(*) FILTER ({name} IS NULL) AS nulls FROM uneven"
        for name in _FACT_LIST.split(", ")
    ),
    "coerce_fact": _with("fact", uneven=_UNEVEN)
    + """SELECT s_id, try_cast(centroid_lon AS DOUBLE) AS centroid_lon,
  try_cast(centroid_lat AS DOUBLE) AS centroid_lat, date, impact_count FROM uneven""",
    "merge_additive": _merged(_ADDED),
    "merge_replace": _merged("coalesce(d.impact_count, b.impact_count)"),
    "merge_replace_rerun": _with(
        "fact",
        delta="SELECT s_id, centroid_lon + 0.5::DOUBLE AS centroid_lon, centroid_lat, date, impact_count "
        f"FROM fact WHERE date >= DATE '{q.DELTA_FROM}' AND impact_count > 1",
    )
    + f"""SELECT * FROM delta UNION ALL
SELECT {_FACT_LIST} FROM fact WHERE date <= DATE '{q.BASE_UNTIL}' AND date NOT IN (SELECT date FROM delta)""",
    "merge_stored": _merged(_ADDED),
    "append_strict": _with(
        "fact",
        delta=f"SELECT s_id, date FROM fact WHERE date >= DATE '{q.DELTA_FROM}' UNION ALL "
        f"SELECT s_id, date FROM fact WHERE date >= DATE '{q.DELTA_AGAIN_FROM}'",
    )
    + f"""SELECT s_id, date, count(*) AS copies, date <= DATE '{q.BASE_UNTIL}' AS stored
FROM delta GROUP BY s_id, date HAVING count(*) > 1 OR date <= DATE '{q.BASE_UNTIL}'""",
    "fact_month_partition": _with("fact")
    + """SELECT CAST(date_trunc('month', date) AS DATE) AS month, count(*) AS n_rows,
  CAST(sum(impact_count) AS BIGINT) AS impacts FROM fact GROUP BY 1""",
    "mart_context": _with("fact")
    + f"""SELECT {_FACT_LIST}, CASE WHEN impact_count > 5 THEN 'critical'
  WHEN impact_count > 3 THEN 'warning' ELSE 'normal' END AS risk_level FROM fact""",
    "mart_daily_summary": _with("fact")
    + f"""SELECT date, count(DISTINCT s_id) AS affected_segments,
  CAST(sum(impact_count) AS BIGINT) AS total_impacts,
  count(CASE WHEN impact_count > 5 THEN 1 END) AS critical_segments,
  count(CASE WHEN impact_count > 3 AND impact_count <= 5 THEN 1 END) AS warning_segments,
  min(impact_count) AS min_impacts, max(impact_count) AS max_impacts,
  {_r('avg(impact_count)', 2)} AS avg_impacts FROM fact GROUP BY date""",
    "mart_repair_priority": _with("fact", recent=_recent("fact", q.AS_OF_FACTS))
    + _priority("centroid_lon, centroid_lat", "s_id, centroid_lon, centroid_lat"),
    "mart_repair_priority_by_segment": _with(
        "fact",
        drifting="SELECT * REPLACE (centroid_lon + CAST(day(date) AS DOUBLE) / 1000 AS centroid_lon) FROM fact",
        recent=_recent("drifting", q.AS_OF_FACTS),
        ranked=_priority(_LATEST_PLACE, "s_id"),
    )
    + f"SELECT * REPLACE ({_r('centroid_lon', 6)} AS centroid_lon) FROM ranked",
    "mart_segment_trend": _with("fact")
    + f"""SELECT {_FACT_LIST}, {_r('''avg(impact_count) OVER (PARTITION BY s_id ORDER BY date
    ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)''', 2)} AS rolling_7d_avg,
  impact_count - lag(impact_count, 7) OVER (PARTITION BY s_id ORDER BY date) AS week_over_week_change
FROM fact""",
    "top_priorities": _with(
        "fact",
        recent=_recent("fact", q.AS_OF_FACTS),
        ranked=_priority(_LATEST_PLACE, "s_id"),
    )
    + "SELECT * FROM ranked ORDER BY priority_score DESC, s_id LIMIT 10",
    "refresh_marts": _with("fact", recent=_recent("fact", q.AS_OF_FACTS))
    + """SELECT 'context' AS mart, 'ok' AS status, count(*) AS n_rows FROM fact UNION ALL
SELECT 'daily_summary', 'ok', count(DISTINCT date) FROM fact UNION ALL
SELECT 'repair_priority', 'ok', count(DISTINCT s_id) FROM recent UNION ALL
SELECT 'segment_trend', 'ok', count(*) FROM fact""",
    "lookup_date_range": _with("fact")
    + "SELECT * FROM fact WHERE date BETWEEN DATE '1996-03-01' AND DATE '1996-04-15'",
    "lookup_segment": _with("fact") + "SELECT * FROM fact WHERE s_id = '7'",
    "lookup_viewport": _with("fact")
    + """SELECT * FROM fact WHERE centroid_lon BETWEEN 127.55 AND 127.65
  AND centroid_lat BETWEEN 34.5 AND 34.8""",
    "lookup_date_segment": _with("fact")
    + "SELECT * FROM fact WHERE date = DATE '1995-08-09' AND s_id = '11'",
    "lookup_impact": _with("fact") + "SELECT * FROM fact WHERE impact_count >= 4",
    "parse_trips": _with("sensor", blocks=_BLOCKS)
    + f"SELECT {_SENSOR_LIST}, dt FROM blocks WHERE {_VALID}",
    "parse_defaults": _with(
        "sensor",
        blocks=_BLOCKS,
        bare="SELECT * REPLACE (0::DOUBLE AS velocity, 99::DOUBLE AS hdop, 0 AS satellites) FROM blocks",
    )
    + f"SELECT {_SENSOR_LIST}, dt FROM bare WHERE {_VALID}",
    "trip_outcomes": _with("sensor", blocks=_BLOCKS) + _OUTCOMES,
    "ingest_counters": _with("sensor", blocks=_BLOCKS, outcomes=_OUTCOMES) + _COUNTERS,
    "write_raw_idempotent": _with("sensor", blocks=_BLOCKS, kept=_KEPT)
    + f"SELECT {_SENSOR_LIST}, dt FROM kept",
    "scan_raw_partition": _with("sensor")
    + f"SELECT {_SENSOR_LIST}, dt FROM sensor WHERE dt = '{q.SCAN_DAY}'",
    "scan_segments_csv": _with("segments") + "SELECT * FROM segments",
    "write_segments": _with("segments") + "SELECT * FROM segments",
    "segments_by_link": _with("segments")
    + """SELECT link_id, count(*) AS n_segments, min(s_id) AS first_s_id,
  arg_min(start_lon, s_id) AS first_lon, max(s_id) AS last_s_id, arg_max(end_lon, s_id) AS last_lon
FROM segments GROUP BY link_id""",
    "parse_wkt_links": _with("links") + _LINE_ENDS,
    "parse_geojson_links": _with("links") + _LINE_ENDS,
    "filter_links": _with("links") + "SELECT link_id, road_no, len FROM links WHERE road_no = '3'",
    "split_links": _with("links", pieces=_PIECES)
    + f"SELECT s_id, link_id, 2 AS n_points, {_r('x1', 6)} AS x1, y1, {_r('x2', 6)} AS x2, y2 FROM pieces",
    "split_links_repeated": _with("links", pieces=_PIECES)
    + "SELECT link_id, 2 * count(*) AS pieces FROM pieces GROUP BY link_id",
    "links_unreadable": _with("links") + "SELECT count(*) AS unreadable FROM links WHERE road_no <> '3'",
    "segment_ids": _with("links")
    + "SELECT link_id, printf('%s_%04d', link_id, CAST(link_id AS BIGINT) * 7) AS s_id FROM links",
    "reproject_points": _with("links", **_geographic("links", "x0", "y0", "place", "link_id"))
    + f"SELECT link_id, {_r('place_lon', 9)} AS lon, {_r('place_lat', 9)} AS lat FROM place",
    "segment_endpoints": _segments_sql(),
    "build_road_segments": _segments_sql("WHERE road_no = '3'"),
    "project_points": _with("sensor", **_plane("sensor", "lon", "lat", "place", "event_id"))
    + f"SELECT event_id, {_r('place_x', 3)} AS x, {_r('place_y', 3)} AS y FROM place",
    "links_in_degrees": _degree_segments(),
    "split_multi_links": _with("links", **_MULTI)
    + f"""SELECT form, printf('%s_%04d', link_id, k) AS s_id, link_id,
  CAST(CASE WHEN p < brk AND q > brk THEN 4 ELSE 2 END AS INT) AS n_points,
  {_r('x0 + p + CASE WHEN p >= brk THEN 1000 ELSE 0 END', 6)} AS x1,
  {_r('x0 + q + CASE WHEN q > brk THEN 1000 ELSE 0 END', 6)} AS x2, y0 AS y2
FROM multi, (SELECT unnest(['wkt', 'geojson']) AS form)""",
    "segments_in_order": _with("segments")
    + """SELECT link_id, printf('%s_%04d', link_id, CAST(s_id AS BIGINT) * 53) AS s_id,
  row_number() OVER (PARTITION BY link_id ORDER BY CAST(s_id AS BIGINT)) - 1 AS place FROM segments""",
    "stream_ingest": _with("sensor", blocks=_BLOCKS, kept=_KEPT)
    + f"SELECT {_SENSOR_LIST}, dt FROM kept",
    "stream_restart": _with("sensor", blocks=_BLOCKS, kept=_KEPT)
    + f"SELECT {_SENSOR_LIST}, dt FROM kept",
    "stream_counters": _with("sensor", blocks=_BLOCKS, outcomes=_OUTCOMES) + _COUNTERS,
    "stream_detect": _with("sensor", blocks=_BLOCKS, kept=_KEPT, scored=_scores("kept", "dt, trip_id"))
    + f"SELECT {_SENSOR_LIST}, dt, {_SCORE_LIST} FROM scored WHERE impact_score > 1.5",
    "stream_daily_counts": _daily_counts() + "SELECT * FROM counts",
}
ORACLES["monthly_counts"] = ORACLES["fact_month_partition"]
ORACLES["compact_raw"] = ORACLES["write_raw_idempotent"]
ORACLES["mart_published"] = ORACLES["mart_daily_summary"]
ORACLES["stream_two_sources"] = ORACLES["stream_daily_counts"]
ORACLES["stream_late_trips"] = _with(
    "sensor",
    trips=f"""SELECT concat(trip_id, '-', CAST(event_id // {RECORDS_PER_MESSAGE} AS VARCHAR)) AS trip_id, dt, count(*) AS n_rows
FROM sensor WHERE {_VALID} AND {_IN_BOX} GROUP BY 1, 2""",
) + f"""SELECT trip_id, dt, n_rows,
  dt < '{q.LATE_FROM}' AND CAST(dt AS DATE) < (SELECT max(CAST(dt AS DATE)) FROM trips) - INTERVAL 2 DAY AS late
FROM trips"""
for _name in ("lookup_segment", "lookup_viewport", "lookup_impact", "lookup_date_range"):
    ORACLES[f"{_name}_stored"] = ORACLES[_name]
