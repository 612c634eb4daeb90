"""The catalog's queries as ANSI SQL, for checking on another engine.

Every statement starts from the ``events`` view. Constants are cast to DOUBLE
where they meet coordinates, since decimal arithmetic would round differently.
"""

from __future__ import annotations

from tripflow.functions.geo import EARTH_RADIUS
from tripflow.plans.catalog import (
    BAND_WIDTH,
    BOUND_DEVIATIONS,
    CROWD_SECONDS,
    FAR_POINT,
    HOME_TZ,
    MAX_DISTANCE,
    MAX_TRIP_SECONDS,
    REFERENCE,
    SAMPLE_EVERY,
    SLOW,
    ZONES,
)

ENDS = ("start_lat", "start_lon", "end_lat", "end_lon")


def dbl(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


# --- geometry ---------------------------------------------------------------


def angle_sql(lat1, lon1, lat2, lon2, compat=False) -> str:
    h = (
        f"(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * pow(sin(radians({lon2} - {lon1}) / 2), 2))"
    )
    angle = f"(2 * atan2(sqrt({h}), sqrt(1 - {h})))"
    return f"(CASE WHEN {lat1} = {lat2} THEN 0.0::DOUBLE ELSE {angle} END)" if compat else angle


def distance_sql(lat1, lon1, lat2, lon2, unit="K", compat=False) -> str:
    return f"({angle_sql(lat1, lon1, lat2, lon2, compat)} * {dbl(EARTH_RADIUS[unit])})"


def bearing_sql(lat1, lon1, lat2, lon2) -> str:
    east = f"sin(radians({lon2}) - radians({lon1})) * cos(radians({lat2}))"
    north = (
        f"cos(radians({lat1})) * sin(radians({lat2})) - sin(radians({lat1}))"
        f" * cos(radians({lat2})) * cos(radians({lon2}) - radians({lon1}))"
    )
    return f"atan2({east}, {north})"


def cross_track_sql(a_lat, a_lon, b_lat, b_lon, point, unit="K", compat=False) -> str:
    p_lat, p_lon = map(dbl, point)
    angle = angle_sql(a_lat, a_lon, p_lat, p_lon, compat)
    turn = f"({bearing_sql(a_lat, a_lon, p_lat, p_lon)} - {bearing_sql(a_lat, a_lon, b_lat, b_lon)})"
    return f"(asin(sin({angle}) * sin({turn})) * {dbl(EARTH_RADIUS[unit])})"


# --- common table expressions -----------------------------------------------

def segments_sql(origin: int = 1704067200, squeeze: int = 300) -> str:
    return f"""
fixes AS (
  SELECT user_id AS vehicle_id, event_id,
    {origin} + CAST(floor((CAST(floor(epoch(ts)) AS BIGINT) - 1704067200) / {squeeze}.0) AS BIGINT) AS t,
    CAST(37.70 AS DOUBLE) + value * CAST(0.0001 AS DOUBLE) AS lat,
    CAST(-122.40 AS DOUBLE)
      + CAST(json_extract_string(props, '$.k') AS DOUBLE) * CAST(0.0001 AS DOUBLE) AS lon,
    CASE WHEN event_type IN ('signup', 'error') THEN 'E' ELSE 'M' END AS status
  FROM events),
pairs AS (
  SELECT *,
    lead(t, 1) OVER w AS t1, lead(lat, 1) OVER w AS lat1, lead(lon, 1) OVER w AS lon1,
    lead(status, 1) OVER w AS status1,
    lead(t, 2) OVER w AS t2, lead(lat, 2) OVER w AS lat2, lead(lon, 2) OVER w AS lon2,
    lead(status, 2) OVER w AS status2
  FROM fixes WINDOW w AS (PARTITION BY vehicle_id ORDER BY event_id)),
seg AS (
  SELECT 2 * event_id AS seg_id, vehicle_id, t AS start_ts, lat AS start_lat, lon AS start_lon,
    status AS start_status,
    CASE WHEN event_id % 7 = 3 THEN t1 - CAST(floor((t1 - t) / 2) AS BIGINT) ELSE t1 END AS end_ts,
    CASE WHEN event_id % 7 = 3 THEN lat + (lat1 - lat) / 3 ELSE lat1 END AS end_lat,
    CASE WHEN event_id % 7 = 3 THEN lon + (lon1 - lon) / 3 ELSE lon1 END AS end_lon, status1 AS end_status
  FROM pairs WHERE t1 IS NOT NULL
  UNION ALL
  SELECT 2 * event_id + 1, vehicle_id, t, lat, lon, status, t2, lat2, lon2, status2
  FROM pairs WHERE event_id % 10 = 0 AND t2 IS NOT NULL)"""

VALID = """
  start_status || end_status IN ('EM', 'MM', 'ME')
  AND abs(start_lat) <= 90 AND abs(end_lat) <= 90 AND abs(start_lon) <= 180 AND abs(end_lon) <= 180
  AND NOT (start_lat = end_lat AND start_lon = end_lon) AND end_ts > start_ts"""

CLEAN = f"clean AS (SELECT * FROM seg WHERE {VALID})"


def trips_sql(source: str = "clean") -> str:
    """``tseg``: the trip segments, with trip_seq and pos, by a recursive scan.

    Carries (last, buf) per vehicle: the time up to which the trip reaches and
    the number of the buffer being filled.
    """
    return f"""
ordered AS (
  SELECT *, start_status || end_status AS pair, end_ts - start_ts AS dur,
    row_number() OVER (PARTITION BY vehicle_id ORDER BY start_ts, end_ts, seg_id) AS rn
  FROM {source}),
scan AS (
  SELECT DISTINCT vehicle_id, CAST(0 AS BIGINT) AS rn, CAST(NULL AS BIGINT) AS last,
    CAST(0 AS BIGINT) AS buf, CAST(NULL AS BIGINT) AS added, CAST(NULL AS BIGINT) AS emitted
  FROM ordered
  UNION ALL
  SELECT vehicle_id, rn,
    CASE act WHEN 'skip' THEN last WHEN 'open' THEN end_ts WHEN 'add' THEN end_ts END,
    CASE WHEN act IN ('skip', 'add') THEN buf ELSE buf + 1 END,
    CASE act WHEN 'add' THEN buf WHEN 'split' THEN buf + 1 END,
    CASE WHEN act IN ('split', 'close') THEN buf END
  FROM (
    SELECT o.vehicle_id, o.rn, o.end_ts, s.last, s.buf,
      CASE
        WHEN s.last IS NOT NULL AND o.start_ts < s.last THEN 'skip'
        WHEN o.pair = 'EM' AND (o.dur > 600 OR s.last IS NOT NULL) THEN 'skip'
        WHEN o.pair = 'EM' THEN 'open'
        WHEN o.pair = 'MM' AND s.last IS NOT NULL AND o.start_ts - s.last >= 300 THEN 'split'
        WHEN o.pair = 'MM' AND o.dur <= 3600 THEN 'add'
        ELSE 'close'
      END AS act
    FROM scan s JOIN ordered o ON o.vehicle_id = s.vehicle_id AND o.rn = s.rn + 1)),
closed AS (SELECT DISTINCT vehicle_id, emitted AS buf FROM scan WHERE emitted IS NOT NULL),
tseg AS (
  SELECT o.vehicle_id, s.added AS buf,
    CAST(dense_rank() OVER (PARTITION BY o.vehicle_id ORDER BY s.added) AS INTEGER) AS trip_seq,
    CAST(row_number() OVER (PARTITION BY o.vehicle_id, s.added ORDER BY o.rn) - 1 AS INTEGER) AS pos,
    o.start_ts, o.start_lat, o.start_lon, o.end_ts, o.end_lat, o.end_lon
  FROM scan s
  JOIN closed c ON c.vehicle_id = s.vehicle_id AND c.buf = s.added
  JOIN ordered o ON o.vehicle_id = s.vehicle_id AND o.rn = s.rn)"""


TSEG6 = """
tseg6 AS (
  SELECT * REPLACE (round(start_lat, 6) AS start_lat, round(start_lon, 6) AS start_lon,
    round(end_lat, 6) AS end_lat, round(end_lon, 6) AS end_lon)
  FROM tseg)"""


def metrics_sql(point=None, limit=None, compat=False, unit="K", source="tseg") -> str:
    """``legs`` and ``trips``: lengths and reject reasons, one row per trip."""
    gap = ("prev_lat", "prev_lon", "start_lat", "start_lon")
    near = "TRUE"
    if point is not None:
        off = cross_track_sql(*ENDS, point, unit, compat)
        off = off if compat else f"abs({off})"
        off_gap = f"abs({cross_track_sql(*gap, point, unit, compat)})"
        near = f"({off} <= {limit} OR (apart AND {off_gap} <= {limit}))"
    key = "vehicle_id, trip_seq"
    return f"""
linked AS (
  SELECT *, lag(end_ts) OVER w AS prev_ts, lag(end_lat) OVER w AS prev_lat, lag(end_lon) OVER w AS prev_lon
  FROM {source} WINDOW w AS (PARTITION BY {key} ORDER BY pos)),
aparted AS (
  SELECT *, prev_ts IS NOT NULL AND (prev_lat <> start_lat OR prev_lon <> start_lon) AS apart,
    {distance_sql(*ENDS, unit, compat)} AS seg_len
  FROM linked),
legs AS (
  SELECT *, CASE WHEN apart THEN {distance_sql(*gap, unit, compat)} ELSE 0 END AS gap_len,
    seg_len * 3600 / (end_ts - start_ts) AS speed,
    CASE WHEN apart AND start_ts < prev_ts THEN 'out_of_sequence'
         WHEN apart AND start_ts - prev_ts > 600 THEN 'long_gap'
         WHEN seg_len * 3600 / (end_ts - start_ts) > 200 THEN 'too_fast' END AS fault,
    {near} AS near
  FROM aparted),
trips AS (
  SELECT {key}, arg_min(start_ts, pos) AS start_ts, arg_max(end_ts, pos) AS end_ts,
    arg_min(start_lat, pos) AS start_lat, arg_min(start_lon, pos) AS start_lon,
    arg_max(end_lat, pos) AS end_lat, arg_max(end_lon, pos) AS end_lon,
    count(*) AS n_segments, sum(gap_len + seg_len) AS distance,
    arg_min(fault, pos) FILTER (fault IS NOT NULL) AS fault, bool_or(near) AS near
  FROM legs GROUP BY {key}),
judged AS (
  SELECT *, CASE WHEN fault IS NOT NULL THEN fault
    WHEN end_ts - start_ts >= 21600 THEN 'too_long'
    WHEN NOT near THEN 'not_near' END AS reject_reason
  FROM trips)"""


def with_(select: str, *ctes: str, fleet: dict | None = None) -> str:
    return "WITH RECURSIVE " + ",\n".join((segments_sql(**(fleet or {})).strip(), *ctes)) + "\n" + select


TRIPS = (CLEAN, trips_sql())


def positions6() -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in ENDS)


# --- statements ---------------------------------------------------------------

PARSED = f"""
parsed AS (
  SELECT seg_id,
    CASE WHEN seg_id % 11 = 4 THEN NULL ELSE vehicle_id END AS vehicle_id,
    CASE WHEN seg_id % 11 = 3 THEN NULL ELSE start_ts END AS start_ts,
    CASE WHEN seg_id % 11 = 2 THEN NULL ELSE round(start_lat, 6) END AS start_lat,
    round(start_lon, 6) AS start_lon, start_status, end_ts,
    round(end_lat, 6) AS end_lat, round(end_lon, 6) AS end_lon, end_status
  FROM seg WHERE seg_id % 11 NOT IN (0, 6))"""

ZONE_ROWS = ", ".join(
    f"('{tz}', {dbl(a)}, {dbl(b)}, {dbl(c)}, {dbl(d)})" for tz, a, b, c, d in ZONES
)



def stats_sql(rows: str = "TRUE") -> str:
    return f"""
points AS (
  SELECT vehicle_id % 4 AS split_key, start_lat AS lat, start_lon AS lon FROM clean WHERE {rows}
  UNION ALL
  SELECT vehicle_id % 4, end_lat, end_lon FROM clean WHERE {rows}),
stats AS (
  SELECT count(*) AS n, avg(lat) AS lat_mean, avg(lon) AS lon_mean,
    var_samp(lat) AS lat_var, var_samp(lon) AS lon_var FROM points),
split_stats AS (
  SELECT split_key, count(*) AS n, avg(lat) AS lat_mean, avg(lon) AS lon_mean,
    var_samp(lat) AS lat_var, var_samp(lon) AS lon_var FROM points GROUP BY split_key),
pooled AS (
  SELECT CAST(sum(n) AS BIGINT) AS n, avg(lat_mean) AS lat_mean, avg(lon_mean) AS lon_mean,
    sum(lat_var * n) / sum(n - 1) AS lat_var, sum(lon_var * n) / sum(n - 1) AS lon_var
  FROM split_stats)"""


SAMPLED, STATS = stats_sql(f"seg_id % {SAMPLE_EVERY} = 0"), stats_sql()

STATS_COLUMNS = (
    "n, round(lat_mean, 9) AS lat_mean, round(lon_mean, 9) AS lon_mean, "
    "round(lat_var, 12) AS lat_var, round(lon_var, 12) AS lon_var"
)


def outliers_sql(stats: str, k: float = BOUND_DEVIATIONS) -> str:
    lat = f"(SELECT lat_mean {{}} {k} * sqrt(lat_var) FROM {stats})"
    lon = f"(SELECT lon_mean {{}} {k} * sqrt(lon_var) FROM {stats})"
    return " AND ".join(
        f"{end}_{axis} BETWEEN {bound.format('-')} AND {bound.format('+')}"
        for axis, bound in (("lat", lat), ("lon", lon))
        for end in ("start", "end")
    )


def seg_text(start: str, end: str) -> str:
    return (
        f"{start} || ' ' || start_lat || ' ' || start_lon || ' ' || {end} || ' ' || end_lat || ' ' || end_lon"
    )


def iso(epoch: str) -> str:
    # Eight hours behind UTC, and seven from the change to summer time on 10 March 2024.
    summer = f"{epoch} >= 1710064800"
    local = f"make_timestamp(({epoch} - CASE WHEN {summer} THEN 25200 ELSE 28800 END) * 1000000)"
    return f"(strftime({local}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN {summer} THEN '-0700' ELSE '-0800' END)"


def complete_sql(start: str, end: str, fleet: dict | None = None) -> str:
    return with_(
        f"""SELECT vehicle_id || ' ' || string_agg({seg_text(start, end)}, ';' ORDER BY pos) AS value
FROM tseg6 GROUP BY vehicle_id, trip_seq""",
        *TRIPS, TSEG6, fleet=fleet,
    )


def summary_sql(start: str, end: str) -> str:
    ends = """
ends AS (
  SELECT vehicle_id, arg_min(start_ts, pos) AS start_ts, arg_min(start_lat, pos) AS start_lat,
    arg_min(start_lon, pos) AS start_lon, arg_max(end_ts, pos) AS end_ts, arg_max(start_ts, pos) AS last_start_ts,
    arg_max(end_lat, pos) AS end_lat, arg_max(end_lon, pos) AS end_lon
  FROM tseg6 GROUP BY vehicle_id, trip_seq)"""
    return with_(f"SELECT vehicle_id || ' ' || {seg_text(start, end)} AS value FROM ends", *TRIPS, TSEG6, ends)


def lengths_sql(distance: str = "distance", **options) -> str:
    return with_(
        f"""SELECT vehicle_id, start_ts, end_ts, round({distance}, 6) AS distance
FROM judged WHERE reject_reason IS NULL""",
        *TRIPS, metrics_sql(**options),
    )


NEAR = {"point": (REFERENCE.lat, REFERENCE.lon), "limit": REFERENCE.range_km}


def fares_sql(distance: str = "distance", start: float = 3.5, per_km: float = 1.71, **options) -> str:
    return with_(
        f"""SELECT start_ts, end_ts, round({distance}, 6) AS distance,
  round({dbl(start)} + {distance} * {dbl(per_km)}, 6) AS cost, vehicle_id
FROM judged WHERE reject_reason IS NULL""",
        *TRIPS, metrics_sql(**options),
    )


def histogram_sql(distance: str = "distance", compat: bool = False, extra: str = "", source: str = "tseg") -> str:
    n = round(MAX_DISTANCE / BAND_WIDTH) + 1
    top = "distance > " if compat else "distance >= "
    return with_(
        f"""SELECT b.band, CASE WHEN b.band = {n - 1} THEN {dbl(MAX_DISTANCE)}
    ELSE (b.band + 1) * {dbl(BAND_WIDTH)} END AS upper_limit,
  CASE WHEN b.band = {n - 1} THEN 'Infinity'
    ELSE CAST((b.band + 1) * {dbl(BAND_WIDTH)} AS VARCHAR) END AS label,
  count(d.distance) AS trips
FROM (SELECT CAST(range AS INTEGER) AS band FROM range({n})) b
LEFT JOIN (SELECT {distance} AS distance FROM judged WHERE reject_reason IS NULL) d
  ON distance <> 0 AND distance <= 200 AND CASE WHEN b.band = {n - 1} THEN {top}{dbl(MAX_DISTANCE)}
    ELSE distance >= b.band * {dbl(BAND_WIDTH)} AND distance < (b.band + 1) * {dbl(BAND_WIDTH)} END
GROUP BY b.band""",
        *TRIPS, *([extra] if extra else []), metrics_sql(compat=compat, source=source),
    )


EDGES = """
kinds AS (
  SELECT *, min(start_ts) FILTER (pos = 0) OVER (PARTITION BY vehicle_id, trip_seq) % 4 AS kind,
    pos = max(pos) OVER (PARTITION BY vehicle_id, trip_seq) AS is_last FROM tseg),
edges AS (
  SELECT * REPLACE (
    start_ts + CASE WHEN NOT is_last THEN 0 WHEN kind = 1 THEN 1000 WHEN kind = 0 THEN -400 ELSE 0 END AS start_ts,
    end_ts + CASE WHEN NOT is_last THEN 0 WHEN kind = 1 THEN 1000 WHEN kind = 0 THEN -400 WHEN kind = 2 THEN 21600
      WHEN kind = 3 THEN 7200 ELSE 0 END AS end_ts,
    end_lat + CASE WHEN is_last AND kind = 3 THEN CAST(2 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS end_lat)
  FROM kinds)"""


STRAIGHT = distance_sql(*ENDS)


def geo_sql(**columns: str) -> str:
    cols = ", ".join(f"round({sql}, 6) AS {name}" for name, sql in columns.items())
    return with_(f"SELECT seg_id, {cols} FROM seg")


ORACLE: dict[str, str] = {
    "parse_raw_segments": with_("SELECT * FROM parsed", PARSED),
    "parse_raw_segments_slow": with_(f"SELECT * REPLACE ({positions6()}) FROM seg", fleet=SLOW),
    "status_transition_filter": with_(
        """SELECT seg_id, vehicle_id, start_status, end_status FROM seg
WHERE (start_status, end_status) IN (('E', 'M'), ('M', 'M'), ('M', 'E'))"""
    ),
    "coordinate_filter": with_(
        f"""SELECT seg_id, vehicle_id, {positions6()} FROM (
  SELECT * REPLACE (
    CASE seg_id % 13 WHEN 0 THEN start_lat + 60.0 WHEN 2 THEN NULL WHEN 3 THEN CAST('NaN' AS DOUBLE)
      WHEN 4 THEN CAST(90 AS DOUBLE) ELSE start_lat END AS start_lat,
    CASE seg_id % 13 WHEN 1 THEN end_lon - 100.0 WHEN 5 THEN CAST(-180 AS DOUBLE) ELSE end_lon END AS end_lon)
  FROM seg)
WHERE NOT isnan(start_lat) AND start_lat BETWEEN -90 AND 90 AND end_lat BETWEEN -90 AND 90
  AND start_lon BETWEEN -180 AND 180 AND end_lon BETWEEN -180 AND 180"""
    ),
    "movement_filter": with_(
        """SELECT seg_id, vehicle_id, start_ts, end_ts FROM (
  SELECT * REPLACE (
    CASE WHEN seg_id % 13 IN (0, 3) THEN start_lat ELSE end_lat END AS end_lat,
    CASE seg_id % 13 WHEN 0 THEN start_lon WHEN 3 THEN start_lon + CAST(0.5 AS DOUBLE) ELSE end_lon END AS end_lon,
    CASE seg_id % 13 WHEN 1 THEN start_ts WHEN 2 THEN start_ts - 5 ELSE end_ts END AS end_ts)
  FROM seg)
WHERE (start_lat <> end_lat OR start_lon <> end_lon) AND end_ts > start_ts"""
    ),
    "assign_timezone": with_(
        """SELECT s.seg_id, min(z.tz) AS tz FROM seg s LEFT JOIN zones z
  ON s.start_lat BETWEEN z.lat_min AND z.lat_max AND s.start_lon BETWEEN z.lon_min AND z.lon_max
GROUP BY s.seg_id""",
        f"zones(tz, lat_min, lat_max, lon_min, lon_max) AS (VALUES {ZONE_ROWS})",
    ),
    "geo_stats": with_(f"SELECT {STATS_COLUMNS} FROM stats", CLEAN, SAMPLED),
    "geo_stats_by_split": with_(f"SELECT split_key, {STATS_COLUMNS} FROM split_stats", CLEAN, SAMPLED),
    "pooled_geo_stats": with_(f"SELECT {STATS_COLUMNS} FROM pooled", CLEAN, SAMPLED),
    "outlier_filter": with_(
        f"SELECT seg_id, vehicle_id FROM clean WHERE {outliers_sql('stats')}", CLEAN, STATS
    ),
    "outlier_filter_pooled": with_(
        f"SELECT seg_id, vehicle_id FROM clean WHERE {outliers_sql('pooled')}", CLEAN, STATS
    ),
    "build_trips": with_(
        "SELECT vehicle_id, trip_seq, pos, start_ts, start_lat, start_lon, end_ts, end_lat, end_lon FROM tseg6",
        *TRIPS, TSEG6,
    ),
    "build_trips_slow": with_(
        "SELECT vehicle_id, trip_seq, pos, start_ts, start_lat, start_lon, end_ts, end_lat, end_lon FROM tseg6",
        *TRIPS, TSEG6, fleet=SLOW,
    ),
    "build_trips_sliced": with_(
        "SELECT vehicle_id, trip_seq, pos, start_ts, start_lat, start_lon, end_ts, end_lat, end_lon FROM tseg6",
        *TRIPS, TSEG6,
    ),
    "build_trips_never_off": with_(
        "SELECT vehicle_id, trip_seq, pos, start_ts, start_lat, start_lon, end_ts, end_lat, end_lon FROM tseg6",
        CLEAN, "metered AS (SELECT * REPLACE ('M' AS start_status, 'M' AS end_status) FROM clean)", trips_sql("metered"), TSEG6,
    ),
    "build_trips_one_minute": with_(
        "SELECT vehicle_id, trip_seq, pos, start_ts, start_lat, start_lon, end_ts, end_lat, end_lon FROM tseg6",
        CLEAN,
        f"""crowded AS (SELECT * REPLACE (start_ts - start_ts % {CROWD_SECONDS} AS start_ts,
  start_ts - start_ts % {CROWD_SECONDS} + end_ts - start_ts AS end_ts) FROM clean)""",
        trips_sql("crowded"), TSEG6,
    ),
    "trip_counts": with_(
        "SELECT vehicle_id, count(DISTINCT trip_seq) AS trips FROM tseg GROUP BY vehicle_id", *TRIPS
    ),
    "max_trip_length": with_(
        f"""SELECT vehicle_id, arg_min(start_ts, pos) AS start_ts, arg_max(end_ts, pos) AS end_ts,
  CAST(count(*) AS INTEGER) AS n_segments
FROM tseg GROUP BY vehicle_id, trip_seq
HAVING arg_max(end_ts, pos) - arg_min(start_ts, pos) <= {MAX_TRIP_SECONDS}""",
        *TRIPS,
    ),
    "trip_summary": with_(
        """SELECT vehicle_id, arg_min(start_ts, pos) AS start_ts, arg_min(start_lat, pos) AS start_lat,
  arg_min(start_lon, pos) AS start_lon, arg_max(end_ts, pos) AS end_ts,
  arg_max(end_lat, pos) AS end_lat, arg_max(end_lon, pos) AS end_lon
FROM tseg6 GROUP BY vehicle_id, trip_seq""",
        *TRIPS, TSEG6,
    ),
    "encode_trips_complete": complete_sql("start_ts", "end_ts"),
    "encode_trips_summary": summary_sql("start_ts", "end_ts"),
    "format_trip_times": complete_sql(iso("start_ts"), iso("end_ts")),
    "format_trip_times_compat": summary_sql(iso("start_ts"), iso("last_start_ts")),
    "format_trip_times_slow": complete_sql(iso("start_ts"), iso("end_ts"), SLOW),
    "decode_trip_lines": with_(
        """SELECT CASE WHEN kind = 1 THEN 'x' ELSE '' END || vehicle_id AS vehicle_id, pos, start_ts, start_lat, start_lon,
  end_ts, end_lat, end_lon FROM (
  SELECT *, min(start_ts) FILTER (pos = 0) OVER (PARTITION BY vehicle_id, trip_seq) % 12 AS kind FROM tseg6)
WHERE kind IN (0, 1, 2, 3, 6, 11)""",
        *TRIPS, TSEG6,
    ),
    "segment_speed": with_(
        """SELECT vehicle_id, start_ts, end_ts, round(seg_len, 6) AS seg_len, round(speed, 6) AS speed
FROM legs""",
        *TRIPS, metrics_sql(),
    ),
    "trip_quality": with_(
        """SELECT vehicle_id, start_ts, end_ts, CAST(n_segments AS INTEGER) AS n_segments, reject_reason
FROM judged""",
        *TRIPS, metrics_sql(),
    ),
    "trip_quality_edges": with_(
        """SELECT vehicle_id, start_ts, end_ts, CAST(n_segments AS INTEGER) AS n_segments, reject_reason FROM judged""",
        *TRIPS, EDGES, metrics_sql(source="edges"),
    ),
    "distance_histogram_edges": histogram_sql(extra=EDGES, source="edges"),
    "trip_length": lengths_sql(),
    "trip_length_miles": lengths_sql(unit="M"),
    "trip_length_straight": lengths_sql(STRAIGHT),
    "trips_near_point": lengths_sql(**NEAR),
    "trips_near_point_compat": lengths_sql(**NEAR, compat=True),
    "trip_fares": fares_sql(),
    "trip_table_fares": fares_sql(),
    "trip_table_histogram": histogram_sql(),
    "trip_fares_near_straight": fares_sql(STRAIGHT, 4.0, 2.25, **NEAR),
    "trip_fares_ordered": f"""SELECT *, row_number() OVER (ORDER BY start_ts, end_ts, vehicle_id, distance) AS ordinal
FROM ({fares_sql()})""",
    "encode_fares": f"""SELECT {iso('start_ts')} || ' ' || {iso('end_ts')} || ' ' || distance || ' ' || cost || ' ' || vehicle_id AS value
FROM ({fares_sql()})""",
    "encode_histogram": f"SELECT band, label || chr(9) || trips AS value FROM ({histogram_sql()})",
    "distance_histogram": histogram_sql(),
    "distance_histogram_straight": histogram_sql(STRAIGHT),
    "distance_histogram_compat": histogram_sql(compat=True),
    "geo_distance": geo_sql(
        km=distance_sql(*ENDS, "K"), miles=distance_sql(*ENDS, "M"), nautical=distance_sql(*ENDS, "N")
    ),
    "geo_distance_compat": geo_sql(km=distance_sql(*ENDS, "K", True)),
    "geo_bearing": geo_sql(radians=bearing_sql(*ENDS), degrees=f"degrees({bearing_sql(*ENDS)})"),
    "geo_cross_track": geo_sql(
        near_km=cross_track_sql(*ENDS, NEAR["point"]),
        far_km=cross_track_sql(*ENDS, FAR_POINT),
        far_miles=cross_track_sql(*ENDS, FAR_POINT, "M"),
    ),
    "raw_lines_to_fares": with_(
        """SELECT start_ts, end_ts, round(distance, 6) AS distance,
  round(CAST(3.5 AS DOUBLE) + distance * CAST(1.71 AS DOUBLE), 6) AS cost, CAST(vehicle_id AS VARCHAR) AS vehicle_id
FROM judged WHERE reject_reason IS NULL""",
        f"parsed AS (SELECT * REPLACE ({positions6()}) FROM seg)",
        f"clean AS (SELECT * FROM parsed WHERE {VALID})",
        STATS,
        f"kept AS (SELECT * FROM clean WHERE {outliers_sql('stats', 20.0)})",
        trips_sql("kept"),
        metrics_sql(**NEAR),
    ),
}

assert HOME_TZ == "America/Los_Angeles"  # the offset in iso()
