"""Named queries over the driver tables, one or more per operator.

Each takes ``(spark, sf_dir)`` and returns a DataFrame. All start from the
segments derived from the whole ``events`` table. Lengths and positions are
rounded where results are compared with another engine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.functions import geo
from tripflow.functions.shared import shared_folder
from tripflow.functions.times import epoch_to_wall_clock
from tripflow.operators import bounds, clean, fares, histogram, metrics, trips, zones
from tripflow.plans import jobs
from tripflow.sources import raw_segments, trip_lines, trip_table
from tripflow.sources.event_segments import read_event_segments

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values of the queries; the oracle SQL uses the same.
HOME_TZ = "America/Los_Angeles"
REFERENCE = metrics.ReferencePoint(37.705, -122.395, 0.1, "ref")
FAR_POINT = (37.62131, -122.37896)
SAMPLE_EVERY, BOUND_DEVIATIONS = 10, 3.0
MAX_TRIP_SECONDS = 600
BAND_WIDTH, MAX_DISTANCE = 0.5, 5.0
CROWD_SECONDS = 60
# A fleet of long segments around a change to summer time.
SLOW = {"origin": 1_710_028_800, "squeeze": 10}
ZONES = [
    ("America/Los_Angeles", 37.70, 37.705, -122.40, -122.39),
    ("America/Denver", 37.704, 37.72, -122.40, -122.396),
    ("America/New_York", 37.71, 37.80, -122.397, -122.39),
]
ZONE_SCHEMA = "tz string, lat_min double, lat_max double, lon_min double, lon_max double"


def r6(c: Column | str) -> Column:
    return F.round(c, 6)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: r6(n) for n in names})


POSITIONS = ("start_lat", "start_lon", "end_lat", "end_lon")


def _segments(spark: SparkSession, sf_dir: str, **fleet) -> DataFrame:
    return read_event_segments(spark, sf_dir, **fleet)


def _clean(spark: SparkSession, sf_dir: str, **fleet) -> DataFrame:
    return clean.clean(_segments(spark, sf_dir, **fleet))


def _trips(spark: SparkSession, sf_dir: str, **fleet) -> DataFrame:
    return trips.build_trips(_clean(spark, sf_dir, **fleet))


def _rounded_trips(spark: SparkSession, sf_dir: str, **fleet) -> DataFrame:
    """Trips with positions rounded, for text forms."""
    one = lambda s: F.struct(
        *[(r6(s[c]) if c in POSITIONS else s[c]).alias(c) for c in trips.trip_fold.SEGMENT_FIELDS]
    )
    return _trips(spark, sf_dir, **fleet).withColumn("segments", F.transform("segments", one))


def _edge_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips whose last segment is early or late, or lasts six hours longer, or goes 222 km on, by the start time."""
    kind = F.pmod(trips.first_segment()["start_ts"], F.lit(4))
    end = trips.last_segment()
    late, longer = F.when(kind == 1, 1000).when(kind == 0, -400).otherwise(0), F.when(kind == 2, 21600).when(kind == 3, 7200).otherwise(0)
    moved = end.withField("start_ts", end["start_ts"] + late).withField("end_ts", end["end_ts"] + late + longer)
    moved = moved.withField("end_lat", end["end_lat"] + F.when(kind == 3, 2.0).otherwise(0.0))
    before = F.slice("segments", F.lit(1), F.size("segments") - 1)
    return _trips(spark, sf_dir).withColumn("segments", F.concat(before, F.array(moved)))


def raw_lines(segments: DataFrame, tz: str = HOME_TZ, damaged: bool = True) -> DataFrame:
    """Segments -> quoted raw lines, if wanted some of them damaged in different ways."""

    def clock(c: str) -> Column:
        return F.concat(F.lit("'"), epoch_to_wall_clock(F.col(c), tz), F.lit("'"))

    def quoted(c: str) -> Column:
        return F.concat(F.lit("'"), F.col(c), F.lit("'"))

    damage = F.pmod("seg_id", F.lit(11)) if damaged else F.lit(-1)
    vehicle = F.col("vehicle_id").cast("string")
    start = [
        F.when(damage == 4, F.concat(F.lit("x"), vehicle)).otherwise(vehicle),
        F.when(damage == 3, F.lit("'2010-02-30 10:00:00'")).otherwise(clock("start_ts")),
        F.when(damage == 2, F.lit("abc")).otherwise(r6("start_lat").cast("string")),
        r6("start_lon").cast("string"),
        quoted("start_status"),
    ]
    end = [clock("end_ts"), r6("end_lat").cast("string"), r6("end_lon").cast("string")]
    last = quoted("end_status")
    status = (
        F.when(damage == 0, F.lit(None))  # eight fields
        .when(damage == 1, F.concat(last, F.lit(",extra")))
        .when(damage == 5, F.concat(last, F.lit(",,")))
        .when(damage == 6, F.lit("''"))  # ninth field empty
        .otherwise(last)
    )
    return segments.select("seg_id", F.concat_ws(",", *start, *end, status).alias("value"))


def parse_raw_segments(spark, sf_dir):
    parsed = raw_segments.parse_raw(raw_lines(_segments(spark, sf_dir)), tz=HOME_TZ)
    return rounded(parsed, *POSITIONS)


def parse_raw_segments_slow(spark, sf_dir):
    parsed = raw_segments.parse_raw(raw_lines(_segments(spark, sf_dir, **SLOW), damaged=False), tz=HOME_TZ)
    return rounded(parsed, *POSITIONS)


def status_transition_filter(spark, sf_dir):
    kept = clean.status_transition_filter(_segments(spark, sf_dir))
    return kept.select("seg_id", "vehicle_id", "start_status", "end_status")


def coordinate_filter(spark, sf_dir):
    damage = F.pmod("seg_id", F.lit(13))
    damaged = _segments(spark, sf_dir).withColumns({
        "start_lat": F.when(damage == 0, F.col("start_lat") + 60.0)
        .when(damage == 2, F.lit(None))
        .when(damage == 3, F.lit(float("nan")))
        .when(damage == 4, F.lit(90.0))
        .otherwise(F.col("start_lat")),
        "end_lon": F.when(damage == 1, F.col("end_lon") - 100.0)
        .when(damage == 5, F.lit(-180.0))
        .otherwise(F.col("end_lon")),
    })
    kept = clean.coordinate_filter(damaged)
    return rounded(kept, *POSITIONS).select("seg_id", "vehicle_id", *POSITIONS)


def movement_filter(spark, sf_dir):
    damage = F.pmod("seg_id", F.lit(13))
    damaged = _segments(spark, sf_dir).withColumns({
        "end_lat": F.when(damage.isin(0, 3), F.col("start_lat")).otherwise(F.col("end_lat")),
        "end_lon": F.when(damage == 0, F.col("start_lon"))
        .when(damage == 3, F.col("start_lon") + 0.5)
        .otherwise(F.col("end_lon")),
        "end_ts": F.when(damage == 1, F.col("start_ts"))
        .when(damage == 2, F.col("start_ts") - 5)
        .otherwise(F.col("end_ts")),
    })
    return clean.movement_filter(damaged).select("seg_id", "vehicle_id", "start_ts", "end_ts")


def assign_timezone(spark, sf_dir):
    boxes = spark.createDataFrame(ZONES, ZONE_SCHEMA)
    return zones.assign_timezone(_segments(spark, sf_dir), boxes).select("seg_id", "tz")


def _stats(spark, sf_dir, split_key=None):
    return bounds.geo_stats(_clean(spark, sf_dir), SAMPLE_EVERY, split_key)


def _rounded_stats(df):
    return df.withColumns({
        "lat_mean": F.round("lat_mean", 9), "lon_mean": F.round("lon_mean", 9),
        "lat_var": F.round("lat_var", 12), "lon_var": F.round("lon_var", 12),
    })


def _split_key() -> Column:
    return F.pmod("vehicle_id", F.lit(4))


def geo_stats(spark, sf_dir):
    return _rounded_stats(_stats(spark, sf_dir))


def geo_stats_by_split(spark, sf_dir):
    return _rounded_stats(_stats(spark, sf_dir, _split_key()))


def pooled_geo_stats(spark, sf_dir):
    return _rounded_stats(bounds.pooled_geo_stats(_stats(spark, sf_dir, _split_key())))


def outlier_filter(spark, sf_dir):
    kept = bounds.outlier_filter(_clean(spark, sf_dir), BOUND_DEVIATIONS)
    return kept.select("seg_id", "vehicle_id")


def outlier_filter_pooled(spark, sf_dir):
    kept = bounds.outlier_filter(_clean(spark, sf_dir), BOUND_DEVIATIONS, compat_split_key=_split_key())
    return kept.select("seg_id", "vehicle_id")


def build_trips(spark, sf_dir):
    rows = trips.trip_segments(trips.build_trips(_clean(spark, sf_dir), number=True))
    return rounded(rows, *POSITIONS)


def build_trips_slow(spark, sf_dir):
    """Trips with segments and pauses of hours."""
    rows = trips.trip_segments(trips.build_trips(_clean(spark, sf_dir, **SLOW), number=True))
    return rounded(rows, *POSITIONS)


def build_trips_sliced(spark, sf_dir):
    """The same trips with every vehicle of more than 40 rows cut into slices."""
    built = trips.build_trips(_clean(spark, sf_dir), split_rows=40, number=True, least_split=1)
    return rounded(trips.trip_segments(built), *POSITIONS)


def build_trips_never_off(spark, sf_dir):
    """Trips of meters that stay on, of vehicles cut into slices: trips end by pauses alone."""
    on = _clean(spark, sf_dir).withColumns({"start_status": F.lit("M"), "end_status": F.lit("M")})
    built = trips.build_trips(on, split_rows=40, number=True, least_split=1)
    return rounded(trips.trip_segments(built), *POSITIONS)


def build_trips_one_minute(spark, sf_dir):
    """Trips of vehicles whose segments crowd into the same minutes, cut inside them."""
    at = F.col("start_ts") - F.pmod("start_ts", F.lit(CROWD_SECONDS))
    crowded = _clean(spark, sf_dir).withColumns({"start_ts": at, "end_ts": at + (F.col("end_ts") - F.col("start_ts"))})
    built = trips.build_trips(crowded, split_rows=16, number=True, least_split=1)
    return rounded(trips.trip_segments(built), *POSITIONS)


def trip_counts(spark, sf_dir):
    return trips.trip_counts(_trips(spark, sf_dir))


def max_trip_length(spark, sf_dir):
    kept = trips.build_trips(_clean(spark, sf_dir), max_trip_length=MAX_TRIP_SECONDS)
    summary = metrics.trip_summary(kept.withColumn("n_segments", F.size("segments")))
    return summary.select("vehicle_id", "start_ts", "end_ts", "n_segments")


def trip_summary(spark, sf_dir):
    return rounded(metrics.trip_summary(_trips(spark, sf_dir)), *POSITIONS)


def encode_trips_complete(spark, sf_dir):
    return trip_lines.encode_trips(_rounded_trips(spark, sf_dir), trip_lines.COMPLETE)


def encode_trips_summary(spark, sf_dir):
    return trip_lines.encode_trips(_rounded_trips(spark, sf_dir), trip_lines.SUMMARY)


def format_trip_times(spark, sf_dir):
    return trip_lines.encode_trips(
        _rounded_trips(spark, sf_dir), trip_lines.COMPLETE, trip_lines.ISO, HOME_TZ
    )


def format_trip_times_compat(spark, sf_dir):
    return trip_lines.encode_trips(
        _rounded_trips(spark, sf_dir), trip_lines.SUMMARY, trip_lines.ISO, HOME_TZ, compat=True
    )


def format_trip_times_slow(spark, sf_dir):
    """Times on both sides of the change to summer time."""
    table = _rounded_trips(spark, sf_dir, **SLOW)
    return trip_lines.encode_trips(table, trip_lines.COMPLETE, trip_lines.ISO, HOME_TZ)


def decode_trip_lines(spark, sf_dir):
    """Decode epoch and ISO lines, some of them damaged in different ways."""
    kind = F.pmod(trips.first_segment()["start_ts"], F.lit(12))
    epoch_line = trip_lines.trip_line(trip_lines.COMPLETE, trip_lines.EPOCH)
    iso_line = trip_lines.trip_line(trip_lines.COMPLETE, trip_lines.ISO, HOME_TZ)
    whole = F.when(kind % 2 == 1, iso_line).otherwise(epoch_line)
    fraction = F.when(kind == 2, F.lit(r"^(\d+ \d+) ")).otherwise(F.lit("^$"))
    whole = F.regexp_replace(whole, fraction, F.lit("$1.75 "))
    suffix = (
        F.when(kind == 4, " 7")  # seven fields
        .when(kind == 5, ";x")  # one field
        .when(kind == 6, ";")  # harmless
        .when(kind == 7, ";2024-01-01T00:00:00+0000 1.0 abc 2024-01-01T00:01:00+0000 1.0 2.0")
        .when(kind == 8, ";2024-01-01T00:00:00+0000 1.0 2.0 2024-01-01T00:01:00+0000 1.0 2.0")
        .when(kind == 9, ";2024-01-01T00:01:00+0000 1.0 2.0 2024-01-01T00:01:00+0000 1.0 2.0")
        .when(kind == 10, ";1 90.0 2.0 2 1.0 2.0")
        .otherwise("")
    )
    line = F.concat(F.when(kind == 1, "x").otherwise(""), whole, suffix)  # also an id that is no number
    lines = _rounded_trips(spark, sf_dir).select(line.alias("value"))
    decoded = trips.trip_segments(trip_lines.decode_trips(lines))
    return decoded.select("vehicle_id", "pos", *trips.trip_fold.SEGMENT_FIELDS)


def _legs(spark, sf_dir):
    """One row per leg of every trip."""
    legged = _trips(spark, sf_dir).select(
        "vehicle_id", "segments", metrics.trip_legs().alias("legs")
    )
    both = legged.select("vehicle_id", F.posexplode(F.arrays_zip("segments", "legs")).alias("pos", "x"))
    return both.select("vehicle_id", "pos", "x.segments.start_ts", "x.segments.end_ts", "x.legs.*")


def segment_speed(spark, sf_dir):
    rows = rounded(_legs(spark, sf_dir), "seg_len", "speed")
    return rows.select("vehicle_id", "start_ts", "end_ts", "seg_len", "speed")


def trip_quality(spark, sf_dir):
    measured = metrics.trip_metrics(_trips(spark, sf_dir))
    return measured.select(
        "vehicle_id", "start_ts", "end_ts", F.size("segments").alias("n_segments"), "reject_reason"
    )


def trip_quality_edges(spark, sf_dir):
    """Trips with gaps of more than ten minutes and below none, of six hours, and of more than 200 km."""
    measured = metrics.trip_metrics(_edge_trips(spark, sf_dir))
    return measured.select(
        "vehicle_id", "start_ts", "end_ts", F.size("segments").alias("n_segments"), "reject_reason"
    )


def distance_histogram_edges(spark, sf_dir):
    return histogram.distance_histogram(_edge_trips(spark, sf_dir), BAND_WIDTH, MAX_DISTANCE)


def _lengths(spark, sf_dir, **options):
    valid = metrics.valid_trips(_trips(spark, sf_dir), **options)
    return rounded(valid, "distance").select("vehicle_id", "start_ts", "end_ts", "distance")


def trip_length(spark, sf_dir):
    return _lengths(spark, sf_dir)


def trip_length_miles(spark, sf_dir):
    return _lengths(spark, sf_dir, unit="M")


def trip_length_straight(spark, sf_dir):
    return _lengths(spark, sf_dir, straight=True)


def trips_near_point(spark, sf_dir):
    return _lengths(spark, sf_dir, ref=REFERENCE)


def trips_near_point_compat(spark, sf_dir):
    return _lengths(spark, sf_dir, ref=REFERENCE, compat=True)


def trip_fares(spark, sf_dir):
    return rounded(fares.fares(_trips(spark, sf_dir)), "distance", "cost")


def trip_fares_near_straight(spark, sf_dir):
    table = fares.fares(_trips(spark, sf_dir), 4.0, 2.25, REFERENCE, straight=True)
    return rounded(table, "distance", "cost")


def trip_fares_ordered(spark, sf_dir):
    """Fares in order; the number each has is its place in it."""
    return fares.number_fares(trip_fares(spark, sf_dir))


def _trip_table(spark, sf_dir):
    """Trips written as a typed table, and read again."""
    path = shared_folder(spark)
    trip_table.write_trip_table(_trips(spark, sf_dir), path)
    return trip_table.read_trip_table(spark, path)


def trip_table_fares(spark, sf_dir):
    """Fares straight from a typed table of trips."""
    table = _trip_table(spark, sf_dir).drop("start_ts", "end_ts")
    return rounded(fares.fares(table), "distance", "cost")


def trip_table_histogram(spark, sf_dir):
    table = _trip_table(spark, sf_dir).drop("start_ts", "end_ts")
    return histogram.distance_histogram(table, BAND_WIDTH, MAX_DISTANCE)


def encode_fares(spark, sf_dir):
    return trip_lines.encode_fares(trip_fares(spark, sf_dir), trip_lines.ISO, HOME_TZ)


def encode_histogram(spark, sf_dir):
    """The histogram's lines, with the band each belongs to for the order."""
    table = distance_histogram(spark, sf_dir)
    return table.select("band", trip_lines.histogram_line().alias("value"))


def _histogram(spark, sf_dir, **options):
    return histogram.distance_histogram(_trips(spark, sf_dir), BAND_WIDTH, MAX_DISTANCE, **options)


def distance_histogram(spark, sf_dir):
    return _histogram(spark, sf_dir)


def distance_histogram_straight(spark, sf_dir):
    return _histogram(spark, sf_dir, straight=True)


def distance_histogram_compat(spark, sf_dir):
    return _histogram(spark, sf_dir, compat=True)


def _geo(spark, sf_dir, **columns):
    rows = _segments(spark, sf_dir)
    return rows.select("seg_id", *[r6(c).alias(name) for name, c in columns.items()])


def geo_distance(spark, sf_dir):
    return _geo(
        spark, sf_dir,
        km=geo.distance(*_ENDS, "K"), miles=geo.distance(*_ENDS, "M"), nautical=geo.distance(*_ENDS, "N"),
    )


def geo_distance_compat(spark, sf_dir):
    return _geo(spark, sf_dir, km=geo.distance(*_ENDS, "K", compat=True))


def geo_bearing(spark, sf_dir):
    angle = geo.bearing(*_ENDS)
    return _geo(spark, sf_dir, radians=angle, degrees=F.degrees(angle))


def geo_cross_track(spark, sf_dir):
    return _geo(
        spark, sf_dir,
        near_km=geo.cross_track(*_ENDS, REFERENCE.lat, REFERENCE.lon),
        far_km=geo.cross_track(*_ENDS, *FAR_POINT),
        far_miles=geo.cross_track(*_ENDS, *FAR_POINT, "M"),
    )


_ENDS = ("start_lat", "start_lon", "end_lat", "end_lon")


def raw_lines_to_fares(spark, sf_dir):
    """All jobs chained: raw text, cleaning, outliers, trips, trip text, fares."""
    parsed = raw_segments.parse_raw(raw_lines(_segments(spark, sf_dir), damaged=False), tz=HOME_TZ)
    built = jobs.surveyed_trips(clean.clean(parsed))
    lines = trip_lines.encode_trips(built, trip_lines.COMPLETE)
    table = fares.fares(trip_lines.decode_trips(lines), ref=REFERENCE)
    return fares.order_fares(rounded(table, "distance", "cost"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        parse_raw_segments, parse_raw_segments_slow, status_transition_filter, coordinate_filter, movement_filter,
        assign_timezone, geo_stats, geo_stats_by_split, pooled_geo_stats, outlier_filter,
        outlier_filter_pooled, build_trips, build_trips_slow, build_trips_sliced, build_trips_never_off, build_trips_one_minute, trip_counts, max_trip_length, trip_summary,
        encode_trips_complete, encode_trips_summary, format_trip_times,
        format_trip_times_compat, format_trip_times_slow, decode_trip_lines, segment_speed, trip_quality, trip_quality_edges, trip_length,
        trip_length_miles, trip_length_straight, trips_near_point, trips_near_point_compat,
        trip_fares, trip_fares_near_straight, trip_fares_ordered, trip_table_fares, trip_table_histogram, encode_fares, distance_histogram, encode_histogram,
        distance_histogram_edges, distance_histogram_straight, distance_histogram_compat, geo_distance,
        geo_distance_compat, geo_bearing, geo_cross_track, raw_lines_to_fares,
    )
}
