"""The three jobs, file to file: trip builder, trip fares, distance histogram."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.operators.bounds import SAMPLE_EVERY, outlier_filter
from tripflow.operators.clean import clean
from tripflow.operators.fares import CHARGE_PER_KM, START_CHARGE, fares, order_fares
from tripflow.operators.histogram import distance_histogram
from tripflow.operators.metrics import ReferencePoint
from tripflow.operators.survey import survey
from tripflow.operators.trips import build_trips, first_segment
from tripflow.operators.zones import assign_timezone
from tripflow.sources import trip_lines as lines
from tripflow.sources.trip_table import read_trip_table, write_trip_table
from tripflow.sources.raw_segments import parse_raw, read_raw

#: Trips between the jobs: lines of text, or a typed table.
TEXT, TABLE = "text", "table"


def read_trips(spark: SparkSession, path: str, kind: str = TEXT) -> DataFrame:
    """Trips from lines, or from a table."""
    if kind == TEXT:
        return lines.read_trip_lines(spark, path)
    if kind != TABLE:
        raise ValueError(f"unknown kind of trips: {kind}")
    return read_trip_table(spark, path).drop("start_ts", "end_ts")


def parse_trip_length(text: str, compat: bool = False) -> int:
    """``HH:MM`` -> seconds. ``compat=True`` counts the minutes as seconds."""
    hours, minutes = (int(part) for part in text.split(":"))
    if hours < 0 or not 0 <= minutes < 60:
        raise ValueError(f"invalid trip length: {text}")
    return hours * 3600 + minutes * (1 if compat else 60)


def _check_partitions(n: int | None) -> None:
    if n is not None and n <= 0:
        raise ValueError("num_partitions must be positive")


def _with_trip_zone(trips: DataFrame, zones: DataFrame | None) -> DataFrame:
    """Add ``tz`` by the first start position, when a zone table is given."""
    if zones is None:
        return trips
    a = first_segment()
    placed = trips.withColumn("_lat", a["start_lat"]).withColumn("_lon", a["start_lon"])
    return assign_timezone(placed, zones, "_lat", "_lon").drop("_lat", "_lon")


def surveyed_trips(
    segments: DataFrame, max_trip_length: int | None = None, num_partitions: int | None = None, **options
) -> DataFrame:
    """Clean segments -> trips of those inside the bounds; the segments are computed twice."""
    known = survey(segments, **options)
    return build_trips(outlier_filter(segments, box=known.box), max_trip_length, num_partitions, hot=known.hot)


def trip_builder(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    form: str = lines.SUMMARY,
    time_format: str = lines.EPOCH,
    tz: str | None = None,
    zones: DataFrame | None = None,
    max_trip_length: str | None = None,
    num_partitions: int | None = None,
    compat: bool = False,
    output_kind: str = TEXT,
) -> None:
    """Raw segment lines -> trip lines, or a typed table of trips.

    The input is read twice: for the survey, and for the trips. ``compat=True`` takes
    the outlier bounds from a sample.
    """
    if output_kind not in (TEXT, TABLE):
        raise ValueError(f"unknown kind of trips: {output_kind}")
    lines.check_paths(input_path, output_path)
    _check_partitions(num_partitions)
    longest = parse_trip_length(max_trip_length, compat) if max_trip_length else None
    parsed = clean(parse_raw(read_raw(spark, input_path), tz, zones))
    if compat:
        trips = build_trips(outlier_filter(parsed, sample_every=SAMPLE_EVERY), longest, num_partitions)
    else:
        trips = surveyed_trips(parsed, longest, num_partitions)
    if output_kind == TABLE:
        return write_trip_table(trips, output_path)
    if time_format == lines.ISO and zones is not None:
        trips, tz = _with_trip_zone(trips, zones), F.col("tz")
    lines.write_lines(lines.encode_trips(trips, form, time_format, tz, compat), output_path)


def trip_fares(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    start_charge: float = START_CHARGE,
    per_km: float = CHARGE_PER_KM,
    ref: ReferencePoint | None = None,
    straight: bool = False,
    time_format: str = lines.EPOCH,
    tz: str | None = None,
    zones: DataFrame | None = None,
    num_partitions: int | None = None,
    compat: bool = False,
    input_kind: str = TEXT,
) -> None:
    """Trip lines, or a table of trips -> fare lines in time order.

    ISO times are given in ``tz``, or in the zone of the trip's first position.
    """
    lines.check_paths(input_path, output_path)
    _check_partitions(num_partitions)
    trips = read_trips(spark, input_path, input_kind)
    keep: tuple[str, ...] = ()
    if time_format == lines.ISO and zones is not None:
        trips, tz, keep = _with_trip_zone(trips, zones), F.col("tz"), ("tz",)
    table = fares(trips, start_charge, per_km, ref, straight, compat, keep)
    lines.write_lines(lines.encode_fares(order_fares(table, num_partitions), time_format, tz), output_path)


def trip_histogram(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    width: float,
    max_dist: float,
    straight: bool = False,
    compat: bool = False,
    input_kind: str = TEXT,
) -> None:
    """Trip lines, or a table of trips -> ``label<TAB>count`` lines in band order."""
    lines.check_paths(input_path, output_path)
    table = distance_histogram(read_trips(spark, input_path, input_kind), width, max_dist, straight, compat=compat)
    lines.write_lines(lines.encode_histogram(table), output_path)
