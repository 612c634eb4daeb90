"""Trips <-> text lines, and the text sources and sinks around them.

A trip line is ``id seg;seg;...`` (complete) or ``id seg`` (summary), where a
segment is ``start lat lon end lat lon`` and times are epoch seconds or ISO text
with offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.functions.project import select_once
from tripflow.functions.times import epoch_to_iso, iso_to_epoch
from tripflow.operators.trips import SEGMENT_STRUCT, first_segment, last_segment

EPOCH, ISO = "epoch", "iso"
SUMMARY, COMPLETE = "summary", "complete"


def format_time(epoch: Column, time_format: str = EPOCH, tz: str | Column | None = None) -> Column:
    """Epoch seconds as text, plain or as ISO text in zone ``tz``."""
    if time_format == EPOCH:
        return epoch.cast("string")
    if time_format != ISO:
        raise ValueError(f"unknown time format: {time_format}")
    if tz is None:
        raise ValueError("ISO times need a zone")
    return epoch_to_iso(epoch, tz)


def trip_line(
    form: str = SUMMARY,
    time_format: str = EPOCH,
    tz: str | Column | None = None,
    compat: bool = False,
) -> Column:
    """The text line of a trip.

    ``tz`` is one zone for all or a column with each trip's own. ``compat=True``
    reproduces a defect: a summary with ISO times gives the last segment's start
    as the end time.
    """
    time = lambda c: format_time(c, time_format, tz)
    place = lambda s, end: [s[f"{end}_lat"].cast("string"), s[f"{end}_lon"].cast("string")]
    if form == COMPLETE:
        one = lambda s: F.concat_ws(
            " ", time(s["start_ts"]), *place(s, "start"), time(s["end_ts"]), *place(s, "end")
        )
        body = F.array_join(F.transform("segments", one), ";")
    elif form == SUMMARY:
        a, b = first_segment(), last_segment()
        end_ts = b["start_ts"] if compat and time_format == ISO else b["end_ts"]
        body = F.concat_ws(
            " ", time(a["start_ts"]), *place(a, "start"), time(end_ts), *place(b, "end")
        )
    else:
        raise ValueError(f"unknown trip form: {form}")
    return F.concat_ws(" ", F.col("vehicle_id").cast("string"), body)


def encode_trips(
    trips: DataFrame,
    form: str = SUMMARY,
    time_format: str = EPOCH,
    tz: str | Column | None = None,
    compat: bool = False,
) -> DataFrame:
    """Trips -> lines, column ``value``; see ``trip_line``."""
    return trips.select(trip_line(form, time_format, tz, compat).alias("value"))


def split_trip_lines(lines: DataFrame, text: str = "value") -> DataFrame:
    """Lines -> ``vehicle_id`` as text and the rest of the line, at the first space."""
    parts = select_once(lines, F.split(F.col(text), " ", 2).alias("_line"))
    return parts.select(F.get("_line", F.lit(0)).alias("vehicle_id"), F.get("_line", F.lit(1)).alias("body"))


def decode_trips(lines: DataFrame, text: str = "value") -> DataFrame:
    """Trip lines -> ``trips(vehicle_id, segments)``, with the id as the text it is.

    The first segment decides whether the line's times are epochs (a fraction
    is cut off) or ISO text. A line is dropped as a whole when any segment does
    not have six fields, has a time of the other kind, a coordinate that is not
    a number, a latitude of 90 degrees or more, a longitude above 180, or does
    not end after it starts.
    """
    parts = F.transform(
        F.split(F.rtrim("body", F.lit(";")), ";"),
        lambda s: F.split(F.rtrim(s), " "),
    )
    number = lambda t: t.try_cast("double")
    field = lambda p, i: F.get(p, F.lit(i))
    first = F.get("_parts", F.lit(0))
    epochs = number(field(first, 0)).isNotNull() & number(field(first, 3)).isNotNull()

    def time(t: Column) -> Column:
        return F.when(F.col("_epochs"), number(t).try_cast("bigint")).otherwise(iso_to_epoch(t))

    def segment(p: Column) -> Column:
        return F.struct(
            time(field(p, 0)).alias("start_ts"),
            number(field(p, 1)).alias("start_lat"),
            number(field(p, 2)).alias("start_lon"),
            time(field(p, 3)).alias("end_ts"),
            number(field(p, 4)).alias("end_lat"),
            number(field(p, 5)).alias("end_lon"),
        )

    def valid(s: Column) -> Column:
        # A NULL anywhere makes the test NULL, which counts as false; NaN
        # compares as larger than any limit.
        return F.coalesce(
            (F.abs(s["start_lat"]) < 90)
            & (F.abs(s["end_lat"]) < 90)
            & (F.abs(s["start_lon"]) <= 180)
            & (F.abs(s["end_lon"]) <= 180)
            & (s["start_ts"] < s["end_ts"]),
            F.lit(False),
        )

    split = select_once(split_trip_lines(lines, text), parts.alias("_parts"), keep=("vehicle_id",))
    six = split.where(F.forall("_parts", lambda p: F.size(p) == 6))
    typed = select_once(
        six.withColumn("_epochs", epochs),
        F.transform("_parts", segment).cast(f"array<{SEGMENT_STRUCT}>").alias("segments"),
        keep=("vehicle_id",),
    )
    return typed.where(F.forall("segments", valid))


def read_trip_lines(spark: SparkSession, path: str) -> DataFrame:
    return decode_trips(spark.read.text(path))


def encode_fares(
    fares: DataFrame, time_format: str = EPOCH, tz: str | Column | None = None
) -> DataFrame:
    """Fares -> lines ``start end distance cost id``."""
    return fares.select(
        F.concat_ws(
            " ",
            format_time(F.col("start_ts"), time_format, tz),
            format_time(F.col("end_ts"), time_format, tz),
            *[F.col(c).cast("string") for c in ("distance", "cost", "vehicle_id")],
        ).alias("value")
    )


def histogram_line() -> Column:
    """``label<TAB>trips``."""
    return F.concat_ws("\t", "label", F.col("trips").cast("string"))


def encode_histogram(histogram: DataFrame) -> DataFrame:
    """Histogram -> lines ``label<TAB>trips``."""
    return histogram.select(histogram_line().alias("value"))


def check_paths(input_path: str, output_path: str) -> None:
    if not input_path or not output_path or input_path == output_path:
        raise ValueError("input and output paths must be given and differ")


def write_lines(lines: DataFrame, path: str) -> None:
    """One text file per partition; refuses to write over existing output."""
    lines.write.mode("errorifexists").text(path)
