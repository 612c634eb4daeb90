"""Raw GPS segment lines -> typed segments.

A raw line has nine comma-separated fields, strings in single quotes:
``id,'start time',lat,lon,'status','end time',lat,lon,'status'``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.functions.project import select_once
from tripflow.functions.times import wall_clock_to_epoch
from tripflow.operators.zones import assign_timezone

SEGMENT_COLUMNS = [
    "seg_id", "vehicle_id",
    "start_ts", "start_lat", "start_lon", "start_status",
    "end_ts", "end_lat", "end_lon", "end_status",
]


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value``."""
    return spark.read.text(path)


def split_fields(lines: DataFrame, text: str = "value") -> DataFrame:
    """Quoted lines -> typed id and positions, statuses, and wall-clock text.

    Lines with fewer than nine fields are dropped; trailing empty fields do not
    count, extra fields are ignored. A field that does not parse becomes NULL
    and is left for ``clean`` to reject. ``seg_id`` is a hash of the line: it
    breaks ties between segments of equal vehicle and times the same way
    whatever the file layout or the number of task attempts.
    """
    line = F.btrim(F.replace(F.col(text), F.lit("'"), F.lit("")), F.lit(" \t\r\n\f"))
    seg_id = F.col("seg_id") if "seg_id" in lines.columns else F.xxhash64(text)
    fields = lines.select(
        seg_id.alias("seg_id"), F.split(F.rtrim(line, F.lit(",")), ",").alias("_f")
    )
    field = lambda i: F.get("_f", F.lit(i))
    return select_once(
        fields,
        F.size("_f").alias("n_fields"),
        field(0).try_cast("bigint").alias("vehicle_id"),
        field(1).alias("start_local"),
        field(2).try_cast("double").alias("start_lat"),
        field(3).try_cast("double").alias("start_lon"),
        field(4).alias("start_status"),
        field(5).alias("end_local"),
        field(6).try_cast("double").alias("end_lat"),
        field(7).try_cast("double").alias("end_lon"),
        field(8).alias("end_status"),
        keep=("seg_id",),
    ).where(F.col("n_fields") >= 9)


def parse_raw(
    lines: DataFrame,
    tz: str | Column | None = None,
    zones: DataFrame | None = None,
    text: str = "value",
) -> DataFrame:
    """Quoted lines -> segments with epoch seconds.

    The wall clock is read in ``tz`` (a zone name or column), or, with
    ``zones``, in the zone that contains the segment's start position. A
    segment in no known zone gets NULL times and is rejected by ``clean``.
    """
    if (tz is None) == (zones is None):
        raise ValueError("give exactly one of tz and zones")
    fields = split_fields(lines, text)
    if zones is not None:
        fields = assign_timezone(fields, zones, "start_lat", "start_lon")
        tz = F.col("tz")
    timed = select_once(
        fields,
        wall_clock_to_epoch(F.col("start_local"), tz).alias("start_ts"),
        wall_clock_to_epoch(F.col("end_local"), tz).alias("end_ts"),
        keep=tuple(c for c in fields.columns if c in SEGMENT_COLUMNS),
    )
    return timed.select(*SEGMENT_COLUMNS)
