"""Trips as a typed Parquet table, for jobs that follow: nothing is encoded or decoded.

The table is clustered by vehicle: a vehicle's trips lie in the partition that the
trip builder made them in, and every file is sorted by vehicle and start, so a reader
of some vehicles or of a span of time skips row groups by their statistics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripflow.operators.trips import SEGMENT_STRUCT, first_segment, last_segment

#: Columns of the table and their types; ``start_ts`` and ``end_ts`` are those of the whole trip.
TABLE = {"vehicle_id": "bigint", "start_ts": "bigint", "end_ts": "bigint", "segments": f"array<{SEGMENT_STRUCT}>"}


def trip_table(trips: DataFrame) -> DataFrame:
    """``trips(vehicle_id, segments)`` with the columns of the table."""
    return trips.select(
        "vehicle_id", first_segment()["start_ts"].alias("start_ts"), last_segment()["end_ts"].alias("end_ts"), "segments"
    )


def write_trip_table(trips: DataFrame, path: str) -> None:
    """Trips -> Parquet files; refuses to write over existing output. No shuffle."""
    table = trip_table(trips).sortWithinPartitions("vehicle_id", "start_ts")
    table.write.mode("errorifexists").parquet(path)


def read_trip_table(spark: SparkSession, path: str) -> DataFrame:
    """``trips(vehicle_id, start_ts, end_ts, segments)`` from a table.

    Further columns are left out; one that is missing or of another type is an error,
    not a column of nulls.
    """
    table = spark.read.parquet(path)
    found = dict(table.dtypes)
    wrong = [f"{c}: {t} expected, {found.get(c, 'nothing')} found" for c, t in TABLE.items() if found.get(c) != t]
    if wrong:
        raise ValueError(f"{path} is not a table of trips ({'; '.join(wrong)})")
    return table.select(*TABLE)
