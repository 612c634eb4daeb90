"""Validity rules for single segments.

Each rule is a Column predicate that is true for rows to keep; a NULL (a field
that did not parse) counts as false in ``where``. Narrow filters, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The status pairs that say something about a trip.
# E = empty, M = metered.
STATUS_PAIRS = ("EM", "MM", "ME")


def useful_status() -> Column:
    return F.concat("start_status", "end_status").isin(*STATUS_PAIRS)


def valid_position(lat: str, lon: str) -> Column:
    # NaN sorts above every number in Spark, so <= rejects it as well.
    return (F.abs(F.col(lat)) <= 90.0) & (F.abs(F.col(lon)) <= 180.0)


def valid_coordinates() -> Column:
    return valid_position("start_lat", "start_lon") & valid_position("end_lat", "end_lon")


def has_moved() -> Column:
    same = (F.col("start_lat") == F.col("end_lat")) & (F.col("start_lon") == F.col("end_lon"))
    return ~same & (F.col("end_ts") > F.col("start_ts"))


def status_transition_filter(segments: DataFrame) -> DataFrame:
    return segments.where(useful_status())


def coordinate_filter(segments: DataFrame) -> DataFrame:
    return segments.where(valid_coordinates())


def movement_filter(segments: DataFrame) -> DataFrame:
    return segments.where(has_moved())


def clean(segments: DataFrame) -> DataFrame:
    """All rules, plus a numeric vehicle id."""
    return segments.where(
        F.col("vehicle_id").isNotNull() & useful_status() & valid_coordinates() & has_moved()
    )
