"""Coordinate -> time zone lookup against a caller-supplied zone table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cell(degrees) -> Column:
    return F.floor(degrees).cast("int")


#: Box parts, one for each zone and cell it touches, up to which the cell table is broadcast.
BROADCAST_PARTS = 200_000
#: Copies of the cell table beyond that bound, over which the rows of a cell are spread.
SALTS = 32


def cell_parts(zones: DataFrame) -> int:
    """Box parts of the cell table: what its size is in proportion to. One pass over the zones."""
    parts = (_cell("lat_max") - _cell("lat_min") + 1) * (_cell("lon_max") - _cell("lon_min") + 1)
    return zones.agg(F.sum(parts.cast("bigint")).alias("n")).first()["n"] or 0


def zone_cells(zones: DataFrame) -> DataFrame:
    """One row per one-degree cell, with the zone boxes that touch it.

    At most 181 x 361 cells exist, however many zones there are.
    """
    boxed = zones.select(
        "tz", "lat_min", "lat_max", "lon_min", "lon_max",
        F.explode(F.sequence(_cell("lat_min"), _cell("lat_max"))).alias("_lat_cell"),
    ).withColumn("_lon_cell", F.explode(F.sequence(_cell("lon_min"), _cell("lon_max"))))
    return boxed.groupBy("_lat_cell", "_lon_cell").agg(
        F.sort_array(F.collect_list(F.struct("tz", "lat_min", "lat_max", "lon_min", "lon_max"))).alias("_boxes")
    )


def assign_timezone(
    df: DataFrame,
    zones: DataFrame,
    lat: str = "start_lat",
    lon: str = "start_lon",
    broadcast_parts: int = BROADCAST_PARTS,
) -> DataFrame:
    """Add ``tz``: the zone whose box contains the position, or NULL.

    ``zones(tz, lat_min, lat_max, lon_min, lon_max)`` has closed boxes; where
    boxes overlap the alphabetically first zone wins. The range test is turned
    into an equi-join on one-degree cells, so there is one hash probe per row
    instead of one comparison per zone, and a row is never multiplied.

    The zone table is measured first. Up to ``broadcast_parts`` box parts (about
    60 bytes each) its cells are broadcast, and the rows of ``df`` stay where
    they are. Beyond that both sides are shuffled, with the cells copied
    ``SALTS`` times and the rows of a cell spread over the copies, since all
    rows of a city may fall into one cell.
    """
    inside = lambda z: (
        F.col(lat).between(z["lat_min"], z["lat_max"]) & F.col(lon).between(z["lon_min"], z["lon_max"])
    )
    keyed = df.withColumn("_lat_cell", _safe_cell(lat)).withColumn("_lon_cell", _safe_cell(lon))
    cells, on = zone_cells(zones), ["_lat_cell", "_lon_cell"]
    if cell_parts(zones) <= broadcast_parts:
        cells = F.broadcast(cells)
    else:
        keyed = keyed.withColumn("_salt", F.pmod(F.xxhash64(lat, lon), F.lit(SALTS)))
        cells = cells.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
        on = [*on, "_salt"]
    return (
        keyed.join(cells, on, "left")
        .withColumn("tz", F.get(F.filter("_boxes", inside), F.lit(0))["tz"])
        .select(*df.columns, "tz")
    )


def _safe_cell(name: str) -> Column:
    # Positions outside the world (or NaN) match no cell; they must not
    # overflow the int cast.
    return F.when(F.abs(F.col(name)) <= 180, _cell(name))
