"""Trip fares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.functions.numbering import number_rows
from tripflow.functions.project import select_once
from tripflow.operators.metrics import ReferencePoint, valid_trips

# Default charges.
START_CHARGE = 3.5
CHARGE_PER_KM = 1.71


def fare(distance: Column | str, start_charge: float = START_CHARGE, per_km: float = CHARGE_PER_KM) -> Column:
    distance = F.col(distance) if isinstance(distance, str) else distance
    return F.lit(float(start_charge)) + distance * F.lit(float(per_km))


def fares(
    trips: DataFrame,
    start_charge: float = START_CHARGE,
    per_km: float = CHARGE_PER_KM,
    ref: ReferencePoint | None = None,
    straight: bool = False,
    compat: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Valid trips -> ``start_ts, end_ts, distance, cost, vehicle_id``.

    With ``ref`` only trips that pass near it. ``keep`` names further columns
    of the trips to carry along. No shuffle.
    """
    if start_charge < 0 or per_km <= 0:
        raise ValueError("start_charge must be >= 0 and per_km > 0")
    return valid_trips(trips, straight, ref, "K", compat).select(
        "start_ts", "end_ts", "distance", fare("distance", start_charge, per_km).alias("cost"), "vehicle_id", *keep
    )


FARE_ORDER = ["start_ts", "end_ts", "vehicle_id", "distance"]


def number_fares(df: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Fares in the order of ``order_fares``, with ``ordinal``, the place from 1.

    The place is that of the ordered output: range partitions, the rows of each, and
    the place inside. The ordered rows are written to the shared folder, so
    the trips under them are built once.
    """
    spread = df.repartition("vehicle_id", "start_ts", "end_ts")
    numbered = number_rows(spread, FARE_ORDER, "ordinal", num_partitions)
    return numbered.withColumn("ordinal", F.col("ordinal") + 1).orderBy("ordinal")


def order_fares(df: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Global order by start and end time.

    Vehicle and amount come last so that trips with equal times have a fixed
    order and spread over several range partitions. ``num_partitions`` fixes
    the number of output partitions.

    A range partitioning samples its input first. The input here would be trip
    building and measuring, run a second time for the sample; the narrow fare
    rows are hash-shuffled before, so that the sample reads shuffle files.
    """
    order = FARE_ORDER
    spread = df.repartition("vehicle_id", "start_ts", "end_ts")
    if not num_partitions:
        return spread.orderBy(*order)
    # The generator keeps Catalyst from merging the two repartitionings.
    kept = select_once(spread, *[F.col(c) for c in df.columns])
    return kept.repartitionByRange(num_partitions, *order).sortWithinPartitions(*order)
