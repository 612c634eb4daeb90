"""One pass over the segments for all that has to be known before trips are built.

The position bounds, which vehicles are hot, and where to cut them come out of a single
aggregation: every segment counts for the whole, a hashed share of them for their
vehicles, and a few of those stand for themselves. Partial sums leave one row for the whole, one for each
vehicle and the few of a task to be shuffled. Only the whole, the hot vehicles and the
few are written, to the shared folder; the driver gets the whole and the cuts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripflow.functions.shared import keep
from tripflow.operators import trip_fold
from tripflow.operators.bounds import DEVIATIONS, Box, geo_bounds

#: Rows of a slice of a hot vehicle, the least number that may be asked for, and sampled rows for each cut.
SPLIT_ROWS, LEAST_SPLIT, SAMPLED = 5_000_000, 100_000, 16
WHOLE, VEHICLE, ROW = 0, 1, 2
ORDER = ["start_ts", "end_ts", "seg_id"]
CUT = "struct<start_ts:bigint,end_ts:bigint,seg_id:bigint>"


@dataclass(frozen=True)
class VehicleCuts:
    """A hot vehicle and the first rows of its slices but the first, as (start, end, id)."""

    vehicle_id: int
    cuts: tuple[tuple[int, int, int], ...]

    def grouped(self) -> tuple:
        """(vehicle, size of a group, cuts in groups)."""
        size = max(1, math.isqrt(len(self.cuts)))
        return self.vehicle_id, size, [list(self.cuts[k : k + size]) for k in range(0, len(self.cuts), size)]


@dataclass(frozen=True)
class Survey:
    """The bounds of the positions, and the hot vehicles."""

    box: Box
    hot: list[VehicleCuts]


def entering_kind() -> Column:
    """What kind of row a segment is to the fold; NULL for one that cannot change any trip.

    Segments that take no time are left out as well: that a segment lasts at least a
    second is what bounds the size of a trip.
    """
    status, seconds = F.concat("start_status", "end_status"), F.col("end_ts") - F.col("start_ts")
    kind = (
        F.when((status == "EM") & (seconds <= trip_fold.MAX_METER_ON), trip_fold.METER_ON)
        .when(status == "MM", trip_fold.METERED)
        .when(status == "ME", trip_fold.METER_OFF)
    )
    return F.when(F.col("vehicle_id").isNotNull() & (seconds > 0), kind).cast("tinyint")


def entering_rows(segments: DataFrame) -> DataFrame:
    """Segments that the fold takes, with ``kind``."""
    return segments.withColumn("kind", entering_kind()).where(F.col("kind").isNotNull())


def sampling_steps(split_rows: int, least_split: int) -> tuple[int, int]:
    """One row in how many counts for its vehicle, and one in how many may become a cut; the second are among the first."""
    if split_rows < least_split:
        raise ValueError(f"split_rows must be at least {least_split}")
    share = max(1, min(64, split_rows // 10_000))
    return share, share * max(1, split_rows // SAMPLED // share)


KEYS = ["mark", "vehicle", *ORDER]


def _mark(mark: int, vehicle=None, rows: bool = False, end: str | None = None) -> Column:
    none, nowhere = F.lit(None).cast("bigint"), F.lit(None).cast("double")
    return F.struct(
        F.lit(mark).alias("mark"), (none if vehicle is None else F.col(vehicle)).alias("vehicle"),
        *[(F.col(c) if rows else none).alias(c) for c in ORDER],
        *[(nowhere if end is None else F.col(f"{end}_{c}")).alias(c) for c in ("lat", "lon")],
    )


def _counts(segments: DataFrame, split_rows: int, least_split: int, whole: bool) -> DataFrame:
    """The aggregation: rows (mark, vehicle, start, end, id, n, moments), those worth keeping."""
    share, every = sampling_steps(split_rows, least_split)
    chance = F.xxhash64("seg_id")
    counted = entering_kind().isNotNull() & (F.pmod(chance, F.lit(share)) == 0)
    sampled = counted & (F.pmod(chance, F.lit(every)) == 0)
    marks = [F.when(counted, _mark(VEHICLE, "vehicle_id")), F.when(sampled, _mark(ROW, "vehicle_id", rows=True))]
    if whole:
        marks += [_mark(WHOLE, end="start"), _mark(WHOLE, end="end")]
    else:
        segments = segments.where(counted)
    one = segments.select(F.explode(F.filter(F.array(*marks), lambda m: m.isNotNull())).alias("m"))
    moments = [
        f(f"m.{axis}").alias(f"{axis}_{name}") for name, f in (("mean", F.avg), ("var", F.var_samp)) for axis in ("lat", "lon")
    ]
    counts = one.groupBy(*[F.col(f"m.{c}").alias(c) for c in KEYS]).agg(F.count("*").alias("n"), *(moments if whole else []))
    return keep(counts.where((F.col("mark") != VEHICLE) | (F.col("n") * share > split_rows)))


def _chosen(counts: DataFrame, split_rows: int, every: int) -> DataFrame:
    """(vehicle, start, end, id) of the cuts of hot vehicles: every so-manieth sampled row of each."""
    hot = counts.where(F.col("mark") == VEHICLE).select("vehicle")
    few = counts.where(F.col("mark") == ROW).join(hot, "vehicle")
    place = F.row_number().over(Window.partitionBy("vehicle").orderBy(*ORDER))
    step = max(1, round(split_rows / every))
    return few.withColumn("_place", place).where(F.col("_place") % step == 0).select("vehicle", *ORDER)


def _cuts(counts: DataFrame, split_rows: int, every: int) -> list[VehicleCuts]:
    """Hot vehicles and their cuts.

    There are at most ``rows / split_rows`` vehicles, and about as many cuts in all.
    """
    cuts: dict[int, list] = {}
    for r in _chosen(counts, split_rows, every).collect():
        cuts.setdefault(r["vehicle"], []).append((r["start_ts"], r["end_ts"], r["seg_id"]))
    return [VehicleCuts(v, tuple(sorted(c))) for v, c in sorted(cuts.items())]


def cut_table(segments: DataFrame, split_rows: int = SPLIT_ROWS, least_split: int = LEAST_SPLIT) -> DataFrame:
    """The hot vehicles as a table (vehicle_id, _size, _groups), a row of ``VehicleCuts.grouped`` each, in the shared
    folder: one pass over the segments, and no cut comes to the driver."""
    _, every = sampling_steps(split_rows, least_split)
    chosen = _chosen(_counts(segments, split_rows, least_split, whole=False), split_rows, every)
    own = chosen.groupBy(F.col("vehicle").alias("vehicle_id")).agg(F.sort_array(F.collect_list(F.struct(*ORDER))).alias("_cuts"))
    sized = own.withColumn("_size", F.greatest(F.lit(1), F.floor(F.sqrt(F.size("_cuts")))).cast("int"))
    number = F.floor((F.size("_cuts") - 1) / F.col("_size")).cast("int")
    groups = F.transform(F.sequence(F.lit(0), number), lambda k: F.slice("_cuts", k * F.col("_size") + 1, F.col("_size")))
    return keep(sized.select("vehicle_id", "_size", groups.cast(f"array<array<{CUT}>>").alias("_groups")))


def hot_vehicles(segments: DataFrame, split_rows: int = SPLIT_ROWS, least_split: int = LEAST_SPLIT) -> list[VehicleCuts]:
    """Vehicles with more than ``split_rows`` rows, and rows to cut them at: one pass over the segments."""
    _, every = sampling_steps(split_rows, least_split)
    return _cuts(_counts(segments, split_rows, least_split, whole=False), split_rows, every)


def survey(
    segments: DataFrame, split_rows: int = SPLIT_ROWS, k: float = DEVIATIONS, least_split: int = LEAST_SPLIT
) -> Survey:
    """Bounds of all clean segments, and hot vehicles with their cuts, in one pass over them.

    The bounds follow from every row. Rows of vehicles are counted from a hashed
    share, and before the bounds apply: that only decides what runs in parallel.
    """
    _, every = sampling_steps(split_rows, least_split)
    counts = _counts(segments, split_rows, least_split, whole=True)
    stats = counts.where(F.col("mark") == WHOLE).agg(
        F.coalesce(F.max("n"), F.lit(0)).alias("n"),
        *[F.max(f"{axis}_{m}").alias(f"{axis}_{m}") for axis in ("lat", "lon") for m in ("mean", "var")],
    )
    return Survey(Box(*geo_bounds(stats, k).first()), _cuts(counts, split_rows, every))
