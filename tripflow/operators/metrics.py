"""Length, validity and nearness of trips.

All figures of a trip come from its own ``segments`` array through array
functions, so nothing is exploded and nothing is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.functions import geo
from tripflow.functions.project import select_once
from tripflow.operators.trips import first_segment, last_segment

# Length units per hour, seconds, seconds.
MAX_SPEED = 200.0
MAX_GAP = 600
MAX_DURATION = 21_600


@dataclass(frozen=True)
class ReferencePoint:
    """A place and the distance within which a trip counts as passing it."""

    lat: float
    lon: float
    range_km: float = 1.0
    name: str = ""

    def check(self, compat: bool = False) -> None:
        bad = abs(self.lat) >= 90 or abs(self.lon) > 180
        # compat: longitude 0 is refused and the range is not looked at.
        bad = bad or (self.lon == 0 if compat else self.range_km < 0)
        if bad:
            raise ValueError(f"invalid reference point: {self}")


def trip_legs(
    segments: Column | str = "segments",
    ref: ReferencePoint | None = None,
    unit: str = "K",
    compat: bool = False,
) -> Column:
    """Array of per-segment figures, in trip order.

    ``seg_len`` and ``speed`` belong to the segment; ``gap_len`` belongs to the
    way from the previous segment's end to this start and is 0 where those
    positions meet. ``fault`` names what is wrong with the leg: first the gap
    (only looked at where positions do not meet), then the speed. ``near`` tells
    whether the great circle of either part passes the reference point.
    ``compat=True`` compares the segment's cross-track distance with its sign,
    so that anything to the left counts as near.
    """
    segments = F.col(segments) if isinstance(segments, str) else segments

    # Three passes over the array; each names what the next one uses several
    # times, because a lambda body evaluates every mention again.
    def pair(s: Column, i: Column) -> Column:
        return F.struct(s.alias("s"), F.get(segments, i - 1).alias("p"))

    def measure(x: Column) -> Column:
        s, p = x["s"], x["p"]
        # NULL for the first leg, which has no previous segment.
        apart = (p["end_lat"] != s["start_lat"]) | (p["end_lon"] != s["start_lon"])
        gap = (p["end_lat"], p["end_lon"], s["start_lat"], s["start_lon"])
        seg = (s["start_lat"], s["start_lon"], s["end_lat"], s["end_lon"])
        near = F.lit(True)
        if ref is not None:
            off_seg = geo.cross_track(*seg, ref.lat, ref.lon, unit, compat)
            off_gap = geo.cross_track(*gap, ref.lat, ref.lon, unit, compat)
            near = ((off_seg if compat else F.abs(off_seg)) <= ref.range_km) | F.when(
                apart, F.abs(off_gap) <= ref.range_km
            ).otherwise(False)
        return F.struct(
            geo.distance(*seg, unit, compat).alias("seg_len"),
            s["start_ts"].alias("start_ts"),
            s["end_ts"].alias("end_ts"),
            F.when(apart, geo.distance(*gap, unit, compat)).otherwise(0.0).alias("gap_len"),
            F.when(apart, s["start_ts"] - p["end_ts"]).alias("gap_secs"),
            near.alias("near"),
        )

    def judge(m: Column) -> Column:
        speed = geo.speed_per_hour(m["seg_len"], m["start_ts"], m["end_ts"])
        return F.struct(
            m["seg_len"].alias("seg_len"),
            speed.alias("speed"),
            m["gap_len"].alias("gap_len"),
            F.when(m["gap_secs"] < 0, "out_of_sequence")
            .when(m["gap_secs"] > MAX_GAP, "long_gap")
            .when(speed > MAX_SPEED, "too_fast")
            .alias("fault"),
            m["near"].alias("near"),
        )

    return F.transform(F.transform(F.transform(segments, pair), measure), judge)


def travelled_length(legs: Column | str = "_legs") -> Column:
    """Segment lengths plus the lengths of the gaps between them."""
    return F.aggregate(legs, F.lit(0.0), lambda total, x: total + x["gap_len"] + x["seg_len"])


def straight_length(unit: str = "K", compat: bool = False) -> Column:
    """First start to last end, as the crow flies."""
    a, b = first_segment(), last_segment()
    return geo.distance(a["start_lat"], a["start_lon"], b["end_lat"], b["end_lon"], unit, compat)


def trip_metrics(
    trips: DataFrame,
    straight: bool = False,
    ref: ReferencePoint | None = None,
    unit: str = "K",
    compat: bool = False,
) -> DataFrame:
    """Add ``start_ts, end_ts, distance, reject_reason`` to trips.

    ``reject_reason`` is NULL for a valid trip. Otherwise it is the first leg's
    fault, ``out_of_sequence`` (a segment starts before the previous one ended,
    at another place), ``long_gap`` (more than ten minutes between such
    segments) or ``too_fast`` (a segment above 200 units per hour), else
    ``too_long`` (six hours or more), else ``not_near``. ``distance`` is NULL for
    a rejected trip. With ``straight`` only the length changes; the checks still
    look at every segment.
    """
    if ref is not None:
        ref.check(compat)
    length = straight_length(unit, compat) if straight else travelled_length()
    faults = F.filter(F.transform("_legs", lambda x: x["fault"]), lambda f: f.isNotNull())
    too_long = F.col("end_ts") - F.col("start_ts") >= MAX_DURATION
    reason = F.coalesce(F.get(faults, F.lit(0)), F.when(too_long, "too_long"))
    if ref is not None:
        reason = F.coalesce(reason, F.when(~F.exists("_legs", lambda x: x["near"]), "not_near"))
    # Callers filter on the reason and compute with the length; both, and the
    # legs under them, are evaluated once per trip.
    others = tuple(trips.columns)
    legged = select_once(
        trips,
        first_segment()["start_ts"].alias("start_ts"),
        last_segment()["end_ts"].alias("end_ts"),
        trip_legs("segments", ref, unit, compat).alias("_legs"),
        keep=others,
    )
    judged = select_once(
        legged, reason.alias("reject_reason"), length.alias("distance"), keep=(*others, "start_ts", "end_ts")
    )
    return judged.withColumn("distance", F.when(F.col("reject_reason").isNull(), F.col("distance")))


def valid_trips(
    trips: DataFrame,
    straight: bool = False,
    ref: ReferencePoint | None = None,
    unit: str = "K",
    compat: bool = False,
) -> DataFrame:
    """Trips that pass every check, with ``start_ts, end_ts, distance``."""
    metrics = trip_metrics(trips, straight, ref, unit, compat)
    return metrics.where(F.col("reject_reason").isNull()).drop("reject_reason")


def trip_summary(trips: DataFrame) -> DataFrame:
    """First start and last end of every trip."""
    a, b = first_segment(), last_segment()
    return trips.select(
        *[c for c in trips.columns if c != "segments"],
        *[a[c].alias(c) for c in ("start_ts", "start_lat", "start_lon")],
        *[b[c].alias(c) for c in ("end_ts", "end_lat", "end_lon")],
    )
