"""Taxi segments derived from the ``events`` table, for tests and benchmarks.

``events(event_id, ts, user_id, event_type, value, props)`` becomes a fleet: a
user is a vehicle, an event is a position fix, and consecutive fixes of a user
bound a segment. Every event is a fix. Two kinds of segment follow from a fix:
one to the next fix, which stops on the way where the tracker lost
its signal (which leaves gaps), and at some fixes a consolidated one to the fix
after the next (which overlaps its parts).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripflow.functions.times import ntz_to_epoch

# Fixed values of the derivation.
ORIGIN_EPOCH = 1_704_067_200
TIME_SQUEEZE = 300
LAT_ORIGIN, LON_ORIGIN, STEP = 37.70, -122.40, 0.0001
EMPTY_EVENTS = ("signup", "error")
LOST_SIGNAL_EVERY, LOST_SIGNAL_AT = 7, 3
CONSOLIDATED_EVERY = 10


def position_fixes(events: DataFrame, origin: int = ORIGIN_EPOCH, squeeze: int = TIME_SQUEEZE) -> DataFrame:
    """events -> ``vehicle_id, event_id, fix(t, lat, lon, status)``.

    Times run from ``origin``, ``squeeze`` times as fast as the events'.
    """
    if dict(events.dtypes)["ts"] == "timestamp_ntz":
        epoch: Column = ntz_to_epoch(F.col("ts"))
    else:
        epoch = F.unix_seconds("ts")
    k = F.get_json_object("props", "$.k").cast("double")
    return events.select(
        F.col("user_id").alias("vehicle_id"),
        "event_id",
        F.struct(
            (F.lit(origin) + F.floor((epoch - ORIGIN_EPOCH) / squeeze)).alias("t"),
            (F.lit(LAT_ORIGIN) + F.col("value") * F.lit(STEP)).alias("lat"),
            (F.lit(LON_ORIGIN) + k * F.lit(STEP)).alias("lon"),
            F.when(F.col("event_type").isin(*EMPTY_EVENTS), "E").otherwise("M").alias("status"),
        ).alias("fix"),
    )


def following_fixes(fixes: DataFrame, split_rows: int = 5_000_000) -> DataFrame:
    """Add ``next_fix`` and ``second_fix``, the vehicle's two fixes that follow.

    A vehicle with more than ``split_rows`` fixes is cut into slices of its
    event ids, so that no task has to sort all of them. The last two fixes of a
    slice then look into the next slices through ``heads``, one row per slice.
    There are at most ``rows / split_rows`` such vehicles and about twice as many
    slices, which bounds both broadcasts.
    """
    every = max(1, min(64, split_rows // 10_000))  # numbers are estimated from a share
    n = F.count("*") * every
    ids = F.max("event_id") - F.min("event_id") + 1
    hot = (
        fixes.where(F.pmod(F.xxhash64("event_id"), F.lit(every)) == 0)
        .groupBy("vehicle_id")
        .agg(
            n.alias("n"),
            F.min("event_id").alias("first_id"),
            F.ceil(ids * F.lit(float(split_rows)) / n).alias("slice_ids"),
        )
        .where(F.col("n") > split_rows)
        .drop("n")
    )
    in_slice = Window.partitionBy("vehicle_id", "slice").orderBy("event_id")
    paired = (
        fixes.join(F.broadcast(hot), "vehicle_id", "left")
        .withColumn("slice", F.floor((F.col("event_id") - F.col("first_id")) / F.col("slice_ids")))
        .select(
            "vehicle_id", "event_id", "slice", "fix",
            F.lead("fix", 1).over(in_slice).alias("next_fix"),
            F.lead("fix", 2).over(in_slice).alias("second_fix"),
            F.row_number().over(in_slice).alias("rank"),
        )
    )
    by_slice = Window.partitionBy("vehicle_id").orderBy("slice")
    heads = paired.where(F.col("slice").isNotNull() & (F.col("rank") == 1)).select(
        "vehicle_id", "slice",
        F.lead("fix", 1).over(by_slice).alias("next_1"),
        F.coalesce(F.lead("next_fix", 1).over(by_slice), F.lead("fix", 2).over(by_slice)).alias("next_2"),
    )
    last = F.col("next_fix").isNull()
    return paired.join(F.broadcast(heads), ["vehicle_id", "slice"], "left").select(
        "vehicle_id", "event_id", "fix",
        F.coalesce("next_fix", "next_1").alias("next_fix"),
        F.coalesce("second_fix", F.when(last, F.col("next_2")).otherwise(F.col("next_1"))).alias("second_fix"),
    )


def segments_from_events(
    events: DataFrame, split_rows: int = 5_000_000, origin: int = ORIGIN_EPOCH, squeeze: int = TIME_SQUEEZE
) -> DataFrame:
    """events -> segments, before any validity filter."""
    paired = following_fixes(position_fixes(events, origin, squeeze), split_rows)
    lost = F.col("event_id") % LOST_SIGNAL_EVERY == LOST_SIGNAL_AT
    to = F.col("next_fix")
    part = F.struct(
        (to["t"] - F.floor((to["t"] - F.col("fix.t")) / 2)).alias("t"),
        (F.col("fix.lat") + (to["lat"] - F.col("fix.lat")) / 3).alias("lat"),
        (F.col("fix.lon") + (to["lon"] - F.col("fix.lon")) / 3).alias("lon"),
        to["status"].alias("status"),
    )
    reached = F.when(to.isNotNull(), F.when(lost, part).otherwise(to))
    consolidated = F.col("event_id") % CONSOLIDATED_EVERY == 0
    ends = F.array(
        F.struct((F.col("event_id") * 2).alias("seg_id"), reached.alias("to")),
        F.struct((F.col("event_id") * 2 + 1).alias("seg_id"), F.when(consolidated, F.col("second_fix")).alias("to")),
    )
    return (
        paired.select("vehicle_id", "fix", F.explode(ends).alias("end"))
        .where(F.col("end.to").isNotNull())
        .select(
            F.col("end.seg_id").alias("seg_id"),
            "vehicle_id",
            F.col("fix.t").alias("start_ts"),
            F.col("fix.lat").alias("start_lat"),
            F.col("fix.lon").alias("start_lon"),
            F.col("fix.status").alias("start_status"),
            F.col("end.to.t").alias("end_ts"),
            F.col("end.to.lat").alias("end_lat"),
            F.col("end.to.lon").alias("end_lon"),
            F.col("end.to.status").alias("end_status"),
        )
    )


def read_event_segments(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return segments_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"), **options)
