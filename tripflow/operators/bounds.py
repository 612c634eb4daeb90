"""Position statistics and the outlier filter built on them."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sampling step of the compatible mode, and band half-width in standard deviations.
SAMPLE_EVERY = 1000
DEVIATIONS = 20.0


class Box(NamedTuple):
    """Limits of latitude and longitude, both ends inside."""

    lat_lo: float
    lat_hi: float
    lon_lo: float
    lon_hi: float


def systematic_sample(segments: DataFrame, every: int = SAMPLE_EVERY) -> DataFrame:
    """Every ``every``-th segment by ``seg_id``.

    The choice depends on the row alone, not on how rows are spread over tasks.
    """
    return segments.where(F.pmod("seg_id", F.lit(every)) == 0)


def geo_stats(
    segments: DataFrame, sample_every: int | None = None, split_key: Column | None = None
) -> DataFrame:
    """Count, mean and sample variance of positions, of all rows or of a systematic sample.

    Start and end positions both count. One row, or with ``split_key`` one row
    per key. Partial aggregation leaves one row per task and key to shuffle.
    """
    sample = segments if sample_every is None else systematic_sample(segments, sample_every)
    keys = []
    if split_key is not None:
        sample = sample.withColumn("split_key", split_key)
        keys = ["split_key"]
    points = sample.select(
        *keys,
        F.explode(
            F.array(
                F.struct(F.col("start_lat").alias("lat"), F.col("start_lon").alias("lon")),
                F.struct(F.col("end_lat").alias("lat"), F.col("end_lon").alias("lon")),
            )
        ).alias("p"),
    )
    return points.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.avg("p.lat").alias("lat_mean"),
        F.avg("p.lon").alias("lon_mean"),
        F.var_samp("p.lat").alias("lat_var"),
        F.var_samp("p.lon").alias("lon_var"),
    )


def pooled_geo_stats(stats: DataFrame) -> DataFrame:
    """Pool per-key statistics: unweighted mean of means, sum(var*n)/sum(n-1)."""
    n = F.col("n")
    pooled = lambda var: F.try_divide(F.sum(F.col(var) * n), F.sum(n - 1))
    return stats.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.coalesce(F.avg("lat_mean"), F.lit(0.0)).alias("lat_mean"),
        F.coalesce(F.avg("lon_mean"), F.lit(0.0)).alias("lon_mean"),
        pooled("lat_var").alias("lat_var"),
        pooled("lon_var").alias("lon_var"),
    )


def geo_bounds(stats: DataFrame, k: float = DEVIATIONS) -> DataFrame:
    """Mean +- ``k`` standard deviations; the whole world when there are no positions."""

    def limit(axis: str, sign: int, world: float) -> Column:
        edge = F.col(f"{axis}_mean") + F.sqrt(f"{axis}_var") * F.lit(sign * float(k))
        return F.when(F.col("n") > 0, F.coalesce(edge, F.lit(world))).otherwise(F.lit(world))

    return stats.select(
        limit("lat", -1, -90.0).alias("lat_lo"),
        limit("lat", 1, 90.0).alias("lat_hi"),
        limit("lon", -1, -180.0).alias("lon_lo"),
        limit("lon", 1, 180.0).alias("lon_hi"),
    )


def outlier_filter(
    segments: DataFrame,
    k: float = DEVIATIONS,
    sample_every: int | None = None,
    compat_split_key: Column | None = None,
    box: Box | None = None,
) -> DataFrame:
    """Keep segments whose start and end lie within the bounds.

    The bounds follow from every row, whatever their number; ``sample_every``
    takes them from a sample instead, which on small input can be too narrow to
    hold the rows it was not taken from. They reach the scan as one scalar
    subquery, so there is no join. With ``compat_split_key`` the statistics are taken per key and pooled.
    A ``box`` that is known, as from ``survey``, saves the pass over the segments.
    """
    if box is not None:
        box = F.struct(*[F.lit(v).alias(c) for c, v in box._asdict().items()])
    else:
        stats = geo_stats(segments, sample_every, compat_split_key)
        if compat_split_key is not None:
            stats = pooled_geo_stats(stats)
        box = geo_bounds(stats, k).select(F.struct("*").alias("box")).scalar()
    inside = lambda axis: (
        F.col(f"start_{axis}").between(box[f"{axis}_lo"], box[f"{axis}_hi"])
        & F.col(f"end_{axis}").between(box[f"{axis}_lo"], box[f"{axis}_hi"])
    )
    return segments.where(inside("lat") & inside("lon"))
