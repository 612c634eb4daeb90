"""Trip counts per distance band."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.operators.metrics import valid_trips

# Fixed value: a longer trip is taken for an error.
SANITY_LIMIT = 200.0


def band_count(width: float, max_dist: float, compat: bool = False) -> int:
    """Number of bands, the open last one included.

    ``max_dist`` must be a multiple of ``width``. ``compat=True`` tests the
    remainder as a whole number, so fractions of a unit go unnoticed.
    """
    if width <= 0 or max_dist <= 0:
        raise ValueError("width and max_dist must be positive")
    ratio = max_dist / width
    if compat:
        if int(max_dist % width) != 0:
            raise ValueError("max_dist must be a multiple of width")
        return int(ratio) + 1
    if round(ratio) < 1 or abs(ratio - round(ratio)) > 1e-9:
        raise ValueError("max_dist must be a multiple of width")
    return round(ratio) + 1


def band_limit(band: Column, width: float, max_dist: float, n_bands: int) -> Column:
    """Upper limit of a band; the last has ``max_dist`` as its nominal limit."""
    return F.when(band == n_bands - 1, F.lit(float(max_dist))).otherwise((band + 1) * F.lit(float(width)))


def band(
    distance: Column | str,
    width: float,
    max_dist: float,
    sanity: float = SANITY_LIMIT,
    compat: bool = False,
) -> Column:
    """Band number of a distance, left-closed; NULL for 0 and above ``sanity``.

    ``compat=True`` leaves out distances that fall between the last regular
    limit and ``max_dist``, both included.
    """
    d = F.col(distance) if isinstance(distance, str) else distance
    n, w = band_count(width, max_dist, compat), F.lit(float(width))
    # Division may land one band off at a limit; the limits themselves decide.
    near = F.floor(d / w)
    exact = near + F.when(d >= (near + 1) * w, 1).when(d < near * w, -1).otherwise(0)
    if not compat:
        number = F.least(exact, F.lit(n - 1))
    elif n == 1:
        number = F.when(d != float(max_dist), F.lit(0))
    else:
        number = F.when(d > float(max_dist), F.lit(n - 1)).when(exact < n - 1, exact)
    return F.when((d != 0) & (d <= sanity), number).cast("int")


def distance_histogram(
    trips: DataFrame,
    width: float,
    max_dist: float,
    straight: bool = False,
    sanity: float = SANITY_LIMIT,
    unit: str = "K",
    compat: bool = False,
) -> DataFrame:
    """Valid trips per band, in band order: ``band, upper_limit, label, trips``.

    Every band appears, empty ones with 0. The count shuffles at most one row
    per task and band.
    """
    n = band_count(width, max_dist, compat)
    number = band("distance", width, max_dist, sanity, compat)
    counts = (
        valid_trips(trips, straight, unit=unit, compat=compat)
        .select(number.alias("band"))
        .where(F.col("band").isNotNull())
        .groupBy("band")
        .agg(F.count("*").alias("trips"))
    )
    bands = trips.sparkSession.range(n).select(F.col("id").cast("int").alias("band"))
    limit = band_limit(F.col("band"), width, max_dist, n)
    return (
        bands.join(counts, "band", "left")
        .select(
            "band",
            limit.alias("upper_limit"),
            F.when(F.col("band") == n - 1, "Infinity").otherwise(limit.cast("string")).alias("label"),
            F.coalesce("trips", F.lit(0)).cast("bigint").alias("trips"),
        )
        .orderBy("band")
    )
