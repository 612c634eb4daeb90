"""Geometry, trip metrics, fares and histogram hand cases."""

import math

import pytest
from pyspark.sql import functions as F

from tripflow.functions import geo
from tripflow.operators import fares, histogram, metrics
from tripflow.operators.trips import TRIP_SCHEMA

C, D = (37.62008, -122.39949), (37.63574, -122.40345)
FAR = (37.62131, -122.37896)


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def pts(*points):
    return [F.lit(x) for p in points for x in p]


def test_distance_units(spark):
    for unit, want in (("K", 1.775893), ("M", 1.103489), ("N", 0.958906), ("?", 1.775893)):
        assert value(spark, geo.distance(*pts(C, D), unit)) == pytest.approx(want, abs=1e-6)


def test_bearing_and_cross_track(spark):
    assert value(spark, geo.bearing(*pts(C, D))) == pytest.approx(-0.197638, abs=1e-6)
    assert value(spark, geo.cross_track(*pts(C, D), *FAR)) == pytest.approx(1.799844, abs=1e-6)
    assert value(spark, geo.cross_track(*pts(D, C), *FAR)) == pytest.approx(-1.799844, abs=1e-6)


def test_equal_latitude(spark):
    p = pts((37.6, -122.40), (37.6, -122.38))
    assert value(spark, geo.distance(*p)) == pytest.approx(1.761974, abs=1e-6)
    assert value(spark, geo.distance(*p, compat=True)) == 0.0


def test_same_and_antipodal_points(spark):
    assert value(spark, geo.distance(*pts(C, C))) == 0.0
    assert value(spark, geo.central_angle(*pts((0.0, 0.0), (0.0, 180.0)))) == pytest.approx(math.pi)


def trips_of(spark, *trips):
    return spark.createDataFrame([(1, list(t)) for t in trips], TRIP_SCHEMA)


def seg(t0, a, t1, b):
    return (t0, *a, t1, *b)


def reasons(df):
    return [r.reject_reason for r in df.collect()]


def test_speed_and_fare(spark):
    t = trips_of(spark, [seg(0, C, 61, D)])
    leg = t.select(F.explode(metrics.trip_legs()).alias("x")).select("x.*").first()
    assert leg.speed == pytest.approx(104.8068, abs=1e-4)
    fare = fares.fares(t).first()
    assert fare.distance == pytest.approx(1.775893, abs=1e-6)
    assert fare.cost == pytest.approx(6.536778, abs=1e-6)
    sample = trips_of(spark, [seg(1267402225, (37.79076, -122.40255), 1267402400, (37.78538, -122.40024))])
    fare = fares.fares(sample).first()
    assert (fare.distance, fare.cost) == (pytest.approx(0.631731, abs=1e-6), pytest.approx(4.580261, abs=1e-6))
    assert fare.asDict().keys() == {"start_ts", "end_ts", "distance", "cost", "vehicle_id"}


def test_charges_are_checked(spark):
    t = trips_of(spark, [seg(0, C, 61, D)])
    for bad in ({"start_charge": -1.0}, {"per_km": 0.0}):
        with pytest.raises(ValueError):
            fares.fares(t, **bad)


def test_reject_reasons(spark):
    a, b, c = (37.60, -122.40), (37.605, -122.40), (37.61, -122.40)
    t = trips_of(
        spark,
        [seg(0, a, 60, b), seg(60, b, 120, c)],  # valid
        [seg(0, a, 5, c)],  # 800 km/h
        [seg(0, a, 60, b), seg(50, c, 120, a)],  # starts too early, elsewhere
        [seg(0, a, 60, b), seg(50, b, 120, a)],  # positions meet, so times are not looked at
        [seg(0, a, 60, b), seg(661, c, 720, a)],  # 601 s
        [seg(0, a, 60, b), seg(660, c, 720, a)],  # 600 s
        [seg(0, a, 60, b), seg(10_000, b, 21_599, c)],
        [seg(0, a, 60, b), seg(10_000, b, 21_600, c)],
        [seg(0, a, 60, b), seg(661, c, 663, a)],  # the gap comes before the speed
    )
    assert reasons(metrics.trip_metrics(t)) == [
        None, "too_fast", "out_of_sequence", None, "long_gap", None, None, "too_long", "long_gap",
    ]


def test_length_adds_gaps_and_straight_does_not(spark):
    a, b, c, d = (37.60, -122.40), (37.605, -122.40), (37.605, -122.41), (37.60, -122.41)
    t = trips_of(spark, [seg(0, a, 60, b), seg(90, c, 150, d)])
    km = lambda p, q: value(spark, geo.distance(*pts(p, q)))
    got = metrics.valid_trips(t).first()
    assert got.distance == pytest.approx(km(a, b) + km(b, c) + km(c, d))
    assert (got.start_ts, got.end_ts) == (0, 150)
    assert metrics.valid_trips(t, straight=True).first().distance == pytest.approx(km(a, d))


def test_gap_of_the_split_sample(spark):
    p, q = (37.78869, -122.40893), (37.77548, -122.42626)
    assert value(spark, geo.distance(*pts(p, q))) == pytest.approx(2.115934, abs=1e-6)
    t = trips_of(
        spark,
        [seg(1213043917, (37.78856, -122.40897), 1213043979, p), seg(1213044662, q, 1213044718, (37.77509, -122.42952))],
    )
    assert reasons(metrics.trip_metrics(t)) == ["long_gap"]


def test_near_point(spark):
    ref = metrics.ReferencePoint(*FAR, 1.0, "far")
    there, back = trips_of(spark, [seg(0, C, 61, D)]), trips_of(spark, [seg(0, D, 61, C)])
    assert reasons(metrics.trip_metrics(there, ref=ref)) == ["not_near"]
    assert reasons(metrics.trip_metrics(back, ref=ref)) == ["not_near"]
    assert reasons(metrics.trip_metrics(there, ref=ref, compat=True)) == ["not_near"]
    assert reasons(metrics.trip_metrics(back, ref=ref, compat=True)) == [None]
    wide = metrics.ReferencePoint(*FAR, 1.8)
    assert reasons(metrics.trip_metrics(back, ref=wide)) == [None]


def test_near_point_by_the_gap_alone(spark):
    a, b, c, d = (37.60, -122.40), (37.60, -122.395), (37.61, -122.395), (37.61, -122.40)
    t = trips_of(spark, [seg(0, a, 60, b), seg(90, c, 150, d)])
    assert reasons(metrics.trip_metrics(t, ref=metrics.ReferencePoint(37.605, -122.3951, 0.05))) == [None]


def test_reference_point_checks():
    for bad in ((90.0, 1.0, 1.0), (10.0, 181.0, 1.0), (10.0, 1.0, -1.0)):
        with pytest.raises(ValueError):
            metrics.ReferencePoint(*bad).check()
    metrics.ReferencePoint(10.0, 0.0, 1.0).check()
    with pytest.raises(ValueError):
        metrics.ReferencePoint(10.0, 0.0, 1.0).check(compat=True)


def bands(spark, distances, *args, **kw):
    df = spark.createDataFrame([(d,) for d in distances], "d double")
    return [r.b for r in df.select(histogram.band("d", *args, **kw).alias("b")).collect()]


def test_bands(spark):
    ds = [0.0, 0.5, 1.0, 9.99, 10.0, 10.5, 200.0, 200.1]
    assert bands(spark, ds, 1.0, 10.0) == [None, 0, 1, 9, 10, 10, 10, None]
    assert bands(spark, ds, 1.0, 10.0, compat=True) == [None, 0, 1, 9, None, 10, 10, None]


def test_band_limits_are_exact(spark):
    width, n = 0.1, 50
    limits = [width * i for i in range(1, n)]
    assert bands(spark, limits, width, 5.0) == list(range(1, n))


def test_band_width_must_divide(spark):
    assert histogram.band_count(0.1, 5.0) == 51
    with pytest.raises(ValueError):
        histogram.band_count(0.3, 10.0)
    assert histogram.band_count(0.3, 10.0, compat=True) == 34
    with pytest.raises(ValueError):
        histogram.band_count(3.0, 10.0, compat=True)
    assert bands(spark, [9.85, 9.95, 10.0, 10.1], 0.3, 10.0, compat=True) == [32, None, None, 33]


def test_empty_histogram_has_every_band(spark):
    rows = histogram.distance_histogram(trips_of(spark), 1.0, 10.0).collect()
    assert [(r.band, r.trips) for r in rows] == [(i, 0) for i in range(11)]
    assert rows[0].label == "1.0" and rows[-1].label == "Infinity" and rows[-1].upper_limit == 10.0
