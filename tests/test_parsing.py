"""Raw lines, cleaning, zones, trip lines and statistics."""

import pytest
from pyspark.sql import functions as F

from tripflow.operators import bounds, clean, trips, zones
from tripflow.sources import raw_segments, trip_lines

TZ = "America/Los_Angeles"
GOOD = "9,'2010-03-15 15:06:56',37.61554,-122.38507,'E','2010-03-15 15:09:56',37.62008,-122.39949,'M'"
PLACES = ("37.1,-122.1", "37.2,-122.2")


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def line(vehicle="9", t0="2010-03-15 15:06:56", a=PLACES[0], s0="M", t1="2010-03-15 15:09:56", b=PLACES[1], s1="M", more=""):
    return f"{vehicle},'{t0}',{a},'{s0}','{t1}',{b},'{s1}'{more}"


def kept(spark, *values):
    return clean.clean(raw_segments.parse_raw(lines(spark, *values), tz=TZ)).count()


def test_sample_line(spark):
    r = raw_segments.parse_raw(lines(spark, GOOD), tz=TZ).first()
    assert (r.vehicle_id, r.start_ts, r.end_ts) == (9, 1268690816, 1268690996)
    assert (r.start_lat, r.start_lon, r.end_lat, r.end_lon) == (37.61554, -122.38507, 37.62008, -122.39949)
    assert (r.start_status, r.end_status) == ("E", "M")


REJECTED = {
    "eight fields": GOOD.rsplit(",", 1)[0],
    "ninth field empty": line(s1=""),
    "empty to empty": line(s0="E", s1="E"),
    "unknown status": line(s0="X"),
    "latitude 91": line(a="91,-122.1"),
    "longitude -181": line(b="37.2,-181"),
    "latitude abc": line(a="abc,-122.1"),
    "latitude NaN": line(a="NaN,-122.1"),
    "same position": line(b=PLACES[0]),
    "same time": line(t1="2010-03-15 15:06:56"),
    "end before start": line(t1="2010-03-15 15:06:55"),
    "no such day": line(t0="2010-02-30 10:00:00"),
    "no time": line(t0="yesterday"),
    "id not a number": line(vehicle="x7"),
    "empty line": "",
}
ACCEPTED = {
    "good": GOOD,
    "latitude 90": line(a="90,-122.1"),
    "tenth field": line(more=",more"),
    "trailing commas": line(more=",,,"),
    "only latitude differs": line(b="37.3,-122.1"),
    "blanks around": f"  {GOOD} \t",
    "leading zero": line(vehicle="07"),
}


@pytest.mark.parametrize("name", REJECTED)
def test_rejected_lines(spark, name):
    assert kept(spark, REJECTED[name]) == 0


@pytest.mark.parametrize("name", ACCEPTED)
def test_accepted_lines(spark, name):
    assert kept(spark, ACCEPTED[name]) == 1


def test_numeric_ids_are_one_vehicle(spark):
    parsed = raw_segments.parse_raw(lines(spark, line("07"), line("7", t0="2010-03-15 15:06:50")), tz=TZ)
    assert {r.vehicle_id for r in parsed.collect()} == {7}


def test_session_zone_does_not_matter(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    values = [line(t0="2010-03-14 02:30:00"), line(t0="2010-11-07 01:30:00")]
    try:
        got = []
        for zone in ("UTC", "Asia/Tokyo", TZ):
            spark.conf.set("spark.sql.session.timeZone", zone)
            parsed = raw_segments.parse_raw(lines(spark, *values), tz=TZ).orderBy("start_ts")
            got.append([r.start_ts for r in parsed.collect()])
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [[1268562600, 1289118600]] * 3  # the second is the earlier of two instants


def test_line_is_split_once(spark):
    """Filters on parsed fields must not parse the line again."""
    plan = clean.clean(raw_segments.parse_raw(lines(spark, GOOD), tz=TZ))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("split(") == 1 and text.count("gettimestamp") == 2


BOXES = [("A/One", 10.0, 20.0, 10.0, 20.0), ("B/Two", 15.0, 25.0, 15.0, 25.0), ("C/Three", -1.5, -0.5, -0.5, 0.5)]


def test_assign_timezone(spark):
    table = spark.createDataFrame(BOXES, "tz string, lat_min double, lat_max double, lon_min double, lon_max double")
    points = [(12.0, 12.0, "A/One"), (17.0, 17.0, "A/One"), (20.5, 20.5, "B/Two"), (25.0, 25.0, "B/Two"),
              (10.0, 20.0, "A/One"), (-1.0, 0.0, "C/Three"), (0.0, 0.0, None), (95.0, 0.0, None),
              (float("nan"), 0.0, None), (None, 0.0, None), (1e300, 0.0, None)]
    df = spark.createDataFrame(points, "start_lat double, start_lon double, want string")
    rows = zones.assign_timezone(df, table).collect()
    assert len(rows) == len(points) and all(r.tz == r.want for r in rows)


def test_parse_with_zones(spark):
    table = spark.createDataFrame([(TZ, 37.0, 38.0, -123.0, -122.0)], "tz string, lat_min double, lat_max double, lon_min double, lon_max double")
    parsed = raw_segments.parse_raw(lines(spark, GOOD, line(a="10,10")), zones=table)
    assert sorted((r.start_ts or 0) for r in parsed.collect()) == [0, 1268690816]
    with pytest.raises(ValueError):
        raw_segments.parse_raw(lines(spark, GOOD))


SEG = "1267402225 37.79076 -122.40255 1267402400 37.78538 -122.40024"
ISO = "2008-06-09T13:38:37-0700 37.78856 -122.40897 2008-06-09T13:39:39-0700 37.78869 -122.40893"


def decoded(spark, *values):
    return trip_lines.decode_trips(lines(spark, *values)).collect()


def test_decode_forms(spark):
    (r,) = decoded(spark, f"9 {SEG}")
    assert r.vehicle_id == "9" and tuple(r.segments[0]) == (1267402225, 37.79076, -122.40255, 1267402400, 37.78538, -122.40024)
    (r,) = decoded(spark, "9 1267402225.0 37.79076 -122.40255 1267402400.9 37.78538 -122.40024")
    assert (r.segments[0].start_ts, r.segments[0].end_ts) == (1267402225, 1267402400)
    (r,) = decoded(spark, f"9 {ISO};{ISO};")
    assert len(r.segments) == 2 and r.segments[0].start_ts == 1213043917


@pytest.mark.parametrize(
    "body",
    [
        SEG.rsplit(" ", 1)[0],
        SEG + " 1",
        f"{SEG};{SEG} 1",
        f"{SEG};{ISO}",
        f"{ISO};{SEG}",
        SEG.replace("37.79076", "90"),
        SEG.replace("37.79076", "-90"),
        SEG.replace("-122.40255", "180.5"),
        SEG.replace("37.79076", "abc"),
        SEG.replace("37.79076", "NaN"),
        SEG.replace("1267402400", "1267402225"),
        SEG.replace("1267402400", "soon"),
        ISO.replace("2008-06-09T13:38:37", "2008-02-30T13:38:37"),
        f"{SEG};;{SEG}",
        "",
    ],
)
def test_decode_drops_whole_line(spark, body):
    assert decoded(spark, f"9 {body}") == []


def test_decode_line_without_body(spark):
    assert decoded(spark, "9", "") == []


def test_decode_keeps_the_id_as_text(spark):
    assert [r.vehicle_id for r in decoded(spark, f"x7 {SEG}", f"07 {SEG}")] == ["x7", "07"]


def trip_table(spark):
    parsed = [(1, [(1268778038, 37.5, -122.25, 1268778098, 37.75, -122.5), (1268778098, 37.75, -122.5, 1268778198, 37.0, -122.0)]),
              (2, [(1268778000, 1.0, 2.0, 1268778001, 3.0, 4.0)])]
    return spark.createDataFrame(parsed, trips.TRIP_SCHEMA)


@pytest.mark.parametrize("time_format", ["epoch", "iso"])
def test_complete_round_trip(spark, time_format):
    table = trip_table(spark)
    back = trip_lines.decode_trips(trip_lines.encode_trips(table, "complete", time_format, "Asia/Kolkata"))
    assert sorted(back.collect()) == sorted(table.withColumn("vehicle_id", F.col("vehicle_id").cast("string")).collect())


def test_encoded_text(spark):
    one = trip_table(spark).where("vehicle_id = 1")
    get = lambda *a, **k: trip_lines.encode_trips(one, *a, **k).first().value
    assert get() == "1 1268778038 37.5 -122.25 1268778198 37.0 -122.0"
    assert get("complete") == (
        "1 1268778038 37.5 -122.25 1268778098 37.75 -122.5;1268778098 37.75 -122.5 1268778198 37.0 -122.0"
    )
    assert get("summary", "iso", TZ) == (
        "1 2010-03-16T15:20:38-0700 37.5 -122.25 2010-03-16T15:23:18-0700 37.0 -122.0"
    )
    assert get("summary", "iso", TZ, compat=True) == (
        "1 2010-03-16T15:20:38-0700 37.5 -122.25 2010-03-16T15:21:38-0700 37.0 -122.0"
    )
    zoned = one.withColumn("zone", F.lit("Asia/Kolkata"))
    text = trip_lines.encode_trips(zoned, "summary", "iso", F.col("zone")).first().value
    assert text.startswith("1 2010-03-17T03:50:38+0530 ")
    for bad in (("other",), ("summary", "other"), ("summary", "iso")):
        with pytest.raises(ValueError):
            get(*bad)


def test_compat_summary_of_one_segment_does_not_decode(spark):
    two = trip_table(spark).where("vehicle_id = 2")
    good = trip_lines.encode_trips(two, "summary", "iso", TZ)
    bad = trip_lines.encode_trips(two, "summary", "iso", TZ, compat=True)
    assert trip_lines.decode_trips(good).count() == 1
    assert trip_lines.decode_trips(bad).count() == 0


STATS = "seg_id bigint, vehicle_id bigint, start_lat double, start_lon double, end_lat double, end_lon double"


def test_stats_and_bounds(spark):
    rows = [(i * 2, i % 2, 10.0 + i, 20.0, 11.0 + i, 20.0 + i % 3) for i in range(10)]
    df = spark.createDataFrame(rows, STATS)
    s = bounds.geo_stats(df, 1).first()
    assert s.n == 20 and s.lat_mean == pytest.approx(15.0) and s.lat_var == pytest.approx(8.947368, abs=1e-6)
    assert bounds.geo_stats(df, 4).first().n == 10
    per = bounds.geo_stats(df, 1, F.col("vehicle_id"))
    pooled = bounds.pooled_geo_stats(per).first()
    parts = per.collect()
    assert pooled.lat_mean == pytest.approx(sum(p.lat_mean for p in parts) / 2)
    assert pooled.lat_var == pytest.approx(sum(p.lat_var * p.n for p in parts) / sum(p.n - 1 for p in parts))


def test_outliers_and_no_sample(spark):
    rows = [(i, 0, 37.0 + i % 7 / 100, -122.0, 37.01, -122.0 + i % 3 / 100) for i in range(200)]
    df = spark.createDataFrame([*rows, (1001, 0, 89.0, -122.0, 37.0, -122.0)], STATS)
    assert bounds.outlier_filter(df, k=20.0, sample_every=10).count() == 200
    # Nothing sampled: the bounds are the whole world.
    odd = df.where("seg_id % 2 = 1")
    assert bounds.outlier_filter(odd, sample_every=2).count() == odd.count()
    assert bounds.outlier_filter(odd, sample_every=2, compat_split_key=F.lit(1)).count() == odd.count()
