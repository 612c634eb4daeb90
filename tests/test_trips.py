"""Trip builder hand cases through Spark."""

import pytest
from pyspark.sql import functions as F

from tripflow.operators import survey as surveys
from tripflow.operators import trip_slices, trips
from tripflow.operators.bounds import geo_bounds, geo_stats, outlier_filter
from tripflow.plans.jobs import surveyed_trips

A, B, C, D = (37.61554, -122.38507), (37.61708, -122.38764), (37.62008, -122.39949), (37.63574, -122.40345)
SCHEMA = (
    "seg_id bigint, vehicle_id bigint, start_ts bigint, start_lat double, start_lon double, start_status string, "
    "end_ts bigint, end_lat double, end_lon double, end_status string"
)


def segs(spark, rows):
    """rows: (vehicle, start, end, pair) -> segment table, ids in list order."""
    data = [
        (i, v, s, 37.0 + i / 1000, -122.0, p[0], e, 37.0 + (i + 1) / 1000, -122.0, p[1])
        for i, (v, s, e, p) in enumerate(rows)
    ]
    return spark.createDataFrame(data, SCHEMA)


def spans(df):
    """{vehicle: [[(start, end), ...], ...]} in time order."""
    out = {}
    for r in df.collect():
        out.setdefault(r.vehicle_id, []).append([(s.start_ts, s.end_ts) for s in r.segments])
    return {v: sorted(t) for v, t in out.items()}


T = 1268690816  # 2010-03-15 15:06:56 local

CASES = {
    "consolidated": (
        [(T, T + 180, "EM"), (T + 60, T + 120, "MM"), (T + 120, T + 180, "MM"), (T + 180, T + 241, "MM"),
         (T + 241, T + 300, "ME")],
        [[(T + 180, T + 241)]],
    ),
    "long meter-on": (
        [(1267343937, 1267578666, "EM"), (1267578666, 1267578728, "MM"), (1267578728, 1267578800, "ME")],
        [[(1267578666, 1267578728)]],
    ),
    "300 s split": (
        [(1213043917, 1213043979, "MM"), (1213044662, 1213044718, "MM"), (1213044718, 1213044800, "ME")],
        [[(1213043917, 1213043979)], [(1213044662, 1213044718)]],
    ),
    "long metered": (
        [(1268778038, 1268778098, "MM"), (1268778098, 1268891832, "MM")],
        [[(1268778038, 1268778098)]],
    ),
    "open tail": ([(0, 60, "EM"), (60, 120, "MM")], []),
    "meter-on during a trip": (
        [(0, 60, "EM"), (60, 120, "MM"), (130, 180, "EM"), (180, 240, "MM"), (240, 300, "ME")],
        [[(60, 120), (180, 240)]],
    ),
    "meter-on after a split": (
        [(0, 60, "MM"), (360, 420, "MM"), (430, 480, "EM"), (480, 540, "MM"), (540, 600, "ME")],
        [[(0, 60)], [(480, 540)]],
    ),
    "overlapping meter-off": (
        [(0, 60, "EM"), (60, 120, "MM"), (100, 110, "ME"), (120, 180, "MM"), (180, 200, "ME")],
        [[(60, 120), (120, 180)]],
    ),
    "gap 299": ([(0, 60, "MM"), (359, 400, "MM"), (400, 410, "ME")], [[(0, 60), (359, 400)]]),
    "gap 300": ([(0, 60, "MM"), (360, 400, "MM"), (400, 410, "ME")], [[(0, 60)], [(360, 400)]]),
    "metered 3600": ([(0, 3600, "MM"), (3600, 3700, "ME")], [[(0, 3600)]]),
    "metered 3601": ([(0, 3601, "MM"), (3601, 3700, "ME")], []),
    "meter-on 600": (
        [(0, 60, "MM"), (360, 400, "MM"), (400, 1000, "EM"), (1000, 1100, "ME")], [[(0, 60)]]
    ),
    "meter-on 601": (
        [(0, 60, "MM"), (360, 400, "MM"), (400, 1001, "EM"), (1001, 1100, "ME")], [[(0, 60)], [(360, 400)]]
    ),
    "long after split": (
        [(0, 60, "MM"), (360, 400, "MM"), (400, 4080, "MM"), (4080, 4100, "ME")], [[(0, 60)], [(360, 400)]]
    ),
}


@pytest.mark.parametrize("split_rows", [None, 5_000_000, 1])
def test_hand_cases(spark, split_rows):
    rows, want = [], {}
    for v, (case, expected) in enumerate(CASES.values()):
        rows += [(v, s, e, p) for s, e, p in case]
        if expected:
            want[v] = expected
    assert spans(trips.build_trips(segs(spark, rows), split_rows=split_rows, least_split=1)) == want


def test_equal_start_times_are_ordered_by_end_then_id(spark):
    rows = [(1, 0, 90, "MM"), (1, 0, 60, "MM"), (1, 60, 80, "MM"), (1, 90, 100, "ME")]
    assert spans(trips.build_trips(segs(spark, rows))) == {1: [[(0, 60), (60, 80)]]}


def fleet(spark, n=12_000, vehicles=5):
    """Random-looking segments; vehicle 0 has about a third of them."""
    h = lambda salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(1_000_003))
    start = h(1) % 400_000
    return spark.range(n).select(
        F.col("id").alias("seg_id"),
        F.when(h(2) % 3 == 0, F.lit(0)).otherwise(h(3) % vehicles).cast("bigint").alias("vehicle_id"),
        start.alias("start_ts"),
        (h(4) / 1e6).alias("start_lat"), (h(5) / 1e6).alias("start_lon"),
        F.when(h(6) % 10 < 8, "M").otherwise("E").alias("start_status"),
        (start + 1 + h(7) % 200).alias("end_ts"),
        (h(8) / 1e6).alias("end_lat"), (h(9) / 1e6).alias("end_lon"),
        F.when(h(10) % 10 < 8, "M").otherwise("E").alias("end_status"),
    ).where("start_status || end_status <> 'EE'")


def content(df):
    return sorted((r.vehicle_id, [tuple(s) for s in r.segments]) for r in df.collect())


def test_result_does_not_depend_on_slices_partitions_or_batches(spark):
    rows = fleet(spark)
    want = content(trips.build_trips(rows, split_rows=None, num_partitions=1))
    assert len(want) > 500
    assert content(trips.build_trips(rows, split_rows=400, least_split=1)) == want
    assert content(trips.build_trips(rows, split_rows=1500, num_partitions=13, least_split=1)) == want
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    try:
        spark.conf.set(key, "37")
        assert content(trips.build_trips(rows, split_rows=400, num_partitions=3, least_split=1)) == want
    finally:
        spark.conf.set(key, old)


def never_off(df):
    """The fleet with meters that stay on."""
    return df.withColumns({"start_status": F.lit("M"), "end_status": F.lit("M")})


def test_a_meter_that_never_goes_off(spark, monkeypatch):
    rows = never_off(fleet(spark))
    want = content(trips.build_trips(rows, split_rows=None))
    monkeypatch.setattr(trip_slices, "FAN", 4)
    built = trips.build_trips(rows, split_rows=150, number=True, least_split=1)
    assert sorted((r.vehicle_id, [tuple(s) for s in r.segments]) for r in built.collect()) == want
    numbers = {}
    for r in sorted(built.collect(), key=lambda r: (r.vehicle_id, r.segments[0].start_ts)):
        numbers.setdefault(r.vehicle_id, []).append(r.trip_seq)
    assert all(n == list(range(1, len(n) + 1)) for n in numbers.values())


def test_no_task_folds_more_than_a_slice_again(spark):
    """Heads and tails of a vehicle whose meter never goes off stay in their slices."""
    rows = never_off(fleet(spark))
    hot = surveys.hot_vehicles(rows, 500, 1)
    folded = trips._fold_slices(trips._with_chunks(trips._fold_input(rows), hot), 4)
    again = folded.where("phase in (2, 3)").groupBy("vehicle_id", "chunk").count()
    assert again.agg(F.max("count")).first()[0] < 2 * 500
    assert again.where("vehicle_id = 0").count() > 5


def test_each_fold_is_planned_once(spark, monkeypatch):
    """The first fold is written; what follows reads it, and folds heads by slice once."""
    kept = []
    monkeypatch.setattr(trips, "keep", lambda df: kept.append(df) or surveys.keep(df))
    built = trips.build_trips(fleet(spark), split_rows=400, number=True, least_split=1)
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert [plan(k).count("MapInArrow") for k in kept].count(1) == 1
    assert plan(built).count("MapInArrow") == 0 and plan(built).count("FlatMapGroupsInArrow") == 1


def test_hot_vehicle_spreads_over_tasks(spark):
    # rows bunched in time: half of them start in a single second
    rows = fleet(spark)
    rows = rows.withColumn("start_ts", F.when(F.col("seg_id") % 2 == 0, F.lit(0)).otherwise(F.col("start_ts")))
    rows = rows.withColumn("end_ts", F.col("start_ts") + 1 + F.col("seg_id") % 50)
    hot = surveys.hot_vehicles(rows, 500, 1)
    chunks = trips._with_chunks(trips._fold_input(rows), hot).where("vehicle_id = 0")
    counts = [r["count"] for r in chunks.groupBy("chunk").count().collect()]
    assert sum(counts) / 500 - 2 < len(counts) <= sum(counts) / 500 + 2 and max(counts) < 2 * 500
    want = content(trips.build_trips(rows, split_rows=None))
    assert content(trips.build_trips(rows, split_rows=500, least_split=1)) == want


def test_survey_in_one_pass(spark):
    """Bounds as by ``geo_bounds``; and input is read twice for trips inside them, not three times."""
    rows = fleet(spark)
    known = surveys.survey(rows, 500, 3.0, 1)
    assert known.hot == surveys.hot_vehicles(rows, 500, 1) and known.hot
    assert tuple(known.box) == pytest.approx(tuple(geo_bounds(geo_stats(rows), 3.0).first()), rel=1e-12)
    want = content(trips.build_trips(outlier_filter(rows, 3.0), split_rows=None))
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    counted = rows.mapInArrow(count, rows.schema)
    built = surveyed_trips(counted, split_rows=500, k=3.0, least_split=1)
    assert content(built) == want
    assert read.value == 2 * rows.count()
    read.value = 0
    assert len(content(surveyed_trips(counted))) > 500
    assert read.value == 2 * rows.count()


def test_survey_of_nothing(spark):
    known = surveys.survey(fleet(spark, 0))
    assert known.hot == [] and tuple(known.box) == (-90.0, 90.0, -180.0, 180.0)


def test_small_slices_are_refused(spark):
    with pytest.raises(ValueError):
        trips.build_trips(fleet(spark, 10), split_rows=1000)


def test_max_trip_length(spark):
    rows = [(1, 0, 300, "MM"), (1, 300, 600, "MM"), (1, 600, 610, "ME"), (2, 0, 300, "MM"), (2, 300, 601, "MM"), (2, 601, 610, "ME")]
    assert list(spans(trips.build_trips(segs(spark, rows), max_trip_length=600))) == [1]
    assert sorted(spans(trips.build_trips(segs(spark, rows), max_trip_length=-1))) == [1, 2]


def test_number_trips_runs_over_days(spark):
    rows = []
    for i in range(5):
        at = i * 50_000
        rows += [(7, at, at + 60, "MM"), (7, at + 60, at + 70, "ME")]
    got = trips.number_trips(trips.build_trips(segs(spark, rows))).orderBy("trip_seq").collect()
    assert [(r.trip_seq, r.segments[0].start_ts) for r in got] == [(i + 1, i * 50_000) for i in range(5)]
