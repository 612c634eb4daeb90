"""File-to-file jobs and the query catalog."""

import pytest

import __spark_entry__ as entry
from tools.check_oracle import compare, connect
from tripflow.operators.fares import order_fares
from tripflow.operators.metrics import ReferencePoint
from tripflow.plans import catalog, jobs, oracle
from tripflow.sources.event_segments import read_event_segments

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def raw_path(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "lines")
    segments = read_event_segments(spark, SMALL)
    catalog.raw_lines(segments).select("value").write.text(path)
    return path


def read(spark, path):
    return [r.value for r in spark.read.text(path).collect()]


@pytest.fixture(scope="session")
def trip_paths(spark, raw_path, tmp_path_factory):
    out = {}
    for form in ("complete", "summary"):
        for time_format in ("epoch", "iso"):
            path = str(tmp_path_factory.mktemp("trips") / "out")
            jobs.trip_builder(spark, raw_path, path, form, time_format, tz=catalog.HOME_TZ)
            out[form, time_format] = path
    return out


def test_trip_builder_modes(spark, trip_paths):
    counts = {k: len(read(spark, p)) for k, p in trip_paths.items()}
    assert len(set(counts.values())) == 1 and counts["complete", "epoch"] > 50


@pytest.mark.parametrize("straight", [False, True])
@pytest.mark.parametrize("time_format", ["epoch", "iso"])
def test_fares_agree_over_input_modes(spark, trip_paths, tmp_path, straight, time_format):
    results = {}
    for mode, path in trip_paths.items():
        out = str(tmp_path / "-".join(mode))
        jobs.trip_fares(
            spark, path, out, 3.5, 1.71, ReferencePoint(37.62131, -122.37896, 3.0, "far"), straight,
            time_format, catalog.HOME_TZ,
        )
        results[mode] = read(spark, out)
    for form in ("complete", "summary"):
        assert sorted(results[form, "epoch"]) == sorted(results[form, "iso"])
    line = results["complete", "epoch"][0].split(" ")
    assert len(line) == 5 and (("T" in line[0]) == (time_format == "iso"))


def test_fares_are_in_global_order(spark, tmp_path, trip_paths):
    path = trip_paths["complete", "epoch"]
    for n in (None, 4):
        out = str(tmp_path / f"fares{n}")
        jobs.trip_fares(spark, path, out, num_partitions=n)
        import glob

        files = sorted(glob.glob(f"{out}/part-*"))
        starts = [int(line.split(" ")[0]) for f in files for line in open(f)]
        assert len(starts) > 50 and starts == sorted(starts)


def test_order_fares_partitions(spark):
    table = catalog.trip_fares(spark, SMALL)
    parts = order_fares(table, 4).rdd.glom().collect()
    keys = [(r.start_ts, r.end_ts) for part in parts for r in part]
    assert len(parts) == 4 and keys == sorted(keys)


def test_ordinal_is_the_place_in_the_output(spark, monkeypatch):
    """A wrong order gives wrong numbers."""
    from tripflow.operators import fares as fare_operators

    table = catalog.trip_fares(spark, SMALL)
    rows = fare_operators.number_fares(table, 4).collect()
    assert [r.ordinal for r in rows] == list(range(1, len(rows) + 1))
    assert [(r.start_ts, r.end_ts) for r in rows] == sorted((r.start_ts, r.end_ts) for r in rows)
    monkeypatch.setattr(fare_operators, "FARE_ORDER", ["end_ts", "vehicle_id"])
    wrong = {(r.start_ts, r.end_ts, r.vehicle_id, r.distance): r.ordinal for r in fare_operators.number_fares(table).collect()}
    assert any(wrong[r.start_ts, r.end_ts, r.vehicle_id, r.distance] != r.ordinal for r in rows)


def test_trip_table_between_the_jobs(spark, raw_path, trip_paths, tmp_path):
    table = str(tmp_path / "table")
    jobs.trip_builder(spark, raw_path, table, tz=catalog.HOME_TZ, output_kind=jobs.TABLE)
    text, typed = str(tmp_path / "text"), str(tmp_path / "typed")
    jobs.trip_fares(spark, trip_paths["complete", "epoch"], text)
    jobs.trip_fares(spark, table, typed, input_kind=jobs.TABLE)
    assert read(spark, text) == read(spark, typed)
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    jobs.trip_histogram(spark, trip_paths["complete", "epoch"], a, 0.5, 5.0)
    jobs.trip_histogram(spark, table, b, 0.5, 5.0, input_kind=jobs.TABLE)
    assert read(spark, a) == read(spark, b)
    for bad in (lambda: jobs.trip_builder(spark, raw_path, table, tz="UTC", output_kind="x"),
                lambda: jobs.trip_histogram(spark, table, str(tmp_path / "c"), 0.5, 5.0, input_kind="x")):
        with pytest.raises(ValueError):
            bad()


def test_trip_table_schema_and_clusters(spark, tmp_path):
    from pyspark.sql import functions as F

    from tripflow.sources.trip_table import read_trip_table, write_trip_table

    path = str(tmp_path / "t")
    trips = catalog._trips(spark, SMALL)
    write_trip_table(trips, path)
    table = read_trip_table(spark, path)
    assert sorted((r.vehicle_id, r.segments) for r in table.collect()) == sorted((r.vehicle_id, r.segments) for r in trips.collect())
    per_file = table.select(F.input_file_name().alias("f"), "vehicle_id", "start_ts").collect()
    for f in {r.f for r in per_file}:
        own = [(r.vehicle_id, r.start_ts) for r in per_file if r.f == f]
        assert own == sorted(own)
    # a further column is left out; a missing one, or one of another type, is refused
    wide, bad, short = (str(tmp_path / n) for n in ("wide", "bad", "short"))
    table.withColumn("x", F.lit(1)).write.parquet(wide)
    assert read_trip_table(spark, wide).columns == table.columns
    table.withColumn("vehicle_id", F.col("vehicle_id").cast("string")).write.parquet(bad)
    table.drop("segments").write.parquet(short)
    for p, word in ((bad, "vehicle_id: bigint expected, string found"), (short, "segments: .* nothing found")):
        with pytest.raises(ValueError, match=word):
            read_trip_table(spark, p)
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        write_trip_table(trips, path)


def test_histogram_job(spark, trip_paths, tmp_path):
    out = str(tmp_path / "hist")
    jobs.trip_histogram(spark, trip_paths["complete", "epoch"], out, 0.5, 5.0)
    rows = [line.split("\t") for line in read(spark, out)]
    assert [r[0] for r in rows] == [str(i / 2) for i in range(1, 11)] + ["Infinity"]
    assert sum(int(r[1]) for r in rows) > 50


def test_job_arguments(spark, raw_path, tmp_path):
    for a, b in (("", "x"), ("x", ""), ("x", "x")):
        with pytest.raises(ValueError):
            jobs.trip_builder(spark, a, b, tz="UTC")
    with pytest.raises(ValueError):
        jobs.trip_builder(spark, raw_path, str(tmp_path / "o"), tz="UTC", num_partitions=0)
    taken = tmp_path / "taken"
    taken.mkdir()
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        jobs.trip_builder(spark, raw_path, str(taken), tz="UTC")


def test_trip_length_argument():
    assert jobs.parse_trip_length("01:30") == 5400
    assert jobs.parse_trip_length("01:30", compat=True) == 3630
    for bad in ("-1:00", "1:60"):
        with pytest.raises(ValueError):
            jobs.parse_trip_length(bad)


def test_iso_output_in_each_trips_zone(spark, raw_path, tmp_path):
    zones = spark.createDataFrame(
        [(catalog.HOME_TZ, 37.0, 38.0, -123.0, -122.0)],
        "tz string, lat_min double, lat_max double, lon_min double, lon_max double",
    )
    a, b = str(tmp_path / "zones"), str(tmp_path / "tz")
    jobs.trip_builder(spark, raw_path, a, "complete", "iso", zones=zones)
    jobs.trip_builder(spark, raw_path, b, "complete", "iso", tz=catalog.HOME_TZ)
    assert sorted(read(spark, a)) == sorted(read(spark, b))
    c, d = str(tmp_path / "fares-zones"), str(tmp_path / "fares-tz")
    jobs.trip_fares(spark, a, c, time_format="iso", zones=zones)
    jobs.trip_fares(spark, a, d, time_format="iso", tz=catalog.HOME_TZ, num_partitions=3)
    assert len(read(spark, c)) > 50 and sorted(read(spark, c)) == sorted(read(spark, d))


def test_fixture_counts(spark):
    """Known numbers of the derived fleet on the smallest tables."""
    from tripflow.operators.metrics import trip_metrics

    assert read_event_segments(spark, SMALL).count() == 1082
    rows = trip_metrics(catalog._trips(spark, SMALL)).collect()
    assert len(rows) == 137 and sum(len(r.segments) for r in rows) == 339
    reasons = [r.reject_reason for r in rows]
    assert (reasons.count(None), reasons.count("too_fast")) == (112, 25)
    assert catalog.trips_near_point(spark, SMALL).count() == 44
    assert catalog.trips_near_point_compat(spark, SMALL).count() == 82


@pytest.mark.parametrize("split_rows", [1, 3, 20])
def test_event_slices_do_not_change_segments(spark, split_rows):
    from tripflow.sources.event_segments import segments_from_events

    events = spark.read.parquet(f"{SMALL}/events.parquet")
    want = segments_from_events(events)
    assert sorted(segments_from_events(events, split_rows).collect()) == sorted(want.collect())


def test_every_query_has_an_oracle():
    assert catalog.QUERIES.keys() == oracle.ORACLE.keys()
    assert entry.queries().keys() >= entry.oracle_sql().keys()


def test_entry(spark):
    assert entry.entry(spark).count() == 112


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_oracle(spark, name):
    ok, note = compare(spark, connect(SMALL), SMALL, name)
    assert ok, note
