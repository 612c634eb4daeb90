"""Trip builder: each vehicle's time-ordered segments -> trips."""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripflow.functions.shared import keep
from tripflow.operators import trip_fold, trip_slices
from tripflow.operators.survey import CUT, LEAST_SPLIT, SPLIT_ROWS, VehicleCuts, cut_table, entering_rows

# The only modules that run inside Python workers. They travel with the task, so
# the package need not be installed on every node.
cloudpickle.register_pickle_by_value(trip_fold)
cloudpickle.register_pickle_by_value(trip_slices)

SEGMENT_STRUCT = (
    "struct<start_ts:bigint,start_lat:double,start_lon:double,"
    "end_ts:bigint,end_lat:double,end_lon:double>"
)
TRIP_SCHEMA = f"vehicle_id bigint, segments array<{SEGMENT_STRUCT}>"
FOLDED_SCHEMA = f"vehicle_id bigint, trip_seq int, segments array<{SEGMENT_STRUCT}>"
SLICE_SCHEMA = (
    "vehicle_id bigint, chunk int, phase tinyint, kind tinyint, start_ts bigint, start_lat double, start_lon double, "
    "end_ts bigint, end_lat double, end_lon double, seg_id bigint, "
    f"trip_seq int, segments array<{SEGMENT_STRUCT}>, function binary, certain boolean, trips bigint"
)
FOLD_ORDER = ["vehicle_id", "chunk", "start_ts", "end_ts", "seg_id"]

DAY = 86_400


def first_segment() -> Column:
    return F.element_at("segments", 1)


def last_segment() -> Column:
    return F.element_at("segments", -1)


def build_trips(
    segments: DataFrame,
    max_trip_length: int | None = None,
    num_partitions: int | None = None,
    split_rows: int | None = SPLIT_ROWS,
    hot: list[VehicleCuts] | None = None,
    number: bool = False,
    least_split: int = LEAST_SPLIT,
) -> DataFrame:
    """Clean segments -> ``trips(vehicle_id, segments)``, one row per trip.

    A vehicle's rows meet in one task, sorted by start time, and are folded as
    a stream that keeps no more than the open trip. Accepted segments of a trip
    do not overlap, so a trip has at most about one segment per second.

    A vehicle with more than ``split_rows`` rows is cut into slices of about that
    many, anywhere in its order of start, end and id. They are folded in parallel,
    in one stream with the vehicles that are not cut, and give functions of
    their start; once these are composed (``trip_slices``), each slice's head is
    folded from its real start, again in parallel. No task reads the rows of more than
    one slice, whether or not the meter ever goes off. Which vehicles are cut, and
    where, never changes the result. The vehicles are counted first, in a pass
    over the rows, unless ``hot`` has them (from ``survey``) or ``split_rows`` is
    None. With a hot vehicle the first fold's result is written to the shared folder.

    ``num_partitions`` fixes the number of shuffle partitions; left out, AQE
    sizes them. Trips longer than ``max_trip_length`` seconds are dropped when
    it is positive. ``number=True`` adds ``trip_seq``, counted before that. A
    ``split_rows`` below ``least_split`` is refused: every slice has its own start to be found.
    """
    cuts = None
    if hot:
        cuts = _given_cuts(segments.sparkSession, hot)
    elif hot is None and split_rows is not None:
        cuts = cut_table(segments, split_rows, least_split)
        cuts = None if cuts.isEmpty() else cuts
    rows = _fold_input(segments)
    if cuts is not None:
        trips = _join_slices(keep(_fold_slices(_cut_at(rows, cuts), num_partitions)), max(1, trip_slices.TOGETHER // split_rows) if split_rows else 1)
    else:
        whole = rows.withColumns({"chunk": F.lit(None).cast("int"), "chunk_start": F.lit(None).cast("bigint")})
        trips = _sorted_runs(whole, num_partitions).mapInArrow(trip_fold.fold_vehicles, FOLDED_SCHEMA)
    if not number:
        trips = trips.drop("trip_seq")
    if max_trip_length is not None and max_trip_length > 0:
        trips = limit_trip_length(trips, max_trip_length)
    return trips


def limit_trip_length(trips: DataFrame, seconds: int) -> DataFrame:
    """Keep trips that last at most ``seconds`` from first start to last end."""
    return trips.where(last_segment()["end_ts"] - first_segment()["start_ts"] <= seconds)


def _fold_input(segments: DataFrame) -> DataFrame:
    """The columns the fold reads, without rows that cannot change anything.

    Positions matter only for metered segments; blank ones compress away in the shuffle.
    """
    metered = F.col("kind") == trip_fold.METERED
    position = lambda c: F.when(metered, F.col(c)).alias(c)
    return entering_rows(segments).select(
        "vehicle_id", "kind", "start_ts", position("start_lat"), position("start_lon"),
        "end_ts", position("end_lat"), position("end_lon"), "seg_id",
    )


def _given_cuts(spark: SparkSession, hot: list[VehicleCuts]) -> DataFrame:
    return spark.createDataFrame([v.grouped() for v in hot], f"vehicle_id bigint, _size int, _groups array<array<{CUT}>>")


def _with_chunks(rows: DataFrame, hot: list[VehicleCuts]) -> DataFrame:
    return _cut_at(rows, _given_cuts(rows.sparkSession, hot))


def _cut_at(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """Add ``chunk``, the number of cuts up to the row, and ``chunk_start``; NULL for vehicles that are not cut.

    The cuts of a vehicle lie in groups of about the root of their number, so that a
    row is compared with one cut of each group, and with those of one group.
    """
    here = F.struct("start_ts", "end_ts", "seg_id")
    groups = F.size(F.filter("_groups", lambda g: F.get(g, 0) <= here))
    marked = rows.join(cuts, "vehicle_id", "left").withColumn("_group", groups - 1)
    marked = marked.withColumn("_own", F.filter(F.get("_groups", "_group"), lambda c: c <= here))
    own = F.col("_own")
    return marked.select(
        *rows.columns,
        F.when(
            F.col("_groups").isNotNull(), F.coalesce(F.col("_group") * F.col("_size") + F.size(own), F.lit(0))
        ).cast("int").alias("chunk"),
        F.try_element_at(own, F.lit(-1))["start_ts"].alias("chunk_start"),
    )


def _sorted_runs(rows: DataFrame, num_partitions: int | None) -> DataFrame:
    rows, keys = rows.select(*trip_fold.ROW_COLUMNS), ["vehicle_id", "chunk"]
    parts = rows.repartition(num_partitions, *keys) if num_partitions else rows.repartition(*keys)
    return parts.sortWithinPartitions(*FOLD_ORDER)


def _fold_slices(rows: DataFrame, num_partitions: int | None) -> DataFrame:
    return _sorted_runs(rows, num_partitions).mapInArrow(trip_fold.fold_slices, SLICE_SCHEMA)


def _join_slices(folded: DataFrame, per_call: int = 1) -> DataFrame:
    """Output of ``_fold_slices``, in files -> all trips, numbered.

    Certain trips are only numbered, by their slice's start. There is one start
    for each slice, about rows / ``split_rows``; Spark chooses the join by their size.
    """
    functions = folded.where(F.col("phase") == trip_fold.FUNCTION).select(
        "vehicle_id", F.col("chunk").alias("place"), "function", "certain", "trips"
    )
    starts = keep(_starts(functions)).withColumnRenamed("place", "chunk")
    done = ["vehicle_id", "trip_seq", "segments"]
    whole = folded.where(F.col("phase") == trip_fold.WHOLE_TRIP).select(*done)
    certain = (
        folded.where(F.col("phase") == trip_fold.CERTAIN_TRIP).select(*done, "chunk")
        .join(starts.select("vehicle_id", "chunk", "shift"), ["vehicle_id", "chunk"])
        .withColumn("trip_seq", (F.col("trip_seq") + F.col("shift")).cast("int")).select(*done)
    )
    raw = folded.where(F.col("phase").isin(trip_fold.HEAD_ROW, trip_fold.TAIL_ROW)).select(
        "vehicle_id", "chunk", "phase", "kind", *trip_fold.SEGMENT_FIELDS, "seg_id"
    )
    # one call for neighbouring small slices: a call for each would cost more than the work in it
    some = F.floor(F.col("chunk") / per_call).alias("some")
    pieces = raw.join(starts, ["vehicle_id", "chunk"]).groupBy("vehicle_id", some).applyInArrow(trip_slices.finish_slice, trip_slices.FINISHED_SCHEMA)
    ordered = F.sort_array(F.collect_list(F.struct("part", "segments")))
    joined = pieces.groupBy("vehicle_id", "trip_seq").agg(
        F.flatten(F.transform(ordered, lambda p: p["segments"])).cast(f"array<{SEGMENT_STRUCT}>").alias("segments")
    )
    return whole.unionByName(certain).unionByName(joined)


def _starts(functions: DataFrame) -> DataFrame:
    """The start of every place of every vehicle, by groups of ``FAN`` places, groups of groups and so on.

    A function of one vehicle's start to end takes it from the empty state; what is
    open at its end is dropped.
    """
    top = functions.agg(F.max("place")).first()[0] or 0
    group = F.floor(F.col("place") / trip_slices.FAN).cast("int")
    marked = functions.withColumn("group_place", group)
    if top < trip_slices.FAN:
        given = {"last": F.lit(None).cast("bigint"), "open": F.lit(False), "before": F.lit(0).cast("bigint"), "fate": F.lit(trip_fold.DROPPED)}
        started = marked.withColumns({f"group_{c}": v for c, v in given.items()})
    else:
        groups = keep(marked.groupBy("vehicle_id", "group_place").applyInArrow(trip_slices.compose_group, trip_slices.FUNCTION_SCHEMA))
        above = _starts(groups).select(
            "vehicle_id", F.col("place").alias("group_place"), *[F.col(c).alias(f"group_{c}") for c in ("last", "open", "before", "fate")]
        )
        started = marked.join(above, ["vehicle_id", "group_place"])
    return started.groupBy("vehicle_id", "group_place").applyInArrow(trip_slices.start_group, trip_slices.START_SCHEMA)


def number_trips(trips: DataFrame) -> DataFrame:
    """Add ``trip_seq``, 1, 2, ... per vehicle in time order.

    Numbered within (vehicle, day) and shifted by the vehicle's trips on
    earlier days, so no vehicle's trips have to pass through one task: the
    running sum sees one row per vehicle and day.
    """
    keys = ["vehicle_id", "_day"]
    dated = trips.withColumn("_day", F.floor(first_segment()["start_ts"] / DAY))
    in_day = Window.partitionBy(*keys).orderBy(
        first_segment()["start_ts"], first_segment()["end_ts"], F.col("segments")
    )
    earlier = Window.partitionBy("vehicle_id").orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        dated.groupBy(*keys)
        .agg(F.count("*").alias("_n"))
        .select(*keys, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    return (
        dated.withColumn("_seq", F.row_number().over(in_day))
        .join(before, keys)
        .withColumn("trip_seq", (F.col("_before") + F.col("_seq")).cast("int"))
        .select("vehicle_id", "trip_seq", *[c for c in trips.columns if c != "vehicle_id"])
    )


def trip_segments(trips: DataFrame) -> DataFrame:
    """One row per trip segment, ``pos`` counting from 0; other columns kept."""
    others = [c for c in trips.columns if c != "segments"]
    return trips.select(*others, F.posexplode("segments").alias("pos", "seg")).select(
        *others, "pos", "seg.*"
    )


def trip_counts(trips: DataFrame) -> DataFrame:
    """Trips per vehicle."""
    return trips.groupBy("vehicle_id").agg(F.count("*").alias("trips"))
