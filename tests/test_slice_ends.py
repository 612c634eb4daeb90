"""Slices are finished many at a call, and their cuts stay in Spark."""

import random

import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest

from tests.test_trips import SCHEMA
from tripflow.operators import survey as surveys
from tripflow.operators import trip_fold as tf
from tripflow.operators import trip_slices as ts
from tripflow.operators import trips


def slices(rnd, n):
    """Sorted rows of ``n`` slices, with arbitrary starts."""
    rows = []
    for k in range(n):
        start = {
            "vehicle_id": k // 4, "chunk": k % 4, "last": rnd.choice([None, 100]), "open": rnd.random() < 0.5, "before": k,
            "behind": k + 9, "fate": rnd.choice([tf.EMITTED, tf.DROPPED]), "certain": rnd.random() < 0.5,
        }
        for phase in sorted(rnd.choice([tf.HEAD_ROW, tf.TAIL_ROW]) for _ in range(rnd.randint(1, 9))):
            begin = (rows[-1]["start_ts"] if rows and rows[-1]["chunk"] == k % 4 and rows[-1]["phase"] == phase else 90) + rnd.choice([5, 40, 400])
            place = {c: float(len(rows)) for c in tf.SEGMENT_FIELDS if not c.endswith("_ts")}
            rows.append({**start, "phase": phase, "kind": rnd.choice([0, 1, 1, 1, 2]), "start_ts": begin, "end_ts": begin + rnd.choice([5, 40, 4000]), "seg_id": len(rows), **place})
    types = {**{c: tf.SLICE_TYPES[c] for c in ("vehicle_id", "chunk", "phase", "kind", *tf.SEGMENT_FIELDS, "seg_id", "certain")},
             "last": pa.int64(), "open": pa.bool_(), "before": pa.int64(), "behind": pa.int64(), "fate": pa.int32()}
    return pa.table({c: pa.array([r[c] for r in rows], t) for c, t in types.items()})


@pytest.mark.parametrize("size", [1, 3, 17, 1000])
@pytest.mark.parametrize("together", [2, 20, 65_536])
def test_many_slices_at_a_call(monkeypatch, size, together):
    monkeypatch.setattr(ts, "TOGETHER", together)
    table = slices(random.Random(size + together), 60)
    keys = sorted(set(zip(table["vehicle_id"].to_pylist(), table["chunk"].to_pylist())))
    want = []
    for v, c in keys:
        own = table.filter(pa.compute.and_(pa.compute.equal(table["vehicle_id"], v), pa.compute.equal(table["chunk"], c)))
        want += ts.finish_slice(own).to_pylist()
    got = [r for b in ts.finish_slices(table.combine_chunks().to_batches(size)) for r in b.to_pylist()]
    assert got == want and len(want) > 20


def test_cuts_do_not_come_to_the_driver(spark, monkeypatch):
    rows = [(i, i % 2, 1000 + 20 * i, 37.0, -122.0, "M", 1010 + 20 * i, 37.1, -122.0, "E" if i % 9 == 0 else "M") for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA)
    whole = trips.build_trips(df, split_rows=None, number=True).collect()
    given = surveys.hot_vehicles(df, 16, 1)
    held = surveys.cut_table(df, 16, 1).orderBy("vehicle_id").collect()
    assert [(r[0], r[1], [[tuple(c) for c in g] for g in r[2]]) for r in held] == [v.grouped() for v in given] and held

    def refused(*_):
        raise AssertionError("cuts in the driver")

    monkeypatch.setattr(surveys, "_cuts", refused)
    monkeypatch.setattr(trips, "_given_cuts", refused)
    cut = trips.build_trips(df, split_rows=16, number=True, least_split=1).collect()
    assert sorted(cut, key=lambda r: (r.vehicle_id, r.trip_seq)) == sorted(whole, key=lambda r: (r.vehicle_id, r.trip_seq)) and cut
