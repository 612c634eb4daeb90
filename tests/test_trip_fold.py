"""The fold kernel against the plain rules, on random vehicles, without Spark."""

import random

import pyarrow as pa
import pytest

from tests.trip_rules import plain_trips
from tripflow.operators import trip_fold as tf
from tripflow.operators import trip_slices as ts

KIND = {"EM": tf.METER_ON, "MM": tf.METERED, "ME": tf.METER_OFF}
SCHEMA = pa.schema(
    [("vehicle_id", pa.int64()), ("chunk", pa.int32()), ("chunk_start", pa.int64()), ("kind", pa.int8()), ("start_ts", pa.int64()),
     ("start_lat", pa.float64()), ("start_lon", pa.float64()), ("end_ts", pa.int64()),
     ("end_lat", pa.float64()), ("end_lon", pa.float64()), ("seg_id", pa.int64())]
)


def batches(rows, size):
    """rows: (vehicle, (chunk, chunk_start) or None, start, end, pair, id); start_lat carries the id."""
    rows = sorted(rows, key=lambda r: (r[0], -1 if r[1] is None else r[1][0], r[2], r[3], r[5]))
    dicts = [
        {"vehicle_id": v, "chunk": c and c[0], "chunk_start": c and c[1], "kind": KIND[p], "start_ts": s, "start_lat": float(i),
         "start_lon": 0.0, "end_ts": e, "end_lat": 0.0, "end_lon": 0.0, "seg_id": i}
        for v, c, s, e, p, i in rows
    ]
    return iter([
        pa.RecordBatch.from_pylist(dicts[k:k + size], schema=SCHEMA) for k in range(0, len(dicts), size)
    ])


def trip_ids(batch):
    trips = zip(batch.column("vehicle_id").to_pylist(), batch.column("segments").to_pylist())
    return [(v, [int(s["start_lat"]) for s in segs]) for v, segs in trips if segs is not None]


def fold_trips(rows, size):
    return [t for b in tf.fold_vehicles(batches(rows, size)) for t in trip_ids(b)]


def starts_of(functions, fan):
    """Starts of all slices of one vehicle, composed ``fan`` at a time."""
    types = {"vehicle_id": pa.int64(), "place": pa.int32(), "function": pa.binary(), "certain": pa.bool_(), "trips": pa.int64()}
    group = lambda rows: pa.table({
        **{c: pa.array([r[c] for r in rows], t) for c, t in types.items()},
        "group_place": pa.array([r["place"] // fan for r in rows], pa.int32()),
    })
    groups = [[f for f in functions if f["place"] // fan == g] for g in sorted({f["place"] // fan for f in functions})]
    if max(f["place"] for f in functions) < fan:
        above = [{"last": None, "open": False, "before": 0, "fate": tf.DROPPED}]
    else:
        above = starts_of([r for g in groups for r in ts.compose_group(group(g)).to_pylist()], fan)
    out = []
    for g, a in zip(groups, above, strict=True):
        t = group(g)
        for c, kind in (("last", pa.int64()), ("open", pa.bool_()), ("before", pa.int64()), ("fate", pa.int32())):
            t = t.append_column(f"group_{c}", pa.array([a[c]] * len(g), kind))
        out += ts.start_group(t).to_pylist()
    return out


def fold_slices(rows, size, fan=3):
    """All trips with their numbers, and how many rows were folded again."""
    out = [r for b in tf.fold_slices(batches(rows, size)) for r in b.to_pylist()]
    trips = [(r["vehicle_id"], r["trip_seq"], r["segments"]) for r in out if r["phase"] == tf.WHOLE_TRIP]
    starts = {}
    for v in {r["vehicle_id"] for r in out if r["phase"] == tf.FUNCTION}:
        functions = [{**r, "place": r["chunk"]} for r in out if r["phase"] == tf.FUNCTION and r["vehicle_id"] == v]
        # places without rows have no function: they are numbered anew
        starts |= {(v, r["place"]): r for r in starts_of(sorted(functions, key=lambda r: r["place"]), fan)}
    trips += [
        (r["vehicle_id"], r["trip_seq"] + starts[r["vehicle_id"], r["chunk"]]["shift"], r["segments"])
        for r in out if r["phase"] == tf.CERTAIN_TRIP
    ]
    again, pieces = [r for r in out if r["phase"] in (tf.HEAD_ROW, tf.TAIL_ROW)], {}
    for key in {(r["vehicle_id"], r["chunk"]) for r in again}:
        own = [{**starts[key], **r, "certain": starts[key]["certain"]} for r in again if (r["vehicle_id"], r["chunk"]) == key]
        names = ["vehicle_id", "chunk", "phase", "kind", *tf.SEGMENT_FIELDS, "seg_id", "last", "open", "before", "behind", "fate", "certain"]
        types = {**tf.SLICE_TYPES, "last": pa.int64(), "open": pa.bool_(), "before": pa.int64(), "behind": pa.int64(), "fate": pa.int32()}
        table = pa.table({c: pa.array([r[c] for r in own], types[c]) for c in names})
        for p in ts.finish_slice(table).to_pylist():
            pieces.setdefault((p["vehicle_id"], p["trip_seq"]), []).append((p["part"], p["segments"]))
    trips += [(v, n, [s for _, part in sorted(p, key=lambda x: x[0]) for s in part]) for (v, n), p in pieces.items()]
    return sorted((v, n, [int(s["start_lat"]) for s in segs]) for v, n, segs in trips), sum(r["phase"] == tf.HEAD_ROW for r in again)


def usable(rows):
    """What reaches the fold: long off-to-on rows are filtered before it."""
    return [r for r in rows if not (r[4] == "EM" and r[3] - r[2] > 600)]


def sliced(rows, size, whole=()):
    """The rows with every vehicle but ``whole`` cut after every ``size`` of its rows."""
    out = []
    for v in sorted({r[0] for r in rows}):
        own = sorted((r for r in rows if r[0] == v), key=lambda r: (r[2], r[3], r[5]))
        for k, r in enumerate(own):
            out.append((v, None if v in whole else (k // size, own[k // size * size][2] if k >= size else None), *r[2:]))
    return out


def random_rows(rng, n, span, weights, dur, vehicles=3):
    return [
        (rng.randrange(vehicles), None, s, s + rng.choice(dur)(rng), rng.choices(["EM", "MM", "ME"], weights)[0], i)
        for i, s in enumerate(rng.randrange(span) for _ in range(n))
    ]


SHAPES = {
    "sparse": (300, 200_000, (2, 6, 2), [lambda r: r.randrange(1, 120), lambda r: r.randrange(1, 900)]),
    "dense": (1500, 40_000, (2, 6, 2), [lambda r: r.randrange(1, 120)]),
    "very dense": (3000, 20_000, (3, 4, 3), [lambda r: r.randrange(1, 400)]),
    "ties": (2000, 30_000, (2, 5, 3), [lambda r: r.choice([1, 1, 60, 600, 601, 3600, 3601])]),
    "long rows": (400, 100_000, (2, 6, 2), [lambda r: r.randrange(1, 5000)]),
    "never off": (800, 60_000, (1, 9, 0), [lambda r: r.randrange(1, 200)]),
    "mostly off": (800, 60_000, (1, 2, 9), [lambda r: r.randrange(1, 200)]),
    "pauses": (400, 200_000, (0, 9, 0), [lambda r: r.choice([20, 30])]),
    "one minute": (900, 60, (1, 6, 2), [lambda r: r.choice([1, 2, 400, 3600])]),
    "round times": (800, 1_000, (2, 5, 3), [lambda r: r.choice([1, 2])]),
}


def make(shape, seed):
    n, span, weights, dur = SHAPES[shape]
    rng = random.Random(f"{shape}{seed}")
    rows = random_rows(rng, n, span, weights, dur)
    if shape == "round times":  # many rows exactly at the 300 s and 3600 s limits
        rows = [(v, c, s * 100, s * 100 + (e - s) * rng.choice([100, 300, 1800, 3700]), p, i) for v, c, s, e, p, i in rows]
    return usable(rows)


def expected(rows):
    out = []
    for v in sorted({r[0] for r in rows}):
        out += [(v, t) for t in plain_trips([(s, e, p, i) for w, _, s, e, p, i in rows if w == v])]
    return out


@pytest.mark.parametrize("shape", SHAPES)
@pytest.mark.parametrize("seed", range(2))
def test_whole_vehicles(shape, seed):
    rows = make(shape, seed)
    want = expected(rows)
    for size in (1, 97, 100_000):
        assert fold_trips(rows, size) == want


def numbered(trips):
    out, n = [], {}
    for v, t in trips:
        n[v] = n.get(v, 0) + 1
        out.append((v, n[v], t))
    return sorted(out)


@pytest.mark.parametrize("shape", SHAPES)
@pytest.mark.parametrize("seed", range(2))
def test_slices_give_the_same_trips(shape, seed):
    rows = make(shape, seed)
    want = numbered(expected(rows))
    for length, size, fan in ((7, 89, 3), (40, 100_000, 4), (300, 500, 1000)):
        got, _ = fold_slices(sliced(rows, length, whole=(1,)), size, fan)
        assert got == want


@pytest.mark.parametrize("shape", ["sparse", "never off", "pauses", "one minute"])
def test_slices_of_one_row(shape):
    rows = make(shape, 9)[:250]
    assert fold_slices(sliced(rows, 1), 1000, 5)[0] == numbered(expected(rows))


def test_composition_is_a_function_of_the_start():
    """Neighbours' composed functions take every start where the two take it one after the other."""
    rows = make("pauses", 1) + [(7, *r[1:]) for r in make("round times", 1)]
    for v in (0, 7):
        cut = sliced([r for r in rows if r[0] == v], 9)
        fs = [ts.table(r["function"]) for b in tf.fold_slices(batches(cut, 50)) for r in b.to_pylist() if r["phase"] == tf.FUNCTION]
        for f, g in zip(fs[1:], fs[2:]):
            both = ts.composed([f, g])
            for last in [tf.NO_TIME, *range(int(cut[0][2]) - 400, int(cut[-1][2]), 137)]:
                mid, a = ts.applied(f, last)
                end, b = ts.applied(g, mid)
                assert ts.applied(both, last) == (end, tf.then(a, b))


def test_slices_settle_and_leave_little_over():
    """A dense vehicle keeps only a few rows at each cut for the second pass."""
    n, span = 60_000, 20 * 14_400
    rng = random.Random(5)
    rows = usable(random_rows(rng, n, span, (2, 6, 2), [lambda r: r.randrange(1, 120)], vehicles=1))
    got, again = fold_slices(sliced(rows, 3000), 1000)
    assert got == numbered(expected(rows))
    assert again < 0.3 * len(rows)


def test_kernel_travels_without_the_package(tmp_path):
    """Workers on other nodes do not have the package."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    from tripflow.operators import trips

    file = tmp_path / "kernel"
    file.write_bytes(cloudpickle.dumps((trips.trip_fold.fold_slices, trips.trip_slices.start_group)))
    code = f"import pickle; a, b = pickle.load(open({str(file)!r}, 'rb')); print(list(a(iter([]))), callable(b))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.stdout.strip() == "[] True", done.stderr
