"""What joins the slices of a vehicle: their functions composed, and their open trips put together.

A slice's function (see ``trip_fold``) takes the ``last`` before it to the ``last``
behind it, and tells what it does to the trip that is open before it. Functions
compose, so ``FAN`` neighbours become one function in one task, ``FAN`` of those the
next, and so on up; then each group's start is known from above and gives
its members' starts, down to the slices. No row of a slice takes part in this.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

from tripflow.operators.trip_fold import (
    DROPPED, EMITTED, NO_TIME, NOTHING, SAME, SEGMENT_TYPE, TAIL_ROW, METER_ON, after, then, trip_arrays,
)

#: Functions that one task composes.
FAN = 256

#: A slice's start: ``last``, has the open trip any rows; the vehicle's trips up to its start, up to its
#: certain ones and up to its end; what happens to the trip open at its end; and is its head followed by certain trips.
START_SCHEMA = (
    "vehicle_id bigint, place int, last bigint, open boolean, before bigint, shift bigint, behind bigint, "
    "fate int, certain boolean"
)
FINISHED_SCHEMA = (
    "vehicle_id bigint, trip_seq int, part int, segments array<struct<start_ts:bigint,start_lat:double,start_lon:double,"
    "end_ts:bigint,end_lat:double,end_lon:double>>"
)
FUNCTION_SCHEMA = "vehicle_id bigint, place int, function binary, certain boolean, trips bigint"


def table(function: bytes) -> np.ndarray:
    return np.frombuffer(function, dtype=np.int64).reshape(-1, 6)


def applied(f: np.ndarray, last: int) -> tuple[int, tuple]:
    """The ``last`` behind and the effect, for a ``last`` before."""
    k = 0 if last == NO_TIME else int(np.searchsorted(f[:, 0], last, side="left")) - 1
    row = f[k].tolist()
    return (last if row[1] == SAME else row[1]), (row[2], bool(row[3]), bool(row[4]), row[5])


def composed(functions: Iterable[np.ndarray]) -> np.ndarray:
    """One function for consecutive slices."""
    total = None
    for g in functions:
        if total is None:
            total = g
            continue
        rows = []
        for limit, last, *effect in total.tolist():
            if last == SAME:
                # g's own classes of the values from here on
                inside = [limit, *(v for v in g[1:, 0].tolist() if v > limit)]
                rows += [(v, *_row(g, v + 1, effect, same=True)) for v in inside]
            else:
                rows.append((limit, *_row(g, last, effect)))
        rows = [r for k, r in enumerate(rows) if k < 2 or r[1:] != rows[k - 1][1:]]
        total = np.array(rows, dtype=np.int64).reshape(-1, 6)
    return total


def _row(g: np.ndarray, last: int, effect: list[int], same: bool = False) -> tuple:
    k = 0 if last == NO_TIME else int(np.searchsorted(g[:, 0], last, side="left")) - 1
    behind = int(g[k, 1])
    if behind == SAME and not same:
        behind = last
    return (behind, *map(int, then(tuple(effect), tuple(g[k, 2:].tolist()))))


def compose_group(group: pa.Table) -> pa.Table:
    """Functions of neighbouring places -> one function; places are those of the groups."""
    rows = group.sort_by("place")
    f = composed(table(x) for x in rows["function"].to_pylist())
    columns = {
        "vehicle_id": rows["vehicle_id"][:1], "place": rows["group_place"][:1],
        "function": pa.array([f.tobytes()], pa.binary()), "certain": pa.nulls(1, pa.bool_()), "trips": pa.nulls(1, pa.int64()),
    }
    return pa.table(columns)


def start_group(group: pa.Table) -> pa.Table:
    """Functions of neighbouring places, with their group's start and fate -> the start and fate of each."""
    rows = group.sort_by("place").to_pylist()
    last, open_, before = (rows[0][f"group_{c}"] for c in ("last", "open", "before"))
    last = NO_TIME if last is None else last
    out, firsts = [], []
    for r in rows:
        end, (first, appended, later, count) = applied(table(r["function"]), last)
        behind = before + count + (first == EMITTED and (open_ or appended))
        out.append({
            "vehicle_id": r["vehicle_id"], "place": r["place"], "last": None if last == NO_TIME else last, "open": open_,
            "before": before, "shift": behind - (r["trips"] or 0), "behind": behind, "certain": r["certain"],
        })
        firsts.append(first)
        open_ = later if first != NOTHING else open_ or appended
        last, before = end, behind
    fate = rows[0]["group_fate"]
    for r, first in zip(reversed(out), reversed(firsts)):
        r["fate"] = fate
        fate = first if first != NOTHING else fate
    types = {
        "vehicle_id": pa.int64(), "place": pa.int32(), "last": pa.int64(), "open": pa.bool_(), "before": pa.int64(),
        "shift": pa.int64(), "behind": pa.int64(), "fate": pa.int32(), "certain": pa.bool_(),
    }
    return pa.table({c: pa.array([r[c] for r in out], t) for c, t in types.items()})


#: Rows of slices that are finished together, at most, unless a slice has more.
TOGETHER = 65_536


def whole_slices(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[int]]]:
    """Batches sorted by (vehicle_id, chunk) -> rows of whole slices, and where each begins, with the end."""
    parts: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        parts.append(batch)
        both = [parts[0].slice(0, 1), batch] if len(parts) > 1 else [batch]
        key = [np.concatenate([b.column(c).to_numpy() for b in both]) for c in ("vehicle_id", "chunk")]
        new = np.flatnonzero((key[0][1:] != key[0][:-1]) | (key[1][1:] != key[1][:-1])) + 2 - len(both)
        if len(new):  # the last slice may go on
            end = int(new[-1])
            parts[-1] = batch.slice(0, end)
            yield from _some_slices(pa.concat_batches(parts))
            parts = [batch.slice(end)]
    if parts:
        yield from _some_slices(pa.concat_batches(parts))


def _some_slices(rows: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[int]]]:
    vehicle, chunk = (rows.column(c).to_numpy() for c in ("vehicle_id", "chunk"))
    new = np.flatnonzero((vehicle[1:] != vehicle[:-1]) | (chunk[1:] != chunk[:-1])) + 1
    low, cuts = 0, [0]
    for end in [*new.tolist(), rows.num_rows]:
        if end - low > TOGETHER and cuts[-1] > 0:
            yield rows.slice(low, cuts[-1]), cuts
            low, cuts = low + cuts[-1], [0]
        cuts.append(end - low)
    if rows.num_rows:
        yield rows.slice(low), cuts


def finish_slice(group: pa.Table) -> pa.Table:
    """``finish_slices`` for the rows of some slices of a vehicle, in any order."""
    order = [(c, "ascending") for c in ("chunk", "phase", "start_ts", "end_ts", "seg_id")]
    rows = group.select([c for c in group.column_names if c != "some"]).sort_by(order).combine_chunks()
    return pa.Table.from_batches(finish_slices(rows.to_batches()), FINISHED)


FINISHED = pa.schema({"vehicle_id": pa.int64(), "trip_seq": pa.int32(), "part": pa.int32(), "segments": pa.list_(SEGMENT_TYPE)})
START_COLUMNS = ["vehicle_id", "chunk", "last", "open", "before", "behind", "fate", "certain"]


def finish_slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Head and tail rows of slices, each with its slice's start -> the slices' first trips, and their pieces of
    trips of several slices.

    Rows are sorted by vehicle, chunk, phase and as in the fold. Every piece has its
    trip's number, which is the next one that the vehicle ends; pieces of trips that never
    end are left out.
    """
    for rows, cuts in whole_slices(batches):
        first = rows.select(START_COLUMNS).take(pa.array(cuts[:-1], pa.int64())).to_pylist()
        phase, heads = rows.column("phase").to_numpy(), []
        for low, high in zip(cuts, cuts[1:]):
            heads.append(low + int(np.count_nonzero(phase[low:high] != TAIL_ROW)))
        events = _events(rows, cuts, heads)
        vehicles, numbers, parts, places = [], [], [], []
        for start, low, end, high, own in zip(first, cuts, heads, cuts[1:], events):
            for number, place in _pieces(start, own, end, high):
                vehicles.append(start["vehicle_id"])
                numbers.append(number)
                parts.append(start["chunk"])
                places.append(place)
        if places:
            yield pa.RecordBatch.from_pydict({
                "vehicle_id": pa.array(vehicles, pa.int64()), "trip_seq": pa.array(numbers, pa.int32()),
                "part": pa.array(parts, pa.int32()), "segments": trip_arrays(rows, places),
            })


def _events(rows: pa.RecordBatch, cuts: list[int], heads: list[int]) -> Iterator[Iterable[tuple]]:
    """The head rows (place, kind, start, end) of each slice; a long slice's are read some at a time."""
    names = ("kind", "start_ts", "end_ts")

    def some(low: int, high: int) -> Iterator[tuple]:
        for a in range(low, high, TOGETHER):
            part = rows.slice(a, min(TOGETHER, high - a))
            yield from zip(range(a, high), *(part.column(c).to_pylist() for c in names))

    if rows.num_rows > TOGETHER:
        yield from (some(low, end) for low, end in zip(cuts, heads))
        return
    held = [rows.column(c).to_pylist() for c in names]
    for low, end in zip(cuts, heads):
        yield zip(range(low, end), *(c[low:end] for c in held))


def _pieces(start: dict, events: Iterable[tuple], heads: int, rows: int) -> list[tuple[int, list[int]]]:
    """(trip number, places of rows) of one slice's pieces; its tail rows are the places from ``heads`` to ``rows``."""
    last, first, lead, trip = start["last"], NOTHING, [], []
    trips: list[list[int]] = []
    for i, kind, begin, end in events:
        if last is not None and (begin < last or kind == METER_ON):
            continue
        if kind == METER_ON:
            last, ends, part_of, how = end, True, False, DROPPED
        else:
            last, ends, part_of = after(kind, last, begin, end)
            how = EMITTED
        if ends:
            if first == NOTHING:
                first, lead, trip = how, trip, []
            elif trip and how == EMITTED:
                trips.append(trip)
            trip = []
        if part_of:
            trip.append(i)
    pieces, number = [], start["before"] + 1
    if first == NOTHING and not start["certain"]:
        if trip and start["fate"] == EMITTED:
            pieces.append((number, trip))
    else:
        if first == EMITTED and (start["open"] or lead):
            pieces.append((number, lead))
            number += 1
        pieces.extend(enumerate(trips, number))
        if start["certain"]:
            trip = list(range(heads, rows))
        if trip and start["fate"] == EMITTED:
            pieces.append((start["behind"] + 1, trip))
    return pieces
