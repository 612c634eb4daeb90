"""Per-task kernel of the trip builder, run by ``mapInArrow``.

Input batches hold rows sorted by (vehicle_id, chunk, start_ts, end_ts, seg_id). A
*run* is one (vehicle_id, chunk); it may span batches. Two things describe a
vehicle at any moment:

``last``  end time of the segment that opened or extended the current trip, or
          None when the next segment is to be taken as it comes;
``trip``  the metered segments collected so far.

A run with a NULL ``chunk`` is a vehicle's whole history and starts from (None, []).
Any other run is a slice out of the middle of a history, whose starting state is not
known. What happens to a row depends on ``last`` alone, so a slice is a function from
the ``last`` at its start to the ``last`` at its end and to what it does to the
trip that is open at its start; ``trip_slices`` composes these functions. The
kernel follows all values of ``last`` at once until one is left. From the next segment
that ends or drops the open trip, everything is certain: trips
are given out, and at the end the open trip's rows. Only the rows before that point,
the *head*, are folded once more, slice by slice, when the slice's start is known.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Row kinds: the meter goes on, stays on, goes off.
METER_ON, METERED, METER_OFF = 0, 1, 2

# Fixed values, seconds.
MAX_METER_ON = 600  # a longer off-to-on segment says nothing (filtered upstream)
SPLIT_GAP = 300  # a pause this long between metered segments starts a new trip
MAX_METERED = 3600  # a longer metered segment ends the trip

SEGMENT_FIELDS = ["start_ts", "start_lat", "start_lon", "end_ts", "end_lat", "end_lon"]
TRIP_COLUMNS = ["vehicle_id", "trip_seq", "segments"]
ROW_COLUMNS = ["vehicle_id", "chunk", "chunk_start", "kind", *SEGMENT_FIELDS, "seg_id"]

# What a row of the slices' fold is.
WHOLE_TRIP, CERTAIN_TRIP, HEAD_ROW, TAIL_ROW, FUNCTION = 0, 1, 2, 3, 4

# What happens first to the trip that is open when a stretch of rows begins.
NOTHING, EMITTED, DROPPED = 0, 1, 2
# ``last`` None in a function's table, and below every time.
NO_TIME, LOWEST = -(1 << 63), -(1 << 62)
# ``last`` stays what it is, in a function's table.
SAME = NO_TIME + 1


def after(kind: int, last: int | None, start: int, end: int) -> tuple[int | None, bool, bool]:
    """A segment that is taken: the new ``last``; does it end the trip; is it part of the open trip then?"""
    if kind == METERED:
        if last is not None and start - last >= SPLIT_GAP:
            return None, True, True
        if end - start <= MAX_METERED:
            return end, False, True
    return None, True, False


class Stretch:
    """What a stretch of rows does to the trips: one way through a slice, or a part of several ways.

    ``first`` is what happens first to the trip open at its start, and ``appended``
    whether rows were added to that trip before; ``open`` and ``count`` tell of what
    comes later: has the trip open at its end any rows, and how many trips ended.
    """

    __slots__ = ("first", "appended", "open", "count", "next")

    def __init__(self):
        self.first, self.appended, self.open, self.count, self.next = NOTHING, False, False, 0, None

    def append(self) -> None:
        if self.first == NOTHING:
            self.appended = True
        else:
            self.open = True

    def end(self, how: int) -> None:
        if self.first == NOTHING:
            self.first = how
        elif how == EMITTED and self.open:
            self.count += 1
        self.open = False

    def effect(self) -> tuple[int, bool, bool, int]:
        return self.first, self.appended, self.open, self.count


def then(a: tuple, b: tuple) -> tuple[int, bool, bool, int]:
    """The effect of one stretch and of the one behind it."""
    if a[0] == NOTHING:
        return (b[0], a[1] or b[1], b[2], b[3])
    if b[0] == NOTHING:
        return (a[0], a[1], a[2] or b[1], a[3])
    return (a[0], a[1], b[2], a[3] + b[3] + (b[0] == EMITTED and (a[2] or b[1])))


class StartStates:
    """All values ``last`` may have in a slice that starts at ``chunk_start``.

    Before the slice every segment starts at ``chunk_start`` at the latest and those
    that set ``last`` run for at most MAX_METERED, so ``last`` is None or some second
    up to ``chunk_start + MAX_METERED``. The seconds that no row has reached stay
    an interval ``(low, high]``. The others are in ``paths``, from the value of
    ``last`` to the stretch that leads there; ``classes`` are the ways in: the
    values above a limit, up to the next limit, begin with a stretch.
    """

    def __init__(self, chunk_start: int):
        self.low, self.high = LOWEST, chunk_start + MAX_METERED
        start = Stretch()
        self.paths: dict[int | None, Stretch] = {None: start}
        self.classes: list[tuple[int, Stretch]] = [(NO_TIME, start)]

    def one(self) -> bool:
        return self.low >= self.high and len(self.paths) == 1

    def step(self, kind: int, start: int, end: int) -> bool:
        """Apply one row; returns whether it had an effect."""
        if kind == METER_ON:
            if None not in self.paths:
                return False
            stretch = self.paths.pop(None)
            stretch.end(DROPPED)
            self._arrive(end, [stretch])
            return True
        taken = [(v, self.paths.pop(v)) for v in [v for v in self.paths if v is None or v <= start]]
        reach = min(start, self.high)
        for low, high in ((self.low, min(reach, start - SPLIT_GAP)), (max(self.low, start - SPLIT_GAP), reach)):
            if low < high:
                taken.append((high, Stretch()))
                self.classes.append((low, taken[-1][1]))
        self.low = max(self.low, reach)
        to: dict[int | None, list[Stretch]] = {}
        for last, stretch in taken:
            new, ends, part = after(kind, last, start, end)
            if ends:
                stretch.end(EMITTED)
            if part:
                stretch.append()
            to.setdefault(new, []).append(stretch)
        for new, stretches in to.items():
            self._arrive(new, stretches)
        return bool(taken)

    def _arrive(self, last: int | None, stretches: list[Stretch]) -> None:
        if last in self.paths:
            stretches = [*stretches, self.paths[last]]
        to = stretches[0]
        if len(stretches) > 1:
            to = Stretch()
            for s in stretches:
                s.next = to
        self.paths[last] = to

    def table(self, paths: dict[int | None, Stretch]) -> np.ndarray:
        """The slice as a function: rows (limit, last at the end, *effect), by limit.

        ``paths`` are the stretches that the slice's end has reached.
        """
        known = {id(s): (NO_TIME if last is None else last, s.effect()) for last, s in paths.items()}
        rows = []
        for limit, stretch in self.classes:
            way = []
            while id(stretch) not in known:
                way.append(stretch)
                stretch = stretch.next
            for s in reversed(way):
                last, effect = known[id(s.next)]
                known[id(s)] = (last, then(s.effect(), effect))
                stretch = s
            last, effect = known[id(stretch)]
            rows.append((limit, last, *map(int, effect)))
        if self.low < self.high:  # values that no row has reached
            rows.append((self.low, SAME, NOTHING, 0, 0, 0))
        rows.sort()
        out = [r for k, r in enumerate(rows) if k < 2 or r[1:] != rows[k - 1][1:]]
        return np.array(out, dtype=np.int64).reshape(-1, 6)


class Run:
    """State of one vehicle, or of one slice of it, while its rows stream by."""

    def __init__(self, chunk: int | None, chunk_start: int):
        self.chunk = chunk
        self.last: int | None = None
        self.trip: list[int] = []
        self.count = 0  # trips that are certain so far
        # of a slice but the first: all states, until one is left and its open trip has ended
        self.states = StartStates(chunk_start) if chunk else None
        self.stretch: Stretch | None = None
        self.certain = not chunk

    def feed(self, kinds, starts, ends, lo, hi, base, trips, heads):
        """Process rows lo..hi of the batch; row i is kept as number base + i."""
        i = lo
        if not self.certain:
            i = self._feed_head(kinds, starts, ends, lo, hi, base, heads)
        last, trip = self.last, self.trip
        before = len(trips)
        while i < hi:
            start = starts[i]
            if last is not None and start < last:
                # Overlaps what the trip already covers; so does every row up
                # to the first that starts at `last` or later.
                i = bisect_left(starts, last, i + 1, hi)
                continue
            kind = kinds[i]
            if kind == METER_ON:
                if last is None:
                    trip, last = [], ends[i]
            elif kind == METERED and last is not None and start - last >= SPLIT_GAP:
                if trip:
                    trips.append(trip)
                trip, last = [base + i], None
            elif kind == METERED and ends[i] - start <= MAX_METERED:
                trip.append(base + i)
                last = ends[i]
            else:
                if trip:
                    trips.append(trip)
                trip, last = [], None
            i += 1
        self.last, self.trip = last, trip
        self.count += len(trips) - before

    def _feed_head(self, kinds, starts, ends, lo, hi, base, heads) -> int:
        """The rows of a slice up to the one that makes all certain; returns the next."""
        i = lo
        while i < hi and self.stretch is None:
            if self.states.step(kinds[i], starts[i], ends[i]):
                heads.append(base + i)
            if self.states.one():
                (self.last, self.stretch), = self.states.paths.items()
            i += 1
        while i < hi:
            kind, start, end, last = kinds[i], starts[i], ends[i], self.last
            i += 1
            if last is not None and (start < last or kind == METER_ON):
                continue
            heads.append(base + i - 1)
            if kind == METER_ON:
                self.last, ends_trip, part = end, True, False
                self.stretch.end(DROPPED)
            else:
                self.last, ends_trip, part = after(kind, last, start, end)
                if ends_trip:
                    self.stretch.end(EMITTED)
                if part:
                    self.stretch.append()
            if ends_trip:
                self.certain, self.trip = True, [base + i - 1] if part else []
                return i
        return i

    def function(self) -> np.ndarray:
        """A slice's function, at its end."""
        if not self.chunk:  # the first slice starts from (None, []), like a whole vehicle
            last = NO_TIME if self.last is None else self.last
            return np.array([[NO_TIME, last, DROPPED, 0, int(bool(self.trip)), self.count]], dtype=np.int64)
        if self.stretch is None:
            return self.states.table(self.states.paths)
        if self.certain:
            self.stretch.open = bool(self.trip)
            self.stretch.count += self.count
        return self.states.table({self.last: self.stretch})


class Folded:
    """What a batch finishes: trips, with their numbers from 1 in the run, head and tail rows, all as places in ``rows``, and functions."""

    def __init__(self):
        self.rows: pa.RecordBatch | None = None
        self.trips: list[list[int]] = []
        self.numbers: list[int] = []
        self.heads: list[int] = []
        self.tails: list[int] = []
        self.functions: list[tuple] = []


class Folder:
    """Folds consecutive batches; rows of the unfinished run wait in ``parts``.

    Rows are numbered through all batches. A part holds the rows of one batch
    that were open when it ended, and their numbers. It is dropped as a whole once
    all of them are too old, and put together with others only when a trip ends,
    so the work is in proportion to the rows however long a trip stays open.
    """

    def __init__(self):
        self.parts: list[tuple[np.ndarray, pa.RecordBatch]] = []
        self.next = 0
        self.run: Run | None = None
        self.key: tuple | None = None

    def push(self, batch: pa.RecordBatch) -> Folded:
        """Folds one more batch; gives what is finished."""
        out = Folded()
        trips: list[list[int]] = []
        base = self.next
        self.next += batch.num_rows
        kinds, starts, ends = (
            batch.column(c).to_numpy().tolist() for c in ("kind", "start_ts", "end_ts")
        )
        for lo, hi in _run_bounds(batch):
            key = (batch.column("vehicle_id")[lo].as_py(), batch.column("chunk")[lo].as_py())
            if key != self.key:
                self._finish(out)
                self.run, self.key = Run(key[1], batch.column("chunk_start")[lo].as_py()), key
            before = self.run.count
            self.run.feed(kinds, starts, ends, lo, hi, base, trips, out.heads)
            out.numbers.extend(range(before + 1, self.run.count + 1))
        self.parts.append((np.arange(base, self.next), batch))
        wanted = [i for trip in trips for i in trip]
        out.rows, place = self._rows(wanted + out.heads + out.tails)
        cuts = np.cumsum([0, *(len(trip) for trip in trips)]).tolist()
        out.trips = [place[a:b] for a, b in zip(cuts, cuts[1:])]
        out.heads, out.tails = place[cuts[-1] : cuts[-1] + len(out.heads)], place[cuts[-1] + len(out.heads) :]
        self._hold(base, batch)
        return out

    def close(self) -> Folded:
        """End of input: what the last run leaves."""
        out = Folded()
        self._finish(out)
        out.rows, out.tails = self._rows(out.tails)
        return out

    def _finish(self, out: Folded) -> None:
        """The run is over: a whole history drops its open trip, a slice gives it out, and its function."""
        if self.run is not None and self.run.chunk is not None:
            if self.run.certain:
                out.tails.extend(self.run.trip)
            out.functions.append((*self.key, self.run.function().tobytes(), self.run.certain, self.run.count))

    def _rows(self, wanted: list[int]) -> tuple[pa.RecordBatch | None, list[int]]:
        """Rows that contain the numbered ones, and where these are."""
        if not wanted:
            return None, []
        low = min(wanted)
        parts = [part for part in self.parts if part[0][-1] >= low]
        place = np.searchsorted(np.concatenate([ids for ids, _ in parts]), wanted)
        return pa.concat_batches([rows for _, rows in parts]), place.tolist()

    def _hold(self, base: int, batch: pa.RecordBatch) -> None:
        """Keep what is open of the batch, numbered from ``base``, and the parts still needed."""
        self.parts.pop()
        open_ = self.run.trip  # ascends
        oldest = open_[0] if open_ else self.next
        self.parts = [part for part in self.parts if part[0][-1] >= oldest]
        own = np.array(open_[bisect_left(open_, base) :], dtype=np.int64)
        if len(own):
            self.parts.append((own, batch.take(pa.array(own - base, pa.int64()))))


Batches = Iterator[pa.RecordBatch]


def fold_vehicles(batches: Batches) -> Batches:
    """Rows of whole vehicles -> trips."""
    folder = Folder()
    for batch in batches:
        if batch.num_rows:
            out = folder.push(batch)
            if out.trips:
                yield _trip_batch(out).select(TRIP_COLUMNS)


def fold_slices(batches: Batches) -> Batches:
    """Rows of slices and of whole vehicles -> trips, and of slices head and tail rows and their functions."""
    folder = Folder()
    for batch in batches:
        if batch.num_rows:
            yield from _slice_batches(folder.push(batch))
    yield from _slice_batches(folder.close())


def _slice_batches(out: Folded) -> Batches:
    if out.trips:
        yield _trip_batch(out)
    for phase, rows in ((HEAD_ROW, out.heads), (TAIL_ROW, out.tails)):
        if rows:
            yield _with_columns(out.rows.take(pa.array(rows, pa.int64())), phase)
    if out.functions:
        vehicle, chunk, function, certain, count = zip(*out.functions)
        rows = pa.RecordBatch.from_pydict({"vehicle_id": pa.array(vehicle, pa.int64()), "chunk": pa.array(chunk, pa.int32())})
        yield _with_columns(rows, FUNCTION, function=pa.array(function, pa.binary()), certain=pa.array(certain, pa.bool_()), trips=pa.array(count, pa.int64()))


def _run_bounds(batch: pa.RecordBatch) -> list[tuple[int, int]]:
    vehicle = batch.column("vehicle_id").to_numpy()
    chunk = batch.column("chunk").fill_null(-1).to_numpy()
    new = (vehicle[1:] != vehicle[:-1]) | (chunk[1:] != chunk[:-1])
    edges = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
    return list(zip(edges[:-1], edges[1:]))


def trip_arrays(rows: pa.RecordBatch, trips: list[list[int]]) -> pa.ListArray:
    """The segments of trips, given as rows."""
    offsets = np.zeros(len(trips) + 1, np.int32)
    np.cumsum([len(trip) for trip in trips], out=offsets[1:])
    picked = rows.take(pa.array([i for trip in trips for i in trip], pa.int64()))
    segments = pa.StructArray.from_arrays([picked.column(c) for c in SEGMENT_FIELDS], names=SEGMENT_FIELDS)
    return pa.ListArray.from_arrays(pa.array(offsets), segments)


def _trip_batch(out: Folded) -> pa.RecordBatch:
    """One row per trip; of the row columns only vehicle and chunk are set."""
    first = out.rows.select(["vehicle_id", "chunk"]).take(pa.array([trip[0] for trip in out.trips], pa.int64()))
    phase = pc.if_else(first.column("chunk").is_null(), pa.scalar(WHOLE_TRIP, pa.int8()), pa.scalar(CERTAIN_TRIP, pa.int8()))
    return _with_columns(first, phase, trip_seq=pa.array(out.numbers, pa.int32()), segments=trip_arrays(out.rows, out.trips))


SEGMENT_TYPE = pa.struct([(c, pa.int64() if c.endswith("_ts") else pa.float64()) for c in SEGMENT_FIELDS])
SLICE_TYPES = {
    "vehicle_id": pa.int64(), "chunk": pa.int32(), "phase": pa.int8(), "kind": pa.int8(),
    **{c: SEGMENT_TYPE.field(c).type for c in SEGMENT_FIELDS}, "seg_id": pa.int64(),
    "trip_seq": pa.int32(), "segments": pa.list_(SEGMENT_TYPE),
    "function": pa.binary(), "certain": pa.bool_(), "trips": pa.int64(),
}


def _with_columns(rows: pa.RecordBatch, phase, **columns: pa.Array) -> pa.RecordBatch:
    """The columns of SLICE_TYPES, null where neither ``rows`` nor ``columns`` has them."""
    n = rows.num_rows
    held = {c: rows.column(c) for c in rows.schema.names} | columns
    held["phase"] = pa.repeat(pa.scalar(phase, pa.int8()), n) if isinstance(phase, int) else phase
    return pa.RecordBatch.from_pydict({c: held[c] if c in held else pa.nulls(n, t) for c, t in SLICE_TYPES.items()})
