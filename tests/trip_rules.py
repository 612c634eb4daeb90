"""The trip rules restated plainly, one vehicle's list at a time, for comparison."""


def plain_trips(rows):
    """rows: (start_ts, end_ts, status pair, id) of one vehicle, any order."""
    trips, current, until = [], [], None
    for start, end, pair, row_id in sorted(rows, key=lambda r: (r[0], r[1], r[3])):
        if until is not None and start < until:
            continue
        if pair == "EM":
            if end - start <= 600 and until is None:
                current, until = [], end
            continue
        if pair == "MM":
            paused = until is not None and start - until >= 300
            if not paused and end - start <= 3600:
                current.append(row_id)
                until = end
                continue
        else:
            paused = False
        if current:
            trips.append(current)
        current, until = ([row_id] if paused else []), None
    return trips
