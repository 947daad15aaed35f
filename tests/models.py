"""Plain-Python statements of the ordered logic, for comparison on small random data."""

from __future__ import annotations

from collections import defaultdict
from datetime import timedelta


def bundles(rows, gap_s):
    """``rows`` of (athlete, id, start, seconds) to {id: start of its bundle}."""
    result, by_athlete = {}, defaultdict(list)
    for row in rows:
        by_athlete[row[0]].append(row)
    for mine in by_athlete.values():
        previous = current = None
        for _, id, start, seconds in sorted(mine, key=lambda r: (r[2], r[1])):
            if previous is None or (start - previous).total_seconds() > gap_s:
                current = start
            result[id] = current
            previous = start + timedelta(seconds=seconds)
    return result


def roles(rows, gap_s):
    """{id: role} with the longest, then earliest, then lowest id as the main one."""
    starts, groups = bundles(rows, gap_s), defaultdict(list)
    for row in rows:
        groups[row[0], starts[row[1]]].append(row)
    result = {}
    for group in groups.values():
        main = min(group, key=lambda r: (-r[3], r[2], r[1]))
        for row in group:
            if row is main:
                result[row[1]] = "main"
            elif row[2] == main[2]:
                result[row[1]] = "same_start"
            else:
                result[row[1]] = "warmup" if row[2] < main[2] else "cooldown"
    return result


def asof(lefts, rights, tolerance_s):
    """``lefts`` of (id, key, ts, waived), ``rights`` of (id, key, ts) to {left id: right id}."""
    result = {}
    for id, key, ts, waived in lefts:
        same_day = [
            r for r in rights if r[1] == key and r[2].date() == ts.date() and r[2] <= ts]
        best = min(same_day, key=lambda r: (-r[2].timestamp(), r[0]), default=None)
        if best and not waived and (ts - best[2]).total_seconds() > tolerance_s:
            best = None
        result[id] = best[0] if best else None
    return result
