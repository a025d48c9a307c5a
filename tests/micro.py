"""Small hand-made logs and plain-Python versions of the order-bound analyses."""

from __future__ import annotations

from collections import Counter, defaultdict

from footfall.operators.cleaning import derive_time
from footfall.sources import RAW_SCHEMA

T0 = 1511539200  # midnight in the business zone, a Saturday
DAY = 86400


def make_log(spark, rows):
    """A log from (user, item, category, behavior, seconds since T0) rows."""
    raw = [(u, i, c, b, T0 + int(s)) for u, i, c, b, s in rows]
    return derive_time(spark.createDataFrame(raw, RAW_SCHEMA))


def visits(spark, *rows):
    """A log from (user, behavior, seconds since T0) rows on one item."""
    return make_log(spark, [(u, 1, 1, b, s) for u, b, s in rows])


def rows_of(frame):
    return [tuple(r) for r in frame.collect()]


def sessions_by_hand(events, gap_us):
    """Lists of behaviours per (user, running number), from event tuples
    (event_id, user, ts_us, behavior)."""
    by_user = defaultdict(list)
    for event_id, user, ts_us, behavior in events:
        by_user[user].append((ts_us, event_id, behavior))
    sessions = {}
    for user, seen in by_user.items():
        last, number = None, 0
        for ts_us, event_id, behavior in sorted(seen):
            if last is None or ts_us - last > gap_us:
                number += 1
            last = ts_us
            sessions.setdefault((user, number), []).append((event_id, behavior))
    return sessions


def paths_by_hand(sessions, steps):
    counts = Counter()
    for walk in sessions.values():
        names = [behavior for _, behavior in walk]
        for start in range(len(names) - steps + 1):
            counts[" → ".join(names[start : start + steps])] += 1
    return counts
