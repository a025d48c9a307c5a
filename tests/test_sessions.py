from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from footfall.operators import sessions
from tests.micro import make_log, paths_by_hand, rows_of, sessions_by_hand, visits

MICROS = 1_000_000


@pytest.mark.parametrize("idle, expected", [(1800, 1), (1801, 2), (1800.5, 2), (1799.9, 1)])
@pytest.mark.parametrize("start", [0, 7, 1799])
@pytest.mark.parametrize("busy_rows", [0, 100])
def test_gap_is_exclusive(spark, idle, expected, start, busy_rows):
    log = visits(spark, (1, "pv", start), (1, "buy", start + int(idle))).withColumn(
        "ts_us",
        F.when(
            F.col("behavior") == "buy", F.col("ts_us") + int(idle % 1 * MICROS)
        ).otherwise(F.col("ts_us")),
    )
    stats = dict(rows_of(sessions.session_stats(sessions.session_rollup(log))))
    assert stats["total_sessions"] == expected
    labelled = sessions.sessionize(log, busy_rows=busy_rows)
    assert labelled.select("session_id").distinct().count() == expected
    assert sessions.behavior_paths(log, busy_rows=busy_rows).count() == 2 - expected


def test_rollup_and_stats(spark):
    log = visits(
        spark, (1, "pv", 0), (1, "pv", 60), (1, "buy", 90), (1, "pv", 9000), (2, "fav", 5)
    )
    rollup = sessions.session_rollup(log)
    assert sorted(rows_of(rollup)) == [("1_1", 3, 2), ("1_2", 1, 1), ("2_1", 1, 1)]
    assert rows_of(sessions.session_stats(rollup)) == [
        ("total_sessions", 3.0),
        ("avg_session_length", 1.67),
        ("gap_minutes", 30.0),
    ]
    assert rows_of(sessions.session_lengths(rollup)) == [(1, 2), (3, 1)]


def test_empty_log(spark):
    log = visits(spark, (1, "pv", 0)).where("false")
    stats = dict(rows_of(sessions.session_stats(sessions.session_rollup(log))))
    assert stats == {"total_sessions": 0.0, "avg_session_length": 0.0, "gap_minutes": 30.0}


def test_equal_times_are_ordered_by_the_tie_break(spark):
    log = make_log(spark, [(1, 1, 1, "pv", 0), (1, 1, 1, "buy", 0), (1, 1, 1, "cart", 0)])
    assert rows_of(sessions.behavior_paths(log)) == [("buy → cart", 1), ("cart → pv", 1)]
    assert rows_of(sessions.behavior_paths_3step(log)) == [("buy → cart → pv", 1)]
    by_id = log.withColumn(
        "event_id", F.expr("CASE behavior WHEN 'pv' THEN 1 WHEN 'buy' THEN 2 ELSE 3 END")
    )
    assert rows_of(sessions.behavior_paths_3step(by_id)) == [("pv → buy → cart", 1)]


@pytest.mark.parametrize("busy_rows", [0, 1, 100])
def test_rows_without_a_user_are_in_no_session(spark, busy_rows):
    log = visits(spark, (None, "pv", 0), (None, "buy", 10), (3, "pv", 0))
    labelled = sessions.sessionize(log, busy_rows=busy_rows)
    assert labelled.count() == 3
    assert {r.session_id for r in labelled.collect()} == {None, "3_1"}
    assert rows_of(sessions.session_rollup(log, busy_rows=busy_rows)) == [("3_1", 1, 1)]
    assert rows_of(sessions.behavior_paths(log, busy_rows=busy_rows)) == []


@pytest.mark.parametrize("busy_rows", [0, 100])
def test_no_gap_at_all(spark, busy_rows):
    log = visits(spark, (1, "pv", 0), (1, "buy", 0), (1, "pv", 1))
    rollup = sessions.session_rollup(log, 0, busy_rows=busy_rows)
    assert sorted(rows_of(rollup)) == [("1_1", 2, 2), ("1_2", 1, 1)]
    assert sessions.sessionize(log, 0, busy_rows=busy_rows).count() == 3


def test_slots_of_a_very_busy_user_are_narrow(spark, monkeypatch):
    """Many rows inside one wide slot are spread over slots of a second."""
    rows = spark.range(30_000).selectExpr(
        "id AS event_id", "1L AS user_id", "id * 9000 AS ts_us", "'pv' AS behavior"
    )
    monkeypatch.setattr(sessions, "ROWS_PER_SECOND", 1)
    _, busy = sessions._split_busy(rows, 0, 300)
    slots = busy.groupBy(sessions._slot(30, F.col("slot_width"))).count()
    assert slots.count() > 80 and slots.agg(F.max("count")).first()[0] < 500
    assert rows_of(sessions.session_rollup(rows, busy_rows=0)) == [("1_1", 30_000, 1)]


def _random_events(seed):
    """Many short histories and one user with a third of all rows."""
    rng = random.Random(seed)
    names = ["pv", "cart", "fav", "buy", "other"]
    events = []
    for user in range(40):
        now = rng.randrange(0, 10**9)
        for _ in range(rng.randrange(1, 40)):
            now += rng.choice([0, 1, 5 * MICROS, 290 * MICROS, 1800 * MICROS, 1801 * MICROS])
            events.append((user, now))
    now = 0
    for _ in range(len(events) // 2):
        now += rng.choice([0, 0, MICROS // 7, MICROS, 30 * MICROS, 1799 * MICROS, 4000 * MICROS])
        events.append((99, now))
    rng.shuffle(events)
    return [(n, user, ts, rng.choice(names)) for n, (user, ts) in enumerate(events)]


EVERYONE, SOME, NOBODY = 0, 100, 10**9


@pytest.mark.parametrize(
    "seed, slot_seconds, busy_rows",
    [(1, 300, EVERYONE), (2, 1, SOME), (3, 100000, SOME), (4, 60, EVERYONE), (5, 300, NOBODY)],
)
def test_equal_to_a_plain_walk_over_each_user(spark, seed, slot_seconds, busy_rows):
    events = _random_events(seed)
    log = spark.createDataFrame(
        events, "event_id long, user_id long, ts_us long, behavior string"
    ).repartition(5)
    walks = sessions_by_hand(events, 1800 * MICROS)

    labels = {
        event_id: f"{user}_{number}"
        for (user, number), walk in walks.items()
        for event_id, _ in walk
    }
    labelled = sessions.sessionize(log, slot_seconds=slot_seconds, busy_rows=busy_rows)
    assert {r.event_id: r.session_id for r in labelled.collect()} == labels
    assert labelled.columns == [*log.columns, "session_id"]

    rolled = sessions.session_rollup(log, slot_seconds=slot_seconds, busy_rows=busy_rows)
    assert {r[0]: (r[1], r[2]) for r in rows_of(rolled)} == {
        f"{user}_{number}": (len(walk), len({b for _, b in walk}))
        for (user, number), walk in walks.items()
    }
    for steps in (2, 3, 4):
        ours = sessions.behavior_paths(
            log, steps, slot_seconds=slot_seconds, busy_rows=busy_rows
        )
        assert dict(rows_of(ours)) == dict(paths_by_hand(walks, steps))
