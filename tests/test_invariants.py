"""Relations between results that must hold on any log."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from footfall.operators import cohorts, funnels, items, rfm, sessions, traffic
from footfall.sources import events_log, orders_log


@pytest.fixture(scope="module", params=["events", "orders"])
def log(request, spark, sf_dir):
    frame = events_log(spark, sf_dir) if request.param == "events" else orders_log(spark, sf_dir)
    frame = frame.persist()
    yield frame
    frame.unpersist()


def total(frame, column):
    return frame.agg(F.sum(column)).first()[0]


def test_totals_agree(log):
    rows = log.count()
    assert total(traffic.daily_uv_pv(log), "total_behavior") == rows
    assert total(traffic.hourly_cvr(log), "total_behavior") == rows
    assert total(traffic.weekday_vs_weekend(log), "total_behavior") == rows
    assert total(funnels.behavior_distribution(log), "count") == rows
    assert total(items.item_hot_rank(log, None), "total") == rows
    assert total(items.category_stats(log), "total") == rows


def test_users_agree(log):
    people = log.select("user_id").distinct().count()
    assert total(cohorts.retention(log), "new_users") == people
    assert total(cohorts.lifecycle(log), "new_users") == people
    assert total(cohorts.active_days(log), "user_count") == people
    first, second = cohorts.lifecycle(log).limit(2).collect()
    if (second.date - first.date).days == 1:
        assert cohorts.retention(log).first().retained_day1 == second.returning_users


def test_sessions_and_paths_agree(log):
    rows = log.count()
    for gap in (30, 360):
        rollup = sessions.session_rollup(log, gap).persist()
        count = rollup.count()
        long = rollup.where("session_length >= 2").count()
        assert total(rollup, "session_length") == rows
        two = sessions.behavior_paths(log, 2, gap)
        three = sessions.behavior_paths_3step(log, gap)
        assert (total(two, "path_count") or 0) == rows - count
        assert (total(three, "count") or 0) == rows - count - long
        assert sessions.sessionize(log, gap).select("session_id").distinct().count() == count
        rollup.unpersist()


def test_segments_agree(log):
    detail = rfm.rfm_detail(log)
    buyers = log.where("behavior = 'buy'").select("user_id").distinct().count()
    assert total(rfm.rfm_segments(detail), "user_count") == buyers
    assert total(rfm.rfm_scores(detail), "user_count") == buyers
    assert total(cohorts.first_purchase_gap(log), "user_count") <= buyers


def test_exports_agree(log):
    ranking = [r.item_id for r in items.item_hot_rank(log, 50).collect()]
    exported = items.item_details(log, 200).collect()
    assert [r.item_id for r in exported][:50] == ranking
    assert all(r.pv_uv <= r.interest_uv for r in exported)
    stages = [r.user_count for r in funnels.conversion_funnel(log).collect()]
    assert stages == sorted(stages, reverse=True)
