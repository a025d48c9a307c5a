from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from footfall.functions import at_least, up_to
from footfall.operators import cohorts, diagnostics, funnels, rfm, traffic
from footfall.params import RFM
from tests.micro import DAY, rows_of, visits

FIRST = dt.date(2017, 11, 25)


def test_daily_counts_rows_users_and_views(spark):
    log = visits(
        spark, (1, "pv", 0), (1, "buy", 5), (2, "wish", 9), (None, "pv", 9), (1, "pv", DAY)
    )
    assert rows_of(traffic.daily_uv_pv(log)) == [
        (FIRST, 2, 2, 4),
        (FIRST + dt.timedelta(1), 1, 1, 1),
    ]


def test_retention_counts_exact_days_and_marks_censored_cohorts(spark):
    log = visits(
        spark, *[(1, "pv", d * DAY) for d in (0, 1, 3)], (2, "pv", 0), (3, "pv", DAY)
    )
    assert rows_of(cohorts.retention(log)) == [
        (FIRST, 2, 1, 50.0, 1, 50.0, 0, 0.0),
        (FIRST + dt.timedelta(1), 1, 0, 0.0, 0, 0.0, 0, 0.0),
    ]
    flagged = cohorts.retention(log, flag_observable=True).collect()
    assert [(r.observable_day1, r.observable_day3, r.observable_day7) for r in flagged] == [
        (True, True, False),
        (True, False, False),
    ]


def test_lifecycle(spark):
    log = visits(spark, (1, "pv", 0), (1, "pv", DAY), (2, "pv", DAY), (3, "buy", DAY))
    assert rows_of(cohorts.lifecycle(log)) == [
        (FIRST, 1, 1, 0, 100.0),
        (FIRST + dt.timedelta(1), 3, 2, 1, 66.67),
    ]


def test_first_purchase_gap(spark):
    log = visits(
        spark,
        *[(1, "pv", 0), (1, "buy", 60)],  # same day
        *[(2, "pv", 0), (2, "buy", DAY)],
        *[(3, "pv", 0), (3, "buy", 3 * DAY)],
        *[(4, "pv", 0), (4, "buy", 7 * DAY)],
        *[(5, "pv", 0), (5, "buy", 8 * DAY)],
        *[(6, "buy", 0), (6, "pv", 2 * DAY)],  # bought first
        *[(7, "buy", 0), (8, "pv", 0)],  # only one of both
    )
    assert dict(rows_of(cohorts.first_purchase_gap(log))) == {
        "当天购买": 1,
        "1天内": 2,
        "2-3天": 1,
        "4-7天": 1,
        "7天以上": 1,
    }
    assert dict(rows_of(cohorts.first_purchase_gap(log, split_negative=True)))["先购后看"] == 1


def test_active_days(spark):
    days_of_users = [(1, 1), (2, 3), (3, 5), (4, 7), (5, 8)]
    log = visits(spark, *[(u, "pv", d * DAY) for u, n in days_of_users for d in range(n)])
    assert dict(rows_of(cohorts.active_days(log))) == {
        "仅1天": 1,
        "2-3天": 1,
        "4-5天": 1,
        "6-7天": 1,
        "8-9天": 1,
    }


def test_rfm_edges(spark):
    buys = {1: 1, 2: 2, 3: 4, 4: 9, 5: 10}
    rows = [(u, "buy", 8 * DAY + i) for u, n in buys.items() for i in range(n)]
    rows += [(10 + back, "buy", (8 - back) * DAY) for back in range(9)]
    rows += [(50, "pv", 8 * DAY)]
    detail = {r.user_id: r for r in rfm.rfm_detail(visits(spark, *rows)).collect()}
    assert 50 not in detail
    assert [detail[u].f_score for u in buys] == [1, 2, 3, 4, 5]
    assert [detail[10 + b].r_score for b in range(9)] == [5, 5, 4, 4, 3, 3, 2, 2, 1]
    assert (detail[18].total_score, detail[18].user_segment) == (1.0, "流失用户")
    assert (detail[17].total_score, detail[17].user_segment) == (1.4, "预流失用户")
    assert (detail[5].total_score, detail[5].user_segment) == (5.0, "高价值用户")


def test_recency_counts_from_the_last_row_of_any_kind(spark):
    log = visits(spark, (1, "buy", 0), (2, "pv", 4 * DAY))
    assert [(r.recency, r.frequency) for r in rfm.rfm_detail(log).collect()] == [(4, 1)]


def test_segments_partition_a_known_score_histogram(spark):
    # Users per score and per segment of a published run.
    scores = {1.0: 21846, 1.4: 45691, 1.6: 4586, 1.8: 46086}
    segments = {"流失用户": 21846, "预流失用户": 96363}
    frame = spark.createDataFrame(list(scores.items()), "total_score double, n long")
    named = frame.groupBy(
        at_least("total_score", RFM.segments, RFM.lowest_segment).alias("s")
    ).agg(F.sum("n"))
    assert dict(rows_of(named)) == segments


@pytest.mark.parametrize("value, label", [(1, "a"), (2, "b"), (3, "b"), (4, "c")])
def test_up_to(spark, value, label):
    out = spark.range(1).select(up_to(str(value), ((1, "a"), (3, "b")), "c"))
    assert out.first()[0] == label


def test_segment_profiles(spark):
    rows = [(1, "buy", i) for i in range(10)] + [(1, "pv", 3700), (2, "buy", 0), (3, "pv", 1)]
    log = visits(spark, *rows)
    detail = rfm.rfm_detail(log)
    high = RFM.top_segment
    assert rows_of(rfm.segment_user_count(detail, high)) == [(high, 1)]
    assert rows_of(rfm.segment_hourly(log, detail, high)) == [(0, 10), (1, 1)]
    assert rows_of(rfm.segment_top_categories(log, detail, high)) == [(1, 11, 1)]
    assert dict(rows_of(rfm.segment_behavior_dist(log, detail, high))) == {"buy": 10, "pv": 1}


def test_no_weekend_in_range(spark):
    monday = 2 * DAY
    log = visits(spark, (1, "pv", monday), (1, "buy", monday + 1), (2, "pv", monday + DAY))
    assert rows_of(traffic.weekday_vs_weekend(log)) == [("工作日", 2, 3, 2, 2, 2, 1, 50.0)]


def test_average_per_day_rounds_half_to_even(spark):
    log = visits(spark, *[(1, "pv", i) for i in range(4)], (1, "pv", DAY))
    assert traffic.weekday_vs_weekend(log).first().daily_avg_behavior == 2  # 5 / 2


def test_daily_funnel_is_strict_and_per_day(spark):
    log = visits(
        spark,
        *[(1, "pv", 0), (1, "cart", 1), (1, "buy", 2)],
        *[(2, "pv", 0), (2, "buy", 1)],
        (3, "fav", 0),
        *[(2, "cart", DAY)],
    )
    assert rows_of(traffic.daily_funnel(log)) == [(FIRST, 2, 1, 1, 50.0, 100.0, 50.0)]


def test_whole_period_funnel(spark):
    log = visits(
        spark,
        *[(1, "pv", 0), (1, "fav", DAY), (1, "buy", 0)],
        *[(2, "pv", 0), (3, "buy", 0), (4, "cart", 0)],
    )
    assert [tuple(r)[1:] for r in funnels.conversion_funnel_detail(log).collect()] == [
        (2, 100.0, 100.0),
        (1, 50.0, 50.0),
        (1, 50.0, 100.0),
    ]
    nobody = funnels.conversion_funnel(log.where("behavior = 'buy'")).collect()
    assert [(r.user_count, r.conversion_rate) for r in nobody] == [(0, 100.0), (0, 0.0), (0, 0.0)]


def test_distribution_includes_unknown_and_missing_behaviors(spark):
    log = visits(spark, (1, "pv", 0), (1, "pv", 1), (1, "wish", 2), (1, None, 3))
    assert {r[0]: r[1:] for r in rows_of(funnels.behavior_distribution(log))} == {
        "pv": (2, 50.0),
        "wish": (1, 25.0),
        None: (1, 25.0),
    }


def test_hourly_rates_without_views(spark):
    log = visits(spark, (1, "buy", 0), (1, "pv", 3600), (2, "pv", 3600), (2, "buy", 3601))
    assert rows_of(traffic.hourly_cvr(log)) == [
        (0, 0, 1, 0, 1, 1, 0.0, 0.0),
        (1, 2, 1, 2, 1, 3, 50.0, 50.0),
    ]


def test_rows_without_a_user_are_never_a_user(spark):
    log = visits(
        spark, (None, "buy", 0), (None, "pv", 5), (1, "pv", 0), (1, "buy", 7), (None, "buy", DAY)
    )
    users = 1
    assert sum(r.new_users for r in cohorts.retention(log).collect()) == users
    assert sum(r.user_count for r in cohorts.active_days(log).collect()) == users
    assert [r.user_id for r in rfm.rfm_detail(log).collect()] == [1]
    assert rows_of(diagnostics.purchases_without_view(log)) == [(3, 2, 66.67)]


def test_labels_may_hold_any_character(spark):
    frame = spark.range(3).select(up_to("id", ((0, "it's"), (1, 'a "b"')), "\\rest").alias("x"))
    assert rows_of(frame) == [("it's",), ('a "b"',), ("\\rest",)]
