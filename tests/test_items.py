from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from footfall.operators import cohorts, diagnostics, funnels, items, lookups, traffic
from footfall.sources import events_log, orders_log
from tests.micro import DAY, make_log, rows_of


def _shop(spark):
    """Item 1 is bought without views, item 2 is viewed much and bought once."""
    rows = [(u, 1, 7, "buy", u) for u in range(5)] + [(0, 1, 7, "pv", 0)]
    rows += [(u, 2, 7, "pv", u) for u in range(10)] + [(u, 2, 7, "cart", u) for u in range(4)]
    rows += [(3, 2, 7, "buy", 60), (3, 2, 7, "buy", 61), (3, 2, 7, "fav", 61)]
    rows += [(None, 2, 7, "pv", 5), (1, 3, 8, "wish", DAY)]
    return make_log(spark, rows)


def test_counts_are_users_and_interest_adds_up(spark):
    base = {r.item_id: r.asDict() for r in items.cvr_base(_shop(spark), "item_id").collect()}
    assert base[2] == {
        "item_id": 2,
        "pv": 10,
        "fav": 1,
        "cart": 4,
        "buy": 1,
        "total_uv": 10,
        "interest_uv": 15,
        "pv_to_buy_rate": 6.67,
    }
    assert base[1]["pv_to_buy_rate"] == 500.0
    assert (base[3]["interest_uv"], base[3]["pv_to_buy_rate"]) == (0, 0.0)


def test_conversion_over_100_percent(spark):
    base = items.item_cvr_base(_shop(spark), min_interest=1)
    assert [r.item_id for r in diagnostics.cvr_over(base).collect()] == [1]
    assert [r.item_id for r in items.item_cvr_top(base, 1).collect()] == [1]
    assert [r.item_id for r in items.item_low_cvr(base, 1).collect()] == [2]
    assert items.item_low_cvr(base.where("false")).count() == 0


def test_union_interest_in_lookups(spark):
    stats = {r.category_id: r for r in items.category_stats(_shop(spark)).collect()}
    seven = stats[7]
    assert (seven.total, seven.pv_uv, seven.interest_uv, seven.buy_uv) == (24, 10, 10, 5)
    assert stats[7].cvr == 50.0
    assert (stats[8].total, stats[8].interest_uv, stats[8].cvr) == (1, 0, 0.0)
    assert [r.item_id for r in items.category_items_lookup(_shop(spark), 7, 1).collect()] == [2]


def test_item_lookup(spark):
    log = _shop(spark)
    assert rows_of(lookups.item_summary(log, 2)) == [(2, 10, 10.0)]
    assert dict(rows_of(lookups.item_behavior_stats(log, 2))) == {
        "pv": 11,
        "cart": 4,
        "buy": 2,
        "fav": 1,
    }
    assert rows_of(lookups.item_hourly_dist(log, 3)) == [(0, 1)]
    assert rows_of(lookups.item_daily_trend(log, 3)) == [(dt.date(2017, 11, 26), "wish", 1)]
    assert rows_of(lookups.item_summary(log, 404)) == [(404, 0, 0.0)]


def test_batch_lookup_of_some_ids(spark):
    log = _shop(spark)
    requests = spark.createDataFrame(
        [("item", 2), ("item", 404), ("category", 8), ("item", 2), ("item", 2**40)],
        "kind string, id long",
    )
    found = {(r.kind, r.id): r for r in lookups.batch_lookup(log, requests).collect()}
    assert set(found) == {("item", 2), ("category", 8)}
    assert found["item", 2].total == 18


def test_overview(spark):
    assert rows_of(lookups.overview(_shop(spark))) == [(25, 10, 10, 5, 50.0)]
    assert rows_of(lookups.overview(_shop(spark).where("false"))) == [(0, 0, 0, 0, 0.0)]


def test_diagnostics(spark):
    log = _shop(spark)
    without = {r[0]: r[1:] for r in rows_of(diagnostics.buyers_without_view(log))}
    assert without == {1: (5, 4, 80.0), 2: (1, 0, 0.0)}
    assert rows_of(diagnostics.purchases_without_view(log)) == [(7, 0, 0.0)]
    by_item = diagnostics.purchases_without_view(log, "user_id", "item_id", "date")
    assert rows_of(by_item) == [(7, 4, 57.14)]


def test_date_filters(spark):
    log = _shop(spark)
    first, second = dt.date(2017, 11, 25), dt.date(2017, 11, 26)
    assert rows_of(lookups.available_dates(log)) == [(first,), (second,)]
    assert lookups.in_dates(log, start=second).count() == 1
    assert lookups.in_dates(log, end="2017-11-25").count() == 24
    assert lookups.in_dates(log).count() == 25
    lifecycle = cohorts.lifecycle(log)
    assert lookups.result_in_dates(lifecycle, second, second).count() == 1
    assert lookups.result_in_dates(cohorts.retention(log), second).count() == 0
    hourly = traffic.hourly_cvr(log)
    assert lookups.result_in_dates(hourly, second) is hourly


def test_nested_export_equals_the_flat_one(spark, sf_dir):
    log = orders_log(spark, sf_dir)
    flat = items.category_items(log)
    nested = items.category_items_nested(log)
    unnested = nested.select("category_id", F.inline("items")).select(*flat.columns)
    assert sorted(rows_of(unnested)) == sorted(rows_of(flat))
    for row in nested.collect():
        assert [item.rank for item in row["items"]] == list(range(1, len(row["items"]) + 1))


def test_approximate_threshold_is_within_its_error(spark, sf_dir):
    base = items.item_cvr_base(orders_log(spark, sf_dir, category=False), 1)
    views = sorted(r.pv for r in base.select("pv").collect())
    kept = items.item_low_cvr_approx(base, n=None)
    threshold = min(r.pv for r in kept.collect())
    below, upto = sum(v < threshold for v in views), sum(v <= threshold for v in views)
    assert below / len(views) <= 0.81 and upto / len(views) >= 0.79


def test_kpis_take_the_best_day(spark):
    log = _shop(spark)
    kpis = lookups.kpi_summary(log)
    assert rows_of(kpis) == [(25, 10, 12, 7, 58.33)]
    share = lookups.behavior_share(funnels.behavior_distribution(log), "buy")
    assert rows_of(share) == [("buy", 7, 28.0)]
    assert lookups.behavior_share(funnels.behavior_distribution(log), "none").count() == 0


def test_rankings_can_be_recut(spark, sf_dir):
    log = events_log(spark, sf_dir)
    whole = rows_of(items.item_hot_rank(log, None))
    assert rows_of(items.item_hot_rank(log, 15)) == whole[:15]
