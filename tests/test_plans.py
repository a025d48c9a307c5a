"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pyarrow.parquet as pq
import pytest

from footfall import increments
from footfall.operators import cleaning, cohorts, items, lookups, quality, ranges, rfm, sessions
from footfall.params import RANGE_START
from footfall.sources import events_log, load_clean, orders_log, write_clean
from footfall.plans import CATALOGUE as QUERIES
from footfall.plans.catalogue import _raw



def plan_of(frame, run=False):
    if run:
        frame.collect()
    text = frame._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0] if run else text


@pytest.fixture()
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in keys:
        spark.conf.set(key, "-1")
    yield
    for key in keys:
        spark.conf.unset(key)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python(spark, sf_dir, no_broadcast, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas"):
        assert bad not in plan
    # Only one-row summaries turned into rows are ever multiplied.
    if "Expand" in plan:
        assert name in {
            "quality_nulls",
            "quality_nulls_csv",
            "session_stats",
            "session_stats_long_gap",
            "session_stats_plain_log",
            "session_stats_in_parts",
            "session_stats_in_parts_long_gap",
            "quality_nulls_shared",
        }


def test_date_range_prunes_partitions_and_columns(spark, sf_dir, tmp_path):
    path = str(tmp_path / "clean")
    write_clean(cleaning.clean(_raw(events_log(spark, sf_dir)), 0, 2**31 - 1), path)
    log = load_clean(spark, path)
    plan = plan_of(lookups.overview(lookups.in_dates(log, "2024-01-08", "2024-01-16")))
    partition_filters = re.search(r"PartitionFilters: \[(.*?)\]", plan).group(1)
    assert "date" in partition_filters
    assert "ReadSchema: struct<user_id:bigint,behavior:string>" in plan
    item = plan_of(lookups.item_summary(log, 42))
    assert "EqualTo(item_id,42)" in re.search(r"PushedFilters: \[(.*?)\]", item).group(1)


def test_dimensions_not_asked_for_cost_no_join(spark, sf_dir):
    plan = plan_of(items.item_hot_rank(orders_log(spark, sf_dir, user=False, category=False)))
    assert "Join" not in plan


def test_shared_rollup_is_shuffled_once(spark, sf_dir):
    log = orders_log(spark, sf_dir, category=False)
    assert "ReusedExchange" in plan_of(items.item_low_cvr(items.item_cvr_base(log)), run=True)
    busy = sessions.behavior_paths(events_log(spark, sf_dir), busy_rows=0)
    assert "ReusedExchange" in plan_of(busy, run=True)


def test_top_items_per_category_are_cut_before_the_shuffle(spark, sf_dir):
    plan = plan_of(items.category_items(orders_log(spark, sf_dir)))
    assert re.search(r"WindowGroupLimit.*Partial", plan)


def test_small_lookups_filter_at_the_scan_and_large_ones_after_the_rollup(
    spark, sf_dir, tmp_path
):
    path = str(tmp_path / "ids")
    spark.sql("SELECT 'item' AS kind, 42L AS id").write.parquet(path)
    log = events_log(spark, sf_dir)

    def lookup():
        return lookups.batch_lookup(log, spark.read.parquet(path))

    small = lookup()._jdf.queryExecution().optimizedPlan().toString()
    assert small.index("Aggregate") < small.index("LeftSemi")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = lookup()._jdf.queryExecution().optimizedPlan().toString()
        assert large.index("LeftSemi") < large.index("Aggregate")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("limit", ["-1", "10m"])
def test_batch_lookup_scans_the_log_once(spark, sf_dir, limit):
    keys = ("autoBroadcastJoinThreshold", "adaptive.autoBroadcastJoinThreshold")
    for key in keys:
        spark.conf.set(f"spark.sql.{key}", limit)
    try:
        plan = plan_of(QUERIES["batch_lookup"](spark, sf_dir), run=True)
    finally:
        for key in keys:
            spark.conf.unset(f"spark.sql.{key}")
    assert len(re.findall(r"FileScan parquet \[l_", plan)) == 1


def test_reports_of_a_log_share_one_scan_and_shuffle(spark, sf_dir):
    plan = plan_of(quality.facts(_raw(events_log(spark, sf_dir))), run=True)
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange hashpartitioning(user_id") == 1


def test_only_new_rows_are_shuffled_into_stored_bitmaps(spark, sf_dir, tmp_path, no_broadcast):
    log = events_log(spark, sf_dir)
    bitmaps = cohorts.activity_bitmaps(log)
    increments.save_bitmaps(bitmaps, "plan_bitmaps", 8, str(tmp_path / "bitmaps"))
    stored = spark.table("plan_bitmaps")
    plan = plan_of(cohorts.merge_bitmaps(stored, bitmaps), run=True)
    assert plan.count("Exchange hashpartitioning") == 1
    assert "FullOuter" in plan
    retention = plan_of(cohorts.retention_of(stored), run=True)
    assert "Exchange hashpartitioning(user_id" not in retention
    spark.sql("DROP TABLE plan_bitmaps")


def test_ranges_read_their_days_of_the_rollups_alone(spark, sf_dir, tmp_path):
    path = str(tmp_path / "ranges")
    increments.save_ranges(events_log(spark, sf_dir), path, "category_id")
    stored = increments.load_ranges(spark, path)
    some = [lookups.in_dates(part, "2024-01-08", "2024-01-09") for part in stored]
    plan = plan_of(ranges.activity_of(*some, "category_id"))
    assert len(re.findall(r"PartitionFilters: \[[^]]*date", plan)) == 2
    assert "events.parquet" not in plan


def test_rankings_beyond_the_group_limit_are_cut_in_parts_first(spark, sf_dir):
    plan = plan_of(items.category_items(orders_log(spark, sf_dir), 5000))
    assert re.search(r"Exchange hashpartitioning\(category_id#\w+, _w\d+#\w+", plan)
    assert plan.count("Window [row_number()") == 2


def _rows_of_scans(frame):
    """Rows that file scans gave, by their metrics."""
    frame.collect()
    plan, found = frame._jdf.queryExecution().executedPlan(), 0
    waiting = [plan]
    while waiting:
        node = waiting.pop()
        if "AdaptiveSparkPlan" in node.nodeName():
            waiting.append(node.executedPlan())
        if "QueryStage" in node.getClass().getSimpleName():
            waiting.append(node.plan())
        if node.nodeName().startswith("Scan parquet"):
            found += node.metrics().apply("numOutputRows").value()
        children = node.children()
        waiting += [children.apply(i) for i in range(children.size())]
    return found


def test_lookups_of_one_item_skip_row_groups(spark, tmp_path):
    """Item 5 occurs among few users; files are ranges of users."""
    rows = spark.range(0, 200_000).selectExpr(
        "id % 20000 AS user_id",
        "IF(id % 20000 < 50, 5L, 1000 + id * 7919 % 150000) AS item_id",
        "1L AS category_id",
        "'pv' AS behavior",
        f"{RANGE_START} + id % 3600 AS timestamp",
    )
    path = str(tmp_path / "clustered")
    write_clean(cleaning.derive_time(rows), path, clustered=True)
    log = load_clean(spark, path)
    seen = lookups.item_behavior_stats(log, 5)
    assert [tuple(r) for r in seen.collect()] == [("pv", 500)]
    assert _rows_of_scans(seen) < 100_000
    files = list((tmp_path / "clustered").rglob("*.parquet"))
    assert len(files) > 1
    for file in files:
        users = pq.read_table(file, columns=["user_id", "timestamp"]).to_pylist()
        order = [(r["user_id"], r["timestamp"]) for r in users]
        assert order == sorted(order)


def test_segment_profiles_join_rolled_up_users(spark, sf_dir, no_broadcast):
    log = events_log(spark, sf_dir)
    plan = rfm.segment_hourly(log, rfm.rfm_detail(log), "潜力用户")
    optimized = plan._jdf.queryExecution().optimizedPlan().toString()
    left = optimized[optimized.index("LeftSemi") :]
    assert left.index("Aggregate [user_id") < left.index("Relation")


def _sources_of_user_shuffles(frame):
    """What feeds each shuffle by user alone, down to the scan."""
    parts = re.split(r"Exchange hashpartitioning\(user_id#\w+, \d+\)", plan_of(frame))[1:]
    return [part[: part.index("FileScan")] for part in parts]


def test_rows_of_a_busy_user_are_never_gathered(spark, sf_dir):
    """Shuffles by user alone see rollups, slot edges or ordinary users only."""
    log = events_log(spark, sf_dir)
    for frame in (
        sessions.session_rollup(log),
        sessions.sessionize(log),
        sessions.behavior_paths(log, 2),
        sessions.behavior_paths(log, 3),
    ):
        sources = _sources_of_user_shuffles(frame)
        assert sources
        for source in sources:
            assert "HashAggregate" in source or "Filter ((nth" in source or "LeftAnti" in source


def test_without_busy_users_one_window_pass_is_left(spark, sf_dir):
    plan = plan_of(sessions.behavior_paths(events_log(spark, sf_dir)), run=True)
    assert "Join" not in plan and "Union" not in plan
    assert plan.count("Window") == 1


def test_ordinary_rows_are_shuffled_once_for_sessions(spark, sf_dir):
    plan = plan_of(sessions.session_rollup(events_log(spark, sf_dir)), run=True)
    assert "Union" not in plan and plan.count("Exchange hashpartitioning(user_id") == 1


def test_cohorts_and_batch_lookups_shuffle_rows_once(spark, sf_dir, no_broadcast):
    retention = plan_of(cohorts.retention(events_log(spark, sf_dir)))
    assert retention.count("Exchange hashpartitioning(user_id") == 1
    plan = plan_of(QUERIES["kpi_summary"](spark, sf_dir))
    assert plan.count("FileScan") == 1


def test_one_busy_user_leaves_few_rows_to_order(spark):
    """200,000 rows of one user within an hour reach the per-user order as 24 edge rows."""
    rows = spark.range(200000).selectExpr(
        "id AS event_id", "1L AS user_id", "id * 18000 AS ts_us", "'pv' AS behavior"
    )
    assert rows.groupBy("user_id", sessions._slot(30, 300)).count().count() == 12
    paths = sessions.behavior_paths(rows, busy_rows=1000)
    assert [tuple(r) for r in paths.collect()] == [("pv → pv", 199999)]
    assert [tuple(r) for r in sessions.session_rollup(rows).collect()] == [("1_1", 200000, 1)]
