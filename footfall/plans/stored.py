"""Named queries whose results are stored, added to in parts, and read back.

Each gives the rows of the query on the whole log, so the SQL is the same.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall import increments, jobs
from footfall.operators import cleaning, cohorts, items, lookups, quality, ranges, sessions
from footfall.plans.oracle import ONE_DAY_AGAIN, ORACLE, TOP_5000
from footfall.plans.catalogue import (
    DATES,
    FEW,
    ITEM,
    LONG_GAP_MINUTES,
    RANGE,
    Query,
    _broken_csv,
    _csv_scan,
    _item_base,
    _raw,
)
from footfall.sources import events_log, fresh_folder, load_clean, orders_log, write_clean

# Times that cut the events into parts: inside a day, and between two days.
CUTS_US = (1704844800_000_000, 1705449600_000_000, 1706000000_000_000)
AGAIN = "2024-01-10"  # the day that is cleaned again
BUCKETS = 8
DEEP = 5000
EXACT = 1e-6  # below one rank, so the sketch is exact


def _parts(log: DataFrame) -> list[tuple[DataFrame, int]]:
    """The log cut by time, each part with the time up to which it goes."""
    ends = [*CUTS_US, 2**60]
    starts = [-(2**60), *CUTS_US]
    ts = F.col("ts_us")
    return [(log.where((ts >= x) & (ts < y)), y) for x, y in zip(starts, ends)]


def _sessions_in_parts(gap_minutes: float, result: Callable[[DataFrame], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        store = fresh_folder(spark, "sessions")
        for part, until in _parts(events_log(spark, sf_dir)):
            increments.add_to_sessions(part, store, until, gap_minutes)
        spans = increments.stored_sessions(spark, store)
        return result(sessions.rollup_of_spans(spans))

    return query


def _from_bitmaps(result: Callable[[DataFrame], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        name, table = f"active_{uuid.uuid4().hex}", None
        for i, (part, _) in enumerate(_parts(events_log(spark, sf_dir))):
            path, grown = fresh_folder(spark, f"active-{i}"), f"{name}_{i}"
            if table is None:
                increments.save_bitmaps(cohorts.activity_bitmaps(part), grown, BUCKETS, path)
            else:
                increments.add_to_bitmaps(part, table, grown, path)
            table = grown
        return result(spark.table(table))

    return query


def _from_ranges(result: Callable[..., DataFrame], *keys: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = fresh_folder(spark, "ranges")
        increments.save_ranges(events_log(spark, sf_dir), path, *keys)
        stored = increments.load_ranges(spark, path)
        return result(*(lookups.in_dates(part, *DATES) for part in stored), *keys)

    return query


def _counts_of_the_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts that are taken while a log is cleaned and written."""
    raw, clean = fresh_folder(spark, "broken"), fresh_folder(spark, "clean")
    _broken_csv(spark, sf_dir).write.csv(raw)
    jobs.clean_log(spark, raw, clean, *RANGE)
    columns = cleaning.report(_raw(events_log(spark, sf_dir))).schema
    return spark.read.schema(columns).json(f"{clean}_report")


def _shared_report(name: str, log: Query = _broken_csv) -> Query:
    return lambda spark, sf_dir: quality.reports(quality.facts(log(spark, sf_dir), *RANGE))[name]


def _one_day_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log of which one day was wrong at first and was cleaned again alone."""
    wrong, right, clean = (fresh_folder(spark, x) for x in ("wrong", "right", "clean"))
    raw = _raw(events_log(spark, sf_dir))
    raw.withColumn("behavior", F.lit("pv")).write.csv(wrong)
    raw.write.csv(right)
    jobs.clean_log(spark, wrong, clean, *RANGE, zone="UTC")
    first = (dt.date.fromisoformat(AGAIN) - dt.date(1970, 1, 1)).days * 86400
    jobs.clean_log(spark, right, clean, first, first + 86399, zone="UTC", only_days=True)
    return load_clean(spark, clean)


def _two_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log that came in two batches with rows in both."""
    first, second, clean = (fresh_folder(spark, x) for x in ("first", "second", "clean"))
    log = events_log(spark, sf_dir)
    _raw(log.where("event_id % 3 <> 0")).write.csv(first)
    _raw(log.where("event_id % 2 = 0 OR event_id % 3 = 0")).write.csv(second)
    jobs.clean_log(spark, first, clean, *RANGE)
    for _ in range(2):  # the same batch again adds nothing
        jobs.add_batch(spark, second, clean, *RANGE)
    return load_clean(spark, clean)


def _clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_folder(spark, "clustered")
    write_clean(cleaning.clean(_csv_scan(spark, sf_dir), *RANGE), path, clustered=True)
    return load_clean(spark, path)


def _clustered_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_folder(spark, "clustered")
    write_clean(events_log(spark, sf_dir), path, clustered=True)
    return lookups.item_behavior_stats(load_clean(spark, path), ITEM)


def _on_items(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(_item_base(orders_log(spark, sf_dir, category=False)))


STORED: dict[str, Query] = {
    "clean_report_of_write": _counts_of_the_write,
    "clean_one_day_again": _one_day_again,
    "clean_two_batches": _two_batches,
    "clean_clustered_roundtrip": _clustered,
    "item_behavior_stats_clustered": _clustered_item,
    "quality_nulls_shared": _shared_report("null_counts"),
    "quality_enum_shared": _shared_report(
        "behavior_domain", lambda spark, sf_dir: _raw(events_log(spark, sf_dir))
    ),
    "quality_duplicates_shared": _shared_report(
        "duplicate_report", lambda spark, sf_dir: _raw(orders_log(spark, sf_dir))
    ),
    "clean_report_shared": _shared_report("clean_report"),
    "session_rollup_in_parts": _sessions_in_parts(30, lambda rollup: rollup),
    "session_stats_in_parts": _sessions_in_parts(30, sessions.session_stats),
    "session_stats_in_parts_long_gap": _sessions_in_parts(
        LONG_GAP_MINUTES, lambda rollup: sessions.session_stats(rollup, LONG_GAP_MINUTES)
    ),
    "session_lengths_in_parts": _sessions_in_parts(30, sessions.session_lengths),
    "retention_from_bitmaps": _from_bitmaps(cohorts.retention_of),
    "user_lifecycle_from_bitmaps": _from_bitmaps(cohorts.lifecycle_of),
    "active_days_from_bitmaps": _from_bitmaps(cohorts.active_days_of),
    "overview_from_bitmaps": _from_ranges(ranges.overview_of),
    "category_stats_from_bitmaps": _from_ranges(ranges.activity_of, "category_id"),
    "item_low_cvr_approx": _on_items(lambda base: items.item_low_cvr_approx(base, error=EXACT)),
    "item_low_cvr_approx_error": _on_items(items.traffic_sketch_holds),
    "item_hot_rank_sketched": lambda spark, sf_dir: items.item_hot_rank_sketched(
        orders_log(spark, sf_dir, user=False, category=False)
    ),
    "category_hot_rank_sketched": lambda spark, sf_dir: items.category_hot_rank_sketched(
        orders_log(spark, sf_dir, user=False), FEW
    ),
    "category_items_deep": lambda spark, sf_dir: items.category_items(
        orders_log(spark, sf_dir), DEEP
    ),
}

_SAME = {
    "clean_report_of_write": "clean_report_csv",
    "clean_two_batches": "clean_roundtrip",
    "clean_clustered_roundtrip": "clean_roundtrip",
    "item_behavior_stats_clustered": "item_behavior_stats",
    "quality_nulls_shared": "quality_nulls_csv",
    "quality_enum_shared": "quality_enum",
    "quality_duplicates_shared": "quality_duplicates",
    "clean_report_shared": "clean_report_csv",
    "session_rollup_in_parts": "session_rollup",
    "session_stats_in_parts": "session_stats",
    "session_stats_in_parts_long_gap": "session_stats_long_gap",
    "session_lengths_in_parts": "session_length_distribution",
    "retention_from_bitmaps": "retention",
    "user_lifecycle_from_bitmaps": "user_lifecycle",
    "active_days_from_bitmaps": "active_days_distribution",
    "overview_from_bitmaps": "overview_in_dates",
    "category_stats_from_bitmaps": "category_stats_in_dates",
    "item_low_cvr_approx": "item_low_cvr",
    "item_hot_rank_sketched": "item_hot_rank",
    "category_hot_rank_sketched": "category_hot_rank_few",
}

STORED_SQL: dict[str, str] = {
    **{name: ORACLE[of] for name, of in _SAME.items()},
    "clean_one_day_again": ONE_DAY_AGAIN,
    "item_low_cvr_approx_error": "SELECT true AS within_error",
    "category_items_deep": TOP_5000,
}
