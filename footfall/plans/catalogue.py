"""Named queries over the given tables.

User, time, session, funnel and segment analyses read ``events``; product
rankings and conversion read ``lineitem`` with the dimensions each needs.
Every query reads its whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.operators import (
    cleaning,
    cohorts,
    diagnostics,
    funnels,
    items,
    lookups,
    quality,
    rfm,
    sessions,
    traffic,
)
from footfall.params import RFM, ActiveDays, Rfm
from footfall.sources import (
    events_log,
    fresh_folder,
    load_clean,
    orders_log,
    part_categories,
    read_log,
    save,
    table,
    write_clean,
    write_rfm,
)
from footfall.sources.logs import RAW_COLUMNS

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries.
RANGE = (1704672000, 1705449599)  # 2024-01-08 00:00:00 to 2024-01-16 23:59:59 UTC
DATES = ("2024-01-08", "2024-01-16")
ITEM = 42
CATEGORY = 3
SEGMENT = "潜力用户"
LONG_GAP_MINUTES = 360
MIN_INTEREST = 25
HIGH_RATE = 40.0
FEW = 5  # a limit that cuts rankings with few groups
WIDE_DAYS = ActiveDays(((10, "1-10"), (14, "11-14"), (18, "15-18")), "more than 18")
# Cuts that spread the users of a month over all segments.
WIDE_RFM = Rfm(
    recency_bands=((0, 5), (1, 4), (3, 3), (5, 2)),
    frequency_bands=((9, 1), (12, 2), (15, 3), (18, 4)),
)
# Columns in which rows of the given tables do repeat.
ITEM_RANGE = (820454400, 946684799)  # 1996-01-01 00:00:00 to 1999-12-31 23:59:59 UTC
REPEATING = ("item_id", "category_id", "behavior", "timestamp")


def _on_events(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(events_log(spark, sf_dir))


def _on_orders(operator: Callable[[DataFrame], DataFrame], **needs: bool) -> Query:
    return lambda spark, sf_dir: operator(orders_log(spark, sf_dir, **needs))


def _on_segment(operator: Callable[..., DataFrame], segment: str = SEGMENT) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        log = events_log(spark, sf_dir)
        return operator(log, rfm.rfm_detail(log), segment)

    return query


def _raw(log: DataFrame) -> DataFrame:
    """The five raw columns with the types of the raw log."""
    types = {"behavior": "string"}
    return log.select(*(F.col(c).cast(types.get(c, "bigint")).alias(c) for c in RAW_COLUMNS))


def _csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_folder(spark, "raw")
    _raw(events_log(spark, sf_dir)).write.csv(path)
    return read_log(spark, path)


def _broken_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw CSV log with text for the user of every tenth item, read again."""
    path = fresh_folder(spark, "broken")
    raw = _raw(events_log(spark, sf_dir))
    user = F.when(F.col("item_id") % 10 == 0, F.lit("nobody"))
    raw.withColumn("user_id", user.otherwise(F.col("user_id").cast("string"))).write.csv(path)
    return read_log(spark, path)


def _repeating(log: DataFrame) -> DataFrame:
    return _raw(log).select(*REPEATING)


def _reference_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A clean log with the seven columns and date that other writers give."""
    path = fresh_folder(spark, "plain")
    log = cleaning.derive_time(_raw(events_log(spark, sf_dir)))
    write_clean(log.select(*RAW_COLUMNS, "datetime", "hour", "date"), path)
    return load_clean(spark, path)


def _in_dates(log: DataFrame) -> DataFrame:
    return lookups.in_dates(log, *DATES)


def _segment_in_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a date range by users whose segment comes from the whole log."""
    log = events_log(spark, sf_dir)
    return rfm.segment_hourly(_in_dates(log), rfm.rfm_detail(log), SEGMENT)


def _nested_as_text(log: DataFrame) -> DataFrame:
    """Top items of each category as one text, in rank order, with all their fields."""
    fields = ("rank", "item_id", "pv", "fav", "cart", "buy", "total", "interest_uv", "buy_uv")
    said = F.transform(
        "items",
        lambda x: F.concat_ws(
            ":", *(x[f] for f in fields), F.round(x["cvr"] * 100).cast("bigint")
        ),
    )
    return items.category_items_nested(log).select(
        "category_id", F.array_join(said, ",").alias("items")
    )


def _clean_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_folder(spark, "clean")
    write_clean(cleaning.clean(_csv_scan(spark, sf_dir), *RANGE), path)
    return load_clean(spark, path)


def _result_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_folder(spark, "result")
    result = traffic.daily_uv_pv(events_log(spark, sf_dir))
    save(result, path)
    return spark.read.schema(result.schema).json(path)


def _rfm_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_folder(spark, "rfm")
    write_rfm(rfm.rfm_detail(events_log(spark, sf_dir)), path)
    return spark.read.parquet(path)


def _batch_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Look up every part and every brand there is."""
    parts = part_categories(spark, sf_dir)
    requests = parts.select(F.lit("item").alias("kind"), F.col("item_id").alias("id")).unionAll(
        parts.select(F.lit("category"), F.col("category_id").cast("long")).distinct()
    )
    return lookups.batch_lookup(orders_log(spark, sf_dir), requests)


def _item_base(log: DataFrame) -> DataFrame:
    return items.item_cvr_base(log, MIN_INTEREST)


def _detail(log: DataFrame) -> DataFrame:
    return rfm.rfm_detail(log)


CATALOGUE: dict[str, Query] = {
    # ingest and cleaning
    "ingest_csv_scan": _csv_scan,
    "clean_time_range": _on_events(lambda log: cleaning.clip_time(_raw(log), *RANGE)),
    "clean_dedup": _on_orders(lambda log: cleaning.dedup(_raw(log))),
    "clean_dedup_items": _on_orders(
        lambda log: cleaning.dedup(_repeating(log.withColumn("user_id", F.lit(0)))), user=False
    ),
    "clean_report": _on_events(lambda log: cleaning.report(_raw(log), *RANGE)),
    "clean_report_items": _on_orders(
        lambda log: cleaning.report(_repeating(log.withColumn("user_id", F.lit(0))), *ITEM_RANGE),
        user=False,
    ),
    "clean_report_csv": lambda spark, sf_dir: cleaning.report(_broken_csv(spark, sf_dir), *RANGE),
    "clean_time_fields": _on_events(lambda log: cleaning.derive_time(_raw(log))),
    "clean_roundtrip": _clean_roundtrip,
    "result_roundtrip": _result_roundtrip,
    # quality
    "quality_report": _on_events(lambda log: quality.range_report(log, *RANGE)),
    "quality_nulls": lambda spark, sf_dir: quality.null_counts(table(spark, sf_dir, "events")),
    "quality_nulls_csv": lambda spark, sf_dir: quality.null_counts(_broken_csv(spark, sf_dir)),
    "quality_enum": _on_events(quality.behavior_domain),
    "quality_duplicates": _on_orders(lambda log: quality.duplicate_report(_raw(log))),
    "quality_duplicates_items": _on_orders(
        lambda log: quality.duplicate_report(_repeating(log.withColumn("user_id", F.lit(0)))),
        user=False,
    ),
    # users
    "daily_uv_pv": _on_events(traffic.daily_uv_pv),
    "retention": _on_events(cohorts.retention),
    "rfm_detail": _on_events(_detail),
    "rfm_detail_roundtrip": _rfm_roundtrip,
    "rfm_segments": _on_events(lambda log: rfm.rfm_segments(_detail(log))),
    "rfm_segments_wide": _on_events(lambda log: rfm.rfm_segments(rfm.rfm_detail(log, WIDE_RFM))),
    "rfm_score_distribution": _on_events(lambda log: rfm.rfm_scores(_detail(log))),
    "sessions_labelled": _on_events(
        lambda log: sessions.sessionize(
            log.select("event_id", "user_id", "behavior", "timestamp", "ts_us")
        )
    ),
    "session_rollup": _on_events(sessions.session_rollup),
    "session_stats": _on_events(lambda log: sessions.session_stats(sessions.session_rollup(log))),
    "session_stats_plain_log": lambda spark, sf_dir: sessions.session_stats(
        sessions.session_rollup(_reference_roundtrip(spark, sf_dir))
    ),
    "session_stats_long_gap": _on_events(
        lambda log: sessions.session_stats(
            sessions.session_rollup(log, LONG_GAP_MINUTES), LONG_GAP_MINUTES
        )
    ),
    "session_length_distribution": _on_events(
        lambda log: sessions.session_lengths(sessions.session_rollup(log))
    ),
    "behavior_paths": _on_events(sessions.behavior_paths),
    "behavior_paths_long_gap": _on_events(
        lambda log: sessions.behavior_paths(log, gap_minutes=LONG_GAP_MINUTES)
    ),
    "behavior_paths_3step": _on_events(sessions.behavior_paths_3step),
    "behavior_paths_3step_long_gap": _on_events(
        lambda log: sessions.behavior_paths_3step(log, LONG_GAP_MINUTES)
    ),
    "user_lifecycle": _on_events(cohorts.lifecycle),
    "first_purchase_gap": _on_events(cohorts.first_purchase_gap),
    "first_purchase_gap_split": _on_events(
        lambda log: cohorts.first_purchase_gap(log, split_negative=True)
    ),
    "active_days_distribution": _on_events(cohorts.active_days),
    "active_days_wide": _on_events(lambda log: cohorts.active_days(log, WIDE_DAYS)),
    # time
    "hourly_cvr": _on_events(traffic.hourly_cvr),
    "weekday_vs_weekend": _on_events(traffic.weekday_vs_weekend),
    "daily_funnel_trend": _on_events(traffic.daily_funnel),
    # products
    "item_hot_rank": _on_orders(items.item_hot_rank, user=False, category=False),
    "category_hot_rank": _on_orders(items.category_hot_rank, user=False),
    "category_hot_rank_few": _on_orders(
        lambda log: items.category_hot_rank(log, FEW), user=False
    ),
    "item_cvr_base": _on_orders(_item_base, category=False),
    "item_cvr_top": _on_orders(lambda log: items.item_cvr_top(_item_base(log)), category=False),
    "item_low_cvr": _on_orders(lambda log: items.item_low_cvr(_item_base(log)), category=False),
    "category_cvr": _on_orders(items.category_cvr),
    # conversion
    "conversion_funnel": _on_events(funnels.conversion_funnel),
    "conversion_funnel_detail": _on_events(funnels.conversion_funnel_detail),
    "behavior_distribution": _on_events(funnels.behavior_distribution),
    # lookups
    "available_dates": _on_events(lookups.available_dates),
    "result_date_filter": _on_events(
        lambda log: lookups.result_in_dates(cohorts.lifecycle(log), *DATES)
    ),
    "cohort_date_filter": _on_events(
        lambda log: lookups.result_in_dates(cohorts.retention(log), "2024-01-02", DATES[1])
    ),
    "overview": _on_events(lookups.overview),
    "overview_in_dates": _on_events(lambda log: lookups.overview(lookups.in_dates(log, *DATES))),
    "category_stats": _on_orders(items.category_stats),
    "category_stats_in_dates": _on_events(lambda log: items.category_stats(_in_dates(log))),
    "item_summary_in_dates": _on_events(lambda log: lookups.item_summary(_in_dates(log), ITEM)),
    "segment_hourly_in_dates": _segment_in_dates,
    "segment_top_categories_few": _on_segment(
        lambda log, detail, segment: rfm.segment_top_categories(log, detail, segment, FEW)
    ),
    "category_items_lookup": _on_orders(lambda log: items.category_items_lookup(log, CATEGORY)),
    "item_behavior_stats": _on_events(lambda log: lookups.item_behavior_stats(log, ITEM)),
    "item_daily_trend": _on_events(lambda log: lookups.item_daily_trend(log, ITEM)),
    "item_hourly_dist": _on_events(lambda log: lookups.item_hourly_dist(log, ITEM)),
    "item_summary": _on_events(lambda log: lookups.item_summary(log, ITEM)),
    "segments": _on_events(lambda log: rfm.rfm_segments(_detail(log))),
    "segment_hourly": _on_segment(rfm.segment_hourly),
    "segment_top_categories": _on_segment(rfm.segment_top_categories),
    "segment_behavior_dist": _on_segment(rfm.segment_behavior_dist),
    "segment_user_count": _on_events(lambda log: rfm.segment_user_count(_detail(log), SEGMENT)),
    "batch_lookup": _batch_lookup,
    # exports
    "item_details": _on_orders(items.item_details, category=False),
    "category_details": _on_orders(items.category_details),
    "category_details_few": _on_orders(lambda log: items.category_details(log, FEW)),
    "category_items": _on_orders(items.category_items),
    "category_items_nested": _on_orders(_nested_as_text),
    # dashboard
    "kpi_summary": _on_events(lookups.kpi_summary),
    "behavior_share": _on_events(
        lambda log: lookups.behavior_share(funnels.behavior_distribution(log), "buy")
    ),
    "high_value_hourly": _on_segment(rfm.segment_hourly, RFM.top_segment),
    # diagnostics
    "purchases_without_view": _on_events(diagnostics.purchases_without_view),
    "purchases_without_item_view": _on_events(
        lambda log: diagnostics.purchases_without_view(log, "user_id", "item_id", "date")
    ),
    "buyers_without_view": _on_orders(diagnostics.buyers_without_view, category=False),
    "cvr_over_100": _on_orders(lambda log: diagnostics.cvr_over(_item_base(log)), category=False),
    "cvr_over_threshold": _on_orders(
        lambda log: diagnostics.cvr_over(_item_base(log), HIGH_RATE), category=False
    ),
    "behavior_level_cvr": _on_events(diagnostics.behavior_level_cvr),
}
