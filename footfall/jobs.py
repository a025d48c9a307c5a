"""Jobs over a whole log: clean it, save all analyses, save the lookup tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Observation, SparkSession

from footfall.functions import rollup
from footfall.operators import cleaning, cohorts, funnels, items, quality, rfm, sessions, traffic
from footfall.params import BUSINESS_ZONE, RANGE_END, RANGE_START
from footfall.sources import load_clean, read_log, save, write_clean, write_rfm

Analysis = Callable[[DataFrame], DataFrame]

# Need every row of the log and its time.
ROW_ANALYSES: dict[str, Analysis] = {
    "session_stats": lambda log: sessions.session_stats(sessions.session_rollup(log)),
    "behavior_paths": sessions.behavior_paths,
    "behavior_paths_3step": sessions.behavior_paths_3step,
}

# Give the same result on the log rolled up to these columns.
USER_KEYS = ("user_id", "date", "hour", "behavior")
USER_ANALYSES: dict[str, Analysis] = {
    "daily_uv_pv": traffic.daily_uv_pv,
    "retention_rate": cohorts.retention,
    "user_lifecycle": cohorts.lifecycle,
    "first_purchase_gap": cohorts.first_purchase_gap,
    "active_days_distribution": cohorts.active_days,
    "hourly_cvr": traffic.hourly_cvr,
    "weekday_vs_weekend": traffic.weekday_vs_weekend,
    "daily_funnel_trend": traffic.daily_funnel,
    "conversion_funnel": funnels.conversion_funnel,
    "conversion_funnel_detail": funnels.conversion_funnel_detail,
    "behavior_distribution": funnels.behavior_distribution,
}

ITEM_KEYS = ("category_id", "item_id", "user_id", "behavior")
ITEM_ANALYSES: dict[str, Analysis] = {
    "item_hot_rank": items.item_hot_rank,
    "category_hot_rank": items.category_hot_rank,
    "item_cvr_top": lambda log: items.item_cvr_top(items.item_cvr_base(log)),
    "item_low_cvr": lambda log: items.item_low_cvr(items.item_cvr_base(log)),
    "category_cvr": items.category_cvr,
}

# Computed from the stored RFM table, which is written once for all of them.
SEGMENT_ANALYSES: dict[str, Analysis] = {
    "rfm_segments": rfm.rfm_segments,
    "rfm_score_distribution": rfm.rfm_scores,
}

ANALYSES = {*ROW_ANALYSES, *USER_ANALYSES, *ITEM_ANALYSES, *SEGMENT_ANALYSES}

EXPORTS: dict[str, Analysis] = {
    "item_details": items.item_details,
    "category_details": items.category_details,
    "category_items": items.category_items_nested,
}


def clean_log(
    spark: SparkSession,
    raw: str,
    clean: str,
    start: int = RANGE_START,
    end: int = RANGE_END,
    zone: str = BUSINESS_ZONE,
    only_days: bool = False,
    clustered: bool = False,
) -> dict[str, int]:
    """Clean the raw CSV log, write it partitioned by date, and return its counts.

    The counts of ``cleaning.report`` are taken while the log is written and
    saved beside it, as ``<clean>_report``.  With ``only_days``, days that the
    cleaned log has no rows of stay as they are stored.
    """
    counts = Observation("clean")

    def counted(rows: DataFrame) -> DataFrame:
        return cleaning.kept(rows.observe(counts, *cleaning.tallies()))

    rows = cleaning.marked(read_log(spark, raw), start, end, zone)
    write_clean(rows, clean, only_days, clustered=clustered, last_step=counted)
    return _saved_counts(spark, counts.get, clean)


def add_batch(
    spark: SparkSession,
    raw: str,
    clean: str,
    start: int = RANGE_START,
    end: int = RANGE_END,
    zone: str = BUSINESS_ZONE,
) -> None:
    """Clean a raw CSV batch and append the rows that the clean log does not hold yet."""
    batch = cleaning.clean(read_log(spark, raw), start, end, zone)
    write_clean(cleaning.unseen(batch, load_clean(spark, clean)), clean, append=True)


def _saved_counts(spark: SparkSession, counts: dict[str, int], clean: str) -> dict[str, int]:
    frame = spark.createDataFrame([tuple(counts.values())], list(counts))
    save(frame, f"{clean.rstrip('/')}_report")
    return counts


def check(log: DataFrame, output: str, start: int = RANGE_START, end: int = RANGE_END) -> None:
    """Save the quality reports of a raw or clean log, each under its name.

    The log is read once, into counts per behaviour that are stored; every
    report comes from those.
    """
    facts = _stored(quality.facts(log, start, end), f"{output}/facts")
    for name, report in quality.reports(facts).items():
        save(report, f"{output}/{name}")


def _stored(frame: DataFrame, path: str) -> DataFrame:
    """Write a frame that several analyses share and read it back."""
    save(frame, path, fmt="parquet")
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _save_all(analyses: dict[str, Analysis], log: DataFrame, output: str) -> None:
    for name, analysis in analyses.items():
        save(analysis(log), f"{output}/{name}")


def analyse(
    log: DataFrame,
    output: str,
    only: Iterable[str] | None = None,
    validate: tuple[int, int] | None = None,
) -> None:
    """Save the analyses of a log, each under its name below ``output``.

    ``validate`` is a closed range of times: the quality reports of the log are
    saved first, below ``output``/checks.

    Analyses that need the same few columns share one stored rollup of the
    log instead of scanning and shuffling all of it again each time.
    """
    wanted = ANALYSES if only is None else set(only)
    if wanted - ANALYSES:
        raise ValueError(f"no such analysis: {', '.join(sorted(wanted - ANALYSES))}")

    if validate:
        check(log, f"{output}/checks", *validate)

    def chosen(analyses: dict[str, Analysis]) -> dict[str, Analysis]:
        return {name: analysis for name, analysis in analyses.items() if name in wanted}

    _save_all(chosen(ROW_ANALYSES), log, output)
    if chosen(USER_ANALYSES) or chosen(SEGMENT_ANALYSES):
        by_user = _stored(rollup(log, *USER_KEYS), f"{output}/rollups/user")
        _save_all(chosen(USER_ANALYSES), by_user, output)
        if chosen(SEGMENT_ANALYSES):
            stored = f"{output}/rfm_detail"
            write_rfm(rfm.rfm_detail(by_user), stored)
            detail = log.sparkSession.read.parquet(stored)
            _save_all(chosen(SEGMENT_ANALYSES), detail, output)
    if chosen(ITEM_ANALYSES):
        by_item = _stored(rollup(log, *ITEM_KEYS), f"{output}/rollups/item")
        _save_all(chosen(ITEM_ANALYSES), by_item, output)


def export(log: DataFrame, output: str) -> None:
    """Save the lookup tables of items and categories."""
    by_item = _stored(rollup(log, *ITEM_KEYS), f"{output}/rollups/item")
    _save_all(EXPORTS, by_item, output)
