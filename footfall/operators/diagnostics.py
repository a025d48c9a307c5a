"""Checks on conversion figures that look too good."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions import BUY, VIEW, rate, rows_of, saw, seen_by_user, users_where


def purchases_without_view(log: DataFrame, *keys: str) -> DataFrame:
    """Buy rows without a view by the same keys (user and date by default).

    One rollup per key set answers it: buys count where the set has no view.
    A key that is NULL matches nothing, so its buys are without a view.
    """
    keys = keys or ("user_id", "date")
    unmatched = " OR ".join(["views = 0", *(f"{key} IS NULL" for key in keys)])
    per_key = log.groupBy(*keys).agg(
        rows_of(log, BUY).alias("buys"), rows_of(log, VIEW).alias("views")
    )
    totals = per_key.agg(
        F.expr("coalesce(sum(buys), 0)").alias("purchases"),
        F.expr(f"coalesce(sum(CASE WHEN {unmatched} THEN buys END), 0)").alias("without_view"),
    )
    return totals.withColumn("share", rate("without_view", "purchases"))


def buyers_without_view(log: DataFrame) -> DataFrame:
    """Per item, buyers and those of them that never viewed it."""
    per_item = (
        seen_by_user(log, "item_id")
        .groupBy("item_id")
        .agg(
            users_where(saw(BUY)).alias("buyers"),
            users_where(saw(BUY), f"NOT {saw(VIEW)}").alias("without_view"),
        )
        .where("buyers > 0")
    )
    return per_item.withColumn("share", rate("without_view", "buyers"))


def cvr_over(base: DataFrame, percent: float = 100.0) -> DataFrame:
    """Items whose conversion lies above a percentage, highest first."""
    return base.where(F.col("pv_to_buy_rate") > percent).orderBy(
        F.desc("pv_to_buy_rate"), "item_id"
    )


def behavior_level_cvr(log: DataFrame) -> DataFrame:
    """Buy rows over view rows."""
    counts = log.agg(rows_of(log, VIEW).alias("pv"), rows_of(log, BUY).alias("buy"))
    return counts.withColumn("cvr", rate("buy", "pv"))
