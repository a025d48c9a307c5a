"""Parametrised lookups and the figures of the dashboard."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions import (
    BUY,
    CART,
    FAV,
    VIEW,
    activity,
    rate,
    rows,
    rows_of,
    saw,
    seen_by_user,
    users_where,
)

Date = dt.date | str | None


def available_dates(log: DataFrame) -> DataFrame:
    """Distinct dates of the log, ascending."""
    return log.select("date").distinct().orderBy("date")


def _within(frame: DataFrame, column: str, start: Date, end: Date) -> DataFrame:
    value = F.col(column)
    if start is not None:
        frame = frame.where(value >= F.lit(start).cast("date"))
    if end is not None:
        frame = frame.where(value <= F.lit(end).cast("date"))
    return frame


def in_dates(log: DataFrame, start: Date = None, end: Date = None) -> DataFrame:
    """Log rows of the inclusive date range; prunes date partitions."""
    return _within(log, "date", start, end)


def result_in_dates(result: DataFrame, start: Date = None, end: Date = None) -> DataFrame:
    """Result rows of the date range, by ``first_date`` or else ``date``.

    A result with neither column is returned as it is.
    """
    for column in ("first_date", "date"):
        if column in result.columns:
            return _within(result, column, start, end)
    return result


def overview(log: DataFrame) -> DataFrame:
    """Rows, users, viewers, buyers and buyers over interested users."""
    per_user = log.groupBy("user_id").agg(
        rows(log).alias("n"),
        F.expr(f"bool_or(behavior = '{VIEW}')").alias("viewed"),
        F.expr(f"bool_or(behavior IN ('{VIEW}', '{CART}', '{FAV}'))").alias("interested"),
        F.expr(f"bool_or(behavior = '{BUY}')").alias("bought"),
    )
    totals = per_user.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_behavior"),
        F.count("user_id").alias("uv"),
        users_where("viewed").alias("pv"),
        users_where("bought").alias("buy"),
        users_where("interested").alias("interested"),
    )
    return totals.select(
        "total_behavior",
        "uv",
        "pv",
        "buy",
        rate("buy", "interested").alias("cvr"),
    )


def _item(log: DataFrame, item_id: int) -> DataFrame:
    return log.where(F.col("item_id") == item_id)


def item_behavior_stats(log: DataFrame, item_id: int) -> DataFrame:
    """Rows of one item per behaviour."""
    return _item(log, item_id).groupBy("behavior").agg(rows(log).alias("count"))


def item_daily_trend(log: DataFrame, item_id: int) -> DataFrame:
    """Rows of one item per date and behaviour."""
    return (
        _item(log, item_id)
        .groupBy("date", "behavior")
        .agg(rows(log).alias("count"))
        .orderBy("date", "behavior")
    )


def item_hourly_dist(log: DataFrame, item_id: int) -> DataFrame:
    """Rows of one item per hour of day."""
    return (
        _item(log, item_id)
        .groupBy("hour")
        .agg(rows(log).alias("count"))
        .orderBy("hour")
    )


def item_summary(log: DataFrame, item_id: int) -> DataFrame:
    """Viewers of one item and its buyers over interested users."""
    counts = seen_by_user(_item(log, item_id)).agg(
        users_where(saw(VIEW)).alias("uv"),
        users_where(saw(VIEW, CART, FAV)).alias("interest_uv"),
        users_where(saw(BUY)).alias("buy_uv"),
    )
    return counts.select(
        F.lit(item_id).alias("item_id"),
        "uv",
        rate("buy_uv", "interest_uv").alias("cvr"),
    )


def batch_lookup(log: DataFrame, requests: DataFrame) -> DataFrame:
    """All measures of the requested items and categories.

    ``requests`` has columns ``kind`` (``item`` or ``category``) and ``id``.
    An id without rows in the log gives no row.  The log is read once: a row
    counts once for its item and once for its category, in one rollup by kind
    and id.  The semi join stands above it; where the requests are few enough
    to broadcast, Catalyst moves it below, so that rows nobody asks for do not
    reach the shuffle.
    """
    ids = F.col("id").try_cast("bigint").alias("id")
    wanted = requests.select("kind", ids).distinct()
    both = F.array(
        *(
            F.struct(F.lit(kind).alias("kind"), F.col(f"{kind}_id").cast("bigint").alias("id"))
            for kind in ("item", "category")
        )
    )
    return activity(log.select("*", F.inline(both)), "kind", "id", only=wanted)


def kpi_summary(log: DataFrame) -> DataFrame:
    """Headline figures of the log, in one pass.

    ``total_uv`` is the best day's users, not the users of the period.
    """
    per_user = log.groupBy("date", "user_id").agg(
        rows(log).alias("n"), rows_of(log, VIEW).alias("views"), rows_of(log, BUY).alias("buys")
    )
    daily = per_user.groupBy("date").agg(
        F.count("user_id").alias("uv"), *(F.sum(c).alias(c) for c in ("n", "views", "buys"))
    )
    totals = daily.agg(
        F.sum("n").alias("total_records"),
        F.max("uv").alias("total_uv"),
        F.sum("views").alias("total_pv"),
        F.coalesce(F.sum("buys"), F.lit(0)).alias("total_buy"),
    )
    return totals.withColumn("avg_cvr", rate("total_buy", "total_pv"))


def behavior_share(distribution: DataFrame, behavior: str) -> DataFrame:
    """Rows of one behaviour and their share of all rows."""
    return distribution.where(F.col("behavior") == behavior)
