"""Traffic per day, per hour of day and per kind of day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions import (
    BUY,
    CART,
    FAV,
    VIEW,
    rate,
    rows,
    rows_of,
    saw,
    seen_by_user,
    users_where,
)

# The names of the two kinds of day.
_WEEKEND = "周末"
_WORKING_DAY = "工作日"


def daily_uv_pv(log: DataFrame) -> DataFrame:
    """Distinct users, views and rows per date."""
    return (
        log.groupBy("date")
        .agg(
            F.count_distinct("user_id").alias("uv"),
            rows_of(log, VIEW).alias("pv"),
            rows(log).alias("total_behavior"),
        )
        .orderBy("date")
    )


def hourly_cvr(log: DataFrame) -> DataFrame:
    """Views, buys and their users per hour of day, with both conversions."""
    per_user = log.groupBy("hour", "user_id").agg(
        rows_of(log, VIEW).alias("views"),
        rows_of(log, BUY).alias("buys"),
        rows(log).alias("n"),
    )
    per_hour = per_user.groupBy("hour").agg(
        F.sum("views").alias("pv_count"),
        F.sum("buys").alias("buy_count"),
        users_where("views > 0").alias("pv_uv"),
        users_where("buys > 0").alias("buy_uv"),
        F.sum("n").alias("total_behavior"),
    )
    return per_hour.select(
        "*",
        rate("buy_count", "pv_count").alias("pv_to_buy_rate"),
        rate("buy_uv", "pv_uv").alias("uv_cvr"),
    ).orderBy("hour")


def weekday_vs_weekend(log: DataFrame) -> DataFrame:
    """Working days against weekends; a kind of day without rows is absent.

    Users are counted on one row per (kind, user) and days on the distinct
    dates, so no row is multiplied for two distinct counts in one aggregate.
    """
    kind = F.when(F.dayofweek("date").isin(1, 7), _WEEKEND).otherwise(_WORKING_DAY)
    per_user = log.groupBy(kind.alias("type"), "user_id").agg(
        rows(log).alias("n"),
        rows_of(log, VIEW).alias("views"),
        rows_of(log, BUY).alias("buys"),
    )
    days = log.select("date").distinct().groupBy(kind.alias("type"))
    per_kind = per_user.groupBy("type").agg(
        F.sum("n").alias("total_behavior"),
        F.count("user_id").alias("uv"),
        F.sum("views").alias("pv"),
        F.sum("buys").alias("buy"),
    )
    per_kind = per_kind.join(days.agg(F.count("date").alias("days")), "type")
    average = F.expr("CAST(bround(total_behavior / days, 0) AS BIGINT)")
    return per_kind.select(
        "type",
        "days",
        "total_behavior",
        average.alias("daily_avg_behavior"),
        "uv",
        "pv",
        "buy",
        rate("buy", "pv").alias("buy_rate"),
    )


def daily_funnel(log: DataFrame) -> DataFrame:
    """Strict funnel per date: viewed, also carted or favourited, also bought."""
    interested = (saw(VIEW), saw(CART, FAV))
    per_date = (
        seen_by_user(log, "date")
        .groupBy("date")
        .agg(
            users_where(saw(VIEW)).alias("pv_uv"),
            users_where(*interested).alias("interest_uv"),
            users_where(*interested, saw(BUY)).alias("buy_uv"),
        )
        .where("pv_uv > 0")
    )
    return per_date.select(
        "*",
        rate("interest_uv", "pv_uv").alias("pv_to_interest_rate"),
        rate("buy_uv", "interest_uv").alias("interest_to_buy_rate"),
        rate("buy_uv", "pv_uv").alias("overall_cvr"),
    ).orderBy("date")
