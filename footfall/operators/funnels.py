"""Whole-period funnel and the mix of behaviours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions import BUY, CART, FAV, VIEW, rate, rows, saw, seen_by_user, users_where

# The stage names.
_STAGES = ("浏览(pv)", "加购/收藏(cart+fav)", "购买(buy)")


def conversion_funnel_detail(log: DataFrame) -> DataFrame:
    """Users passing each stage, against the first and the previous stage.

    A user passes a stage having done it and all stages before it at any time
    in the period.
    """
    interested = (saw(VIEW), saw(CART, FAV))
    passed = seen_by_user(log).agg(
        users_where(saw(VIEW)).alias("s1"),
        users_where(*interested).alias("s2"),
        users_where(*interested, saw(BUY)).alias("s3"),
    )

    def row(name: str, count: str, overall: Column, step: Column) -> Column:
        return F.struct(
            F.lit(name).alias("stage"),
            F.col(count).alias("user_count"),
            overall.alias("conversion_rate"),
            step.alias("step_conversion_rate"),
        )

    first, second, third = _STAGES
    stages = F.array(
        row(first, "s1", F.lit(100.0), F.lit(100.0)),
        row(second, "s2", rate("s2", "s1"), rate("s2", "s1")),
        row(third, "s3", rate("s3", "s1"), rate("s3", "s2")),
    )
    return passed.select(F.inline(stages))


def conversion_funnel(log: DataFrame) -> DataFrame:
    """Users passing each stage, against the first stage."""
    return conversion_funnel_detail(log).drop("step_conversion_rate")


def behavior_distribution(log: DataFrame) -> DataFrame:
    """Rows per behaviour and their share of all rows.

    The share is taken over the grouped rows, of which there is one per
    behaviour code.
    """
    counts = log.groupBy("behavior").agg(rows(log).alias("count"))
    everything = "sum(count) OVER (PARTITION BY 0)"
    return counts.withColumn("percentage", rate("count", everything)).orderBy(
        F.desc("count"), "behavior"
    )
