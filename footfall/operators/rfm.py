"""Recency/frequency scoring of buyers and profiles of the segments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions import BUY, at_least, rows, top, up_to, users
from footfall.params import RFM, TOP_N, Rfm


def rfm_detail(log: DataFrame, params: Rfm = RFM) -> DataFrame:
    """One row per buyer: recency, frequency, scores and segment.

    Rows without a user make no buyer.  Recency counts back from the last date of the whole log, which enters as
    a scalar subquery.
    """
    last_date = log.agg(F.max("date")).scalar()
    buyers = (
        log.where((F.col("behavior") == BUY) & F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(F.max("date").alias("last_buy"), rows(log).alias("frequency"))
        .select("user_id", F.datediff(last_date, "last_buy").alias("recency"), "frequency")
    )
    scored = buyers.select(
        "*",
        up_to("recency", params.recency_bands, params.recency_beyond).alias("r_score"),
        up_to("frequency", params.frequency_bands, params.frequency_beyond).alias("f_score"),
    )
    weighted = f"r_score * {params.recency_weight}D + f_score * {params.frequency_weight}D"
    return scored.withColumn("total_score", F.expr(f"round({weighted}, 2)")).withColumn(
        "user_segment", at_least("total_score", params.segments, params.lowest_segment)
    )


def rfm_segments(detail: DataFrame) -> DataFrame:
    """Users per segment, largest first."""
    return (
        detail.groupBy("user_segment")
        .agg(F.count(F.lit(1)).alias("user_count"))
        .orderBy(F.desc("user_count"), "user_segment")
    )


def rfm_scores(detail: DataFrame) -> DataFrame:
    """Users per total score."""
    return (
        detail.groupBy("total_score")
        .agg(F.count(F.lit(1)).alias("user_count"))
        .orderBy("total_score")
    )


def _in_segment(per_user: DataFrame, detail: DataFrame, segment: str) -> DataFrame:
    """Restrict a per-user rollup to the users of one segment.

    The rollup comes before the join, so a user's rows are combined on the
    map side and no user is large at the join.  Where the segment is small
    enough to broadcast, Catalyst moves the semi join below the rollup.
    """
    members = detail.where(F.col("user_segment") == segment).select("user_id")
    return per_user.join(members, "user_id", "left_semi")


def _rows_by(log: DataFrame, key: str) -> DataFrame:
    return log.groupBy("user_id", key).agg(rows(log).alias("n"))


def segment_hourly(log: DataFrame, detail: DataFrame, segment: str) -> DataFrame:
    """Rows per hour of day of the users in a segment."""
    return (
        _in_segment(_rows_by(log, "hour"), detail, segment)
        .groupBy("hour")
        .agg(F.sum("n").alias("behavior_count"))
        .orderBy("hour")
    )


def segment_top_categories(
    log: DataFrame, detail: DataFrame, segment: str, n: int | None = TOP_N.segment_categories
) -> DataFrame:
    """Categories with the most rows by users of a segment, and those users."""
    per_category = (
        _in_segment(_rows_by(log, "category_id"), detail, segment)
        .groupBy("category_id")
        .agg(F.sum("n").alias("behavior_count"), users().alias("user_count"))
    )
    return top(per_category, n, F.desc("behavior_count"), F.col("category_id"))


def segment_behavior_dist(log: DataFrame, detail: DataFrame, segment: str) -> DataFrame:
    """Rows per behaviour of the users in a segment."""
    return (
        _in_segment(_rows_by(log, "behavior"), detail, segment)
        .groupBy("behavior")
        .agg(F.sum("n").alias("count"))
    )


def segment_user_count(detail: DataFrame, segment: str) -> DataFrame:
    """Number of users in a segment."""
    return detail.where(F.col("user_segment") == segment).agg(
        F.lit(segment).alias("user_segment"), F.count(F.lit(1)).alias("user_count")
    )
