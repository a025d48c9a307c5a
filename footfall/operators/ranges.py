"""Distinct users of any date range, from bitmaps per day instead of the log.

Distinct users do not add up over days, but sets of users do.  Each (date, key)
has its users as exact bitmaps of 32,768 ids, one for each kind of user; a range
is the union of its days.  Row counts do add up and are a rollup of their own.
A bitmap takes 4 KB for any number of users, so this is for keys that many users
meet, such as the whole log or categories, not for single items.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions import BUY, CART, FAV, VIEW, rate, rollup, rows, rows_of, saw, seen_by_user

_KINDS = {
    "uv": "true",
    "pv_uv": saw(VIEW),
    "interest_uv": saw(VIEW, CART, FAV),
    "buy_uv": saw(BUY),
}


def user_bitmaps(log: DataFrame, *keys: str) -> DataFrame:
    """Users of each (date, keys) by kind, one row per 32,768 user ids.

    Rows are first reduced to one per (date, keys, user), combined on the map
    side.  Rows without a user or a date are in no bitmap.
    """
    known = log.where("user_id IS NOT NULL AND date IS NOT NULL")
    place = "bitmap_bit_position(user_id)"
    return (
        seen_by_user(known, "date", *keys)
        .groupBy("date", *keys, F.expr("bitmap_bucket_number(user_id)").alias("bucket"))
        .agg(
            *(
                F.expr(f"bitmap_construct_agg(CASE WHEN {holds} THEN {place} END)").alias(kind)
                for kind, holds in _KINDS.items()
            )
        )
    )


def day_counts(log: DataFrame, *keys: str) -> DataFrame:
    """Rows of each (date, keys, behaviour), as a rollup of the log."""
    return rollup(log.where("date IS NOT NULL"), "date", *keys, "behavior")


def users_of(bitmaps: DataFrame, *keys: str) -> DataFrame:
    """Distinct users of all days that the bitmaps cover, by kind."""
    united = bitmaps.groupBy(*keys, "bucket").agg(
        *(F.bitmap_or_agg(kind).alias(kind) for kind in _KINDS)
    )
    return united.groupBy(*keys).agg(
        *(F.coalesce(F.sum(F.bitmap_count(kind)), F.lit(0)).alias(kind) for kind in _KINDS)
    )


def overview_of(bitmaps: DataFrame, counts: DataFrame) -> DataFrame:
    """What ``lookups.overview`` gives for the days of both frames."""
    total = counts.agg(rows(counts).alias("total_behavior"))
    found = users_of(bitmaps).select(
        F.col("uv"), F.col("pv_uv").alias("pv"), F.col("buy_uv").alias("buy"), "interest_uv"
    )
    totals = found.withColumn("total_behavior", total.scalar())
    return totals.select("total_behavior", "uv", "pv", "buy", rate("buy", "interest_uv").alias("cvr"))


def activity_of(bitmaps: DataFrame, counts: DataFrame, *keys: str) -> DataFrame:
    """What ``activity`` gives per key for the days of both frames; one row a key is joined."""
    measured = counts.groupBy(*keys).agg(
        *(rows_of(counts, b).alias(b) for b in (VIEW, FAV, CART, BUY)),
        rows(counts).alias("total"),
    )
    kinds = ("pv_uv", "interest_uv", "buy_uv")
    users = users_of(bitmaps, *keys).select(*(F.col(k).alias(f"of_{k}") for k in keys), *kinds)
    same = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"of_{k}")) for k in keys))
    return measured.join(users, same, "left").select(
        *keys, VIEW, FAV, CART, BUY, "total",
        *(F.coalesce(k, F.lit(0)).alias(k) for k in kinds),
        F.coalesce(rate("buy_uv", "interest_uv"), F.lit(0.0)).alias("cvr"),
    )
