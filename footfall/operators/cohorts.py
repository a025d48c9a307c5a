"""Retention and user lifecycle, all on one row per (user, active date).

The active days of a user also fit a bitmap, 64 days a word, that can be stored
and merged with the bitmap of further days; every result here follows from it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions import BUY, VIEW, rate, up_to
from footfall.params import ACTIVE_DAYS, RETENTION_DAYS, ActiveDays

# The labels of the distributions.
_GAP_BANDS = ((1, "1天内"), (3, "2-3天"), (7, "4-7天"))
_GAP_BEYOND = "7天以上"
_GAP_SAME_DAY = "当天购买"
_GAP_NEGATIVE = "先购后看"


def user_days(log: DataFrame) -> DataFrame:
    """Distinct (user, date) with the user's first active date.

    One aggregate per user collects the distinct dates; it combines on the map
    side and holds no more than the days of the log, however many rows a user
    has.
    """
    return _dates_of_users(log).select(
        "user_id", F.explode("dates").alias("date"), F.array_min("dates").alias("first_date")
    )


def _dates_of_users(log: DataFrame) -> DataFrame:
    """The set of active dates of every user there is."""
    known = log.where("user_id IS NOT NULL AND date IS NOT NULL")
    return known.groupBy("user_id").agg(F.collect_set("date").alias("dates"))


def retention(
    log: DataFrame, days: Sequence[int] = RETENTION_DAYS, flag_observable: bool = False
) -> DataFrame:
    """Users of each first date that are active again exactly N days later.

    A cohort whose day N lies past the end of the log gets 0, like one that
    nobody returned from; ``flag_observable`` adds a column per N that tells
    the two apart.
    """
    last_date = log.agg(F.max("date")).scalar() if flag_observable else None
    return _retention(user_days(log), days, last_date)


def _retention(user_days: DataFrame, days: Sequence[int], last_date: Column | None) -> DataFrame:
    cohorts = (
        user_days.groupBy("first_date")
        .agg(
            *(
                F.expr(f"count_if(datediff(date, first_date) = {n})").alias(name)
                for n, name in [(0, "new_users"), *((n, f"retained_day{n}") for n in days)]
            )
        )
    )
    columns = ["first_date", "new_users"]
    for n in days:
        retained = f"retained_day{n}"
        columns += [retained, rate(retained, "new_users").alias(f"retention_rate_day{n}")]
        if last_date is not None:
            reached = F.date_add("first_date", n) <= last_date
            columns.append(reached.alias(f"observable_day{n}"))
    return cohorts.select(*columns).orderBy("first_date")


def lifecycle(log: DataFrame) -> DataFrame:
    """New and returning users per date."""
    return _lifecycle(user_days(log))


def _lifecycle(user_days: DataFrame) -> DataFrame:
    per_date = (
        user_days.groupBy("date")
        .agg(
            F.count(F.lit(1)).alias("total_users"),
            F.expr("count_if(date = first_date)").alias("new_users"),
        )
    )
    return per_date.select(
        "*",
        F.expr("total_users - new_users").alias("returning_users"),
        rate("new_users", "total_users").alias("new_user_ratio"),
    ).orderBy("date")


def first_purchase_gap(log: DataFrame, split_negative: bool = False) -> DataFrame:
    """Days from first view to first buy, for users that did both.

    Users that bought before their first view fall into the shortest
    non-zero band unless ``split_negative`` gives them their own.
    """
    firsts = (
        log.where(f"behavior IN ('{VIEW}', '{BUY}') AND user_id IS NOT NULL")
        .groupBy("user_id")
        .agg(
            F.expr(f"min(CASE WHEN behavior = '{VIEW}' THEN date END)").alias("viewed"),
            F.expr(f"min(CASE WHEN behavior = '{BUY}' THEN date END)").alias("bought"),
        )
        .where("viewed IS NOT NULL AND bought IS NOT NULL")
    )
    gap = "datediff(bought, viewed)"
    label = F.when(F.expr(f"{gap} = 0"), _GAP_SAME_DAY)
    if split_negative:
        label = label.when(F.expr(f"{gap} < 0"), _GAP_NEGATIVE)
    label = label.otherwise(up_to(gap, _GAP_BANDS, _GAP_BEYOND))
    return (
        firsts.groupBy(label.alias("gap_group"))
        .agg(F.count(F.lit(1)).alias("user_count"))
        .orderBy("gap_group")
    )


def active_days(log: DataFrame, params: ActiveDays = ACTIVE_DAYS) -> DataFrame:
    """Users by number of distinct active dates, in the given bands."""
    return _active_days(_dates_of_users(log).select(F.size("dates").alias("days")), params)


def _active_days(per_user: DataFrame, params: ActiveDays) -> DataFrame:
    band = up_to("days", params.bands, params.beyond)
    return (
        per_user.groupBy(band.alias("active_group"))
        .agg(F.count(F.lit(1)).alias("user_count"))
        .orderBy(F.desc("user_count"), "active_group")
    )


BITMAP_SCHEMA = "user_id BIGINT, base INT, words ARRAY<BIGINT>"


def activity_bitmaps(log: DataFrame) -> DataFrame:
    """``user_id``, ``base`` and ``words``: bit d % 64 of word d div 64 - base is epoch day d."""
    days = _dates_of_users(log).select(
        "user_id", F.transform("dates", lambda d: F.unix_date(d)).alias("days")
    )
    bits = """transform(sequence(base, shiftright(array_max(days), 6)), w ->
      aggregate(filter(days, d -> shiftright(d, 6) = w), 0L, (a, d) -> a | shiftleft(1L, d & 63)))"""
    based = days.withColumn("base", F.expr("shiftright(array_min(days), 6)"))
    return based.select("user_id", "base", F.expr(bits).alias("words"))


def merge_bitmaps(stored: DataFrame, more: DataFrame) -> DataFrame:
    """Bitmaps of the days of both sides; a day in both counts once.

    Where ``stored`` is bucketed by user, only ``more`` is shuffled.
    """
    ours, theirs = stored.alias("s"), more.alias("m")
    joined = ours.join(theirs, "user_id", "full_outer").selectExpr(
        "user_id",
        "least(s.base, m.base) AS base",
        "greatest(s.base + size(s.words), m.base + size(m.words)) - 1 AS last",
        "s.base AS s_base",
        "s.words AS s_words",
        "m.base AS m_base",
        "m.words AS m_words",
    )
    either = """transform(sequence(base, last), w ->
      coalesce(get(s_words, w - s_base), 0L) | coalesce(get(m_words, w - m_base), 0L))"""
    return joined.selectExpr("user_id", "base", f"{either} AS words")


def user_days_of(bitmaps: DataFrame) -> DataFrame:
    """What ``user_days`` gives, from bitmaps and without a shuffle."""
    days = """transform(filter(sequence(base * 64, (base + size(words)) * 64 - 1), d ->
      shiftright(words[shiftright(d, 6) - base], d & 63) & 1 = 1), d -> date_from_unix_date(d))"""
    dated = bitmaps.select("user_id", F.expr(days).alias("dates"))
    return dated.select(
        "user_id", F.explode("dates").alias("date"), F.array_min("dates").alias("first_date")
    )


def retention_of(bitmaps: DataFrame, days: Sequence[int] = RETENTION_DAYS) -> DataFrame:
    """What ``retention`` gives, from bitmaps."""
    return _retention(user_days_of(bitmaps), days, None)


def lifecycle_of(bitmaps: DataFrame) -> DataFrame:
    """What ``lifecycle`` gives, from bitmaps."""
    return _lifecycle(user_days_of(bitmaps))


def active_days_of(bitmaps: DataFrame, params: ActiveDays = ACTIVE_DAYS) -> DataFrame:
    """What ``active_days`` gives, from bitmaps."""
    days = F.expr("aggregate(words, 0, (n, w) -> n + bit_count(w))")
    return _active_days(bitmaps.select(days.alias("days")), params)
