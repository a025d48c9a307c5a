"""Rankings and conversion of items and categories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
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
    top,
    users,
    users_where,
)
from footfall.functions.measures import ROWS
from footfall.params import ITEM_CONVERSION, TOP_N


def hot_counts(log: DataFrame, key: str) -> DataFrame:
    """Rows per behaviour and in total for each key."""
    return log.groupBy(key).agg(
        *(rows_of(log, b).alias(b) for b in (VIEW, FAV, CART, BUY)),
        rows(log).alias("total"),
    )


def hot_rank(log: DataFrame, key: str, n: int | None) -> DataFrame:
    """Rows per behaviour and in total for each key, largest total first."""
    return top(hot_counts(log, key), n, F.desc("total"), F.col(key))


def item_hot_rank(log: DataFrame, n: int | None = TOP_N.items) -> DataFrame:
    return hot_rank(log, "item_id", n)


def category_hot_rank(log: DataFrame, n: int | None = TOP_N.categories) -> DataFrame:
    return hot_rank(log, "category_id", n)


def heavy_keys(log: DataFrame, key: str, tracked: int, parts: int = 256) -> DataFrame:
    """One row: ``names``, keys that may be frequent, ``n_rows``, and ``unseen``.

    A key outside ``names`` has at most ``unseen`` rows.  The sketch follows
    ``tracked`` keys, whatever their number in the log, and is merged in two
    steps, so that no task reads the sketches of all others.
    """
    sketch = F.expr(f"approx_top_k_accumulate({key}, {tracked})")
    by_part = log.groupBy((F.spark_partition_id() % parts).alias("part")).agg(
        sketch.alias("state"), rows(log).alias("n_rows")
    )
    merged = by_part.agg(
        F.expr(f"approx_top_k_combine(state, {tracked})").alias("state"),
        F.sum("n_rows").alias("n_rows"),
    )
    found = merged.select(
        F.expr(f"approx_top_k_estimate(state, {tracked})").alias("found"),
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
    )
    # An estimate is off by at most 3.5 rows in ``tracked``, and a key is named
    # once its least possible count exceeds that, so others have twice as many
    # at most.  Where ``tracked`` keys are named, more may come after the last.
    cut = F.when(F.size("found") >= tracked, F.array_min("found.count")).otherwise(0)
    off = F.ceil(F.col("n_rows") * F.lit(7.0) / tracked)
    return found.select(
        F.col("found.item").alias("names"), "n_rows", F.greatest(cut, off).alias("unseen")
    )


def hot_rank_sketched(log: DataFrame, key: str, n: int, tracked: int) -> DataFrame:
    """As ``hot_rank``, without a shuffle of all keys where few of them stand out.

    Keys found by a sketch, and NULL, are counted exactly in a second scan.
    Another key has no more rows than the sketch can miss, nor more than are
    left over by those counted.  If the last place has more, the ranking is
    whole; otherwise all keys are counted.  The choice is made inside the plan
    and never shows in the result.  A rollup of the log, whose rows weigh
    differently, is small already and ranked as ever.
    """
    if ROWS in log.columns:
        return hot_rank(log, key, n)
    sketch = heavy_keys(log, key, tracked)
    names = sketch.select(F.explode(F.concat(F.array(F.lit(None)), "names")).alias("__name"))
    chosen = log.join(F.broadcast(names), F.col(key).eqNullSafe(F.col("__name")), "left_semi")
    counted = hot_counts(chosen, key)
    order = (F.desc("total"), F.col(key))
    ranked = top(counted, n, *order)
    seen = counted.agg(F.coalesce(F.sum("total"), F.lit(0))).scalar()
    last = ranked.agg(F.when(F.count(F.lit(1)) == n, F.min("total")).otherwise(0)).scalar()
    missed = sketch.select(F.least(F.col("n_rows") - seen, "unseen").alias("most"))
    whole = missed.select((F.col("most") == 0) | (F.col("most") < last)).scalar()
    every = hot_rank(log.where(~whole), key, n)
    return top(ranked.where(whole).unionByName(every), n, *order)


def item_hot_rank_sketched(
    log: DataFrame, n: int = TOP_N.items, tracked: int = TOP_N.tracked_keys
) -> DataFrame:
    """``item_hot_rank`` for logs with very many items."""
    return hot_rank_sketched(log, "item_id", n, tracked)


def category_hot_rank_sketched(
    log: DataFrame, n: int = TOP_N.categories, tracked: int = TOP_N.tracked_keys
) -> DataFrame:
    """``category_hot_rank`` for logs with very many categories."""
    return hot_rank_sketched(log, "category_id", n, tracked)


def cvr_base(log: DataFrame, key: str) -> DataFrame:
    """Distinct users per behaviour for each key, and buyers over interest.

    ``interest_uv`` adds up viewing, carting and favouriting users, so a user
    who did all three counts three times.
    """
    per_key = (
        seen_by_user(log, key)
        .groupBy(key)
        .agg(
            *(users_where(saw(b)).alias(b) for b in (VIEW, FAV, CART, BUY)),
            users().alias("total_uv"),
        )
        .withColumn("interest_uv", F.expr(f"{VIEW} + {CART} + {FAV}"))
    )
    return per_key.withColumn("pv_to_buy_rate", rate(BUY, "interest_uv"))


def item_cvr_base(log: DataFrame, min_interest: int = ITEM_CONVERSION.min_interest) -> DataFrame:
    """Item conversion, for items with enough interest."""
    return cvr_base(log, "item_id").where(F.col("interest_uv") >= min_interest)


def item_cvr_top(base: DataFrame, n: int | None = TOP_N.converting_items) -> DataFrame:
    """Items with the highest conversion."""
    return top(base, n, F.desc("pv_to_buy_rate"), F.col("item_id"))


def _low_converting(base: DataFrame, threshold: Column, n: int | None) -> DataFrame:
    busy = base.where(F.col(VIEW) >= base.agg(threshold).scalar())
    return top(busy, n, F.asc("pv_to_buy_rate"), F.col("item_id"))


def item_low_cvr(
    base: DataFrame,
    n: int | None = TOP_N.low_converting_items,
    quantile: float = ITEM_CONVERSION.traffic_quantile,
) -> DataFrame:
    """Items with much traffic and the lowest conversion.

    The traffic threshold is an exact quantile.  Its state is one counter per
    distinct number of viewers, which stays small: n distinct counts need at
    least n * n / 2 (item, viewer) pairs.
    """
    exact = F.expr(f"percentile_disc({quantile}) WITHIN GROUP (ORDER BY {VIEW})")
    return _low_converting(base, exact, n)


def traffic_sketch(quantile: float, error: float) -> Column:
    """Aggregate for a traffic threshold whose rank is off by at most ``error``."""
    return F.percentile_approx(VIEW, quantile, round(1 / error))


def item_low_cvr_approx(
    base: DataFrame,
    n: int | None = TOP_N.low_converting_items,
    quantile: float = ITEM_CONVERSION.traffic_quantile,
    error: float = ITEM_CONVERSION.quantile_error,
) -> DataFrame:
    """As ``item_low_cvr`` with a quantile sketch of bounded rank error.

    With an error below one rank, 1 / number of items, it is the exact quantile.
    """
    return _low_converting(base, traffic_sketch(quantile, error), n)


def traffic_sketch_holds(
    base: DataFrame,
    quantile: float = ITEM_CONVERSION.traffic_quantile,
    error: float = ITEM_CONVERSION.quantile_error,
) -> DataFrame:
    """Whether the threshold of ``item_low_cvr_approx`` lies within its error of the quantile."""
    at = base.agg(traffic_sketch(quantile, error)).scalar()
    ranks = base.select(VIEW, at.alias("at")).agg(
        F.avg((F.col(VIEW) < F.col("at")).cast("int")).alias("below"),
        F.avg((F.col(VIEW) <= F.col("at")).cast("int")).alias("up_to"),
    )
    low, high = F.col("below") <= quantile + error, F.col("up_to") >= quantile - error
    return ranks.select((low & high).alias("within_error"))


def category_cvr(log: DataFrame) -> DataFrame:
    """Conversion of every category, highest first."""
    return cvr_base(log, "category_id").orderBy(F.desc("pv_to_buy_rate"), "category_id")


def category_stats(log: DataFrame) -> DataFrame:
    """All measures of every category, most active first."""
    return activity(log, "category_id").orderBy(F.desc("total"), "category_id")


def category_items_lookup(
    log: DataFrame, category_id: int, n: int | None = TOP_N.category_items
) -> DataFrame:
    """The most active items of one category."""
    chosen = log.where(F.col("category_id") == category_id)
    return top(activity(chosen, "item_id").drop("pv_uv"), n, F.desc("total"), F.col("item_id"))


def item_details(log: DataFrame, n: int | None = TOP_N.exported_items) -> DataFrame:
    """All measures of the most active items."""
    return top(activity(log, "item_id"), n, F.desc("total"), F.col("item_id"))


def category_details(log: DataFrame, n: int | None = TOP_N.exported_categories) -> DataFrame:
    """All measures of the most active categories."""
    return top(activity(log, "category_id"), n, F.desc("total"), F.col("category_id"))


# Up to so many rows, Spark itself cuts a ranking on the map side.
_GROUP_LIMIT = 1000


def category_items(
    log: DataFrame, n: int = TOP_N.category_items, salts: int = 64
) -> DataFrame:
    """The most active items within every category.

    Up to a thousand rows a category, Spark cuts each map task's output to ``n``
    rows per category before the shuffle.  For more, items are dealt over
    ``salts`` parts of their category, each part is cut to ``n``, and what is
    left is ranked: a category that holds most items is never sorted in one
    task, which gets at most ``salts * n`` of them.
    """
    order = (F.desc("total"), F.col("item_id"))
    found = activity(log, "category_id", "item_id").drop("pv_uv")
    if n > _GROUP_LIMIT:
        part = F.pmod(F.hash("item_id"), F.lit(salts))
        within = Window.partitionBy("category_id", part).orderBy(*order)
        found = found.withColumn("place", F.row_number().over(within))
        found = found.where(F.col("place") <= n).drop("place")
    ranking = Window.partitionBy("category_id").orderBy(*order)
    ranked = found.withColumn("rank", F.row_number().over(ranking))
    return ranked.where(F.col("rank") <= n)


def category_items_nested(log: DataFrame, n: int = TOP_N.category_items) -> DataFrame:
    """One row per category with its most active items as an array."""
    ranked = category_items(log, n)
    item = F.struct("rank", *(c for c in ranked.columns if c not in ("category_id", "rank")))
    return ranked.groupBy("category_id").agg(
        F.array_sort(F.collect_list(item)).alias("items")
    )
