"""Rates, behaviour counts and distinct-user counts.

Distinct users per behaviour are counted in two steps: one row per
(group, user) first, then a plain count per group.  Both steps combine on the
map side, so a group or a user holding a large part of the log is spread over
all map tasks, and no row is multiplied as it would be by several
``count_distinct`` calls in one aggregate.

Rows without a user count as rows but never as a user.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The behaviour codes of the log.
VIEW = "pv"
CART = "cart"
FAV = "fav"
BUY = "buy"
BEHAVIORS = (VIEW, CART, FAV, BUY)

ROWS = "n_rows"  # in a rollup of the log: how many log rows a row stands for

_BIT = {name: 1 << position for position, name in enumerate(BEHAVIORS)}
_BIT_OF_ROW = "CASE behavior {} ELSE 0 END".format(
    " ".join(f"WHEN '{name}' THEN {bit}" for name, bit in _BIT.items())
)


def rate(part: str, whole: str) -> Column:
    """Percentage with two decimals, 0.0 where there is nothing to divide by."""
    return F.expr(f"CASE WHEN {whole} > 0 THEN round({part} / {whole} * 100, 2) ELSE 0D END")


def rows(log: DataFrame) -> Column:
    """Number of log rows; in a rollup of the log, of the rows it stands for."""
    return F.expr(f"coalesce(sum({ROWS}), 0)") if ROWS in log.columns else F.expr("count(1)")


def rows_of(log: DataFrame, behavior: str) -> Column:
    """Number of log rows with this behaviour."""
    if ROWS in log.columns:
        return F.expr(f"coalesce(sum(CASE WHEN behavior = '{behavior}' THEN {ROWS} END), 0)")
    return F.expr(f"count(CASE WHEN behavior = '{behavior}' THEN 1 END)")


def rollup(log: DataFrame, *keys: str) -> DataFrame:
    """The log reduced to one row per distinct keys, with the rows it stands for.

    Operators that use no other column give the same result on the rollup.
    """
    return log.groupBy(*keys).agg(rows(log).alias(ROWS))


def seen_by_user(log: DataFrame, *keys: str) -> DataFrame:
    """One row per (keys, user) with the set of behaviours seen, as a bit mask.

    One integer stands for all behaviours, so every consumer of this frame
    needs the same shuffled columns and Spark can reuse the exchange.
    """
    return log.groupBy(*keys, "user_id").agg(F.expr(f"bit_or({_BIT_OF_ROW})").alias("seen"))


def saw(*behaviors: str) -> str:
    """Condition: the ``seen`` mask holds any of these behaviours."""
    return f"(seen & {sum(_BIT[b] for b in behaviors)}) <> 0"


def users() -> Column:
    """Users in a frame that has one row per (group, user)."""
    return F.count("user_id")


def users_where(*conditions: str) -> Column:
    """Users that meet all conditions, in a frame with one row per (group, user)."""
    return F.expr(f"count(CASE WHEN {' AND '.join(conditions)} THEN user_id END)")


def activity(log: DataFrame, *keys: str, only: DataFrame | None = None) -> DataFrame:
    """Row counts per behaviour, distinct users and conversion for each key.

    ``interest_uv`` is the distinct union of viewing, carting and favouriting
    users; ``cvr`` is buyers over those.

    ``only`` restricts the result to the keys it holds.  The semi join stands
    above the rollups: where ``only`` is small enough to broadcast, Catalyst
    moves it below them to the scan, and where not, the join sees one row per
    key and so has no hot key.
    """
    per_user = log.groupBy(*keys, "user_id").agg(
        *(rows_of(log, b).alias(b) for b in (VIEW, FAV, CART, BUY)),
        rows(log).alias("total"),
    )
    per_key = per_user.groupBy(*keys).agg(
        users_where(f"{VIEW} > 0").alias("pv_uv"),
        users_where(f"{VIEW} + {CART} + {FAV} > 0").alias("interest_uv"),
        users_where(f"{BUY} > 0").alias("buy_uv"),
        *(F.sum(c).alias(c) for c in (VIEW, FAV, CART, BUY, "total")),
    )
    if only is not None:
        per_key = per_key.join(only, list(keys), "left_semi")
    return per_key.select(
        *keys,
        VIEW,
        FAV,
        CART,
        BUY,
        "total",
        "pv_uv",
        "interest_uv",
        "buy_uv",
        rate("buy_uv", "interest_uv").alias("cvr"),
    )


def top(frame: DataFrame, n: int | None, *order: Column) -> DataFrame:
    """Rows in order, cut to the first ``n`` when a ranking asks for it."""
    ranked = frame.orderBy(*order)
    return ranked if n is None else ranked.limit(n)
