"""Sessions and the behaviour paths inside them.

A session is a maximal run of one user's rows with no idle time above the
gap.  Rows have to be put in order for it, but no operator here puts all rows
of a busy user into one task.  For busy users time is cut into slots no wider
than the gap, so rows of one user and slot always share a session, and what is
ordered per user afterwards grows with the number of slots in the log's
period, not with the number of rows.  Results do not depend on who counts as
busy.  Rows without a user are in no session and on no path.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.params import SESSION_GAP_MINUTES

SLOT_SECONDS = 300
# A user is busy with more rows than both limits; the share bounds the number
# of busy users by its inverse, so their list is always small enough to
# broadcast.  Who counts as busy changes the plan, never the result.
BUSY_SHARE = 1e-6
BUSY_ROWS = 1_000_000
# Rows that a busy user may have for each second of slot width.
ROWS_PER_SECOND = 200_000

_MICROS = 1_000_000
_ARROW = " → "


def _gap(minutes: float) -> int:
    return int(minutes * 60 * _MICROS)


def _slot(gap_minutes: float, seconds: Column | float = SLOT_SECONDS) -> Column:
    """Start of the row's slot, which is never wider than the gap."""
    width = F.least(F.lit(max(1, _gap(gap_minutes))), (F.lit(seconds) * _MICROS).cast("long"))
    return (F.col("ts_us") - F.pmod("ts_us", F.greatest(width, F.lit(1)))).alias("slot")


def _split_busy(
    log: DataFrame, busy_rows: int, slot_seconds: float = SLOT_SECONDS
) -> tuple[DataFrame, DataFrame]:
    """The rows of ordinary users, and those of busy users with their slot width.

    The width falls with the user's rows, down to a second, so a slot does not
    grow with the log.  Where nobody is busy, adaptive execution drops the
    second part.  Rows without a user are in neither.
    """
    known = log.where("user_id IS NOT NULL")
    sizes = known.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    limit = sizes.agg(F.expr(f"greatest(sum(n) * {BUSY_SHARE}D, {busy_rows}D)")).scalar()
    width = F.lit(slot_seconds * slot_seconds * ROWS_PER_SECOND) / F.col("n")
    width = F.least(F.lit(float(slot_seconds)), F.greatest(F.lit(1.0), width))
    busy = sizes.where(F.col("n") > limit).select(
        F.col("user_id").alias("busy_user"), width.alias("slot_width")
    )
    same = F.col("user_id") == F.col("busy_user")
    ordinary = known.join(F.broadcast(busy), same, "left_anti")
    return ordinary, known.join(F.broadcast(busy), same).drop("busy_user")


def _order(log: DataFrame) -> list[str]:
    """Order of a user's rows: by time, then by id or else by all columns."""
    if "event_id" in log.columns:
        return ["ts_us", "event_id"]
    return ["ts_us", "behavior", "item_id", "category_id"]


def _numbered(spans: DataFrame, gap_minutes: float, *order: str) -> DataFrame:
    """Number the sessions of each user over spans of activity in time order.

    A span opens a session when it starts more than the gap after everything
    before it has ended.
    """
    in_time = Window.partitionBy("user_id").orderBy(*(order or ("slot", "first_us", "last_us")))
    earlier = in_time.rowsBetween(Window.unboundedPreceding, -1)
    idle = F.col("first_us") - F.max("last_us").over(earlier)
    opens = F.when(idle.isNull() | (idle > _gap(gap_minutes)), 1).otherwise(0)
    up_to_here = in_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return spans.withColumn("opens", opens).withColumn(
        "session_no", F.sum("opens").over(up_to_here)
    )


def _spans(log: DataFrame, slot: Column, *extra: str) -> DataFrame:
    return log.groupBy("user_id", slot, *extra).agg(
        F.min("ts_us").alias("first_us"),
        F.max("ts_us").alias("last_us"),
        F.count(F.lit(1)).alias("n"),
    )


def _session_id() -> Column:
    return F.concat_ws("_", F.col("user_id").cast("string"), F.col("session_no").cast("string"))


def _row_spans(log: DataFrame) -> DataFrame:
    """Every row as a span of its own."""
    return log.select("*", *(F.col("ts_us").alias(c) for c in ("first_us", "last_us")))


def sessionize(
    log: DataFrame,
    gap_minutes: float = SESSION_GAP_MINUTES,
    slot_seconds: float = SLOT_SECONDS,
    busy_rows: int = BUSY_ROWS,
) -> DataFrame:
    """The log with ``session_id`` = user and running session number.

    Ordinary users are numbered row by row.  Busy users are numbered on one
    span per slot, which is joined back to the rows on user and slot.  Rows
    without a user belong to no session: their id is NULL.
    """
    ordinary, busy = _split_busy(log, busy_rows, slot_seconds)
    columns = [*log.columns, _session_id().alias("session_id")]
    by_row = _numbered(_row_spans(ordinary), gap_minutes, *_order(log)).select(*columns)

    slot = _slot(gap_minutes, F.col("slot_width"))
    numbered = _numbered(_spans(busy, slot), gap_minutes).select(
        F.col("user_id").alias("span_user"), F.col("slot").alias("span_slot"), "session_no"
    )
    same_span = (F.col("user_id") == F.col("span_user")) & (F.col("slot") == F.col("span_slot"))
    by_span = busy.select("*", slot).join(numbered, same_span).select(*columns)
    nobody = log.where("user_id IS NULL").select("*", F.lit(None).cast("string").alias("session_id"))
    return by_row.unionByName(by_span).unionByName(nobody)


def session_rollup(
    log: DataFrame,
    gap_minutes: float = SESSION_GAP_MINUTES,
    slot_seconds: float = SLOT_SECONDS,
    busy_rows: int = BUSY_ROWS,
) -> DataFrame:
    """Rows and distinct behaviours of each session.

    Rows of ordinary users are shuffled once, numbered in order and grouped
    where they are.  Of busy users, only spans per (user, slot, behaviour) are
    shuffled, combined on the map side.
    """
    rolled = _rolled(
        log,
        gap_minutes,
        slot_seconds,
        busy_rows,
        F.sum("n").alias("session_length"),
        F.size(F.collect_set("behavior")).cast("long").alias("unique_behaviors"),
    )
    return rolled.select(_session_id().alias("session_id"), "session_length", "unique_behaviors")


def _rolled(
    log: DataFrame, gap_minutes: float, slot_seconds: float, busy_rows: int, *measures: Column
) -> DataFrame:
    """Measures per (user, session number) over spans with their rows ``n`` and ``behavior``."""
    needed = log.select("user_id", "ts_us", "behavior")
    ordinary, busy = _split_busy(needed, busy_rows, slot_seconds)
    by_row = _numbered(_row_spans(ordinary).withColumn("n", F.lit(1)), gap_minutes, "ts_us")
    slot = _slot(gap_minutes, F.col("slot_width"))
    by_span = _numbered(_spans(busy, slot, "behavior"), gap_minutes)
    parts = (part.groupBy("user_id", "session_no").agg(*measures) for part in (by_row, by_span))
    return reduce(DataFrame.unionAll, parts)


# What is known of a session from some of its rows; enough to go on when more come.
SPAN_SCHEMA = (
    "user_id BIGINT, first_us BIGINT, last_us BIGINT, session_length BIGINT, "
    "behaviors ARRAY<STRING>"
)


def session_spans(
    log: DataFrame,
    gap_minutes: float = SESSION_GAP_MINUTES,
    slot_seconds: float = SLOT_SECONDS,
    busy_rows: int = BUSY_ROWS,
) -> DataFrame:
    """Every session of a log as a summary that ``stitch`` can go on with."""
    return _rolled(
        log,
        gap_minutes,
        slot_seconds,
        busy_rows,
        F.min("first_us").alias("first_us"),
        F.max("last_us").alias("last_us"),
        F.sum("n").alias("session_length"),
        F.collect_set("behavior").alias("behaviors"),
    ).drop("session_no")


def stitch(spans: DataFrame, gap_minutes: float = SESSION_GAP_MINUTES) -> DataFrame:
    """Summaries of parts of a log as those of the whole: neighbours within the gap are one.

    The rows to order per user are sessions of the parts, not log rows.
    """
    numbered = _numbered(spans, gap_minutes, "first_us", "last_us")
    behaviors = F.array_distinct(F.flatten(F.collect_list("behaviors")))
    return (
        numbered.groupBy("user_id", "session_no")
        .agg(
            F.min("first_us").alias("first_us"),
            F.max("last_us").alias("last_us"),
            F.sum("session_length").alias("session_length"),
            behaviors.alias("behaviors"),
        )
        .drop("session_no")
    )


def is_closed(until_us: int, gap_minutes: float = SESSION_GAP_MINUTES) -> Column:
    """Whether no row from ``until_us`` on can belong to the session any more."""
    return F.lit(until_us) - F.col("last_us") > _gap(gap_minutes)


def rollup_of_spans(spans: DataFrame) -> DataFrame:
    """What ``session_rollup`` gives, from the stitched summaries of a whole log."""
    in_time = Window.partitionBy("user_id").orderBy("first_us")
    return spans.withColumn("session_no", F.row_number().over(in_time)).select(
        _session_id().alias("session_id"),
        "session_length",
        F.size("behaviors").cast("long").alias("unique_behaviors"),
    )


def session_stats(rollup: DataFrame, gap_minutes: float = SESSION_GAP_MINUTES) -> DataFrame:
    """Number of sessions, mean length and the gap, as (metric, value) rows."""
    totals = rollup.agg(
        F.count(F.lit(1)).cast("double").alias("total_sessions"),
        F.coalesce(F.round(F.avg("session_length"), 2), F.lit(0.0)).alias("avg_session_length"),
        F.lit(float(gap_minutes)).alias("gap_minutes"),
    )
    return totals.unpivot([], totals.columns, "metric", "value")


def session_lengths(rollup: DataFrame) -> DataFrame:
    """Sessions per length."""
    return (
        rollup.groupBy("session_length")
        .agg(F.count(F.lit(1)).alias("session_count"))
        .orderBy("session_length")
    )


def _walks(
    rows: DataFrame, steps: int, gap_minutes: float, order: list[str], *keys: str
) -> DataFrame:
    """Rows with the ``steps - 1`` behaviours before them in the same session."""
    window = Window.partitionBy(*keys).orderBy(*order)
    times = [F.col("ts_us"), *(F.lag("ts_us", i).over(window) for i in range(1, steps))]
    idle = F.greatest(*(later - earlier for later, earlier in zip(times, times[1:])), F.lit(0))
    back = [f"back{i}" for i in range(steps - 1, 0, -1)]
    walked = rows.select(
        "*",
        *(F.lag("behavior", i).over(window).alias(f"back{i}") for i in range(1, steps)),
        times[-1].isNotNull().alias("complete"),
        idle.alias("idle"),
    )
    known = " AND ".join(f"{column} IS NOT NULL" for column in back)
    together = walked.where(f"complete AND idle <= {_gap(gap_minutes)} AND {known}")
    return together.withColumn("path", F.concat_ws(_ARROW, *back, "behavior"))


def behavior_paths(
    log: DataFrame,
    steps: int = 2,
    gap_minutes: float = SESSION_GAP_MINUTES,
    slot_seconds: float = SLOT_SECONDS,
    busy_rows: int = BUSY_ROWS,
    path: str = "path_segment",
    count: str = "path_count",
) -> DataFrame:
    """Counts of ``steps`` consecutive behaviours inside a session.

    Busy users are walked slot by slot.  The paths that reach back over a slot
    boundary are walked on the slots' first and last ``steps - 1`` rows alone,
    which hold all rows such a path can touch.
    """
    order = _order(log)
    rows = log.select("user_id", *dict.fromkeys([*order, "behavior"]))
    ordinary, busy = _split_busy(rows, busy_rows, slot_seconds)

    in_slot = Window.partitionBy("user_id", "slot").orderBy(*order)
    slotted = busy.select("*", _slot(gap_minutes, F.col("slot_width"))).drop("slot_width")
    edges = slotted.select(
        "*",
        F.row_number().over(in_slot).alias("nth"),
        F.lead("ts_us", steps - 1).over(in_slot).isNull().alias("near_end"),
    ).where(f"nth < {steps} OR near_end")

    parts = (
        _walks(ordinary, steps, gap_minutes, order, "user_id"),
        _walks(slotted, steps, gap_minutes, order, "user_id", "slot"),
        _walks(edges, steps, gap_minutes, order, "user_id").where(f"nth < {steps}"),
    )
    walked = reduce(DataFrame.unionAll, (part.select("path") for part in parts))
    return (
        walked.groupBy(F.col("path").alias(path))
        .agg(F.count(F.lit(1)).alias(count))
        .orderBy(F.desc(count), path)
    )


def behavior_paths_3step(log: DataFrame, gap_minutes: float = SESSION_GAP_MINUTES) -> DataFrame:
    """Counts of three consecutive behaviours inside a session."""
    return behavior_paths(log, 3, gap_minutes, path="path3", count="count")
