"""Stored results that a further part of the log is added to, without the log so far."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.operators import cohorts, ranges, sessions
from footfall.params import SESSION_GAP_MINUTES
from footfall.sources import save
from footfall.sources.sinks import subfolders

_STATES = f"{sessions.SPAN_SCHEMA}, closed BOOLEAN"


def _steps(spark: SparkSession, store: str) -> list[int]:
    """Times up to which the sessions of a store are known, ascending."""
    names = subfolders(spark, store)
    return sorted(int(n.removeprefix("until=")) for n in names if n.startswith("until="))


def _step(spark: SparkSession, store: str, until_us: int) -> DataFrame:
    return spark.read.schema(_STATES).parquet(f"{store}/until={until_us}")


def add_to_sessions(
    log: DataFrame, store: str, until_us: int, gap_minutes: float = SESSION_GAP_MINUTES
) -> None:
    """Add the rows of a log that lie before ``until_us`` and after what is stored.

    Only sessions that were still open are read again; those that no later row
    can belong to are written for good.  A step that is repeated replaces
    itself.  Rows from before the last step are refused.  The gap must be that
    of the earlier steps.
    """
    spark = log.sparkSession
    earlier = [step for step in _steps(spark, store) if step < until_us]
    late = F.col("ts_us") < (earlier[-1] if earlier else -(2**63))
    if not log.where(late | (F.col("ts_us") >= until_us)).isEmpty():
        raise ValueError(f"rows outside {earlier[-1:] or ['the beginning']} to {until_us}")
    spans = sessions.session_spans(log, gap_minutes)
    if earlier:
        still_open = _step(spark, store, earlier[-1]).where("NOT closed").drop("closed")
        spans = sessions.stitch(spans.unionByName(still_open), gap_minutes)
    closed = sessions.is_closed(until_us, gap_minutes).alias("closed")
    save(spans.select("*", closed), f"{store}/until={until_us}", fmt="parquet")


def stored_sessions(spark: SparkSession, store: str) -> DataFrame:
    """Summaries of all sessions of a store: closed ones of every step, open ones of the last."""
    steps = _steps(spark, store)
    last = _step(spark, store, steps[-1])
    for step in steps[:-1]:
        last = last.unionByName(_step(spark, store, step).where("closed"))
    return last.drop("closed")


def save_bitmaps(bitmaps: DataFrame, table: str, buckets: int, path: str | None = None) -> None:
    """Store activity bitmaps as a table that is bucketed and sorted by user."""
    writer = bitmaps.write.bucketBy(buckets, "user_id").sortBy("user_id").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def add_to_bitmaps(log: DataFrame, stored: str, table: str, path: str | None = None) -> None:
    """Store the bitmaps of ``stored`` and of a further part of the log as a new table.

    The stored table keeps its buckets; only the new rows are shuffled, one per
    user.  A part that is added twice changes nothing.
    """
    spark = log.sparkSession
    detail = spark.sql(f"DESCRIBE TABLE EXTENDED {stored}").where("col_name = 'Num Buckets'")
    buckets = int(detail.first()["data_type"])
    merged = cohorts.merge_bitmaps(spark.table(stored), cohorts.activity_bitmaps(log))
    save_bitmaps(merged, table, buckets, path)


def save_ranges(log: DataFrame, path: str, *keys: str, only_days: bool = False) -> None:
    """Store user bitmaps and row counts per (date, keys), partitioned by date.

    With ``only_days``, days that the log has no rows of stay as they are.
    """
    parts = {"users": ranges.user_bitmaps, "counts": ranges.day_counts}
    for name, part in parts.items():
        writer = part(log, *keys).hint("rebalance", "date").write.partitionBy("date")
        if only_days:
            writer = writer.option("partitionOverwriteMode", "dynamic")
        writer.mode("overwrite").parquet(f"{path}/{name}")


def load_ranges(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """User bitmaps and row counts as stored."""
    return spark.read.parquet(f"{path}/users"), spark.read.parquet(f"{path}/counts")
