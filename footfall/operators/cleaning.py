"""Cleaning of the raw log."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.measures import ROWS, rollup
from footfall.params import BUSINESS_ZONE, RANGE_END, RANGE_START

_FLAGS = ("inside", "malformed")


def clip_time(log: DataFrame, start: int = RANGE_START, end: int = RANGE_END) -> DataFrame:
    """Rows whose epoch second lies in the closed range; NULL times fall out."""
    return log.where(F.col("timestamp").between(start, end))


def dedup(log: DataFrame) -> DataFrame:
    """Rows that are equal in all columns are kept once."""
    return log.dropDuplicates()


def derive_time(log: DataFrame, zone: str = BUSINESS_ZONE) -> DataFrame:
    """Add ``datetime`` text, ``hour`` and ``date`` in the business zone.

    Works on zone-less timestamps, so the session time zone has no influence.
    ``ts_us`` carries the instant in microseconds for the session operators.
    """
    epoch = F.expr("timestampadd(SECOND, timestamp, TIMESTAMP_NTZ'1970-01-01 00:00:00')")
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), epoch)
    return log.select(
        "*",
        (F.col("timestamp").cast("long") * 1000000).alias("ts_us"),
        local.cast("string").alias("datetime"),
        F.hour(local).alias("hour"),
        F.to_date(local).alias("date"),
    )


def _flagged(log: DataFrame, start: int, end: int) -> DataFrame:
    """Distinct rows with their number of copies, and which count as what."""
    columns = [c for c in log.columns if c != ROWS]
    inside = F.coalesce(F.col("timestamp").between(start, end), F.lit(False))
    broken = reduce(Column.__or__, (F.col(c).isNull() for c in columns))
    return rollup(log, *columns).select(
        "*", inside.alias("inside"), broken.alias("malformed")
    )


def tallies() -> list[Column]:
    """The counts of ``report`` as aggregates over rows of ``marked``."""

    def total(value: Column, where: Column) -> Column:
        return F.coalesce(F.sum(F.when(where, value)), F.lit(0))

    n, inside = F.col(ROWS), F.col("inside")
    return [
        F.coalesce(F.sum(n), F.lit(0)).alias("raw_rows"),
        total(n, F.col("malformed")).alias("malformed_rows"),
        total(n, ~inside).alias("out_of_range_rows"),
        total(n - 1, inside).alias("duplicate_rows"),
        F.count_if(inside).alias("kept_rows"),
    ]


def report(log: DataFrame, start: int = RANGE_START, end: int = RANGE_END) -> DataFrame:
    """What cleaning does with the rows: one row of counts.

    ``malformed_rows`` have a field that could not be read (NULL), wherever
    they end up.  ``out_of_range_rows`` fall out for their time, NULL times
    included; of the rest, ``duplicate_rows`` are surplus copies.
    """
    return _flagged(log, start, end).agg(*tallies())


def marked(
    log: DataFrame,
    start: int = RANGE_START,
    end: int = RANGE_END,
    zone: str = BUSINESS_ZONE,
) -> DataFrame:
    """The distinct rows with time columns, copies and flags, before any is dropped.

    Rows out of range are still there, without a time, so that one pass can
    count with ``tallies`` what ``kept`` then takes away.
    """
    rows = _flagged(log, start, end)
    return derive_time(rows.withColumn("timestamp", F.when(F.col("inside"), F.col("timestamp"))), zone)


def kept(rows: DataFrame) -> DataFrame:
    """The clean log in rows of ``marked``."""
    return rows.where("inside").drop(ROWS, *_FLAGS)


def unseen(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows of a clean batch, once each, that a stored clean log does not hold.

    Copies share their second and so their date: of the stored log, only the
    days of the batch are read.  A row is compared by all columns of the batch,
    NULLs as equal, and both sides are distinct, so no key is hot.  What is
    left can be appended; a batch that arrives twice adds nothing.
    """
    days = [row["date"] for row in batch.select("date").distinct().collect()]
    known = stored.where(F.col("date").isin(days)).select(*batch.columns)
    known = known.toDF(*(f"known_{c}" for c in batch.columns))
    same = (F.col(c).eqNullSafe(F.col(f"known_{c}")) for c in batch.columns)
    return dedup(batch).join(known, reduce(Column.__and__, same), "left_anti")


def clean(
    log: DataFrame,
    start: int = RANGE_START,
    end: int = RANGE_END,
    zone: str = BUSINESS_ZONE,
) -> DataFrame:
    """The whole cleaning step: clip, drop duplicates, derive time columns."""
    return derive_time(dedup(clip_time(log, start, end)), zone)
