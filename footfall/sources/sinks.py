"""Writers for the cleaned log and for result tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# Lookups of one item skip row groups whose filter does not hold it.
_ITEM_FILTER = {
    "parquet.bloom.filter.enabled#item_id": "true",
    "parquet.bloom.filter.adaptive.enabled#item_id": "true",
}


def write_clean(
    log: DataFrame,
    path: str,
    only_days: bool = False,
    append: bool = False,
    clustered: bool = False,
    last_step: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Write the cleaned log, partitioned by date.

    It takes the place of what is stored; with ``only_days``, of those days
    that the log has rows of, and other days keep their files; with ``append``
    it adds to what is stored.

    The rebalance hint lets adaptive execution merge small and split large
    date partitions by size, so that a day holding much of the log is written
    by many tasks and a quiet day does not leave one file per task.

    With ``clustered``, files hold ranges of (date, user, time) in order and a
    bloom filter of their items.  Time is part of the range, so a user with
    much of a day is split too.

    ``last_step`` is applied behind the last shuffle, where every row passes
    once however often tasks are repeated; rows may be counted and dropped there.
    """
    if clustered:
        order = ("date", "user_id", "timestamp")
        laid = log.repartitionByRange(*order).sortWithinPartitions(*order)
    else:
        laid = log.hint("rebalance", "date")
    writer = (last_step(laid) if last_step else laid).write.partitionBy("date")
    writer = writer.options(**_ITEM_FILTER) if clustered else writer
    if only_days:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.mode("append" if append else "overwrite").parquet(path)


def save(result: DataFrame, path: str, fmt: str = "json") -> None:
    """Put a result table in the place of what is stored.

    The table is written aside and renamed when it is complete, so a failed
    write leaves the old one and a reader never meets half a table.
    """
    aside = f"{path.rstrip('/')}-{uuid.uuid4().hex}"
    result.write.format(fmt).save(aside)
    _rename(result.sparkSession, aside, path)


def _rename(spark: SparkSession, new: str, path: str) -> None:
    jvm = spark.sparkContext._jvm
    source, target, old = (
        jvm.org.apache.hadoop.fs.Path(p) for p in (new, path.rstrip("/"), f"{new}-old")
    )
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    replaces = files.exists(target)
    if replaces and not files.rename(target, old):
        raise OSError(f"cannot move {path} aside")
    if not files.rename(source, target):
        raise OSError(f"cannot rename {new} to {path}")
    if replaces:
        files.delete(old, True)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []


def write_rfm(detail: DataFrame, path: str) -> None:
    """Overwrite the per-user RFM table as Parquet."""
    save(detail, path, fmt="parquet")
