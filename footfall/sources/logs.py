"""Readers for the raw CSV log and the cleaned Parquet log."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The headerless column order of the raw log.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("category_id", T.LongType()),
        T.StructField("behavior", T.StringType()),
        T.StructField("timestamp", T.LongType()),
    ]
)
RAW_COLUMNS = tuple(RAW_SCHEMA.fieldNames())


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Raw headerless CSV log; a malformed field reads as NULL."""
    return spark.read.csv(path, schema=RAW_SCHEMA, header=False)


def load_clean(spark: SparkSession, path: str, cache: bool = False) -> DataFrame:
    """Cleaned log with DATE, hour and instant, whoever wrote it.

    A ``date`` of another type is converted; ``date``, ``hour`` and ``ts_us``
    are derived from ``datetime`` and ``timestamp`` where they are missing.

    Leave ``cache`` off for single lookups so that date and column pruning
    reach the scan; turn it on when many analyses share one log.
    """
    log = spark.read.parquet(path)
    if "date" not in log.columns:
        log = log.withColumn("date", F.to_date(F.substring("datetime", 1, 10)))
    elif log.schema["date"].dataType != T.DateType():
        log = log.withColumn("date", F.to_date("date"))
    if "hour" not in log.columns:
        log = log.withColumn("hour", F.substring("datetime", 12, 2).cast("int"))
    if "ts_us" not in log.columns:
        log = log.withColumn("ts_us", F.col("timestamp").cast("long") * 1_000_000)
    return log.persist(StorageLevel.MEMORY_AND_DISK) if cache else log
