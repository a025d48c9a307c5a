"""Data quality checks of a log, each in one pass, or all of them in one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.functions import BEHAVIORS, rollup
from footfall.functions.measures import ROWS
from footfall.params import RANGE_END, RANGE_START


def range_report(log: DataFrame, start: int = RANGE_START, end: int = RANGE_END) -> DataFrame:
    """Total rows and rows whose time lies outside the closed range."""
    ts = F.col("timestamp")
    return log.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if((ts < start) | (ts > end)).alias("out_of_range_count"),
    )


def _missing(field: T.StructField) -> Column:
    value = F.col(field.name)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def null_counts(frame: DataFrame) -> DataFrame:
    """NULL (and for floating columns NaN) values per column, one row each."""

    counts = frame.agg(*(F.count_if(_missing(f)).alias(f.name) for f in frame.schema.fields))
    return counts.unpivot([], frame.columns, "column_name", "null_count")


def _is_known() -> Column:
    return F.coalesce(F.col("behavior").isin(*BEHAVIORS), F.lit(False)).alias("is_valid")


def behavior_domain(log: DataFrame) -> DataFrame:
    """Distinct behaviours, their rows, and whether each is a known code."""
    return (
        log.groupBy("behavior")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("*", _is_known())
        .orderBy("behavior")
    )


def duplicate_report(log: DataFrame) -> DataFrame:
    """Total, distinct and surplus rows, comparing all columns."""
    copies = log.groupBy(*log.columns).agg(F.count(F.lit(1)).alias("copies"))
    return copies.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_rows"),
    )


def facts(log: DataFrame, start: int = RANGE_START, end: int = RANGE_END) -> DataFrame:
    """Counts per behaviour from which ``reports`` gives every check of a log.

    One scan and one shuffle of the rows, as they are told apart by all columns;
    what comes out has a row per behaviour.
    """
    ts, n = F.col("timestamp"), F.col(ROWS)
    columns = [c for c in log.columns if c != ROWS]
    inside = F.coalesce(ts.between(start, end), F.lit(False))
    outside = F.coalesce((ts < start) | (ts > end), F.lit(False))
    broken = reduce(Column.__or__, (F.col(c).isNull() for c in columns))

    def total(value: Column, where: Column) -> Column:
        return F.coalesce(F.sum(F.when(where, value)), F.lit(0))

    return rollup(log, *columns).groupBy("behavior").agg(
        F.sum(n).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        total(n, outside).alias("out_of_range_count"),
        total(n, broken).alias("malformed_rows"),
        total(n, ~inside).alias("out_of_range_rows"),
        total(n - 1, inside).alias("duplicate_rows"),
        F.count_if(inside).alias("kept_rows"),
        *(total(n, _missing(log.schema[c])).alias(f"null_{c}") for c in columns),
    )


def reports(facts: DataFrame) -> dict[str, DataFrame]:
    """The reports of a log by name, from its ``facts``; same rows as each on its own."""

    def sums(**columns: str) -> DataFrame:
        return facts.agg(
            *(F.coalesce(F.sum(c), F.lit(0)).alias(name) for name, c in columns.items())
        )

    def same(*names: str) -> dict[str, str]:
        return {name: name for name in names}

    missing = [c.removeprefix("null_") for c in facts.columns if c.startswith("null_")]
    nulls = sums(**{c: f"null_{c}" for c in missing})
    duplicates = sums(**same("total_rows", "distinct_rows"))
    return {
        "range_report": sums(**same("total_rows", "out_of_range_count")),
        "null_counts": nulls.unpivot([], missing, "column_name", "null_count"),
        "behavior_domain": facts.select(
            "behavior", F.col("total_rows").alias("n"), _is_known()
        ).orderBy("behavior"),
        "duplicate_report": duplicates.withColumn(
            "duplicate_rows", F.col("total_rows") - F.col("distinct_rows")
        ),
        "clean_report": sums(
            raw_rows="total_rows",
            **same("malformed_rows", "out_of_range_rows", "duplicate_rows", "kept_rows"),
        ),
    }
