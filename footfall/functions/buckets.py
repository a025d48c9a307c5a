"""Banding of a number into scores or labels, as one CASE expression."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def _bands(
    value: str,
    holds: Callable[[Column, Column], Column],
    bands: Iterable[tuple[float, Any]],
    rest: Any,
) -> Column:
    cases = F
    for bound, out in bands:
        cases = cases.when(holds(F.expr(value), F.lit(bound)), F.lit(out))
    return F.lit(rest) if cases is F else cases.otherwise(F.lit(rest))


def up_to(value: str, bands: Iterable[tuple[float, Any]], beyond: Any) -> Column:
    """Result of the first band whose inclusive upper bound holds ``value``."""
    return _bands(value, Column.__le__, bands, beyond)


def at_least(value: str, bands: Iterable[tuple[float, Any]], below: Any) -> Column:
    """Result of the first band whose inclusive lower bound ``value`` reaches."""
    return _bands(value, Column.__ge__, bands, below)
