"""Column expressions and small rollups shared by the operators."""

from footfall.functions.buckets import at_least, up_to
from footfall.functions.measures import (
    BEHAVIORS,
    BUY,
    CART,
    FAV,
    VIEW,
    activity,
    rate,
    rollup,
    rows,
    rows_of,
    saw,
    seen_by_user,
    top,
    users,
    users_where,
)

__all__ = [
    "BEHAVIORS",
    "BUY",
    "CART",
    "FAV",
    "VIEW",
    "activity",
    "at_least",
    "rate",
    "rollup",
    "rows",
    "rows_of",
    "saw",
    "seen_by_user",
    "top",
    "up_to",
    "users",
    "users_where",
]
