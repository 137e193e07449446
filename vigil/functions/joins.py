"""Joins in which a null key equals a null key, so no row is lost for want of a key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str],
                   how: str = "inner") -> DataFrame:
    """Like ``left.join(right, keys, how)`` for inner, left and full outer joins, with null-safe
    comparison; the key columns come first, once."""
    other = right.withColumnsRenamed({c: f"_r_{c}" for c in keys})
    on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in keys])
    both = left.join(other, on, how)
    if how.startswith("full"):
        both = both.withColumns({c: F.coalesce(c, f"_r_{c}") for c in keys})
    rest = [c for c in [*left.columns, *right.columns] if c not in keys]
    return both.select(*keys, *rest)
