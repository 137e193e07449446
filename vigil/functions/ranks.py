"""Places in a sorted order without a task that sees all rows.

The distinct values are counted (partial counts, so a value that a third of all rows hold is one
row a task), and each count goes to the range of its value. Within a range a window adds up; the
totals of the ranges, ``RANGES`` rows per group, are added up across; the sum is the place. Rows
take theirs from the small table of values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.functions.joins import null_safe_join
from vigil.functions.sizing import bounded_broadcast, hint

RANGES = 256
# Relative error of the splitters' quantiles: ranges differ in size by so much at most.
_ERROR = 1.0 / (4 * RANGES)


def ranked(df: DataFrame, by: list[str], value: str, place: str, descending: bool = True) -> DataFrame:
    """``df`` with the rank of ``value`` (numeric; equal values share it) within ``by``, in a table
    sorted by it. Nulls come last, as the largest place."""
    counts, small = bounded_broadcast(df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n")), name="values")
    numbers = counts.where(F.col(value).isNotNull())
    splitters = numbers.approxQuantile(value, [i / RANGES for i in range(1, RANGES)], _ERROR)
    cuts = F.array(*[F.lit(float(c)) for c in sorted(set(splitters))]).cast("array<double>")
    # the number of splitters up to the value; nulls have a range of their own
    up = F.size(F.filter(cuts, lambda c: c <= F.col(value)))
    number = F.when(F.col(value).isNull(), F.lit(RANGES + 1)).otherwise(
        F.lit(RANGES) - up if descending else up)
    key = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_last()
    counts = counts.withColumn("_range", number)
    past = Window.unboundedPreceding
    inside = Window.partitionBy(*by, "_range").orderBy(key).rowsBetween(past, -1)
    totals = counts.groupBy(*by, "_range").agg(F.sum("_n").alias("_t"))
    across = Window.partitionBy(*(by or [F.lit(0)])).orderBy("_range").rowsBetween(past, -1)
    totals = totals.select(*by, "_range", F.coalesce(F.sum("_t").over(across), F.lit(0)).alias("_before"))
    inner = counts.withColumn("_sum", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    places = null_safe_join(inner, F.broadcast(totals) if not by else totals, [*by, "_range"]).select(
        *by, value, (F.lit(1) + F.col("_before") + F.col("_sum")).alias(place))
    out = null_safe_join(df, hint(places, small), [*by, value])
    return out.select(place, *df.columns).orderBy(*by, place)
