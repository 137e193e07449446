"""Running count / mean / variance per (scope, sensor) over all batches so far.

Semantics kept from the reference: statistics include the current batch; the shift K is the
first reading ever seen for the key; mean = K + A/N (0.0 when N = 0); variance =
(B - A^2/N)/(N - 1), 0.0 when N < 2, where A = sum(x - K) and B = sum((x - K)^2).

Plan: one partial aggregate over the readings gives, per (scope, sensor, batch), the count,
the batch mean and the batch sum of squared deviations (Spark's Welford/Chan moments, exact
for constant batches), first/last reading and extremes. Those are re-centred on K exactly:
a = n (mean_b - K), b = m2_b + n (mean_b - K)^2, so across batches merging is plain addition
(two-level running scan, no single-task window). Readings never leave their executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.exact import limb_sums, with_limbs, with_moments
from vigil.functions.joins import null_safe_join
from vigil.functions.scan import RunSpec, running
from vigil.schema import SIGMAS

KEY = ["scope", "sensor"]


def batch_partials(readings: DataFrame) -> DataFrame:
    """One row per (scope, sensor, batch); map-side partial aggregation, so a hot key costs
    one partial row per map task. The sums are exact, so thresholds made of them, and breaches of
    readings that lie right at one, do not depend on how the readings are dealt to tasks."""
    g = with_limbs(readings.select(*KEY, "batch", "ord", "x"), "x").groupBy(*KEY, "batch").agg(
        F.count("x").alias("n"),
        F.sum("x").alias("_sum"),
        F.avg("x").alias("_avg"),
        F.var_pop("x").alias("_vp"),
        F.min("x").alias("x_min"),
        F.max("x").alias("x_max"),
        F.min_by("x", "ord").alias("x_first"),
        F.max_by("x", "ord").alias("x_last"), *limb_sums())
    const, exact = F.col("x_min") == F.col("x_max"), F.col("_large") == 0
    return with_moments(g, "n").select(
        *KEY, "batch", "n", F.when(exact, F.col("_total")).otherwise(F.col("_sum")).alias("sum_b"),
        "x_min", "x_max", "x_first", "x_last",
        F.when(const, F.col("x_min")).when(exact, F.col("_mean")).otherwise(F.col("_avg")).alias("mean_b"),
        F.when(const, F.lit(0.0)).when(exact, F.col("_squares")).otherwise(F.col("_vp") * F.col("n")).alias("m2_b"))


def running_moments(partials: DataFrame, sigmas: float = SIGMAS) -> DataFrame:
    """Per (scope, sensor, batch): k, cnt, mean, var, std, lo, hi (statistics through the batch)."""
    k = partials.groupBy(*KEY).agg(F.min_by("x_first", "batch").alias("k"))
    p = null_safe_join(partials, k, KEY)
    d = F.col("mean_b") - F.col("k")
    p = p.withColumn("a", F.col("n") * d).withColumn("b", F.col("m2_b") + F.col("n") * d * d)
    r = running(p, KEY, "batch", [RunSpec("cnt", "n"), RunSpec("sa", "a"), RunSpec("sb", "b")])
    cnt = F.col("cnt")
    mean = F.when(cnt == 0, F.lit(0.0)).otherwise(F.col("k") + F.col("sa") / cnt)
    var = F.when(cnt < 2, F.lit(0.0)).otherwise(
        (F.col("sb") - F.col("sa") * F.col("sa") / cnt) / (cnt - 1))
    std = F.sqrt(F.greatest(var, F.lit(0.0)))
    out = r.select("*", mean.alias("mean"), var.alias("var"), std.alias("std"))
    return (out.withColumn("lo", F.col("mean") - F.col("std") * F.lit(sigmas))
               .withColumn("hi", F.col("mean") + F.col("std") * F.lit(sigmas))
               .drop("a", "b", "sa", "sb", "sum_b"))


def running_totals(partials: DataFrame) -> DataFrame:
    """A10: running count, total and mean per (scope, sensor, batch); mean 0.0 when count 0."""
    r = running(partials, KEY, "batch", [RunSpec("cnt", "n"), RunSpec("total", "sum_b")])
    return r.select(*KEY, "batch", "cnt", "total",
                    F.when(F.col("cnt") == 0, F.lit(0.0))
                     .otherwise(F.col("total") / F.col("cnt")).alias("mean"))
