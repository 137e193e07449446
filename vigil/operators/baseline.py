"""Expectation taken from the readings themselves (R3): the mean per sensor and hour of day.

Breaches of the residual (reading minus expectation) are judged against the usual course of a
day. The expectation is a partial aggregate over all readings, one row per sensor and hour.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.joins import null_safe_join


def hourly_expectation(readings: DataFrame, ts: str = "ts") -> DataFrame:
    """(sensor, hour, expected): mean reading of each sensor in each hour of the day."""
    return readings.groupBy("sensor", F.hour(ts).alias("hour")).agg(F.avg("x").alias("expected"))


def residual_readings(readings: DataFrame, expectation: DataFrame, ts: str = "ts") -> DataFrame:
    """Long readings with a ``ts`` column -> the same readings with x replaced by x - expected.
    The expectation has at most 24 rows per sensor (25 with a null time)."""
    j = null_safe_join(readings.withColumn("hour", F.hour(ts)), expectation, ["sensor", "hour"], "left")
    return j.withColumn("x", F.col("x") - F.col("expected")).drop("expected", "hour")
