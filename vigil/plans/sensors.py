"""Queries of the anomaly pipeline: statistics, breaches, states, alarm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.operators.alarm import alarm_commands, alarm_machine, alarm_type
from vigil.operators.breach import plan_breaches
from vigil.functions.sizing import materialize
from vigil.operators.moments import batch_partials, running_totals
from vigil.sources.tables import events, long_readings, message_readings, wide_messages

DP = 4  # doubles derived from sums are compared at 4 decimals


def settle(c, dp: int = DP):
    """Round to ``dp`` decimals after first rounding at ``dp + 6``: running means of short
    decimals often sit exactly on a rounding tie, and two engines' summation orders put them an
    ulp either side; the first rounding removes that noise so both land on the same side."""
    return F.round(F.round(c, dp + 6), dp)


def r4(c):
    return settle(F.col(c)).alias(c)


def long_plan(spark: SparkSession, sf_dir: str):
    return plan_breaches(long_readings(events(spark, sf_dir), unit="day"))


def wide_plan(spark: SparkSession, sf_dir: str):
    return plan_breaches(message_readings(wide_messages(events(spark, sf_dir), unit="hour")))


def breaches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: every reading with its two-sigma band (statistics through its batch) and code."""
    c = long_plan(spark, sf_dir).codes()
    return c.select("ord", "guid", "sensor", "batch", "x", r4("lo"), r4("hi"), "code")


def running_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = long_plan(spark, sf_dir).thr
    return t.select("sensor", "batch", "cnt", r4("mean"), r4("std"), r4("lo"), r4("hi"))


def running_totals_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = materialize(batch_partials(long_readings(events(spark, sf_dir), unit="day")), "partials")
    t = running_totals(p)
    return t.select("sensor", "batch", "cnt", r4("total"), r4("mean"))


def sensor_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = wide_plan(spark, sf_dir).states()
    return s.select("ord", "guid", "sensor", "batch", "x", "code", "state")


def breach_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = wide_plan(spark, sf_dir).events()
    return e.select("sensor", "batch", "ord", "guid", "x", r4("lo"), r4("hi"), "kind")


def alarm_type_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = wide_plan(spark, sf_dir)
    return alarm_type(p.end_states()).select("batch", "alarm_type")


def alarm_commands_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = wide_plan(spark, sf_dir)
    m = alarm_machine(alarm_type(p.end_states()))
    return alarm_commands(m).select("batch", "command", "code", "warning", "alarm")


def ack_rule(types: DataFrame) -> DataFrame:
    """Fixture acknowledgements: the device answers except in every third hour."""
    return types.select("scope", "batch", ((F.hour("batch") % 3) != 0).alias("ack"))


def alarm_with_acks(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = wide_plan(spark, sf_dir)
    types = alarm_type(p.end_states())
    m = alarm_machine(types, ack_rule(types))
    return m.select("batch", "alarm_type", "ack", "alarm", "command")


def device_breaches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-device statistics (scope = guid): each device's own running band."""
    r = long_readings(events(spark, sf_dir), unit="day", scope="guid")
    c = plan_breaches(r).codes()
    return c.select("ord", "guid", "sensor", "batch", "x", r4("lo"), r4("hi"), "code")


def device_alarm_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-device alarm (scope = guid): each device's own sensor states drive its own alarm."""
    p = plan_breaches(message_readings(wide_messages(events(spark, sf_dir), unit="hour"), scope="guid"))
    m = alarm_machine(alarm_type(p.end_states()))
    return alarm_commands(m).select(F.col("scope").alias("guid"), "batch", "command", "code", "warning", "alarm")
