"""Alarm type (T5) and the alarm on/off state machine with acknowledgements.

Alarm states: 0 off, 1 on, 2 changing to off, 3 changing to on. Once per batch, after all
readings: ``on`` = some sensor's end state is +1/-1. Transitions (reference table):

    old  on  send   new (no ack)  new (ack)
     0   y   ON        3             1
     0   n   -         0             0
     1   y   -         1             1
     1   n   OFF       2             0
     2   y   -         2             2
     2   n   OFF       2             0
     3   y   ON        3             1
     3   n   -         3             3

Closed form used here (checked against a sequential replay in the tests): a batch with
on & ack is an "E1", one with not-on & ack an "E0". The alarm is in its on-phase (1 or 2)
after batch t exactly when the latest E-batch up to t is an E1 (E1s inside the on-phase and
E0s inside the off-phase change nothing). The phase began at S1 = the first E1 after the
latest E0 (resp. S0 = the first E0 after the latest E1; the start of time when there is no
E1 yet). In the on-phase the state is 2 when a not-on batch lies in (S1, t], else 1; in the
off-phase it is 3 when an on batch lies in (S0, t], else 0. A command is sent at t when
``on`` differs from the phase before t. The latest-E / latest-on / latest-off batches are
running maxima (one two-level running scan); S0/S1 are minima per segment (aggregates).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.joins import null_safe_join
from vigil.functions.scan import RunSpec, running
from vigil.functions.sizing import materialize
from vigil.schema import ALARM_CODE_OFF, ALARM_CODE_ON, ALARM_PRIORITY


def batch_sensor_states(end_states: DataFrame, priority: list[str] = ALARM_PRIORITY) -> DataFrame:
    """(scope, batch, <one column per sensor>) with each sensor's state after the batch;
    a sensor without readings in a batch keeps its last state (0 before its first reading)."""
    wide = end_states.groupBy("scope", "batch").agg(
        *[F.max(F.when(F.col("sensor") == s, F.col("end_state"))).alias(f"_v{i}")
          for i, s in enumerate(priority)])
    wide = materialize(wide, "sensor-states")
    last = wide.select("scope", "batch", *[
        F.when(F.col(f"_v{i}").isNotNull(), F.struct(F.col("batch").alias("b"), F.col(f"_v{i}").alias("v")))
        .alias(f"_c{i}") for i in range(len(priority))])
    r = running(last, ["scope"], "batch", [RunSpec(f"_r{i}", f"_c{i}", "max") for i in range(len(priority))])
    return r.select("scope", "batch", *[F.coalesce(F.col(f"_r{i}.v"), F.lit(0)).alias(s)
                                        for i, s in enumerate(priority)])


def alarm_type(end_states: DataFrame, priority: list[str] = ALARM_PRIORITY) -> DataFrame:
    """(scope, batch, alarm_type): first sensor in priority order in state +1/-1, else ''. Written
    once, one row per scope and batch."""
    st = batch_sensor_states(end_states, priority)
    t = F.lit("")
    for s in reversed(priority):
        t = F.when(F.col(s).isin(1, -1), F.lit(s)).otherwise(t)
    return materialize(st.select("scope", "batch", t.alias("alarm_type")), "alarm-types")


def alarm_machine(types: DataFrame, acks: DataFrame | None = None) -> DataFrame:
    """Per (scope, batch): alarm_type, ack, state after the batch, and the command sent (or NULL).

    ``acks`` (scope, batch, ack boolean) says whether a command sent in that batch is
    acknowledged; missing rows / no table = acknowledged."""
    t = types
    if acks is not None:
        t = null_safe_join(t, acks.select("scope", "batch", "ack"), ["scope", "batch"], "left")
    else:
        t = t.withColumn("ack", F.lit(None).cast("boolean"))
    t = t.withColumn("ack", F.coalesce(F.col("ack"), F.lit(True)))
    on = F.col("alarm_type") != F.lit("")
    b = F.col("batch")
    t = (t.withColumn("_e1", F.when(on & F.col("ack"), b))
          .withColumn("_e0", F.when(~on & F.col("ack"), b))
          .withColumn("_on", F.when(on, b))
          .withColumn("_off", F.when(~on, b)))
    r = running(t, ["scope"], "batch", [
        RunSpec("e1", "_e1", "max"), RunSpec("e0", "_e0", "max"),
        RunSpec("lon", "_on", "max"), RunSpec("loff", "_off", "max"),
        RunSpec("e1p", "_e1", "max", inclusive=False), RunSpec("e0p", "_e0", "max", inclusive=False)])
    r = materialize(r, "alarm")  # read three times
    # phase starts: first E0 inside the segment opened by the latest E1, and vice versa.
    # Only read in their own phase, where they lie at or before the batch, so a segment
    # minimum (an aggregate, not a running scan) is enough. NULL segment = before any E-batch.
    s0 = r.groupBy("scope", "e1").agg(F.min("_e0").alias("s0")).withColumnRenamed("e1", "_g1")
    s1 = r.groupBy("scope", "e0").agg(F.min("_e1").alias("s1")).withColumnRenamed("e0", "_g0")
    r = (r.join(s0.withColumnRenamed("scope", "_sc1"),
                F.col("scope").eqNullSafe(F.col("_sc1")) & F.col("e1").eqNullSafe(F.col("_g1")), "left")
          .join(s1.withColumnRenamed("scope", "_sc0"),
                F.col("scope").eqNullSafe(F.col("_sc0")) & F.col("e0").eqNullSafe(F.col("_g0")), "left"))
    e1, e0, e1p, e0p = F.col("e1"), F.col("e0"), F.col("e1p"), F.col("e0p")
    lon, loff, s0, s1 = F.col("lon"), F.col("loff"), F.col("s0"), F.col("s1")
    phase_after = e1.isNotNull() & (e0.isNull() | (e1 > e0))
    phase_before = e1p.isNotNull() & (e0p.isNull() | (e1p > e0p))
    on_state = F.when(loff.isNotNull() & (loff > s1), F.lit(2)).otherwise(F.lit(1))
    off_state = F.when(lon.isNotNull() & (e1.isNull() | (lon > s0)), F.lit(3)).otherwise(F.lit(0))
    state = F.when(phase_after, on_state).otherwise(off_state)
    send = on != phase_before
    command = F.when(send & on, F.lit("ON")).when(send, F.lit("OFF"))
    code = F.when(send & on, F.lit(ALARM_CODE_ON)).when(send, F.lit(ALARM_CODE_OFF))
    return r.select("scope", "batch", "alarm_type", "ack", state.alias("alarm"),
                    command.alias("command"), code.alias("code"))


def alarm_commands(machine: DataFrame) -> DataFrame:
    """K7 command rows: (scope, batch, command, code, warning, alarm) for batches that send."""
    return (machine.where(F.col("command").isNotNull())
                   .select("scope", "batch", "command", "code",
                           F.col("alarm_type").alias("warning"), "alarm"))
