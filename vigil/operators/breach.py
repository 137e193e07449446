"""Two-sigma breaches (F5), per-sensor warning states (T4) and breach events.

Reference rule, per reading in order: x > hi -> state 1, x < lo -> state -1; in range ->
2 if the sensor's state was not 0, else 0. State 2 is sticky (it never returns to 0), so
the state of an in-range reading is 2 exactly when *any* earlier reading of the key breached.

Set form (no ordered per-row loop):
  * per (scope, sensor, batch) the small thresholds table knows whether the batch breaches
    (x_max > hi or x_min < lo), the running "breached before this batch" flag and the code of
    the batch's last reading — enough for the end-of-batch state of every key;
  * the only row-level ordering needed is the first breaching ``ord`` inside the one batch
    where a key first breaches: a ``min`` aggregate (partial, skew-proof) joined back.
The thresholds table is materialized once and broadcast only when its row count is under
the bound; otherwise the joins are ordinary shuffled joins.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions.joins import null_safe_join
from vigil.functions.sizing import MAX_BROADCAST_ROWS, bounded_broadcast, hint, materialize
from vigil.operators.moments import KEY, batch_partials, running_moments
from vigil.schema import SIGMAS


def breach_code(x: Column, lo: Column, hi: Column) -> Column:
    """+1 above hi, -1 below lo, else 0 — strict on both sides."""
    return F.when(x > hi, F.lit(1)).when(x < lo, F.lit(-1)).otherwise(F.lit(0))


def thresholds(partials: DataFrame, sigmas: float = SIGMAS) -> DataFrame:
    """Per (scope, sensor, batch): statistics, band, batch breach flags and end-of-batch state,
    from the (materialized) batch partials."""
    m = running_moments(partials, sigmas)
    m = m.withColumn("breach_b", ((F.col("x_max") > F.col("hi")) | (F.col("x_min") < F.col("lo"))).cast("int"))
    m = m.withColumn("last_code", breach_code(F.col("x_last"), F.col("lo"), F.col("hi")))
    # breach flags are monotone in time: one "first breaching batch" per key decides them
    m = materialize(m, "moments")
    fbb = m.where(F.col("breach_b") == 1).groupBy(*KEY).agg(F.min("batch").alias("fbb"))
    r = null_safe_join(m, fbb, KEY, "left")
    r = (r.withColumn("br_thru", F.coalesce((F.col("batch") >= F.col("fbb")).cast("int"), F.lit(0)))
          .withColumn("br_before", F.coalesce((F.col("batch") > F.col("fbb")).cast("int"), F.lit(0)))
          .drop("fbb"))
    end_state = (F.when(F.col("last_code") != 0, F.col("last_code"))
                 .when(F.col("br_thru") == 1, F.lit(2)).otherwise(F.lit(0)))
    first_here = (F.col("breach_b") == 1) & (F.col("br_before") == 0)
    return r.withColumn("end_state", end_state).withColumn("first_here", first_here)


@dataclass
class BreachPlan:
    """Readings plus their materialized thresholds table and the join strategy chosen for it."""
    readings: DataFrame
    thr: DataFrame
    small: bool          # thresholds may be broadcast
    max_broadcast_rows: int = MAX_BROADCAST_ROWS

    def codes(self) -> DataFrame:
        t = self.thr.select(*KEY, "batch", "lo", "hi", "br_before", "first_here")
        j = null_safe_join(self.readings, hint(t, self.small), [*KEY, "batch"])
        return j.withColumn("code", breach_code(F.col("x"), F.col("lo"), F.col("hi")))

    def _first_breaches(self) -> DataFrame:
        """The thresholds table with ``fb_ord``, the first breaching reading of each key. Only the
        one batch in which a key first breaches is looked at."""
        firsts, few = bounded_broadcast(self.thr.where("first_here").select(*KEY, "batch", "lo", "hi"),
                                        self.max_broadcast_rows, "firsts")
        j = null_safe_join(self.readings, hint(firsts, few), [*KEY, "batch"])
        fb = (j.where(breach_code(F.col("x"), F.col("lo"), F.col("hi")) != 0)
              .groupBy(*KEY).agg(F.min("ord").alias("fb_ord")))
        t = self.thr.select(*KEY, "batch", "lo", "hi", "br_before", "first_here")
        return materialize(null_safe_join(t, fb, KEY, "left"), "first-breaches")

    def states(self) -> DataFrame:
        s = null_safe_join(self.readings, hint(self._first_breaches(), self.small), [*KEY, "batch"])
        s = s.withColumn("code", breach_code(F.col("x"), F.col("lo"), F.col("hi")))
        back = (F.col("br_before") == 1) | (F.col("first_here") & (F.col("ord") > F.col("fb_ord")))
        state = (F.when(F.col("code") != 0, F.col("code"))
                 .when(back, F.lit(2)).otherwise(F.lit(0)))
        return s.withColumn("state", state).drop("fb_ord")

    def events(self) -> DataFrame:
        s = self.states()
        kind = (F.when(F.col("code") == 1, F.lit("HIGH")).when(F.col("code") == -1, F.lit("LOW"))
                .otherwise(F.lit("BACK")))
        return (s.where((F.col("code") != 0) | (F.col("state") == 2))
                 .select(*KEY, "batch", "ord", "guid", "x", "lo", "hi", kind.alias("kind")))

    def end_states(self) -> DataFrame:
        return self.thr.select(*KEY, "batch", "end_state")


def plan_breaches(readings: DataFrame, sigmas: float = SIGMAS,
                  max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> BreachPlan:
    """Pass 1 scans the readings once into per-batch partials (written once: everything up to
    the thresholds reads only that small table); later passes join thresholds back to rows.
    Readings of a null key or batch are a group of their own."""
    partials = materialize(batch_partials(readings), "partials")
    thr, small = bounded_broadcast(thresholds(partials, sigmas), max_broadcast_rows, "thresholds")
    return BreachPlan(readings, thr, small, max_broadcast_rows)
