"""Running (prefix) aggregates without a single-task window.

A plain ``Window.partitionBy(k).orderBy(t)`` running sum puts every row of a key into one
task; ordered over the whole table (no key) it puts *everything* in one task. Here the order
column is cut into buckets: bucket totals are a small aggregate, their exclusive prefix is a
window over buckets only, and the in-bucket running value is a window partitioned by
``(keys, bucket)``. The result is ``combine(prefix of earlier buckets, in-bucket running)``,
so no task ever holds more than one bucket of one key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.functions.joins import null_safe_join

_AGG = {"sum": F.sum, "max": F.max, "min": F.min}


@dataclass(frozen=True)
class RunSpec:
    """``out`` = running ``op`` of ``col`` in order; ``inclusive=False`` stops before the row."""
    out: str
    col: str
    op: str = "sum"
    inclusive: bool = True


def _combine(op: str, pre: Column, cur: Column) -> Column:
    if op == "sum":
        return F.when(pre.isNull() & cur.isNull(), F.lit(None)).otherwise(
            F.coalesce(pre, F.lit(0)) + F.coalesce(cur, F.lit(0)))
    if op == "max":
        return F.greatest(pre, cur)
    return F.least(pre, cur)


def default_bucket(df: DataFrame, order: str) -> Column:
    """Calendar month for timestamps; ``order // 2**16`` for integral order columns."""
    kind = df.schema[order].dataType.typeName()
    if kind.startswith("timestamp") or kind == "date":
        return F.date_trunc("month", F.col(order))
    return F.floor(F.col(order) / F.lit(1 << 16))


def running(df: DataFrame, by: list[str], order: str, specs: list[RunSpec],
            bucket: Column | None = None, parts: int | None = None) -> DataFrame:
    """Add one column per spec: the running aggregate within ``by`` ordered by ``order``.

    ``order`` must be unique within ``by`` (it is the batch key in every use here). Null keys are
    a group like any other. ``parts`` tasks take the rows (None: as many as the session says)."""
    bkt = bucket if bucket is not None else default_bucket(df, order)
    b = df.withColumn("_bkt", bkt)
    # 1. running value inside each (by, bucket): the one exchange of the input rows
    cols = []
    for s in specs:
        w = Window.partitionBy(*by, "_bkt").orderBy(order).rowsBetween(
            Window.unboundedPreceding, 0 if s.inclusive else -1)
        cols.append(_AGG[s.op](s.col).over(w).alias(f"_i_{s.out}"))
    inner = (b.repartition(parts, *by, "_bkt") if parts else b).select("*", *cols)
    # 2. bucket totals (partial aggregation of the input, one row per key and bucket) and
    #    their exclusive prefix: a window over bucket rows only. The input is evaluated by
    #    both branches; callers write or persist it when it is expensive.
    tot = b.groupBy(*by, "_bkt").agg(*[_AGG[s.op](s.col).alias(f"_t_{s.out}") for s in specs])
    wb = Window.partitionBy(*by).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    pre = tot.select(*by, "_bkt",
                     *[_AGG[s.op](f"_t_{s.out}").over(wb).alias(f"_p_{s.out}") for s in specs])
    # 3. combine on the window's own keys, so the row side keeps its partitioning
    joined = null_safe_join(inner, pre, [*by, "_bkt"], "left")
    out = joined.select(*df.columns,
                        *[_combine(s.op, F.col(f"_p_{s.out}"), F.col(f"_i_{s.out}")).alias(s.out)
                          for s in specs])
    return out
