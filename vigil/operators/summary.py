"""Batch summaries over message tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.schema import ALERT_LIMIT, AVG_ALERT_TEXT, AVG_OK_TEXT, MAX_ALERT_TEXT


def field(msgs: DataFrame, path: str, alias: str, ids: tuple[str, ...] = ()) -> DataFrame:
    """Nested projection with alias (P1), e.g. ``payload.data.temperature as temperature``."""
    return msgs.select(*ids, F.col(f"msg.{path}").alias(alias))


def distinct_float(msgs: DataFrame, path: str = "payload.data.temperature",
                   name: str = "temperature") -> DataFrame:
    """``select distinct cast(<path> as float) as <name>``: the 32-bit narrowing merges near
    values before the distinct (A7, P2). Partial aggregation, so duplicates never pile up."""
    return msgs.select(F.col(f"msg.{path}").cast("float").alias(name)).distinct()


def mean_min_max(values: DataFrame, name: str = "temperature") -> DataFrame:
    """One row, reference column names: avg(<name>), min(<name>), max(<name>) (A5)."""
    return values.agg(F.avg(name).alias(f"avg({name})"), F.min(name).alias(f"min({name})"),
                      F.max(name).alias(f"max({name})"))


def summary_stats(values: DataFrame, name: str = "temperature") -> DataFrame:
    """Typed twin of ``describe()`` (A6): count, mean, stddev (sample), min, max."""
    return values.agg(F.count(name).alias("count"), F.avg(name).alias("mean"),
                      F.stddev_samp(name).alias("stddev"), F.min(name).alias("min"),
                      F.max(name).alias("max"))


def alerts(values: DataFrame, name: str = "temperature", limit: float = ALERT_LIMIT) -> DataFrame:
    """Threshold alerts on the aggregate (F4): the max alert line (or NULL) and the avg verdict."""
    a = mean_min_max(values, name)
    mx, av = F.col(f"max({name})"), F.col(f"avg({name})")
    return a.select(mx.alias("max_temperature"), av.alias("avg_temperature"),
                    F.when(mx > F.lit(limit), F.lit(MAX_ALERT_TEXT)).alias("max_alert"),
                    F.when(av > F.lit(limit), F.lit(AVG_ALERT_TEXT)).otherwise(F.lit(AVG_OK_TEXT))
                     .alias("avg_alert"))


def search_eq(msgs: DataFrame, value: float, ids=("ord",), path="payload.data.temperature",
              name="temperature") -> DataFrame:
    """rows whose field equals ``value``."""
    return field(msgs, path, name, ids).where(F.col(name) == F.lit(value))


def filter_gt(msgs: DataFrame, value: float, ids=("ord",), path="payload.data.temperature",
              name="temperature") -> DataFrame:
    """rows whose field is strictly above ``value``."""
    return field(msgs, path, name, ids).where(F.col(name) > F.lit(value))


def top_desc(msgs: DataFrame, n: int = 100, ids=("ord",), path="payload.data.temperature",
             name="temperature") -> DataFrame:
    """The ``n`` largest values (ties by id) — a top-k, planned as TakeOrderedAndProject."""
    return field(msgs, path, name, ids).orderBy(F.col(name).desc(), *[F.col(i) for i in ids]).limit(n)
