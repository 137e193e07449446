"""Queries of the message, summary, line, word and baseline jobs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions.sizing import materialize
from vigil.operators import baseline, lines, summary, words
from vigil.operators.breach import plan_breaches
from vigil.plans import feeds
from vigil.plans.sensors import settle
from vigil.session import ensure_checkpoint_dir
from vigil.sources.framing import decode_records, readings_of, reassemble
from vigil.sources.messages import read_lines
from vigil.sources.splits import read_objects
from vigil.sources.tables import events, message_readings, read_table, wide_messages

DP = 4


def _r(c, dp=DP):
    return settle(F.col(c), dp).alias(c)


def _projection(msgs: DataFrame, ord_col) -> DataFrame:
    """The reference's reading projection (P1): device, reply url and the four sensor values."""
    m = F.col("msg")
    d = m.getField("payload").getField("data")
    return msgs.select(ord_col.alias("ord"), m.getField("guid").alias("guid"),
                       m.getField("payload").getField("reply_to").alias("reply_url"),
                       *[d.getField(f).alias(f) for f in ("temperature", "pressure", "humidity", "ambient_light")],
                       d.getField("timestamp").alias("timestamp"))


# -- sources and framing ------------------------------------------------------------------

def json_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    msgs, _ = decode_records(feeds.json_records(events(spark, sf_dir)), keep=["offset"])
    return _projection(msgs, F.col("offset"))


def json_reassemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, _, _ = reassemble(feeds.split_line_records(events(spark, sf_dir)))
    msgs, _ = decode_records(docs, keep=["offset"])
    return _projection(msgs, F.expr(f"offset div {feeds.LINE_SLOTS}"))


def reassemble_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the line feed loses, with its text: nothing else may be missing."""
    docs, unfinished, lost = reassemble(feeds.split_line_records(events(spark, sf_dir)))
    _, bad = decode_records(docs, keep=["offset"])
    cols = [F.expr(f"offset div {feeds.LINE_SLOTS}").alias("ord"), "value", "reason"]
    return (lost.select(*cols).unionByName(bad.select(*cols)).unionByName(
        unfinished.withColumn("reason", F.lit("unfinished")).select(*cols)))


def decode_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages and rejects of records of every form, each record accounted for."""
    msgs, bad = decode_records(feeds.mixed_records(events(spark, sf_dir)), ["offset"],
                               lambda p: materialize(p, "parsed"))
    good = msgs.select(F.col("offset").alias("ord"), F.col("idx").cast("int").alias("idx"),
                       F.col("msg.payload.data.temperature").alias("temperature"),
                       F.lit(None).cast("string").alias("text"), F.lit(None).cast("string").alias("reason"))
    return good.unionByName(bad.select(
        F.col("offset").alias("ord"), F.lit(None).cast("int").alias("idx"),
        F.lit(None).cast("double").alias("temperature"), F.col("value").alias("text"), "reason"))


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of JSON files that the query writes: most in one file on a single line, every fifth
    pretty-printed in another."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/vigil-files/{uuid.uuid4().hex}"
    m = wide_messages(events(spark, sf_dir))
    fifth = F.coalesce(F.col("ord") % 5 == 0, F.lit(False))
    (m.where(~fifth).select(F.to_json("msg")).coalesce(1).write.option("lineSep", ",").text(f"{root}/line"))
    (m.where(fifth).select(F.to_json("msg", {"pretty": "true"})).coalesce(1).write.option("lineSep", " ,\n")
     .text(f"{root}/pretty"))
    docs, lost = read_objects(spark, root)
    msgs, bad = decode_records(docs, keep=["offset"])
    good = _projection(msgs, F.lit(None).cast("long")).drop("ord").withColumn("reason", F.lit(None).cast("string"))
    nothing = [F.lit(None).cast(t).alias(c) for c, t in good.dtypes if c != "reason"]
    return good.unionByName(lost.select(*nothing, "reason")).unionByName(bad.select(*nothing, "reason"))


def read_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word total of text files that the query writes, read line by line."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/vigil-files/{uuid.uuid4().hex}"
    read_table(spark, sf_dir, "documents").select("text").write.text(path)
    return words.word_total(read_lines(spark, path), "value")


def sensor_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    msgs, _ = decode_records(feeds.sensor_array_records(events(spark, sf_dir)), keep=["offset"])
    r = readings_of(msgs.withColumnRenamed("offset", "ord"), ["ord"])
    return r.select("ord", "guid", "sensor", "x")


def rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = decode_records(feeds.broken_records(events(spark, sf_dir)), keep=["offset"])
    return bad.select(F.col("offset").alias("ord"), "reason")


# -- batch summaries (SQL over messages) ------------------------------------------------------------

def _msgs(spark, sf_dir):
    return wide_messages(events(spark, sf_dir))


def distinct_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.distinct_float(_msgs(spark, sf_dir)).orderBy(F.col("temperature").desc())


def summary_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = summary.mean_min_max(summary.distinct_float(_msgs(spark, sf_dir)))
    return s.select(_r("avg(temperature)"), "min(temperature)", "max(temperature)")


def summary_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = summary.summary_stats(summary.distinct_float(_msgs(spark, sf_dir)))
    return s.select("count", _r("mean"), _r("stddev"), "min", "max")


def describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``describe()``: one row each of count, mean, stddev, min and max, as rounded numbers."""
    d = summary.distinct_float(_msgs(spark, sf_dir)).describe()
    return d.select("summary", settle(F.col("temperature").cast("double")).alias("temperature"))


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = summary.alerts(summary.distinct_float(_msgs(spark, sf_dir)))
    return a.select("max_temperature", _r("avg_temperature"), "max_alert", "avg_alert")


def search_eq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.search_eq(_msgs(spark, sf_dir), 100.0)


def filter_gt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.filter_gt(_msgs(spark, sf_dir), 85.0)


def top_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.top_desc(_msgs(spark, sf_dir), 100)


# -- line stream jobs ---------------------------------------------------------------------

def _lines(spark, sf_dir):
    """Messages printed one field a line, and the same on one compact line each."""
    ev = events(spark, sf_dir)
    return feeds.pretty_lines(ev).unionByName(feeds.compact_lines(ev))


LINE_IDS = ["batch", "ord", "line_no"]


def _values(spark, sf_dir):
    m = lines.matched_lines(feeds.pretty_lines(events(spark, sf_dir)), LINE_IDS)
    return lines.line_values(m, LINE_IDS)


def line_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = lines.matched_lines(_lines(spark, sf_dir), LINE_IDS)
    return m.select("batch", "ord", "sensor", "line")


def line_filter_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numbers of both feeds; a compact line gives both sensors theirs."""
    m = lines.matched_lines(_lines(spark, sf_dir), LINE_IDS)
    return lines.line_values(m, LINE_IDS).select("batch", "ord", "line_no", "sensor", "x")


def line_filter_temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = lines.matched_lines(_lines(spark, sf_dir), LINE_IDS, lines.TEMPERATURE_PATTERN)
    return lines.line_values(m, LINE_IDS).select("batch", "ord", "sensor", "x")


def line_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _values(spark, sf_dir).select("batch", "ord", "sensor", "x")


def batch_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.batch_count(_values(spark, sf_dir))


def batch_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = lines.batch_sum(_values(spark, sf_dir))
    return s.select("batch", "sensor", _r("total", 6), "label")


def batch_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    # written once: a range sort samples its input, which would match and parse every line twice
    return lines.batch_sort(materialize(_values(spark, sf_dir), "values"))


def string_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.batch_sort(materialize(_values(spark, sf_dir), "values"), by_text=True)


# -- word jobs ----------------------------------------------------------------------------

def word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.word_counts(read_table(spark, sf_dir, "documents"))


def word_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.word_total(read_table(spark, sf_dir, "documents"))


def strip_whitespace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.stripped_length(read_table(spark, sf_dir, "documents"), ["doc_id"])


# -- expectation from the data ------------------------------------------------------------

def residual_breaches(spark: SparkSession, sf_dir: str) -> DataFrame:
    msgs = wide_messages(events(spark, sf_dir), unit="hour", keep=("ts",))
    readings = message_readings(msgs, keep=("ts",))
    mean = materialize(baseline.hourly_expectation(readings), "expectation")
    # residuals are settled, so that both engines' sums fall on the same side of a bound
    res = baseline.residual_readings(readings, mean).drop("ts").withColumn("x", settle(F.col("x"), 6))
    c = plan_breaches(res).codes()
    return c.select("ord", "sensor", "batch", "x", _r("lo"), _r("hi"), "code")
