"""Streaming queries: the tables are landed as files slice by slice, each slice is run as one
micro-batch (``availableNow`` on one checkpoint), and the outputs of all batches are returned."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions.sizing import materialize
from vigil.plans import feeds
from vigil.plans.sensors import r4, settle
from vigil.session import ensure_checkpoint_dir
from vigil.sources.messages import read_answers, read_records_table
from vigil.sources.tables import events, read_table
from vigil.streaming import AnomalyStream, BatchHeaders, LineJobs, WordCounts, with_answers

SLICES = 3
DAYS = 30


def _slice(ts: str, slices: int = SLICES) -> Column:
    """Number of the slice of the month that a time falls into; what comes earlier or has no time is
    in the first, what comes later in the last."""
    days = F.datediff(F.col(ts).cast("date"), F.lit("2024-01-01").cast("date"))
    return F.coalesce(F.greatest(F.lit(0), F.least(
        F.lit(slices - 1), F.floor(days / (DAYS // slices)))), F.lit(0))


def _root(spark: SparkSession) -> str:
    """A folder of its own in the shared one of ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/vigil-streams/{uuid.uuid4().hex}"


def _stream(spark: SparkSession, records: DataFrame, process: Callable, root: str, slices: int = SLICES,
            source: Callable[[DataFrame], DataFrame] = lambda df: df, name: str | None = None,
            between: Callable[[int], None] = lambda i: None) -> None:
    """Run ``process`` over the slices of ``records`` (column ``slice``), calling ``between`` behind
    each; ``source`` may extend the stream of records."""
    for i in range(slices):
        records.where(F.col("slice") == i).drop("slice").write.mode("append").parquet(f"{root}/in")
        w = (source(read_records_table(spark, f"{root}/in", streaming=True)).writeStream
             .foreachBatch(process).option("checkpointLocation", f"{root}/checkpoint"))
        w = w.queryName(name) if name else w
        w.trigger(availableNow=True).start().awaitTermination()
        between(i)


def _messages(spark: SparkSession, sf_dir: str, slices: int = SLICES) -> DataFrame:
    records = feeds.json_records(events(spark, sf_dir), keep=("ts",))
    return records.select("topic", "partition", "offset", "value", _slice("ts", slices).alias("slice"))


def _anomalies(spark: SparkSession, sf_dir: str, **options) -> AnomalyStream:
    root = _root(spark)
    process = AnomalyStream(f"{root}/out", **options)
    _stream(spark, _messages(spark, sf_dir), process, root)
    return process


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _anomalies(spark, sf_dir).output(spark, "events")
    return e.select("batch_id", "sensor", F.col("offset").alias("ord"), "guid", "x",
                    r4("lo"), r4("hi"), "kind")


def _commands(c: DataFrame) -> DataFrame:
    return c.select(F.col("scope").alias("guid"), "batch_id", "command", "code", "warning", "alarm")


def stream_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commands of every device's own alarm."""
    return _commands(_anomalies(spark, sf_dir, scope="guid").output(spark, "commands"))


ACK_SLICES = 6


def stream_acks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commands of every device's own alarm while the devices answer through a second stream: a
    batch's command is answered before the next batch, unless (device + batch) % 3 is 0."""
    root = _root(spark)
    process = AnomalyStream(f"{root}/out", scope="guid", auto_ack=False)
    spark.createDataFrame([], "scope string, batch_id long, ack boolean").write.parquet(f"{root}/answers")

    def answer(i: int) -> None:
        sent = process.output(spark, "commands").where(F.col("batch_id") == i)
        given = (F.col("scope").cast("long") + F.col("batch_id")) % 3 != 0
        sent.select("scope", "batch_id", given.alias("ack")).write.mode("append").parquet(f"{root}/answers")

    _stream(spark, _messages(spark, sf_dir, ACK_SLICES), process, root, ACK_SLICES,
            lambda records: with_answers(records, read_answers(spark, f"{root}/answers")), between=answer)
    return _commands(process.output(spark, "commands"))


def stream_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _anomalies(spark, sf_dir).output(spark, "statistics")
    return s.select("batch_id", "sensor", F.col("n").alias("cnt"), r4("mean"), r4("std"))


def stream_reassemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages read line by line, some of them over several batches: the last lines of every
    partition's slice come with the next one, wherever that cuts a message."""
    ev = events(spark, sf_dir)
    lines = feeds.split_line_records(ev, keep=("ts",))
    # cut between lines: an offset that no message starts or ends at
    # (every message has a line at the first of its offsets: no text is needed to find them)
    places = ev.select("ts", (F.col("event_id") % feeds.LINE_PARTITIONS).cast("int").alias("partition"),
                       (F.col("event_id") * feeds.LINE_SLOTS).alias("offset"))
    first = places.groupBy("partition", _slice("ts").alias("_s")).agg(F.min("offset").alias("_o"))
    cuts = [F.max(F.when(F.col("_s") == i, F.col("_o"))).alias(f"_c{i}") for i in range(1, SLICES)]
    cuts = first.groupBy("partition").agg(*cuts)
    later = sum((F.coalesce((F.col("offset") > F.col(f"_c{i}") + 1).cast("int"), F.lit(0))
                 for i in range(1, SLICES)), F.lit(0))
    records = lines.join(F.broadcast(cuts), "partition").select(
        "topic", "partition", "offset", "value", later.alias("slice"))
    root = _root(spark)
    process = AnomalyStream(f"{root}/out", framing="lines", values=True)
    _stream(spark, materialize(records, "lines"), process, root)
    v = process.output(spark, "values")
    return v.select(F.expr(f"offset div {feeds.LINE_SLOTS}").alias("ord"), "guid", "reply_url", "temperature",
                    "pressure", "humidity", "ambient_light")


def _line_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = feeds.pretty_lines(events(spark, sf_dir), keep=("ts",))
    return lines.select(F.lit("lines").alias("topic"), F.lit(0).alias("partition"),
                        (F.col("ord") * 16 + F.col("line_no")).alias("offset"), "value",
                        _slice("ts").alias("slice"))


def stream_line_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _root(spark)
    _stream(spark, _line_records(spark, sf_dir), LineJobs(f"{root}/out"), root)
    s = spark.read.parquet(f"{root}/out/sum")
    return s.select(F.col("batch_id").cast("long"), "sensor", settle(F.col("total"), 6).alias("total"),
                    "label")


def stream_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for every batch of the line jobs, also for the one that comes without lines."""
    root, headers = _root(spark), BatchHeaders()
    records = _line_records(spark, sf_dir)
    records = records.withColumn("slice", F.when(F.col("slice") > 0, F.col("slice") + 1).otherwise(0))
    with headers.listening(spark):
        _stream(spark, records, LineJobs(f"{root}/out"), root, SLICES + 1, headers.observe, headers.name)
    return headers.table(spark).select("batch_id", "records")


def stream_word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    records = docs.select(F.lit("texts").alias("topic"), F.lit(0).alias("partition"),
                          F.col("doc_id").alias("offset"), F.col("text").alias("value"),
                          F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(SLICES)).alias("slice"))
    root = _root(spark)
    _stream(spark, records, WordCounts(f"{root}/out"), root)
    w = spark.read.parquet(f"{root}/out/word_counts")
    return w.select(F.col("batch_id").cast("long"), "word", "n")
