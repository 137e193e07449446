"""Per-micro-batch line and word jobs (reference: 2-second DStream batches) and a console sink.

Each job is a ``foreachBatch`` function: it persists the batch once and writes every output
for ``batch_id`` with overwrite, so a re-delivered batch rewrites the same files.
"""

from __future__ import annotations

import threading
import uuid
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from vigil.operators import lines as L
from vigil.operators import words as W
from vigil.schema import RUNNING_NAMES


def console(df: DataFrame, checkpoint: str, num_rows: int = 20, trigger: dict | None = None):
    """K1: print every micro-batch (a header per batch, even when empty), first ``num_rows``."""
    w = (df.writeStream.format("console").option("numRows", str(num_rows)).option("truncate", "false")
         .option("checkpointLocation", checkpoint))
    return w.trigger(**(trigger or {"processingTime": "2 seconds"})).start()


class BatchHeaders(StreamingQueryListener):
    """One row per batch of a query: its id, time and number of records, 0 included. The records are
    counted while the batch's own jobs read them (``observe``), and reported with its progress; a
    job that reads the batch twice without persisting it would count them twice.

        headers = BatchHeaders()
        with headers.listening(spark):
            headers.observe(records).writeStream.queryName(headers.name)...
        headers.table(spark)
    """

    def __init__(self, name: str | None = None):
        self.name = name or f"headers-{uuid.uuid4().hex}"
        self.rows: dict[int, tuple[int, str, int]] = {}
        self._running: set[str] = set()
        self._quiet = threading.Condition()

    def observe(self, records: DataFrame) -> DataFrame:
        return records.observe(self.name, F.count(F.lit(1)).alias("records"))

    @contextmanager
    def listening(self, spark: SparkSession, patience: float = 60.0):
        """Listen while queries run; at the end, wait until the last one has been reported."""
        spark.streams.addListener(self)
        try:
            yield self
            with self._quiet:
                self._quiet.wait_for(lambda: not self._running, patience)
        finally:
            spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            with self._quiet:
                self._running.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.name == self.name:
            seen = p.observedMetrics.get(self.name)
            if seen is not None or p.batchId not in self.rows:
                self.rows[p.batchId] = (p.batchId, p.timestamp, seen.records if seen is not None else 0)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._quiet:
            self._running.discard(str(event.runId))
            self._quiet.notify_all()

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([self.rows[i] for i in sorted(self.rows)],
                                     "batch_id long, time string, records long")


@dataclass
class LineJobs:
    """Line stream: filter (F3), values (P3/P6), count (A1), sums (A2), sorted values (O2/O3),
    label lines (P8) and running totals across batches (A10, kept in a small state table)."""
    root: str
    sort_as_text: bool = False

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        out = f"{self.root}/{{}}/batch_id={batch_id}"
        recs = df.select(F.col("offset").alias("ord"), "value")
        m = L.matched_lines(recs, ["ord"]).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            v = L.line_values(m, ["ord"]).withColumn("batch", F.lit(batch_id))
            m.write.mode("overwrite").parquet(out.format("lines"))
            L.batch_count(v).write.mode("overwrite").parquet(out.format("count"))
            sums = L.batch_sum(v)
            sums.write.mode("overwrite").parquet(out.format("sum"))
            L.batch_sort(v, self.sort_as_text).write.mode("overwrite").parquet(out.format("sorted"))
            self._running(df.sparkSession, sums, v, batch_id)
        finally:
            m.unpersist()

    def _running(self, spark, sums: DataFrame, v: DataFrame, batch_id: int) -> None:
        """A10: count / total / mean per sensor over all batches so far (mean 0.0 at count 0)."""
        cur = (v.where(F.col("x").isNotNull()).groupBy("sensor")
                .agg(F.count("*").alias("n_b"), F.sum("x").alias("t_b")))
        path = f"{self.root}/running/version={{}}"
        schema = "sensor string, count long, total double"
        # only the first batch has no version before it; a missing one stops the stream
        prev = (spark.read.schema(schema).parquet(path.format(batch_id - 1)) if batch_id > 0
                else spark.createDataFrame([], schema))
        j = prev.join(cur, "sensor", "full_outer").select(
            "sensor", (F.coalesce("count", F.lit(0)) + F.coalesce("n_b", F.lit(0))).alias("count"),
            (F.coalesce("total", F.lit(0.0)) + F.coalesce("t_b", F.lit(0.0))).alias("total"))
        j = j.withColumn("mean", F.when(F.col("count") == 0, F.lit(0.0)).otherwise(F.col("total") / F.col("count")))
        # the line that reports each sensor's running statistics
        name = F.coalesce(*[F.when(F.col("sensor") == s, F.lit(t)) for s, t in RUNNING_NAMES.items()],
                          F.col("sensor"))
        label = F.concat(F.lit("Running stats for "), name, F.format_string(
            ": count=%d total=%.2f mean=%.2f", "count", "total", "mean"))
        j.withColumn("label", label).write.mode("overwrite").parquet(path.format(batch_id))


@dataclass
class WordCounts:
    """Word counts of each batch only (no running total), words split on single spaces (A3)."""
    root: str

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        (W.word_counts(df.select(F.col("value").alias("text")))
           .write.mode("overwrite").parquet(f"{self.root}/word_counts/batch_id={batch_id}"))


@dataclass
class SqlJobs:
    """Per batch: decode the batch's JSON documents, register them as the view ``view`` and run
    the statements on it; each result is written for the batch id under its name. Bad records go
    to ``rejects`` instead of failing (or silently skipping) the batch."""
    root: str
    statements: dict
    view: str = "messages"

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        from vigil.plans import sqlview
        from vigil.sources.framing import decode_records
        spark = df.sparkSession
        recs = df.select("topic", "partition", "offset", "value").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            msgs, bad = decode_records(recs, keep=["offset"])
            bad.write.mode("overwrite").parquet(f"{self.root}/rejects/batch_id={batch_id}")
            sqlview.register_messages(msgs, self.view)
            for name, sql in self.statements.items():
                spark.sql(sql).write.mode("overwrite").parquet(f"{self.root}/{name}/batch_id={batch_id}")
            sqlview.drop_messages(spark, self.view)
        finally:
            recs.unpersist()
