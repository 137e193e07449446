"""Command-line jobs on Kafka or on files.

    python -m vigil.apps anomaly  --brokers B --topic T --out DIR --checkpoint DIR [--scope guid]
    python -m vigil.apps lines    --brokers B --topic T --out DIR --checkpoint DIR
    python -m vigil.apps sql      --brokers B --topic T --out DIR --checkpoint DIR --sql "hot=SELECT ..."
    python -m vigil.apps words    --brokers B --topic T --out DIR --checkpoint DIR
    python -m vigil.apps summary  --path FILE_OR_DIR           (batch: whole-file JSON documents)
    python -m vigil.apps wordtotal --path FILE_OR_DIR          (batch: text lines)

Streaming jobs read ``--path`` (a directory of record parquet files, or of text files with
``--text``) instead of Kafka when ``--brokers`` is not given. ``--once`` processes what is
available and stops (availableNow); otherwise the trigger is ``--every`` (default 2 seconds).
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from vigil.operators import summary, words
from vigil.sources.framing import decode_records
from vigil.sources.messages import (read_answers, read_documents, read_kafka, read_lines,
                                    read_records_table, write_kafka)
from vigil.streaming import AnomalyStream, LineJobs, SqlJobs, WordCounts, with_answers


def _records(spark: SparkSession, a):
    if a.brokers:
        return read_kafka(spark, a.brokers, a.topic, streaming=True,
                          max_offsets_per_trigger=a.max_per_trigger)
    if a.text:
        return read_lines(spark, a.path, streaming=True, max_files_per_trigger=a.max_files)
    return read_records_table(spark, a.path, streaming=True, max_files_per_trigger=a.max_files)


def _start(records, fn, a):
    w = records.writeStream.foreachBatch(fn).option("checkpointLocation", a.checkpoint)
    w = w.trigger(availableNow=True) if a.once else w.trigger(processingTime=a.every)
    return w.start()


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="vigil.apps")
    p.add_argument("job", choices=["anomaly", "lines", "sql", "words", "summary", "wordtotal"])
    p.add_argument("--brokers")
    p.add_argument("--topic")
    p.add_argument("--path")
    p.add_argument("--text", action="store_true")
    p.add_argument("--out")
    p.add_argument("--checkpoint")
    p.add_argument("--scope", default="ALL", choices=["ALL", "guid"])
    p.add_argument("--framing", default="document", choices=["document", "lines"])
    p.add_argument("--acks", help="folder where answers (scope, batch_id, ack) arrive; else all are answered")
    p.add_argument("--command-topic", help="topic that commands are also sent to")
    p.add_argument("--values", action="store_true", help="also write every message's values")
    p.add_argument("--sort-as-text", action="store_true")
    p.add_argument("--sql", action="append", default=[], metavar="NAME=STATEMENT",
                   help="statement on the view 'messages', once per batch; may be repeated")
    p.add_argument("--every", default="2 seconds")
    p.add_argument("--once", action="store_true")
    p.add_argument("--max-files", type=int, default=None)
    p.add_argument("--max-per-trigger", type=int, default=None)
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName(f"vigil-{a.job}").getOrCreate()

    if a.job == "summary":
        docs = read_documents(spark, a.path)
        msgs, bad = decode_records(docs, keep=["topic"])
        vals = summary.distinct_float(msgs)
        vals.orderBy(F.col("temperature").desc()).show()
        vals.describe().show()
        summary.mean_min_max(vals).show()
        summary.alerts(vals).show(truncate=False)
        print(f"rejected documents: {bad.count()}")
        return
    if a.job == "wordtotal":
        lines = spark.read.text(a.path)
        total = words.word_total(lines, "value").collect()[0]["total"]
        print(f"Word count total = {total}")
        return

    def send(commands, batch_id):
        write_kafka(commands, a.brokers, a.command_topic, key_col="scope")

    fn = {"anomaly": lambda: AnomalyStream(
              a.out, scope=a.scope, framing=a.framing, auto_ack=a.acks is None,
              values=a.values, command_sink=send if a.command_topic else None),
          "lines": lambda: LineJobs(a.out, sort_as_text=a.sort_as_text),
          "sql": lambda: SqlJobs(a.out, dict(s.split("=", 1) for s in a.sql)),
          "words": lambda: WordCounts(a.out)}[a.job]()
    records = _records(spark, a)
    if a.job == "anomaly" and a.acks:
        records = with_answers(records, read_answers(spark, a.acks))
    _start(records, fn, a).awaitTermination()


if __name__ == "__main__":
    main()
