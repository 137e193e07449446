"""File sources (whole-file JSON, text lines), the per-batch SQL job and the console sink."""

import json
import os

from pyspark.sql import functions as F

from vigil.operators import summary, words
from vigil.sources.framing import decode_records
from vigil.sources.messages import read_documents, read_lines, read_records_table
from vigil.streaming import SqlJobs, console


def _msg(guid, t):
    return {"guid": guid, "destination": "0-AAA12345678", "eventTime": "2017-05-20T13:39:37.775000Z",
            "payload": {"format": "f", "data": {"temperature": t, "pressure": 29.0, "humidity": 50.0,
                                                "ambient_light": 100.0, "timestamp": "2017-06-05T17:09:52Z"}}}


def test_whole_file_documents(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "docs")
    os.makedirs(d)
    with open(os.path.join(d, "a.json"), "w") as f:
        json.dump([_msg("a", 96.5), _msg("b", 70.25), _msg("c", 70.25)], f, indent=2)
    with open(os.path.join(d, "b.json"), "w") as f:
        f.write('[{"guid": "x", ')  # truncated document
    msgs, bad = decode_records(read_documents(spark, d), keep=["topic"])
    vals = summary.distinct_float(msgs)
    assert sorted(r.temperature for r in vals.collect()) == [70.25, 96.5]
    a = summary.alerts(vals).collect()[0]
    assert a.max_alert.startswith("*ALERT!*") and a.avg_alert.startswith("Avg. temperature was OK")
    assert bad.count() == 1


def test_text_lines_word_total(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "t.txt")
    with open(p, "w") as f:
        f.write("one two  three\n four five \n\n")
    lines = read_lines(spark, p)
    assert words.word_total(lines, "value").collect()[0].total == 5


def test_sql_jobs_and_console(spark, tmpdir_path, capsys):
    root = tmpdir_path
    vals = [100.0, 90.0, 50.0, 86.0]
    rows = [("t", 0, i, json.dumps([_msg(f"g{i}", v)])) for i, v in enumerate(vals)] + [("t", 0, 9, "[{")]
    spark.createDataFrame(rows, "topic string, partition int, offset long, value string") \
         .coalesce(1).write.parquet(os.path.join(root, "in", "part-000"))
    src = read_records_table(spark, os.path.join(root, "in", "*"), streaming=True)
    q = (src.writeStream.foreachBatch(SqlJobs(os.path.join(root, "out"), {
            "sort": "SELECT payload.data.temperature FROM messages",
            "search": "SELECT payload.data.temperature FROM messages WHERE payload.data.temperature = 100",
            "filter": "SELECT payload.data.temperature FROM messages WHERE payload.data.temperature > 85"}))
         .option("checkpointLocation", os.path.join(root, "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    out = os.path.join(root, "out")
    assert [r.temperature for r in spark.read.parquet(os.path.join(out, "sort")).orderBy(F.desc("temperature")).collect()] == [100.0, 90.0, 86.0, 50.0]
    assert [r.temperature for r in spark.read.parquet(os.path.join(out, "search")).collect()] == [100.0]
    assert sorted(r.temperature for r in spark.read.parquet(os.path.join(out, "filter")).collect()) == [86.0, 90.0, 100.0]
    assert spark.read.parquet(os.path.join(out, "rejects")).count() == 1
    c = console(read_records_table(spark, os.path.join(root, "in", "*"), streaming=True).select("offset"),
                os.path.join(root, "ck2"), trigger={"availableNow": True})
    c.awaitTermination()
    assert c.lastProgress is not None and c.lastProgress["numInputRows"] == 5
