"""State and acknowledgements of the anomaly stream, batch by batch."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from vigil.streaming import AnomalyStream, BatchHeaders, KeyedLog, Ledger, with_answers

RECORD = "topic string, partition int, offset long, value string"


def batch(spark, values, guid="g"):
    rows = [("t", 0, i, json.dumps({"guid": guid, "payload": {"data": {"temperature": float(v)}}}))
            for i, v in enumerate(values)]
    return spark.createDataFrame(rows or [("t", 0, 0, " ")], RECORD)


def commands(spark, proc):
    return sorted((r.batch_id, r.command) for r in proc.output(spark, "commands").collect())


def answered(spark, records, *batches):
    answers = spark.createDataFrame([("ALL", b, True) for b in batches], "scope string, batch_id long, ack boolean")
    return with_answers(records, answers)


def alarm(spark, proc, batch_id):
    return [r.alarm for r in proc.state(spark, "alarm", batch_id).collect()]


def test_answers_settle_late_and_without_readings_and_stay(spark, tmpdir_path):
    proc = AnomalyStream(os.path.join(tmpdir_path, "out"), auto_ack=False)
    proc(batch(spark, [70] * 30), 0)
    proc(answered(spark, batch(spark, [500]), 0), 1)  # an answer to no command
    again = answered(spark, batch(spark, [5000]), 2, 0)  # and two that come too early or to nothing
    proc(again, 2)
    assert commands(spark, proc) == [(1, "ON"), (2, "ON")] and alarm(spark, proc, 2) == [3]
    proc(answered(spark, batch(spark, [5000]), 1), 2)  # delivered again: it is done
    assert commands(spark, proc) == [(1, "ON"), (2, "ON")] and alarm(spark, proc, 2) == [3]
    # a late answer to the first of both, in a batch without readings
    proc(answered(spark, batch(spark, []), 1), 3)
    assert alarm(spark, proc, 3) == [1]
    proc(batch(spark, [50000]), 4)
    assert commands(spark, proc) == [(1, "ON"), (2, "ON")] and alarm(spark, proc, 4) == [1]


def test_lost_state_stops_the_stream(spark, tmpdir_path):
    proc = AnomalyStream(os.path.join(tmpdir_path, "out"))
    proc(batch(spark, [70]), 0)
    with pytest.raises(RuntimeError, match="state is lost"):
        proc(batch(spark, [70]), 5)


def test_devices_without_name_and_silent_devices(spark, tmpdir_path):
    proc = AnomalyStream(os.path.join(tmpdir_path, "out"), scope="guid", auto_ack=False)
    proc(batch(spark, [70] * 30, "loud"), 0)
    proc(batch(spark, [500], "loud"), 1)
    for i in (2, 3):
        proc(batch(spark, [70], None), i)
    n = {r.scope: r.n for r in proc.state(spark, "sensors", 3).collect()}
    assert n == {"loud": 31, None: 2}
    assert commands(spark, proc) == [(1, "ON")]  # the silent device is not told again


# -- keyed state: what is written follows the keys that are touched ----------------------------
def size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def test_idle_keys_are_not_rewritten(spark, tmpdir_path):
    schema = StructType([StructField("scope", StringType()), StructField("n", LongType())])
    led = Ledger(spark, os.path.join(tmpdir_path, "out"))
    log = KeyedLog(led, "counts", ["scope"], schema)
    idle = 1_000_000
    many = spark.range(idle).select(F.col("id").cast("string").alias("scope"), F.lit(0).cast("long").alias("n"))
    _, path = log.append([], 0, many)
    runs = log.settle([], 0, path, idle)
    first, want = size(led.path(path)), {}
    for i in range(1, 10):
        rows = [(str(k), 100 * i + k) for k in (i, i + 1, 10 ** 7 + i)]
        want |= dict(rows)
        before = size(led.root)
        _, path = log.append(runs, i, spark.createDataFrame(rows, schema))
        runs = log.settle(runs, i, path, len(rows))
        assert size(led.root) - before < first / 100
    assert len(runs) <= 4 and runs[0]["rows"] == idle  # small runs have met, the large one has stayed
    asked = spark.createDataFrame([(k,) for k in [*want, "77", "nobody"]], "scope string")
    got = {r.scope: r.n for r in log.lookup(runs, asked, True).collect()}
    assert got == want | {"77": 0}
    assert got == {r.scope: r.n for r in log.lookup(runs, asked, False).collect()}
    assert log.all(runs).count() == idle + 9


def test_runs_of_like_size_meet(spark, tmpdir_path):
    schema = StructType([StructField("scope", StringType()), StructField("n", LongType())])
    log, runs, rnd, want = KeyedLog(Ledger(spark, os.path.join(tmpdir_path, "out")), "s", ["scope"], schema), [], random.Random(1), {}
    for i in range(14):
        rows = {rnd.choice([None, *"abcdefghij"]): rnd.randint(0, 9) for _ in range(rnd.randint(1, 6))}
        want |= rows
        _, path = log.append(runs, i, spark.createDataFrame(list(rows.items()), schema))
        runs = log.settle(runs, i, path, len(rows))
    assert len(runs) < 8 and {r.scope: r.n for r in log.all(runs).collect()} == want
    assert log.lookup([], log.all(runs), True).count() == 0


# -- a batch is published whole ---------------------------------------------------------------
@pytest.mark.parametrize("fails", ["events", "commit"])
def test_readers_see_a_batch_whole_or_not_at_all(spark, tmpdir_path, monkeypatch, fails):
    proc = AnomalyStream(os.path.join(tmpdir_path, "out"), values=True)
    proc(batch(spark, [70] * 30), 0)
    good = Ledger.put, Ledger.commit

    def put(self, name, batch_id, rows):
        path = good[0](self, name, batch_id, rows)
        if name == fails:
            raise KeyboardInterrupt("killed")
        return path

    def commit(self, batch_id, manifest):
        raise KeyboardInterrupt("killed")

    seen = {n: proc.output(spark, n).count() for n in ("events", "statistics", "commands", "values", "rejects")}
    monkeypatch.setattr(Ledger, "commit", commit) if fails == "commit" else monkeypatch.setattr(Ledger, "put", put)
    with pytest.raises(KeyboardInterrupt):
        proc(batch(spark, [500]), 1)
    assert {n: proc.output(spark, n).count() for n in seen} == seen
    monkeypatch.undo()
    proc(batch(spark, [500]), 1)  # delivered again
    got = {n: proc.output(spark, n).count() for n in seen}
    assert got == {"events": 1, "statistics": 2, "commands": 1, "values": 31, "rejects": 0}
    assert [r.n for r in proc.state(spark, "sensors", 1).collect()] == [31]


def test_headers_of_all_batches(spark, tmpdir_path):
    headers = BatchHeaders()
    schema = "topic string, partition int, offset long, value string"
    with headers.listening(spark):
        for n in (3, 0, 2):
            spark.range(n).selectExpr("'t' topic", "0 partition", "id offset", "'v' value").write.mode(
                "append").parquet(os.path.join(tmpdir_path, "in"))
            df = spark.readStream.schema(schema).parquet(os.path.join(tmpdir_path, "in"))
            (headers.observe(df).writeStream.queryName(headers.name).foreachBatch(lambda d, i: d.collect())
             .option("checkpointLocation", os.path.join(tmpdir_path, "c")).trigger(availableNow=True)
             .start().awaitTermination())
    assert [(r.batch_id, r.records) for r in headers.table(spark).collect()] == [(0, 3), (1, 0), (2, 2)]
