"""Per-batch line and word stream jobs, per-device stream scope, and the command sink."""

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from vigil.operators import lines as L
from vigil.plans import feeds
from vigil.sources.messages import read_records_table
from vigil.sources.tables import events
from vigil.streaming import AnomalyStream, Ledger, LineJobs, WordCounts


def _land(spark, root, frames):
    for i, df in enumerate(frames):
        df.coalesce(1).write.parquet(os.path.join(root, "in", f"part-{i:03d}"))
    return read_records_table(spark, os.path.join(root, "in", "*"), streaming=True, max_files_per_trigger=1)


def _run(df, fn, ckpt):
    q = (df.writeStream.foreachBatch(fn).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def test_line_jobs_per_batch(spark, tmpdir_path):
    root = tmpdir_path
    lines = feeds.pretty_lines(events(spark, SF_SMALL).where(F.col("event_id") < 60))
    recs = lines.select(F.lit("t").alias("topic"), F.lit(0).alias("partition"),
                        (F.col("ord") * 100 + F.col("line_no")).alias("offset"), "value", "ord")
    frames = [recs.where(F.col("ord") < 30).drop("ord"), recs.where(F.col("ord") >= 30).drop("ord")]
    _run(_land(spark, root, frames), LineJobs(os.path.join(root, "out")), os.path.join(root, "ckpt"))
    out = os.path.join(root, "out")
    counts = {r.batch: r.n for r in spark.read.parquet(os.path.join(out, "count")).collect()}
    assert counts == {0: 30, 1: 30}
    sums = spark.read.parquet(os.path.join(out, "sum")).where("sensor = 'HUMIDITY'").collect()
    want = [L.batch_sum(L.line_values(L.matched_lines(f.withColumn("ord", F.col("offset")), ["ord"]), ["ord"])
                        .withColumn("batch", F.lit(0))).where("sensor = 'HUMIDITY'").collect()[0].total
            for f in frames]
    assert sorted(round(r.total, 6) for r in sums) == sorted(round(w, 6) for w in want)
    run = {r.sensor: r for r in spark.read.parquet(os.path.join(out, "running", "version=1")).collect()}
    assert run["HUMIDITY"]["count"] == 60
    assert abs(run["HUMIDITY"].total - sum(want)) < 1e-6


def test_word_counts_per_batch(spark, tmpdir_path):
    root = tmpdir_path
    rows = [("t", 0, 0, "a b  a"), ("t", 0, 1, "b")]
    frames = [spark.createDataFrame(rows[:1], "topic string, partition int, offset long, value string"),
              spark.createDataFrame(rows[1:], "topic string, partition int, offset long, value string")]
    _run(_land(spark, root, frames), WordCounts(os.path.join(root, "out")), os.path.join(root, "ckpt"))
    wc = spark.read.parquet(os.path.join(root, "out", "word_counts"))
    got = sorted((r.batch_id, r.word, r.n) for r in wc.collect())
    assert got == [(0, "", 1), (0, "a", 2), (0, "b", 1), (1, "b", 1)]


def test_device_scope_stream_and_command_sink(spark, tmpdir_path):
    root = tmpdir_path
    recs = feeds.json_records(events(spark, SF_SMALL))
    hours = [r.batch for r in recs.select("batch").distinct().orderBy("batch").limit(4).collect()]
    frames = [recs.where(F.col("batch") == h).drop("batch") for h in hours]
    seen = []
    proc = AnomalyStream(os.path.join(root, "out"), scope="guid",
                         command_sink=lambda df, i: seen.append((i, df.count())))
    _run(_land(spark, root, frames), proc, os.path.join(root, "ckpt"))
    st = proc.state(spark, "sensors", 3)
    n_msgs = sum(f.count() for f in frames)
    assert st.agg(F.sum("n")).collect()[0][0] == 4 * n_msgs  # four sensors per message
    assert st.select("scope").distinct().count() > 1
    cdir = os.path.join(root, "out", "commands")
    written = sorted(int(d.split("=")[1]) for d in os.listdir(cdir) if d.startswith("batch_id=")) \
        if os.path.exists(cdir) else []
    assert [i for i, _ in seen] == written  # the sink sees exactly the batches that sent commands
    assert all(n > 0 for _, n in seen)


def test_empty_batch_carries_state(spark, tmpdir_path):
    """A batch without good readings changes no statistics and runs no alarm step."""
    root = os.path.join(tmpdir_path, "out")
    recs = feeds.json_records(events(spark, SF_SMALL)).drop("batch")
    proc = AnomalyStream(root)
    first = recs.where(F.col("offset") < 200)
    proc(first, 0)
    bad = spark.createDataFrame([("t", 0, 1, '[{"guid": "x", '), ("t", 0, 2, "   ")],
                                "topic string, partition int, offset long, value string")
    proc(bad, 1)
    for name, n in (("sensors", 4), ("alarm", 1)):
        v0, v1 = (sorted(map(tuple, proc.state(spark, name, i).collect())) for i in (0, 1))
        assert v0 == v1 and len(v0) == n
    assert not os.path.exists(os.path.join(root, "commands", "batch_id=1"))
    assert spark.read.parquet(os.path.join(root, "rejects", "batch_id=1")).count() == 1  # blank is not a reject


def test_old_state_is_pruned(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "out")
    recs = feeds.json_records(events(spark, SF_SMALL)).drop("batch")
    proc = AnomalyStream(root, keep_batches=2)
    for i in range(6):
        proc(recs.where((F.col("offset") >= 25 * i) & (F.col("offset") < 25 * (i + 1))), i)
    led = Ledger(spark, root)
    for name in ("sensors", "alarm"):
        named = {r["path"] for i in (4, 5) for r in led.manifest(i)["runs"][name]}
        kept = {f"{name}/{d}" for d in os.listdir(os.path.join(root, name)) if d.startswith("run=")}
        spent = {p for i in (4, 5) for p in led.manifest(i)["spent"]}
        assert named <= kept <= named | spent, (name, kept)
        assert proc.state(spark, name, 4).count() == proc.state(spark, name, 5).count() > 0
