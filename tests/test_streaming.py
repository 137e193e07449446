"""Streaming == table form; restart from checkpoint; re-delivered batch ids are idempotent."""

import os

from pyspark.sql import functions as F

from conftest import SF_MID as SF_SMALL
from vigil.operators.alarm import alarm_commands, alarm_machine, alarm_type
from vigil.operators.breach import plan_breaches
from vigil.plans import feeds
from vigil.sources.messages import read_records_table
from vigil.sources.tables import events, message_readings, wide_messages
from vigil.streaming import AnomalyStream, with_answers

HOURS = 6


def _landed(spark, root, n_hours=None):
    """Write the first hourly batches of the messages, one parquet file per hour."""
    n_hours = n_hours or HOURS
    ev = events(spark, SF_SMALL)
    recs = feeds.json_records(ev)
    hours = [r.batch for r in recs.select("batch").distinct().orderBy("batch").limit(n_hours).collect()]
    for i, h in enumerate(hours):
        (recs.where(F.col("batch") == h).drop("batch").coalesce(1)
             .write.parquet(os.path.join(root, "in", f"part-{i:03d}")))
    return hours


def _stream(spark, root, src_dirs, ckpt, proc):
    df = read_records_table(spark, os.path.join(root, "in", "*"), streaming=True, max_files_per_trigger=1)
    q = proc.start(df, ckpt, trigger={"availableNow": True})
    q.awaitTermination()


def _table_form(spark, hours):
    ev = events(spark, SF_SMALL).where(F.date_trunc("hour", "ts").isin(hours))
    plan = plan_breaches(message_readings(wide_messages(ev)))
    evs = {(r.ord, r.sensor, r.kind) for r in plan.events().collect()}
    cmds = [(r.batch, r.command, r.warning) for r in
            alarm_commands(alarm_machine(alarm_type(plan.end_states()))).orderBy("batch").collect()]
    return evs, cmds


def test_stream_equals_table_and_restarts(spark, tmpdir_path):
    root = tmpdir_path
    hours = _landed(spark, root)
    out = os.path.join(root, "out")
    proc = AnomalyStream(out)
    _stream(spark, root, None, os.path.join(root, "ckpt"), proc)
    got_ev = {(r.offset, r.sensor, r.kind) for r in proc.output(spark, "events").collect()}
    cm = proc.output(spark, "commands").orderBy("batch_id").collect()
    want_ev, want_cmds = _table_form(spark, hours)
    assert got_ev == want_ev and len(want_ev) > 0
    assert [(hours[r.batch_id], r.command, r.warning) for r in cm] == want_cmds

    # re-deliver the last batch by hand (what Spark does after a failure): same state, outputs
    last = HOURS - 1
    before = sorted(map(tuple, proc.state(spark, "sensors", last).collect()))
    cmds_before = proc.output(spark, "commands").count()
    os.remove(os.path.join(out, "commits", f"{last}.json"))  # as if it had not come to its commit
    for _ in range(2):
        proc(spark.read.parquet(os.path.join(root, "in", f"part-{last:03d}")), last)
        assert sorted(map(tuple, proc.state(spark, "sensors", last).collect())) == before
        assert proc.output(spark, "commands").count() == cmds_before


def test_restart_midway(spark, tmpdir_path):
    root = tmpdir_path
    hours = _landed(spark, root)
    # move the second half away, run, bring it back, run again from the same checkpoint
    import shutil
    later = os.path.join(root, "later")
    os.makedirs(later)
    for i in range(HOURS // 2, HOURS):
        shutil.move(os.path.join(root, "in", f"part-{i:03d}"), os.path.join(later, f"part-{i:03d}"))
    out = os.path.join(root, "out")
    ckpt = os.path.join(root, "ckpt")
    _stream(spark, root, None, ckpt, AnomalyStream(out))
    for i in range(HOURS // 2, HOURS):
        shutil.move(os.path.join(later, f"part-{i:03d}"), os.path.join(root, "in", f"part-{i:03d}"))
    _stream(spark, root, None, ckpt, AnomalyStream(out))
    got_ev = {(r.offset, r.sensor, r.kind) for r in AnomalyStream(out).output(spark, "events").collect()}
    want_ev, _ = _table_form(spark, hours)
    assert got_ev == want_ev


def test_line_framed_stream_carries_tails(spark, tmpdir_path):
    root = tmpdir_path
    ev = events(spark, SF_SMALL).where(F.col("event_id") < 40)
    recs = feeds.split_line_records(ev).where(F.col("partition") == 0).orderBy("offset").collect()
    # cut the line records into 3 files at arbitrary points (documents split across batches)
    cuts = [0, 7, 23, len(recs)]
    for i in range(3):
        part = recs[cuts[i]:cuts[i + 1]]
        spark.createDataFrame(part, "topic string, partition int, offset long, value string") \
             .coalesce(1).write.parquet(os.path.join(root, "in", f"part-{i:03d}"))
    out = os.path.join(root, "out")
    proc = AnomalyStream(out, framing="lines", values=True)
    _stream(spark, root, None, os.path.join(root, "ckpt"), proc)
    assert not os.path.exists(os.path.join(out, "rejects"))  # written only when a batch has some
    assert proc.state(spark, "frames", 2).count() == 0
    assert proc.output(spark, "values").count() == 10


RECORD = "topic string, partition int, offset long, value string"


def _by_lines(spark, proc, batches):
    offset = 0
    for i, lines in enumerate(batches):
        proc(spark.createDataFrame([("t", 0, offset + k, v) for k, v in enumerate(lines)], RECORD), i)
        offset += len(lines)


def test_a_message_over_many_batches_is_written_once(spark, tmpdir_path):
    """One line a batch: the text of the open message stays in the chunks of its batches."""
    out, n = os.path.join(tmpdir_path, "out"), 6
    proc = AnomalyStream(out, framing="lines", values=True, keep_batches=2 * n)
    body = [f'"x{i}": "{"y" * 1000} }}{{ {i}",' for i in range(n - 2)]
    _by_lines(spark, proc, [['{"guid": "long",'], *[[b] for b in body], ['"payload": {}}', '{"guid": "next"}']])
    chunks = spark.read.parquet(os.path.join(out, "open"))
    assert chunks.count() == n - 1 and chunks.select("value").distinct().count() == n - 1
    assert sorted(r.guid for r in proc.output(spark, "values").collect()) == ["long", "next"]
    assert proc.output(spark, "rejects").count() == 0
    assert proc.state(spark, "frames", n - 2).count() == 1 and proc.state(spark, "frames", n - 1).count() == 0


def test_open_messages_that_break_off_or_close_within_a_line(spark, tmpdir_path):
    proc = AnomalyStream(os.path.join(tmpdir_path, "out"), framing="lines", values=True, keep_batches=1)
    _by_lines(spark, proc, [
        ['[{"guid": "a", "x": {"y":'], ['{"z": {}}'], ["1" + "}}, ", '{"guid": "b"'],  # no colon: a fresh start may follow
        ['{"guid": "c"}, {"guid": "d", "x": {"q": 1}'], ["}, ", '{"guid": "e", "x":'], ['{"guid": "inner"}}', "]"]])
    values = {r.guid: r.batch_id for r in proc.output(spark, "values").collect()}
    lost = [r.value for r in proc.output(spark, "rejects").orderBy("batch_id", "offset").collect()]
    assert values == {"c": 3, "d": 4, "e": 5}
    # "a" holds two objects side by side: closed, but no JSON; "b" is cut off by the fresh start
    assert len(lost) == 2 and lost[0].startswith('{"guid": "a"') and lost[1] == '{"guid": "b"'
    assert not os.path.exists(os.path.join(tmpdir_path, "out", "open", "batch_id=0"))  # no longer needed


def test_stream_acknowledgements_match_table_machine(spark, tmpdir_path):
    """Answers arrive as a second stream, a batch's before the next one; the commands sent equal the
    table-form machine given the same per-batch acknowledgements."""
    root = tmpdir_path
    hours = _landed(spark, root, 16)
    flags = [i % 3 != 1 for i in range(len(hours))]
    proc = AnomalyStream(os.path.join(root, "out"), auto_ack=False)
    for i in range(len(hours)):
        answers = spark.createDataFrame([("ALL", i - 1, flags[i - 1])], "scope string, batch_id long, ack boolean")
        proc(with_answers(spark.read.parquet(os.path.join(root, "in", f"part-{i:03d}")), answers), i)
    got = [(hours[r.batch_id], r.command, r.warning)
           for r in proc.output(spark, "commands").orderBy("batch_id").collect()]
    ev = events(spark, SF_SMALL).where(F.date_trunc("hour", "ts").isin(hours))
    plan = plan_breaches(message_readings(wide_messages(ev)))
    types = alarm_type(plan.end_states())
    ack_df = spark.createDataFrame([("ALL", h, f) for h, f in zip(hours, flags)],
                                   "scope string, batch timestamp_ntz, ack boolean")
    want = [(r.batch, r.command, r.warning) for r in
            alarm_commands(alarm_machine(types, ack_df)).orderBy("batch").collect()]
    assert got == want and len(want) >= 2, want
