"""Hand-made edge cases (statistics, states, alarm, text)."""

import datetime as dt

from pyspark.sql import functions as F

from replay_model import replay
from vigil.functions.text import split_on_space, split_on_whitespace, strip_whitespace
from vigil.operators.alarm import alarm_machine, alarm_type
from vigil.operators.breach import plan_breaches
from vigil.sources.framing import decode_records, readings_of

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "scope string, sensor string, batch timestamp, ord long, guid string, x double"


def _df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _series(values_per_batch, sensor="HUMIDITY"):
    rows, o = [], 0
    for b, vals in enumerate(values_per_batch):
        for v in vals:
            o += 1
            rows.append(("ALL", sensor, T0 + dt.timedelta(hours=b), o, "g", v))
    return rows


def test_first_reading(spark):
    t = plan_breaches(_df(spark, _series([[70.0]]))).thr.collect()[0]
    assert (t.cnt, t.mean, t.std, t.end_state) == (1, 70.0, 0.0, 0)


def test_high_then_normal_and_sticky(spark):
    rows = _series([[70.0] * 30, [90.0], [70.0], [70.0], [70.0]])
    st = plan_breaches(_df(spark, rows)).states().orderBy("ord").collect()
    assert [r.state for r in st] == [0] * 30 + [1, 2, 2, 2]
    assert [r.code for r in st][30:] == [1, 0, 0, 0]


def test_constant_series_has_no_breach(spark):
    st = plan_breaches(_df(spark, _series([[0.1] * 10, [0.1] * 10, [0.1] * 10]))).states().collect()
    assert {r.state for r in st} == {0}


def test_priority_and_alarm(spark):
    rows = []
    o = 0
    for b in range(31):
        for s in ("HUMIDITY", "PRESSURE"):
            o += 1
            v = 50.0 if b < 30 else 500.0
            rows.append(("ALL", s, T0 + dt.timedelta(hours=b), o, "g", v))
    plan = plan_breaches(_df(spark, rows))
    types = alarm_type(plan.end_states()).orderBy("batch").collect()
    assert types[-1].alarm_type == "PRESSURE"
    assert all(t.alarm_type == "" for t in types[:-1])


def test_unacknowledged_and_pending_reversal(spark):
    # breach in batches 1 and 2 (not acknowledged), then back in range without ack
    vals = [[50.0] * 30, [500.0], [5000.0], [50.0], [50.0]]
    rows = _series(vals, "TEMPERATURE")
    plan = plan_breaches(_df(spark, rows))
    types = alarm_type(plan.end_states())
    acks = types.select("scope", "batch", F.lit(False).alias("ack"))
    m = alarm_machine(types, acks).orderBy("batch").collect()
    assert [r.command for r in m] == [None, "ON", "ON", None, None]
    assert [r.alarm for r in m] == [0, 3, 3, 3, 3]
    _, _, trace = replay([(T0 + dt.timedelta(hours=i), [(o, "TEMPERATURE", x) for o, x in
                          zip(range(100 * i, 100 * i + len(v)), v)]) for i, v in enumerate(vals)],
                         acks=[False] * 5)
    assert [t[4] for t in trace] == [r.command for r in m]


def test_null_and_nan_ignored(spark):
    docs = spark.createDataFrame(
        [(1, '[{"guid":"a","payload":{"data":{"temperature":70.0,"humidity":null}}}]'),
         (2, '{"guid":"b","payload":{"data":{"temperature":71.0,"humidity":"NaN"}}}')],
        "offset long, value string")
    msgs, bad = decode_records(docs, keep=["offset"])
    r = readings_of(msgs, ["offset"]).collect()
    assert bad.count() == 0
    assert sorted((x.guid, x.sensor) for x in r) == [("a", "TEMPERATURE"), ("b", "TEMPERATURE")]


def test_missing_reply_to_and_shapes(spark):
    docs = spark.createDataFrame([
        (1, '[{"guid":"a","payload":{"format":"f","data":{"sensors":[{"current":1.5,"senstype":"humidity"},'
            '{"current":2.5,"senstype":"temperature"}],"timestamp":"t"}}}]'),
        (2, '[{"guid":"b","payload":{"reply_to":"","data":{"temperature":3.0,"pressure":4.0,'
            '"humidity":5.0,"ambient_light":6.0,"timestamp":"t"}}}]'),
        (3, '[{"guid":"c","payload":{"data":{"temperature":1.0,"latitude":1.0,"longitude":2.0,"altitude":3.0}}}]'),
        (4, '[{"guid":"d","payload":'),
    ], "offset long, value string")
    msgs, bad = decode_records(docs, keep=["offset"])
    assert [r.offset for r in bad.collect()] == [4]
    got = sorted((r.guid, r.sensor, r.x) for r in readings_of(msgs, ["offset"]).collect())
    assert got == [("a", "HUMIDITY", 1.5), ("a", "TEMPERATURE", 2.5), ("b", "HUMIDITY", 5.0),
                   ("b", "LIGHT", 6.0), ("b", "PRESSURE", 4.0), ("b", "TEMPERATURE", 3.0),
                   ("c", "TEMPERATURE", 1.0)]
    reply = {r.msg.guid: r.msg.payload.reply_to for r in msgs.collect()}
    assert reply == {"a": None, "b": "", "c": None}


def test_float_narrowing(spark):
    from vigil.operators.summary import distinct_float
    m = spark.createDataFrame([(100.1,), (100.1000001,)], "t double").select(
        F.struct(F.struct(F.struct(F.col("t").alias("temperature")).alias("data")).alias("payload")).alias("msg"))
    assert distinct_float(m).count() == 1


def test_word_splits(spark):
    df = spark.createDataFrame([("a  b ",), ("a b c",)], "v string")
    r = df.select(split_on_space("v").alias("s"), split_on_whitespace("v").alias("w"),
                  strip_whitespace("v").alias("z")).collect()
    assert r[0].s == ["a", "", "b", ""] and r[0].w == ["a", "b"] and r[0].z == "ab"
    assert r[1].w == ["a", "b", "c"] and r[1].z == "abc"
    u = spark.createDataFrame([("a\u00a0b\u2003c\x1fd\u200be",)], "v string").select(
        split_on_whitespace("v").alias("w"), strip_whitespace("v").alias("z")).collect()[0]
    assert u.w == "a\u00a0b\u2003c\x1fd\u200be".split() and u.z == "abcd\u200be"
