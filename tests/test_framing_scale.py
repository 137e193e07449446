"""Framing at size: what the pattern can tell is not counted, texts are parsed and looked at once,
and a task's share of lines does not grow with their number."""

import random

import pytest
from pyspark.sql import functions as F

from vigil.functions.sizing import materialize
from vigil.plans import batchjobs
from vigil.sources import framing


def _pieces(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "k long, value string")
    return [(r._o, r._x) for r in framing.pieces(df, "value", ["k"]).orderBy("k").collect()]


def test_deep_and_cut_off_objects_are_not_counted(spark, monkeypatch):
    counted = F.raise_error(F.lit("counted")).cast("struct<objects:array<string>,outside:string>")
    monkeypatch.setattr(framing, "_deep_pieces", lambda text: counted)
    deep = '{"x":' * 100 + "1" + "}" * 100
    cut = '{"guid": "a", "payload": {"data": {"t": 1}, "s": "{'
    assert _pieces(spark, [f"[{deep},{deep}]", f"{deep} {cut}"]) == [([deep, deep], None), ([deep, cut], None)]


def test_pattern_and_counting_agree(spark, monkeypatch):
    r = random.Random(3)
    marks = ['{"x":', "{", "}", "}", "1", " ", ",", '"', '"a{"', '"b}"', "["]
    texts = ["".join(r.choice(marks) for _ in range(r.randint(1, 40))) for _ in range(400)]
    for d in (framing.SHALLOW, framing.SHALLOW + 1, framing.SHALLOW + 2, 400):
        texts += ['{"x":' * d + "1" + "}" * (d + more) + ' {"a":"{"}' for more in (-1, 0, 1)]
    found = _pieces(spark, texts)
    small = framing._object(1)
    monkeypatch.setattr(framing, "OBJECT", small)
    monkeypatch.setattr(framing, "PIECE", rf"(?s){small}|\{{.*+")
    monkeypatch.setattr(framing, "OPEN", r"^(?!)")
    assert found == _pieces(spark, texts)


@pytest.mark.parametrize("task_bytes", [2000, 1 << 27])
def test_more_lines_more_parts(spark, monkeypatch, task_bytes):
    monkeypatch.setattr(framing, "TASK_BYTES", task_bytes)
    monkeypatch.setattr(framing, "BUCKET_OFFSETS", 4)
    rows = [("t", 0, 2 * i + j, v) for i in range(300) for j, v in enumerate(['{"guid": "%d",' % i, '"a": {}}'])]
    lines = spark.createDataFrame(rows, "topic string, partition int, offset long, value string")
    parts = framing._dealt(materialize(lines, "lines"), "value", ["offset"]).rdd.getNumPartitions()
    assert parts > 50 if task_bytes == 2000 else parts < 50
    docs, unfinished, lost = framing.reassemble(lines)
    assert [r.value for r in docs.orderBy("offset").collect()] == [
        '{"guid": "%d",\n"a": {}}' % i for i in range(300)]
    assert unfinished.count() == lost.count() == 0


def test_lines_are_looked_at_once(spark, monkeypatch):
    seen = spark.sparkContext.accumulator(0)

    def look(v):
        seen.add(1)
        return v

    lines = spark.createDataFrame([("t", 0, i, v) for i, v in enumerate(["{", '"guid": "a"', "}"] * 40)],
                                  "topic string, partition int, offset long, value string")
    lines = lines.withColumn("value", F.udf(look, "string")("value"))
    docs, _, _ = framing.reassemble(lines)
    assert docs.count() == 40 and seen.value == 120


def test_mixed_records_are_parsed_once(spark):
    plan = batchjobs.decode_mixed(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "from_json" not in plan.lower() and "jsontostructs" not in plan.lower()


def test_chunks_of_files_are_dealt_by_size(spark, monkeypatch, tmp_path):
    from vigil.sources import splits

    monkeypatch.setattr(framing, "TASK_BYTES", 2000)
    asked, running = [], splits.running
    monkeypatch.setattr(splits, "running", lambda *a, parts=None: asked.append(parts) or running(*a, parts=parts))
    (tmp_path / "a.json").write_text(",".join('{"guid": "}%d", "a": {}}' % i for i in range(60)))
    docs, lost = splits.read_objects(spark, str(tmp_path))
    assert {r.value for r in docs.collect()} == {'{"guid": "}%d", "a": {}}' % i for i in range(60)}
    assert lost.count() == 0 and min(asked) > 8
