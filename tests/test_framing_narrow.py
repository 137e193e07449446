"""Line framing sorts and writes rows of a few numbers; the texts are written once and joined once."""

import random

from vigil.functions.sizing import materialize
from vigil.sources import framing

LINES = "topic string, partition int, offset long, value string"


def test_only_the_lines_hold_texts(spark):
    rows = [("t", 0, i, v) for i, v in enumerate(['{"guid": "a",', '"b": {}', "}"] * 20)]
    columns = {}

    def once(df, name):
        columns.setdefault(name, set()).update(df.columns)
        return materialize(df, name)

    lines, frames = framing.framed_lines(spark.createDataFrame(rows, LINES), once=once)
    assert [name for name, found in columns.items() if "value" in found] == ["lines"]
    assert "value" in lines.columns and "value" not in frames.columns
    assert framing.assemble(framing.line_pieces(lines, frames))[0].count() == 20


def test_lines_of_one_place_stay_as_many(spark):
    rows = [("t", 0, 5, '{"a": 1}'), ("t", 0, 5, '{"b": 2}'), ("t", 0, 6, '{"c": 3}')]
    lines, frames = framing.framed_lines(spark.createDataFrame(rows, LINES))
    values = [r.value for r in framing.line_pieces(lines, frames).collect()]
    assert sorted(values) == ['{"a": 1}', '{"b": 2}', '{"c": 3}']


def test_buckets_of_any_size_agree(spark, monkeypatch):
    r = random.Random(7)
    pieces = ["{", "}", "[", "]", "},", '"a": {', '"b": "}{",', '{"c": {}}', "1", "", "  ", " {", "x", "}}", "{{", ":"]
    rows = [("t", p, o, r.choice(pieces)) for p in range(4) for o in range(150)]

    def found(size):
        monkeypatch.setattr(framing, "BUCKET_OFFSETS", size)
        return [sorted(map(tuple, df.collect())) for df in framing.reassemble(spark.createDataFrame(rows, LINES))]

    one = found(1 << 20)
    assert one[0] and one[2] and one == found(3) == found(1)
