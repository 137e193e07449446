"""Reassembly of documents split over line records."""

from pyspark.sql import functions as F

from vigil.sources.framing import decode_records, reassemble


def _lines(i, t):
    return ["[", "{", f'"guid": "g{i}", "payload": {{"data": {{"temperature": {t}}}}}', "}", "]"]


def test_two_documents_and_truncated_tail(spark):
    vals = _lines(1, 70.0) + ['[{"guid": "g2", "payload": {"data": {"temperature": 71.0}}}]'] \
        + _lines(3, 72.0) + ["[", "{", '"guid": "g4"']
    recs = spark.createDataFrame([("t", 0, i, v) for i, v in enumerate(vals)],
                                 "topic string, partition int, offset long, value string")
    docs, tail, lost = reassemble(recs)
    msgs, bad = decode_records(docs, keep=["offset"])
    assert sorted(r.msg.guid for r in msgs.collect()) == ["g1", "g2", "g3"]
    assert bad.count() == 0 and lost.count() == 0
    assert [r.value for r in tail.orderBy("offset").collect()] == ["{", '"guid": "g4"']


def test_brackets_inside_strings_and_partitions(spark):
    vals = ['[', '{"guid": "a]b}", "payload": {"format": "[x{"}}', ']']
    rows = [("t", p, o, v) for p in (0, 1) for o, v in enumerate(vals)]
    recs = spark.createDataFrame(rows, "topic string, partition int, offset long, value string")
    docs, tail, _ = reassemble(recs)
    msgs, _ = decode_records(docs, keep=["partition"])
    assert sorted((r.partition, r.msg.guid) for r in msgs.collect()) == [(0, "a]b}"), (1, "a]b}")]
    assert tail.count() == 0


def _recs(spark, vals):
    return spark.createDataFrame([("t", 0, i, v) for i, v in enumerate(vals)],
                                 "topic string, partition int, offset long, value string")


def test_long_array_gives_every_message(spark):
    """An array of over 100,000 lines: messages come out one by one."""
    n = 21_000
    vals = ["["]
    for i in range(n):
        vals += _lines(i, 70.0)[1:4] + [","] + [""]
    docs, tail, lost = reassemble(_recs(spark, vals))
    msgs, bad = decode_records(docs, keep=["offset"])
    assert len(vals) > 100_000
    assert msgs.select("msg.guid").distinct().count() == n
    assert bad.count() == tail.count() == lost.count() == 0


def test_long_literal(spark):
    """A string literal of over a million characters, with quotes and braces escaped in it."""
    text = ('x{\\"}' * 250_000)
    recs = _recs(spark, ['{"guid": "' + text + '",', '"payload": {}}', '{"guid": "b"}'])
    docs, tail, lost = reassemble(recs)
    msgs, bad = decode_records(docs, keep=["offset"])
    assert sorted(len(r.n) for r in msgs.select(F.col("msg.guid").alias("n")).collect()) == [1, 1_000_000]
    assert bad.count() == tail.count() == lost.count() == 0


def test_unclosed_opener_loses_only_itself(spark):
    vals = ['{"guid": "bad"', *_lines(1, 1.0), '[{"guid": "worse", "payload":', *_lines(2, 2.0), *_lines(3, 3.0)]
    docs, tail, lost = reassemble(_recs(spark, vals))
    msgs, bad = decode_records(docs, keep=["offset"])
    assert {r.msg.guid for r in msgs.collect()} >= {"g1", "g3"}
    text = "".join(r.value for r in lost.collect())
    assert "bad" in text and tail.count() == 0
    got = {r.msg.guid for r in msgs.collect()}
    assert "g2" in got or "g2" in text + "".join(r.value for r in bad.collect())


def test_decode_accounts_for_everything(spark):
    df = spark.createDataFrame(list(enumerate([
        '[{"guid":"a"}],[{"guid":"b"}]', '[{"guid":"c"}] trailing', "[null]", '{"payload":5}',
        '{"guid":"d","payload":{"data":{"temperature":"abc"}}}', '{"foo":1}', "\t\r", "[]", "", None])),
        "offset long, value string")
    msgs, bad = decode_records(df, keep=["offset"])
    assert sorted((r.offset, r.msg.guid) for r in msgs.collect()) == [(0, "a"), (0, "b"), (1, "c")]
    assert sorted((r.offset, r.value, r.reason) for r in bad.collect()) == [
        (1, "trailing", "malformed"), (2, "null", "malformed"), (3, '{"payload":5}', "malformed"),
        (4, '{"guid":"d","payload":{"data":{"temperature":"abc"}}}', "malformed"),
        (5, '{"foo":1}', "not a message")]


def test_concatenated_documents_in_one_record(spark):
    from vigil.sources.framing import decode_records
    df = spark.createDataFrame([
        (1, '[{"guid":"a"}][{"guid":"b"}, {"guid":"c"}]'),
        (2, '{"guid":"d"} \n {"guid":"e ][ x"}'),
        (3, '[{"guid":"f"}] [{"guid":'),
        (4, '[{"guid":"g ][ h"}]'),
    ], "offset long, value string")
    m, bad = decode_records(df, keep=["offset"])
    assert sorted((r.offset, r.idx, r.msg.guid) for r in m.collect()) == [
        (1, 0, "a"), (1, 1, "b"), (1, 2, "c"), (2, 0, "d"), (2, 1, "e ][ x"), (3, 0, "f"), (4, 0, "g ][ h")]
    assert [(r.offset, r.value) for r in bad.collect()] == [(3, '{"guid":')]


def test_reassembly_property_random_layouts(spark):
    """Random documents, pretty-printed (json.dumps indent) or compact, interleaved over several
    partitions with gaps in the offsets: reassembly + decode returns exactly the documents."""
    import json
    import random

    from vigil.sources.framing import decode_records
    rnd = random.Random(3)
    rows, want = [], []
    for part in range(3):
        off = 0
        for d in range(25):
            guid = f"p{part}d{d}" + rnd.choice(["", "]", "{x}", '\\"[', " , "])
            msgs = [{"guid": guid + f"#{i}", "payload": {"data": {"temperature": rnd.random()}}}
                    for i in range(rnd.randint(1, 3))]
            doc = msgs[0] if (len(msgs) == 1 and rnd.random() < 0.3) else msgs
            text = json.dumps(doc, indent=rnd.choice([None, 1, 2]))
            for line in text.split("\n"):
                rows.append(("t", part, off, line))
                off += rnd.randint(1, 3)
            want += [(part, m["guid"]) for m in msgs]
    rnd.shuffle(rows)
    recs = spark.createDataFrame(rows, "topic string, partition int, offset long, value string")
    docs, tail, lost = reassemble(recs)
    msgs, bad = decode_records(docs, keep=["partition"])
    got = sorted((r.partition, r.msg.guid) for r in msgs.collect())
    assert got == sorted(want)
    assert tail.count() == 0 and lost.count() == 0 and bad.count() == 0


def test_stray_closer_does_not_break_later_documents(spark):
    vals = _lines(1, 70.0) + ["]"] + _lines(2, 71.0) + ["}", "  "] + _lines(3, 72.0)
    recs = spark.createDataFrame([("t", 0, i, v) for i, v in enumerate(vals)],
                                 "topic string, partition int, offset long, value string")
    docs, tail, lost = reassemble(recs)
    msgs, bad = decode_records(docs, keep=["offset"])
    assert sorted(r.msg.guid for r in msgs.collect()) == ["g1", "g2", "g3"]
    assert bad.count() == 0 and tail.count() == 0
    assert [r.value for r in lost.collect()] == ["}"]  # a lone "]" only separates


def _nested(guid, levels, open_=False):
    inner = '{"y{\\"}": ' * levels + "1" + "" if open_ else '{"y{\\"}": ' * levels + "1" + "}" * levels + "}"
    return f'{{"guid": "{guid}", "payload": {{"data": {{"temperature": 1.0}}}}, "x": ' + inner


def test_objects_of_any_depth_cost_only_themselves(spark):
    vals = [_nested("a", 13) + ', {"guid": "b"}',
            "[" + _nested("c", 100) + "," + _nested("d", 4) + ',{"guid": "e"}] trailing ' + _nested("f", 30)
            + ' " more {"guid": "g"}',
            '{"foo": ' + '{"a": ' * 50 + "1" + "}" * 50 + '}, {"guid": "h"}',
            '[{"guid": "i"}, ' + _nested("j", 60, open_=True) + ' {"guid": "lost with j"}',
            _nested("too deep for the parser", 3000) + ', {"guid": "k"}',
            '}} {"guid": "l"} } ' + _nested("m\x00\x02\x00\x01", 20) + '{"guid": "n"}', _nested("o", 20)]
    df = spark.createDataFrame(list(enumerate(vals)), "offset long, value string")
    msgs, bad = decode_records(df, keep=["offset"])
    got = sorted((r.offset, r.msg.guid) for r in msgs.collect())
    # (a raw control character is no JSON: that message is rejected with its text)
    assert got == [(0, "a"), (0, "b"), *((1, g) for g in "cdefg"), (2, "h"), (3, "i"), (4, "k"), (5, "l"), (5, "n"), (6, "o")]
    lost = sorted((r.offset, r.value) for r in bad.collect())
    assert [o for o, _ in lost] == [1, 2, 3, 4, 5, 5] and lost[2][1] == vals[3][len('[{"guid": "i"}, '):]
    assert lost[1][1].startswith('{"foo"') and _nested("m\x00\x02\x00\x01", 20) in [v for _, v in lost]


def test_long_records_of_deep_messages(spark):
    """Over a megabyte, thousands of messages nested deeper than any pattern."""
    n = 2500
    value = "[" + ",\n".join(_nested(f"g{i}", 20 + i % 30) for i in range(n)) + "]"
    assert len(value) > 1_000_000
    msgs, bad = decode_records(spark.createDataFrame([(0, value)], "offset long, value string"), ["offset"])
    assert [r.msg.guid for r in msgs.orderBy("idx").collect()] == [f"g{i}" for i in range(n)]
    assert bad.count() == 0


def test_lines_of_any_depth(spark):
    """One brace a line, a hundred levels, and closers that leave several levels at once."""
    vals = ['{"guid": "a", "payload": {}, "x":', *['{"y":'] * 60, "1", "}" * 30, "}" * 31, '{"guid": "b"}',
            '{"guid": "c", "x": ' + '{"y": ' * 45, "2" + "}" * 40 + ', "z": ' + '{"w": ' * 50, "3" + "}" * 50,
            "}" * 6 + ', {"guid": "d"}', '{"guid": "e", "z": {"y":' * 30 + "1" + "}" * 60]
    docs, tail, lost = reassemble(_recs(spark, vals))
    msgs, bad = decode_records(docs, keep=["offset"])
    assert sorted(r.msg.guid for r in msgs.collect()) == list("abcde")
    assert bad.count() == tail.count() == lost.count() == 0
