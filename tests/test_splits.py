"""JSON files read in byte ranges, and places by ranges."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from vigil.functions.ranks import RANGES, ranked
from vigil.sources.framing import decode_records
from vigil.sources.splits import read_chunks, read_objects


@pytest.fixture()
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def write(folder, **files):
    os.makedirs(folder, exist_ok=True)
    for name, text in files.items():
        with open(os.path.join(folder, name), "w", encoding="utf-8", newline="") as f:
            f.write(text)


def test_files_are_read_by_many_tasks(spark, tmpdir_path, small_splits):
    rnd = random.Random(7)
    odd = ["", "}", "{", "a}b", '\\"}', "\\\\", '"', "é}漢", "},{", "x" * 50, "\n}"]

    def message(i):
        return {"guid": f"{i}{rnd.choice(odd)}", "payload": {"format": rnd.choice(odd), "data": {"temperature": i / 4}}}

    first, second = [message(i) for i in range(1500)], [message(i) for i in range(2000, 2300)]
    write(tmpdir_path, line=json.dumps(first), pretty=json.dumps(second, indent=1, ensure_ascii=False) + "\n",
          one=json.dumps(message(5000)), none=" [] \n", nothing="")
    assert read_chunks(spark, tmpdir_path).rdd.getNumPartitions() > 6
    docs, lost = read_objects(spark, tmpdir_path)
    msgs, bad = decode_records(docs, keep=["topic", "offset"])
    rows = msgs.select("topic", "offset", "msg.guid", "msg.payload.format").orderBy("offset").collect()
    by_file = {}
    for r in rows:
        by_file.setdefault(r.topic.rsplit("/", 1)[1], []).append((r.guid, r.format))
    want = lambda ms: [(m["guid"], m["payload"]["format"]) for m in ms]
    assert by_file["line"] == want(first) and by_file["pretty"] == want(second)
    assert len(by_file["one"]) == 1 and set(by_file) == {"line", "pretty", "one"}
    assert lost.count() == bad.count() == 0


def test_broken_files_cost_what_is_broken(spark, tmpdir_path, small_splits):
    good = [json.dumps({"guid": f"g{i}", "payload": {}}) for i in range(40)]
    write(tmpdir_path, cut="[" + ",".join(good[:10]) + ', {"guid": "open", "payload": {',
          quote="\n".join([*good[10:20], '{"guid": "no end of this}', *good[20:30]]),
          stray=good[30] + "} and } " + good[31])
    docs, lost = read_objects(spark, tmpdir_path)
    msgs, bad = decode_records(docs, keep=["offset"])
    got = {r.guid for r in msgs.select("msg.guid").collect()}
    assert got >= {f"g{i}" for i in [*range(20), 30, 31]}
    text = " ".join(r.value for r in lost.collect()) + " ".join(r.value for r in bad.collect())
    assert all(f'"g{i}"' in text for i in range(20, 30) if f"g{i}" not in got)
    assert "open" in text and "no end of this" in text and "and" in text


def test_places_of_hot_values_and_nulls(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice("ab"), rnd.choice([7.0, None, float(rnd.randint(0, 2000))])) for _ in range(6000)]
    df = spark.createDataFrame(rows, "g string, x double")
    for down in (True, False):
        out = ranked(df, ["g"], "x", "place", down)
        got = out.collect()
        for g in "ab":
            xs = sorted((x for h, x in rows if h == g and x is not None), reverse=down)
            first = {}
            for i, x in enumerate(xs, 1):
                first.setdefault(x, i)
            want = [(first.get(x, len(xs) + 1), x) for h, x in rows if h == g]
            mine = [(r.place, r.x) for r in got if r.g == g]
            key = lambda v: (v[0], str(v[1]))
            assert sorted(mine, key=key) == sorted(want, key=key)
            assert [p for p, _ in mine] == sorted(p for p, _ in mine)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "array_repeat" not in plan and "Window" in plan
    assert ranked(df.limit(0), [], "x", "place").count() == 0
    assert RANGES > 1 and ranked(df.select("x"), [], "x", "place").agg(F.max("place")).first()[0] <= 6000
