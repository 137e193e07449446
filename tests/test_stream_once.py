"""What a batch writes is evaluated once, and its order is a number wherever that is possible."""

import os

from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from vigil.sources.framing import pieces
from vigil.streaming.ledger import Ledger, empty
from vigil.streaming.runner import PLACE, packed_order

PLACES = "partition int, offset long, idx int"


def test_outputs_are_evaluated_once(spark, tmpdir_path):
    seen = spark.sparkContext.accumulator(0)

    def look(i):
        seen.add(1)
        return i

    led = Ledger(spark, os.path.join(tmpdir_path, "out"))
    rows = spark.range(0, 1000, 1, 4).select(F.udf(look, LongType())("id").alias("i"))
    assert led.put("rows", 0, rows) == "rows/batch_id=0" and seen.value == 1000
    assert led.put("rows", 0, empty(spark, rows.schema)) is None and led.put("rows", 1, None) is None
    assert not os.path.exists(led.path("rows"))


def test_packed_order_is_that_of_the_places(spark):
    near = [(p, o, i) for p in (None, -1, 3) for o in (None, -5, 0, 7) for i in (None, 0, 2)]
    far = [(0, -(1 << 63), 0), (1, (1 << 63) - 1, 5), (0, (1 << 63) - 1, 1)]
    for places, kind in ((near, "bigint"), (far, "struct"), ([], "bigint")):
        df = spark.createDataFrame(places, PLACES)
        df = df.withColumn("ord", packed_order(df))
        assert dict(df.dtypes)["ord"].startswith(kind)
        by_struct = [tuple(r)[:3] for r in df.orderBy(F.struct(*PLACE)).collect()]
        assert [tuple(r)[:3] for r in df.orderBy("ord").collect()] == by_struct
        assert df.select("ord").distinct().count() == len(places)


def test_rows_kept_for_a_batch_bring_no_lineage(spark, tmpdir_path):
    led = Ledger(spark, os.path.join(tmpdir_path, "out"))
    rows = led.once("rows", 3, spark.range(10).withColumn("k", F.col("id") % 3).groupBy("k").count())
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert rows.count() == 3 and plan.strip().count("\n") == 0 and "Relation" in plan
    led.clear(3)
    assert not os.path.exists(led.path("work/batch_id=3"))


def test_what_a_single_object_leaves_of_a_record(spark):
    want = {'[{"a":1}]': (1, None), '{"a":1} x': (1, "x"), 'x, {"a":1}': (1, "x"), '{"a":1}{"a":1}': (2, None),
            '{"a":{"b":1}} {"b":1}': (2, None), 'y {"a":1} z {"a":1}': (2, 'y  z'), "no": (0, "no"), " ": (0, None)}
    df = pieces(spark.createDataFrame([(v,) for v in want], "v string"), "v", ["v"])
    assert {r.v: (len(r["_o"]), r["_x"]) for r in df.collect()} == want
