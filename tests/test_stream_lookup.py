"""Keyed state is looked up by hash, without sorting its rows."""

import os

from pyspark.sql.types import LongType, StringType, StructField, StructType

from vigil.streaming.ledger import KeyedLog, Ledger

SCHEMA = StructType([StructField("scope", StringType()), StructField("n", LongType()), StructField("m", LongType())])


def test_the_newest_run_wins_by_hash(spark, tmpdir_path):
    log = KeyedLog(Ledger(spark, os.path.join(tmpdir_path, "out")), "state", ["scope"], SCHEMA)
    runs = []
    for i, rows in enumerate([[("a", 1, 1), ("b", 2, 2), (None, 3, 3)], [("a", 4, None), (None, None, 5)]]):
        _, path = log.append(runs, i, spark.createDataFrame(rows, SCHEMA))
        runs.append({"path": path, "rows": len(rows), "first": i})
    state = log.all(runs)
    assert {tuple(r) for r in state.collect()} == {("a", 4, None), ("b", 2, 2), (None, None, 5)}
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
