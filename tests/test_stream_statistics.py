"""Statistics of every batch stay, however many batches the stream has."""

import json
import os
from statistics import mean, stdev

import pytest

from vigil.streaming import AnomalyStream


@pytest.mark.parametrize("scope, key", [("ALL", "ALL"), ("guid", "g")])
def test_statistics_outlive_the_state(spark, tmpdir_path, scope, key):
    root = os.path.join(tmpdir_path, "out")
    proc = AnomalyStream(root, scope=scope, keep_batches=1)
    seen, want = [], {}
    for i in range(4):
        values = [] if i == 2 else [60.0 + i, 70.0, 75.0 - i]  # batch 2 has no readings
        rows = [("t", 0, k, json.dumps({"guid": "g", "payload": {"data": {"temperature": v}}}))
                for k, v in enumerate(values)] or [("t", 0, 0, " ")]
        df = spark.createDataFrame(rows, "topic string, partition int, offset long, value string")
        for _ in range(2 if i == 1 else 1):  # batch 1 is delivered twice
            proc(df, i)
        seen += values
        if values:
            want[i] = (key, "TEMPERATURE", len(seen), len(values), mean(seen), stdev(seen))
    rows = proc.output(spark, "statistics").collect()
    got = {r.batch_id: (r.scope, r.sensor, r.n, r.n_b, pytest.approx(r["mean"]),
                        pytest.approx(r["std"])) for r in rows}
    assert len(rows) == 3 and got == want
    assert all(r.lo < r["mean"] < r.hi for r in rows)
