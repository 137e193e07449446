"""Golden: the one captured console batch (100 humidity and 100 light lines)."""

import os

from pyspark.sql import functions as F

from vigil.operators import lines as L

DATA = os.path.join(os.path.dirname(__file__), "data", "console_batch_lines.txt")


def _records(spark):
    with open(DATA) as f:
        vals = [ln.rstrip("\n") for ln in f if not ln.startswith("#")]
    # printed in the same batch; surround with non-matching lines of the pretty-printed message
    rows = []
    for i, v in enumerate(vals):
        rows += [(3 * i, '  "guid": "0-ZZZ123456785B",'), (3 * i + 1, "        " + v.replace(":", ": ")),
                 (3 * i + 2, '  "senstype": "humidity"')]
    return spark.createDataFrame(rows, "ord long, value string")


def test_console_batch(spark):
    m = L.matched_lines(_records(spark), ["ord"])
    v = L.line_values(m, ["ord"]).withColumn("batch", F.lit(0))
    assert m.where("sensor = 'HUMIDITY'").count() == 300  # shape-A 'senstype' lines match too
    cnt = L.batch_count(v).collect()[0]
    assert cnt.n == 100 and cnt.label == "Total Count of Msgs: 100"
    sums = {r.sensor: r for r in L.batch_sum(v).collect()}
    assert round(sums["HUMIDITY"].total, 6) == 4621.335414
    assert round(sums["LIGHT"].total, 6) == 18902.224282
    assert sums["HUMIDITY"].label == "Total Sum of Humidity: 4621.335414"
    srt = [(r.sensor, r.x) for r in L.batch_sort(v).collect()]
    hum = [x for s, x in srt if s == "HUMIDITY"]
    light = [x for s, x in srt if s == "LIGHT"]
    assert hum[0] == 10.598499 and hum[-1] == 89.876546 and hum == sorted(hum)
    assert light[0] == 180.001149 and light[-1] == 199.656695 and len(light) == 100
