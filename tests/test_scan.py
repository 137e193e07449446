"""The two-level running scan equals a plain sequential running aggregate."""

import random

from pyspark.sql import functions as F

from vigil.functions.scan import RunSpec, running


def test_running_matches_sequential(spark):
    rnd = random.Random(5)
    rows = []
    for key in ("a", "b", None):
        for o in rnd.sample(range(5000), 400):
            rows.append((key, o, rnd.randint(-5, 5), rnd.choice([None, rnd.randint(0, 100)])))
    df = spark.createDataFrame(rows, "k string, o long, v long, w long")
    specs = [RunSpec("s", "v"), RunSpec("se", "v", "sum", inclusive=False),
             RunSpec("mx", "w", "max"), RunSpec("mne", "w", "min", inclusive=False)]
    # small buckets so many rows sit behind bucket boundaries
    out = running(df, ["k"], "o", specs, bucket=F.floor(F.col("o") / 97))
    got = {(r.k, r.o): (r.s, r.se, r.mx, r.mne) for r in out.collect()}
    for key in ("a", "b", None):
        seq = sorted((o, v, w) for k, o, v, w in rows if k == key)
        tot, mx, mn = 0, None, None
        for o, v, w in seq:
            before_sum, before_min = tot, mn
            tot += v
            if w is not None:
                mx = w if mx is None else max(mx, w)
            s, se, gmx, gmne = got[(key, o)]
            assert (s, gmx, gmne) == (tot, mx, before_min), (key, o)
            assert (se or 0) == before_sum  # exclusive sum: NULL before the first row
            if w is not None:
                mn = w if mn is None else min(mn, w)
