"""Sums, thresholds and breaches do not depend on how readings are dealt to tasks."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from vigil.operators.breach import plan_breaches
from vigil.operators.moments import batch_partials


def readings(spark, values):
    rows = [("ALL", s, b, i, "g", float(x)) for i, (s, b, x) in enumerate(values)]
    return spark.createDataFrame(rows, "scope string, sensor string, batch int, ord long, guid string, x double")


@pytest.mark.parametrize("centre, spread", [(70.0, 20.0), (1 / 3, 1e-7), (-1e6, 0.1), (1e9, 1e3), (0.0, 1e-3), (5e9, 7.0)])
def test_moments_against_fractions(spark, centre, spread):
    rnd = random.Random(str(centre))
    xs = [centre + rnd.uniform(-spread, spread) for _ in range(3000)]
    r = batch_partials(readings(spark, [("s", 0, x) for x in xs])).first()
    exact = [Fraction(x) for x in xs]
    mean = sum(exact) / len(xs)
    m2 = float(sum((x - mean) ** 2 for x in exact))
    assert r.n == 3000 and r.sum_b == pytest.approx(float(sum(exact)), rel=1e-14, abs=1e-14)
    assert r.mean_b == pytest.approx(float(mean), rel=1e-14, abs=1e-16) and r.m2_b == pytest.approx(m2, rel=1e-6)


def test_bits_do_not_depend_on_partitions(spark):
    rnd = random.Random(5)
    values = [(rnd.choice("ab"), rnd.randrange(4), rnd.choice([rnd.gauss(70, 9), rnd.uniform(-1e5, 1e5), 0.1, 1 / 3]))
              for _ in range(4000)]
    df = readings(spark, values).persist()
    seen = set()
    for n in (1, 7, 200):
        dealt = df.repartition(n, F.rand(n))
        got = sorted((r.sensor, r.batch, r.n, r.sum_b.hex(), r.mean_b.hex(), r.m2_b.hex())
                     for r in batch_partials(dealt).collect())
        seen.add(tuple(got))
    assert len(seen) == 1


def test_breaches_at_the_bound(spark):
    """Readings put right at the thresholds and one step of a double beside them."""
    rnd = random.Random(8)
    first = [("a", 0, rnd.gauss(50, 7)) for _ in range(900)]
    band = plan_breaches(readings(spark, first)).thr.first()
    near = [x for b in (band.lo, band.hi) for x in (b, math.nextafter(b, -1e9), math.nextafter(b, 1e9))]
    df = readings(spark, first + [("a", 1, x) for x in near]).persist()
    # thresholds of the first batch against the readings that lie at them
    codes = {}
    for n in (1, 7, 200):
        dealt = df.repartition(n, F.rand(n + 1))
        moved = dealt.withColumn("batch", F.lit(0))
        codes[n] = [(r.ord, r.code, r.lo.hex(), r.hi.hex()) for r in plan_breaches(moved).codes().orderBy("ord").collect()]
    assert codes[1] == codes[7] == codes[200] and len(codes[1]) == 906


def test_values_that_cannot_be_cut(spark):
    df = readings(spark, [("a", 0, 1e300), ("a", 0, 2e300), ("b", 0, 2.0 ** 40), ("b", 0, 1.0), ("c", 0, 3.0)])
    got = {r.sensor: (r.sum_b, r.mean_b) for r in batch_partials(df).collect()}
    assert got == {"a": (3e300, 1.5e300), "b": (2.0 ** 40 + 1, (2.0 ** 40 + 1) / 2), "c": (3.0, 3.0)}
