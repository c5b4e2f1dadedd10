"""Sums of doubles: right to the last bit, whatever the order and the partitions."""

import math
import random

from pyspark.sql import functions as F

from quarterbill.functions.exact import exact_sum
from quarterbill.operators.spread import stage


def _rows(rng, n):
    for _ in range(n):
        yield rng.choice([rng.uniform(-1e6, 1e6), rng.uniform(0, 1), 0.1, -0.1, 2.675, 1e12 + 0.25, -1e12, 0.0])


def test_same_bits_over_shuffles(spark):
    rng = random.Random(8)
    rows = [(g, x) for g in range(5) for x in _rows(rng, 4000)] + [(9, None), (10, 3.5)]
    want = {g: math.fsum(x for h, x in rows if h == g) for g in range(5)} | {9: None, 10: 3.5}
    plain = set()
    for seed in range(5):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "g long, x double").repartition(3 + seed)
        found = df.groupBy("g").agg(F.expr(exact_sum("x")).alias("s"), F.sum("x").alias("plain"), F.expr(exact_sum("x", "x > 0")).alias("more"))
        got = {r.g: r for r in found.collect()}
        assert {g: r.s for g, r in got.items()} == want
        plain.add(tuple(got[g].plain for g in range(5)))
        assert got[0].more == math.fsum(x for g, x in rows if g == 0 and x > 0)
    assert len(plain) > 1  # which is why


def test_totals_do_not_depend_on_the_order(spark):
    from quarterbill.plans import reports

    rng = random.Random(3)
    rows = [(rng.uniform(0, 500), rng.uniform(0, 250)) for _ in range(3000)]
    charges = stage(spark.createDataFrame(rows, "storage_price double, compute_price double").selectExpr("*", "storage_price + compute_price AS total_price"))
    found = {tuple(reports.totals(charges.orderBy(F.rand(seed)).repartition(2 + seed)).first()) for seed in range(5)}
    assert len(found) == 1
    assert found.pop()[0] == math.fsum(r[0] for r in rows)
