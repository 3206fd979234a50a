"""Quantiles by sketch and second pass against sorted lists."""

import random

import pytest
from pyspark.sql import functions as F

from driftline.operators import quantiles as Q

SHARES = [0.0, 0.1, 0.25, 0.5, 0.9, 0.999, 1.0]


def slow(xs, p):
    xs = sorted(x for x in xs if x is not None)
    h = p * (len(xs) - 1)
    a, b = xs[int(h)], xs[min(int(h) + 1, len(xs) - 1)]
    return a + (b - a) * (h - int(h))


@pytest.fixture(scope="module")
def groups():
    rnd = random.Random(8)
    big = [rnd.gauss(0, 1) for _ in range(30_000)]
    ties = [float(rnd.choice([1, 1, 1, 2, 3])) for _ in range(5000)]
    return {"big": big, "ties": ties, "one": [4.0], "two": [1.0, 2.0], None: [rnd.random() for _ in range(50)] + [None], "flat": [7.0] * 300}


@pytest.mark.parametrize("size", [1000, 8])
def test_exact_in_large_small_tied_and_null_groups(spark, groups, size):
    """A sketch of size 8 errs by more than the margin, so that its bounds have to give way."""
    df = spark.createDataFrame([(g, x) for g, xs in groups.items() for x in xs] + [("none", None)], "g string, x double").repartition(6)
    got = {r.g: r.quantiles for r in Q.quantiles(df, ["g"], "x", SHARES, size=size).collect()}
    assert got.keys() == groups.keys()
    for g, xs in groups.items():
        assert got[g] == [pytest.approx(slow(xs, p), abs=1e-12) for p in SHARES], g


def test_buckets_are_those_of_percentiles(spark, groups):
    df = spark.createDataFrame([(g, x) for g, xs in groups.items() for x in xs], "g string, x double").repartition(6)
    exact = df.groupBy("g").agg(F.array_distinct(F.percentile("x", F.array(*map(F.lit, (0.25, 0.5, 0.75))))).alias("q")).withColumnRenamed("g", "of")
    want = df.join(exact, F.col("g").eqNullSafe(F.col("of"))).select("g", "x", F.when(F.col("x").isNotNull(), 1 + F.size(F.filter("q", lambda e: F.col("x") > e))).alias("b"))
    got = Q.buckets(df, ["g"], "x", [0.25, 0.5, 0.75], "b")
    count = lambda d: {(r.g, r.b): r["count"] for r in d.groupBy("g", "b").count().collect()}
    assert count(got) == count(want)
    assert Q.buckets(df.limit(0), ["g"], "x", [0.5]).count() == 0
