"""The scan of affine maps against plain loops, with blocks of a few rows and one key of many."""

import random

import pytest
from pyspark.sql import functions as F

from driftline.operators import folds, scans

SCHEMA = "symbol string, date int, x double"


def series(seed=1):
    rnd = random.Random(seed)
    return {s: [None if rnd.random() < 0.2 else rnd.uniform(-5, 5) for _ in range(n)] for s, n in (("a", 200), ("b", 7), ("c", 1), (None, 33))} | {"none": [None] * 9}


def frame(spark, found):
    return spark.createDataFrame([(s, k, x) for s, xs in found.items() for k, x in enumerate(xs)], SCHEMA).repartition(6)


def check(df, col, want):
    got = {(r.symbol, r.date): r[col] for r in df.collect()}
    flat = {(s, k): v for s, vs in want.items() for k, v in enumerate(vs)}
    assert got.keys() == flat.keys()
    assert all(got[k] == v if v is None or got[k] is None else got[k] == pytest.approx(v, rel=1e-9, abs=1e-9) for k, v in flat.items())


def ewm(xs, alpha):
    e, out = None, []
    for x in xs:
        e = e if x is None else x if e is None else (1 - alpha) * e + alpha * x
        out.append(e)
    return out


def wilder(xs, n):
    seen, w, out = [], None, []
    for x in xs:
        if x is not None:
            seen.append(x)
            w = sum(seen) / n if len(seen) == n else (w * (n - 1) + x) / n if len(seen) > n else None
        out.append(w)
    return out


def adjusted(xs, alpha):
    num = den = 0.0
    out = []
    for x in xs:
        num, den = num * (1 - alpha) + (x or 0.0), den * (1 - alpha) + (x is not None)
        out.append(num / den if den else None)
    return out


@pytest.mark.parametrize("block", [5, 4096])
def test_means_equal_loops_with_nulls_short_keys_and_blocks_of_blocks(spark, block):
    found = series()
    df = frame(spark, found)
    check(scans.ewm(df, "x", 0.3, "m", block=block), "m", {s: ewm(xs, 0.3) for s, xs in found.items()})
    check(scans.wilder(df, "x", 6, "m", block=block), "m", {s: wilder(xs, 6) for s, xs in found.items()})
    check(scans.ewm_adjusted(df, {"m": "x"}, 0.3, block=block), "m", {s: adjusted(xs, 0.3) for s, xs in found.items()})


def test_adx_equals_the_fold(spark):
    rnd = random.Random(2)
    rows = []
    for s in "ab":
        p = 100.0
        for k in range(90):
            p += rnd.uniform(-2, 2)
            rows.append((s, k, p + rnd.random(), p - rnd.random(), p))
    df = spark.createDataFrame(rows, "symbol string, date int, high double, low double, close double")
    want = {(r.symbol, r.date): (r.adx, r.atr) for r in folds.adx(df, 7, 5).collect()}
    got = {(r.symbol, r.date): (r.adx, r.atr) for r in scans.adx(df, 7, 5, block=8).collect()}
    assert got.keys() == want.keys()
    for k, pair in want.items():
        assert got[k] == tuple(v if v is None else pytest.approx(v, abs=1e-9) for v in pair)


def test_one_key_of_two_million_rows_spreads_over_tasks(spark):
    n, alpha = 2_000_000, 0.01
    df = spark.range(n).select(F.lit("k").alias("symbol"), F.col("id").alias("date"), F.sin(F.col("id") / 1000).alias("x"))
    rows = scans.numbered(df)
    sizes = rows.groupBy(scans.PART).count().agg(F.max("count"), F.count("*")).first()
    assert sizes[0] <= scans.BLOCK and sizes[1] == -(-n // scans.BLOCK)
    got = {r.date: r.m for r in scans.ewm(df, "x", alpha, "m").filter("date % 199999 = 0").collect()}
    import numpy as np

    x, e, want = np.sin(np.arange(n) / 1000), None, {}
    for k, v in enumerate(x.tolist()):
        e = v if e is None else (1 - alpha) * e + alpha * v
        if k % 199999 == 0:
            want[k] = e
    assert got == {k: pytest.approx(v, abs=1e-9) for k, v in want.items()}


def test_empty_table(spark):
    assert scans.ewm(spark.createDataFrame([], SCHEMA), "x", 0.5).count() == 0
