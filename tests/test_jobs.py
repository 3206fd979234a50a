"""Signal states, rotations and model steps against plain pandas and hand-made tables."""

import datetime
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from driftline.operators import folds, membership, walk
from driftline.plans import jobs, models

SF = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not Path(SF).exists(), reason="tables are not here")


def reversion(g, window, bands, low, high, trend_n):
    """One symbol's mean-reversion weights before the cap, by pandas windows."""
    x = g.sort_values("date").reset_index(drop=True)
    mean, sd, trend = x.close.rolling(window).mean().shift(1), x.close.rolling(window).std().shift(1), x.close.rolling(trend_n).mean().shift(1)
    d = x.close.diff()
    ewm = lambda v: v.fillna(0).ewm(com=13, min_periods=14).mean()
    rsi = (100 - 100 / (1 + ewm(d.clip(lower=0)) / ewm(-d.clip(upper=0)))).shift(1)
    e = np.where((x.close > mean + bands * sd) & (rsi > high) & (x.close < trend), -1.0, np.nan)
    x["e"] = np.where((x.close < mean - bands * sd) & (rsi < low) & (x.close > trend), 1.0, e)
    pos = x.e.ffill().fillna(0)
    x.loc[((pos == 1) & (x.close >= mean)) | ((pos == -1) & (x.close <= mean)), "e"] = 0.0
    x["weight"] = x.e.ffill().fillna(0) * 0.1
    return x[trend.notna()]


def test_mean_reversion_is_two_passes(spark):
    """Random walks, against pandas windows and exponential means."""
    rng = np.random.default_rng(5)
    w = pd.concat([pd.DataFrame({"symbol": s, "date": range(400), "close": 100 + rng.normal(size=400).cumsum()}) for s in "abc"])
    how = (10, 1.0, 45, 55, 40)
    want = {(s, r.date): r.weight for s, g in w.groupby("symbol") for r in reversion(g, *how).itertuples()}
    got = {(r.symbol, r.date): r.weight for r in jobs.mean_reversion(spark.createDataFrame(w), *how).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-6 for k in want)
    assert {round(x, 1) for x in want.values()} == {-0.1, 0.0, 0.1}


def test_rotation_enters_stays_and_leaves(spark):
    """Three symbols, one place, a buffer of two: the first is taken, kept at rank two, dropped at three, and a stop ends it."""
    day = lambda m: datetime.date(2024, m, 28)
    moms = {1: "abc", 2: "bac", 3: "bca", 4: "abc"}  # best first
    rows = [(s, day(m), 1.0, 3.0 - order.index(s), m == 4 and s == "b", day(m).replace(day=1)) for m, order in moms.items() for s in "abc"]
    df = spark.createDataFrame(rows, "symbol string, date date, close double, mom double, stop boolean, period date")
    out = jobs.rotation(df, 1, 2, F.lit(True), F.col("stop"))
    held = {(r.symbol, r.date.month) for r in out.collect() if r.weight > 0}
    assert held == {("a", 1), ("a", 2), ("b", 2), ("b", 3), ("a", 4)}
    assert jobs.rotation(df.limit(0), 1, 2, F.lit(True), F.col("stop")).count() == 0


def test_fold_keeps_every_row(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 2, None), ("b", 1, 3.0)], "symbol string, date int, x double")
    out = folds.fold(df, lambda s, r: {"n": s["n"] + 1}, {"n": "n"}, {"n": F.lit(0)}, ["x"])
    assert sorted((r.symbol, r.date, r.n) for r in out.collect()) == [("a", 1, 1), ("a", 2, 2), ("b", 1, 1)]


def test_fold_of_a_long_key(spark):
    """A key of 20,000 rows beside short ones: the recursion goes on across blocks, in time order."""
    rows = [("long", i, float(i % 7)) for i in range(20000)] + [("one", 1, 5.0), ("two", 1, 1.0), ("two", 2, 3.0)]
    out = folds.ewm(spark.createDataFrame(rows, ["symbol", "date", "x"]), "x", 0.25).collect()
    assert len(out) == len(rows)
    e, got = None, {(r.symbol, r.date): r.ewm for r in out}
    for i in range(20000):
        e = float(i % 7) if e is None else 0.75 * e + 0.25 * (i % 7)
        assert got["long", i] == pytest.approx(e)
    assert got["one", 1] == 5.0 and got["two", 2] == 1.5


def test_event_to_spell_keeps_repeated_additions(spark):
    rows = [("a", 1, "ADD"), ("a", 3, "ADD"), ("a", 5, "REMOVE"), ("b", 2, "REMOVE"), ("b", 4, "ADD")]
    e = spark.createDataFrame(rows, ["symbol", "d", "event"]).selectExpr("symbol", "date_add(date'2024-01-01', cast(d as int)) as date", "event")
    day = lambda df: sorted((r.symbol, r.start.day - 1, r.end.day - 1) for r in df.collect())
    assert day(membership.event_to_spell(e, "2024-01-10")) == [("a", 1, 9), ("a", 3, 5), ("b", 4, 9)]
    assert day(membership.spells(e, "2024-01-10")) == [("a", 1, 5), ("b", 4, 9)]


@tables
def test_models_score_all_test_rows(spark):
    n = models.samples(spark, SF).filter("part = 'test'").count()
    p = models.pca_variance(spark, SF).orderBy("component").collect()
    assert [r.component for r in p] == list(range(1, 65))
    assert all(a.share >= b.share for a, b in zip(p, p[1:])) and p[-1].cumulative == pytest.approx(1, abs=1e-4)
    rows = models.labelled(spark, SF).dropna(subset=["label", "until"])
    years = walk.years_of(rows, models.FIRST)
    unseen = rows.filter(F.year("date").isin(years)).count()
    for r in models.model_compare(spark, SF).collect():
        assert r.n == unseen == r.tp + r.tn + r.fp + r.fn and -1 <= r.mcc <= 1
        assert r.max_drawdown <= 0 and r.volatility > 0


def test_classifiers_learn_a_line(spark):
    """A class that one feature decides is told on rows that training did not see."""
    rng = np.random.default_rng(0)
    rows = [(i, float(v[0] > 0), 1.0, Vectors.dense(v)) for i, v in enumerate(rng.normal(size=(400, 2)).tolist())]
    df = spark.createDataFrame(rows, ["vec_id", "y", "w", "raw"])
    for name in models.classifiers():
        s = models.scores(df.filter("vec_id < 300"), df.filter("vec_id >= 300"), name).collect()
        assert len(s) == 100 and sum((r.score >= 0.5) == (r.y == 1) for r in s) >= 90, name
