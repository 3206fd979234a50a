"""Operators on small hand-made tables; expected values are worked out by hand."""

import datetime
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from driftline.functions.expr import business_month_end, normal_cdf, week_ending
from driftline.operators import bars as B, quality
from driftline.operators import folds, joins, membership
from driftline.operators import portfolio as P
from driftline.operators import windows as W
from driftline.sources import store


def day(text):
    return date.fromisoformat(text)


def series(spark, values, symbol="A"):
    rows = [(symbol, date(2024, 1, i + 1), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "symbol string, date date, x double")


def column(df, name):
    return [r[name] for r in df.orderBy("symbol", "date").collect()]


def test_bins(spark):
    days = ["2024-03-28", "2024-03-30", "2024-03-31", "2024-04-02"]
    df = spark.createDataFrame([(day(d),) for d in days], "d date").select("d", week_ending("d").alias("w"), business_month_end("d").alias("m"))
    got = df.orderBy("d").collect()
    assert [str(r.w) for r in got] == ["2024-03-29", "2024-04-05", "2024-04-05", "2024-04-05"]
    assert [str(r.m) for r in got] == ["2024-03-29", "2024-04-30", "2024-04-30", "2024-04-30"]


def test_period_bars_skip_nulls(spark):
    rows = [("A", day("2024-01-01"), None, 5.0, 1.0, 3.0, 10), ("A", day("2024-01-02"), 2.0, 6.0, 2.0, None, 5)]
    df = spark.createDataFrame(rows, "symbol string, date date, open double, high double, low double, close double, volume long")
    (bar,) = B.bars(df, week_ending("date")).collect()
    assert (bar.open, bar.high, bar.low, bar.close, bar.volume) == (2.0, 6.0, 1.0, 3.0, 15)


def test_calendar_grid_keeps_empty_days(spark):
    grid = B.calendar_grid(series(spark, [1.0]), "2024-01-01", "2024-01-03")
    assert column(grid, "x") == [1.0, None, None]


def test_sma_with_and_without_least(spark):
    got = series(spark, [1.0, 2.0, 6.0]).select("symbol", "date", W.sma("x", 3).alias("a"), W.sma("x", 3, 1).alias("b"))
    assert column(got, "a") == [None, None, 3.0]
    assert column(got, "b") == [1.0, 1.5, 3.0]


def test_fill(spark):
    got = series(spark, [None, 1.0, None, 2.0, None]).select("symbol", "date", W.forward_fill("x").alias("f"), W.back_fill("x").alias("b"))
    assert column(got, "f") == [None, 1.0, 1.0, 2.0, 2.0]
    assert column(got, "b") == [1.0, 1.0, 2.0, 2.0, None]


def test_ranks(spark):
    df = spark.createDataFrame([("A", 1.0), ("B", 1.0), ("C", 3.0), ("D", None)], "symbol string, x double").withColumn("date", F.lit("2024-01-01"))
    got = {r.symbol: r for r in df.select("symbol", W.rank_first("x").alias("f"), W.rank_average("x").alias("a"), W.rank_scaled("x").alias("s")).collect()}
    assert [got[s].f for s in "ABCD"] == [2, 3, 1, 4]
    assert [got[s].a for s in "ABC"] == [1.5, 1.5, 3.0]
    assert [got[s].s for s in "ABCD"] == [-1.0, -1.0, 1.0, 0.0]
    assert df.filter("symbol = 'A'").select(W.rank_scaled("x").alias("s")).first().s == 0.0


def test_weight_change_and_equity(spark):
    assert column(series(spark, [0.0, 0.5, 0.5, 0.0]).select("symbol", "date", W.weight_change("x").alias("c")), "c") == [0.0, 0.5, 0.0, -0.5]
    e = series(spark, [0.1, -0.5, 0.2]).withColumn("e", W.equity("x"))
    assert column(e, "e") == pytest.approx([1.1, 0.55, 0.66])
    assert column(e.withColumn("d", W.drawdown("e")), "d")[1] == pytest.approx(-0.5)


def test_ewm(spark):
    assert column(folds.ewm(series(spark, [1.0, 2.0, 4.0, 8.0, 3.0]), "x", 0.5), "ewm") == [1.0, 1.5, 2.75, 5.375, 4.1875]
    assert column(folds.ewm(series(spark, [1.0, 3.0]), "x", 0.5, adjust=True), "ewm") == pytest.approx([1.0, 3.5 / 1.5])


def test_wilder(spark):
    assert column(folds.wilder(series(spark, [1.0, 3.0, None, 6.0]), "x", 2), "wilder") == [None, 2.0, 2.0, 4.0]


def test_asof(spark):
    left = series(spark, [1.0, 2.0, 3.0, 4.0])
    right = spark.createDataFrame([("A", day("2024-01-02"), 7.0), ("A", day("2024-01-04"), None)], "symbol string, date date, y double")
    assert column(joins.asof(left, right, ["y"]), "y") == [None, 7.0, 7.0, None]
    assert column(joins.asof(left, right, ["y"], forward=True), "y") == [7.0, 7.0, None, None]


def test_interval_ends_are_inside_and_rows_once(spark):
    spells = spark.createDataFrame([("A", day("2024-01-02"), day("2024-01-03")), ("A", day("2024-01-03"), day("2024-01-03"))], "symbol string, start date, end date")
    got = joins.interval(series(spark, [1.0, 2.0, 3.0, 4.0]), spells)
    assert column(got, "x") == [2.0, 3.0]


def test_spells(spark):
    rows = [("A", "2024-01-01", "ADD"), ("A", "2024-01-05", "ADD"), ("A", "2024-01-09", "REMOVE"), ("A", "2024-02-01", "ADD"), ("B", "2024-01-01", "REMOVE"), ("C", "2024-01-03", "REMOVE"), ("C", "2024-01-03", "ADD")]
    events = spark.createDataFrame([(s, day(d), e) for s, d, e in rows], "symbol string, date date, event string")
    got = {(r.symbol, str(r.start), str(r.end)) for r in membership.spells(events, "2024-03-01").collect()}
    assert got == {("A", "2024-01-01", "2024-01-09"), ("A", "2024-02-01", "2024-03-01"), ("C", "2024-01-03", "2024-01-03")}


def test_upsert_twice_changes_nothing(spark):
    target, source = series(spark, [1.0, 2.0]), series(spark, [9.0, 2.0, 3.0])
    once = store.upsert(target, source, ["symbol", "date"])
    twice = store.upsert(once, source, ["symbol", "date"])
    assert column(once, "x") == column(twice, "x") == [9.0, 2.0, 3.0]
    assert column(store.insert_only(target, source, ["symbol", "date"]), "x") == [1.0, 2.0, 3.0]


def test_written_round_trip(spark):
    df = series(spark, [1.0, None, 3.0])
    assert column(store.written(df), "x") == [1.0, None, 3.0]


def test_split_period(spark):
    df = spark.createDataFrame([(day("2024-01-01"), day("2024-01-10"))], "start date, end date")
    got = [(r.part_start.day, r.part_end.day) for r in store.split_period(df, 4).orderBy("part_start").collect()]
    assert got == [(1, 5), (6, 10)]


def test_backtest_costs_turnover(spark):
    w = spark.createDataFrame([("A", day("2024-01-01"), 10.0, 1.0), ("A", day("2024-01-02"), 11.0, 0.0)], "symbol string, date date, close double, weight double")
    first, second = P.backtest(w, 0.01).orderBy("date").collect()
    assert first.net == pytest.approx(0.1 - 0.01)
    assert second.net == pytest.approx(-0.01)


def test_normal_cdf(spark):
    got = spark.createDataFrame([(0.0,), (1.96,), (-1.96,)], "x double").select(normal_cdf(F.col("x")).alias("p")).collect()
    assert [r.p for r in got] == pytest.approx([0.5, 0.975, 0.025], abs=1e-4)


def test_empty_tables(spark):
    none = series(spark, [1.0]).filter("false")
    assert folds.ewm(none, "x", 0.5).count() == 0
    assert joins.asof(none, none.select("symbol", "date", F.col("x").alias("y")), ["y"]).count() == 0
    assert B.calendar_grid(none, "2024-01-01", "2024-01-03").count() == 0


def test_adx(spark):
    import random

    rng, n, m = random.Random(1), 4, 3
    rows, level = [], 100.0
    for i in range(28):
        level += rng.uniform(-3, 3)
        rows.append(("A", date(2024, 2, i + 1), level + rng.uniform(1, 2), level - rng.uniform(1, 2), level))
    df = spark.createDataFrame(rows, "symbol string, date date, high double, low double, close double")

    tr, plus, minus = [], [], []
    for (_, _, h0, l0, c0), (_, _, h, low, _) in zip(rows, rows[1:]):
        tr.append(max(h - low, abs(h - c0), abs(low - c0)))
        up, down = h - h0, l0 - low
        plus.append(up if up > down and up > 0 else 0.0)
        minus.append(down if down > up and down > 0 else 0.0)

    def wilder(x, size):
        out = [sum(x[:size]) / size]
        for v in x[size:]:
            out.append((out[-1] * (size - 1) + v) / size)
        return out

    dx = [100 * abs(p - q) / (p + q) if p + q else 0.0 for p, q in zip(wilder(plus, n), wilder(minus, n))]
    got = folds.adx(df, n, atr=m)
    assert column(got, "adx") == pytest.approx([None] * (2 * n - 1) + wilder(dx, n))
    assert column(got, "atr") == pytest.approx([None] * m + wilder(tr, m))


def test_required_rules_raise(spark):
    df = spark.createDataFrame([(1, 2.0), (2, None), (3, -1.0)], "k int, x double")
    rules = {("not_null", "x"): F.col("x").isNull(), ("positive", "x"): ~(F.col("x") > 0)}
    assert {(r.rule, r.failures) for r in quality.failures(df, rules).collect()} == {("not_null", 1), ("positive", 1)}
    with pytest.raises(quality.RulesFailed, match="not_null of x: 1 rows; positive of x: 1 rows"):
        quality.require(df, rules)
    with pytest.raises(quality.RulesFailed, match="^positive"):
        quality.require(df, rules, warn=frozenset({("not_null", "x")}))
    assert quality.require(df.filter("x > 0"), rules).count() == 1
    assert quality.require(df.limit(0), rules).count() == 0


def days_of(n):
    return datetime.date(2024, 1, 1) + datetime.timedelta(n)


def test_snapshots_and_counts_equal_going_through_all_days(spark):
    """Overlapping, touching, long and one-day spells; dates on ends, between and outside; bins of a few days."""
    rnd = random.Random(6)
    spells = [(rnd.choice("abcdefgh"), a, a + rnd.choice([0, 1, 5, 40, 200])) for a in (rnd.randrange(-100, 300) for _ in range(60))]
    dates = [days_of(n) for n in rnd.sample(range(-120, 420), 90)]
    s = spark.createDataFrame([(k, days_of(a), days_of(b)) for k, a, b in spells], "symbol string, start date, end date")
    d = spark.createDataFrame([(x,) for x in dates] * 2, "date date")
    want = {x: sorted({k for k, a, b in spells if days_of(a) <= x <= days_of(b)}) for x in dates}
    want = {x: m for x, m in want.items() if m}
    for bins in (1, 7, 1000):
        assert {r.date: r.members for r in membership.snapshots(s, d, days=bins).collect()} == want
    assert {r.date: r.n for r in membership.counts(s, d).collect()} == {x: len(m) for x, m in want.items()}
    assert membership.snapshots(s.limit(0), d).count() == 0


def test_interval_join_equals_trying_all_spells(spark):
    rnd = random.Random(9)
    spells = [(rnd.choice(["a", "b", None]), rnd.randrange(50), rnd.choice([None, *range(60)])) for _ in range(40)]
    rows = [(rnd.choice(["a", "b", "c", None]), rnd.choice([None, *range(70)]), n) for n in range(300)]
    s = spark.createDataFrame([(k, days_of(a), None if b is None else days_of(b)) for k, a, b in spells], "symbol string, start date, end date")
    left = spark.createDataFrame([(k, None if t is None else days_of(t), n) for k, t, n in rows], "symbol string, date date, n int")
    want = {n for k, t, n in rows if t is not None and any(k is not None and k == q and b is not None and a <= t <= b for q, a, b in spells)}
    got = joins.interval(left, s)
    assert got.columns == left.columns and sorted(r.n for r in got.collect()) == sorted(want)
