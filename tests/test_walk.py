"""Walk-forward training on made panels: planted skill is found, labels made of the future and noise give none."""

import datetime
import random

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from driftline.operators import walk

MODELS = {"logistic": lambda: LogisticRegression(labelCol="y", featuresCol="features", weightCol="w", regParam=0.01)}


def panel(spark, label, n=12, years=6):
    """Weekly rows of n symbols with two random features; label(feature, noise) is known four weeks later."""
    rnd = random.Random(4)
    rows = []
    for s in range(n):
        for k in range(52 * years):
            day = datetime.date(2010, 1, 1) + datetime.timedelta(7 * k)
            x, z = rnd.gauss(0, 1), rnd.gauss(0, 1)
            rows.append((f"s{s}", day, day + datetime.timedelta(28), 10.0, 1, x, z, int(label(x, rnd.gauss(0, 1))), rnd.gauss(0, 0.01) + 0.01 * x))
    return spark.createDataFrame(rows, "symbol string, date date, until date, close double, volume long, x double, z double, label int, nx double")


def test_each_year_is_scored_by_earlier_years_whose_labels_were_known(spark):
    df = panel(spark, lambda x, e: x + 0.3 * e > 0.5)
    assert walk.years_of(df, 3) == [2013, 2014, 2015] and walk.years_of(df.limit(0), 3) == []
    for year in (2013, 2015):
        p = df.withColumn("p", walk.part(year))
        train, test = p.filter("p = 'train'"), p.filter("p = 'test'")
        assert train.agg(F.max("until")).first()[0] < datetime.date(year, 1, 1) <= test.agg(F.min("date")).first()[0]
        assert p.filter(F.col("p").isNull() & (F.year("date") < year)).count() > 0  # labels that look into the year
    scored = walk.walk_forward(df, ["x", "z"], MODELS, 3)
    assert scored.columns[:2] == ["model", "split"]
    assert scored.filter(F.year("date") != F.col("split")).count() == 0
    assert scored.count() == df.filter("date >= '2013-01-01'").count()
    c = walk.confusion(scored, ["model"]).first()
    assert c.n == c.tp + c.tn + c.fp + c.fn and c.mcc > 0.6


def test_noise_and_labels_of_the_future_give_no_skill(spark):
    c = walk.confusion(walk.walk_forward(panel(spark, lambda x, e: e > 0.5), ["x", "z"], MODELS, 4), ["model"]).first()
    assert abs(c.mcc) < 0.1


def test_years_of_one_class_and_no_rows_give_none(spark):
    df = panel(spark, lambda x, e: False, n=1)
    assert walk.walk_forward(df, ["x"], MODELS, 3).count() == 0
    assert walk.walk_forward(df.limit(0), ["x"], MODELS, 3).count() == 0


def test_picks_by_group_pay_for_new_entries_only(spark):
    day = lambda k: datetime.date(2024, 1, 5) + datetime.timedelta(7 * k)
    rows = [("m", s, day(k), 2.0, 3, score, nx) for k, table in enumerate(([("a", 0.9, 0.1), ("b", 0.8, 0.3), ("c", 0.1, -0.2)], [("a", 0.9, 0.1), ("b", 0.2, 0.0), ("c", 0.7, 0.4)], [("a", 0.1, 0.1), ("b", 0.1, 0.1), ("c", None, 0.1)])) for s, score, nx in table]
    rows += [("n", *r[1:]) for r in rows if r[2] == day(0)] + [("m", "d", day(0), 1.0, 1, 0.99, None)]
    df = spark.createDataFrame(rows, "model string, symbol string, date date, close double, volume long, score double, nx double")
    got = {(r.model, r.date): (r.gross, r.net, r.n) for r in walk.picks(df, 2, 0.5, 0.01, ["model"]).collect()}
    assert got == {
        ("m", day(0)): (pytest.approx(0.2), pytest.approx(0.19), 2),
        ("m", day(1)): (pytest.approx(0.25), pytest.approx(0.245), 2),
        ("m", day(2)): (0.0, 0.0, 0),
        ("n", day(0)): (pytest.approx(0.2), pytest.approx(0.19), 2),
    }
