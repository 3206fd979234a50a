"""Queries of model steps over the vectors of `embeddings`: scaling, components, classifiers, regressions, comparison.

Models are Spark's own and are fitted on training rows (by hash of the id) and applied to the others; they have no SQL.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftline.functions.expr import r, ratio
from driftline.operators import portfolio as P
from driftline.operators import walk
from driftline.operators import windows as W
from driftline.plans.catalog import QUERIES, query
from driftline.plans.composites import RANKED_FACTORS
from driftline.sources.store import scan, written

#: Trees of the forest and rounds of boosting.
TREES, ROUNDS = 500, 10


def samples(spark, sf) -> DataFrame:
    """(vec_id, part, y, raw): raw is the whole embedding as a vector; y is 1 for odd labels; part is test for three rows
    in sixteen by the id's MD5. Rows without id or label, and embeddings that are null or hold a null, are left out."""
    e = scan(spark, sf, "embeddings").filter("vec_id is not null and label is not null and forall(embedding, x -> x is not null)")
    part = F.when(F.left(F.md5(F.col("vec_id").cast("string")), F.lit(1)).isin("0", "1", "2"), "test").otherwise("train")
    return e.select("vec_id", part.alias("part"), (F.col("label") % 2).cast("double").alias("y"), array_to_vector(F.col("embedding").cast("array<double>")).alias("raw"))


def train_test(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Training rows with class weights that balance the two classes, and test rows."""
    s = samples(spark, sf)
    train = s.filter("part = 'train'")
    n = train.groupBy("y").agg(F.count("*").alias("n"))
    whole = Window.partitionBy()  # two rows
    w = n.select("y", (F.sum("n").over(whole) / (F.count("*").over(whole) * F.col("n"))).alias("w"))
    return train.join(F.broadcast(w), "y"), s.filter("part = 'test'")  # w: two rows


SAMPLES = "SELECT vec_id, CASE WHEN left(md5(CAST(vec_id AS VARCHAR)), 1) IN ('0', '1', '2') THEN 'test' ELSE 'train' END AS part, unnest(range(1, len(embedding) + 1)) AS feature, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL"


def scaler() -> StandardScaler:
    return StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True)


@query("standard_scale", f"WITH s AS ({SAMPLES}), f AS (SELECT feature, avg(x) AS m, stddev_samp(x) AS sd FROM s WHERE part = 'train' GROUP BY 1) SELECT vec_id, part, CAST(feature AS INTEGER) AS feature, round(coalesce((x - m) / nullif(sd, 0), 0), 5) AS value FROM s JOIN f USING (feature)")
def standard_scale(spark, sf):
    """(vec_id, part, feature, value): mean and sample deviation of the training rows, applied to all rows and features.
    The fit is one pass of two vectors a task; a feature that does not vary becomes zero."""
    s = samples(spark, sf)
    done = scaler().fit(s.filter("part = 'train'")).transform(s)
    x = done.select("vec_id", "part", F.posexplode(vector_to_array("features")).alias("k", "value"))
    return x.select("vec_id", "part", (F.col("k") + 1).alias("feature"), r("value", 5).alias("value"))


@query("pca_variance")
def pca_variance(spark, sf):
    """(component, share, cumulative): variance that the components of the scaled training features explain, all of them."""
    train, _ = train_test(spark, sf)
    scaled = scaler().fit(train).transform(train)
    width = scaled.select(F.size(vector_to_array("features"))).first()[0]
    shares = PCA(k=width, inputCol="features", outputCol="pc").fit(scaled).explainedVariance.toArray().tolist()
    rows = [(k + 1, float(x), float(sum(shares[: k + 1]))) for k, x in enumerate(shares)]  # one a feature
    return spark.createDataFrame(rows, "component int, share double, cumulative double").select("component", r("share", 5).alias("share"), r("cumulative", 5).alias("cumulative"))


def classifiers() -> dict:
    kw = {"labelCol": "y", "featuresCol": "features", "weightCol": "w"}
    return {
        "logistic_balanced": LogisticRegression(**kw),
        "random_forest": RandomForestClassifier(**kw, numTrees=TREES, maxDepth=10, seed=42),
        "boosted_trees": GBTClassifier(**kw, maxIter=ROUNDS, maxDepth=4, seed=42),
    }


def scores(train: DataFrame, test: DataFrame, name: str) -> DataFrame:
    """(vec_id, y, score) of test rows: the probability of class 1."""
    model = Pipeline(stages=[scaler(), classifiers()[name]]).fit(train)
    return model.transform(test).select("vec_id", "y", vector_to_array("probability")[1].alias("score"))


for _name in ("logistic_balanced", "random_forest", "boosted_trees"):

    @query(_name)
    def classify(spark, sf, name=_name):
        train, test = train_test(spark, sf)
        return scores(train, test, name).select("vec_id", "y", r("score", 5).alias("score"))


@query("linear_family")
def linear_family(spark, sf):
    """(model, rmse, r2) on test rows of least squares, lasso and ridge, which predict the last feature from all others."""
    x = vector_to_array("raw")
    s = samples(spark, sf).select("part", F.element_at(x, -1).alias("label"), array_to_vector(F.slice(x, F.lit(1), F.size(x) - 1)).alias("features"))
    train, test = s.filter("part = 'train'"), s.filter("part = 'test'")
    mean = train.agg(F.avg("label").alias("mean"))
    out = None
    for name, reg, mix in (("least_squares", 0.0, 0.0), ("lasso", 0.01, 1.0), ("ridge", 1.0, 0.0)):
        p = LinearRegression(labelCol="label", featuresCol="features", regParam=reg, elasticNetParam=mix).fit(train).transform(test)
        off, base = F.col("label") - F.col("prediction"), F.col("label") - F.col("mean")
        k = p.join(F.broadcast(mean)).agg(r(F.sqrt(F.avg(off * off)), 5).alias("rmse"), r(1 - ratio(F.sum(off * off), F.sum(base * base)), 5).alias("r2")).select(F.lit(name).alias("model"), "rmse", "r2")  # mean: one row
        out = k if out is None else out.unionByName(k)
    return out


#: Years of data before the first test year, and weeks that a label looks ahead.
FIRST, AHEAD = 3, 4


def labelled(spark, sf) -> DataFrame:
    """The ranked weekly factors with label (1 for the five best returns over the next four weeks, of two percent or more),
    the date that it is made of (until) and the next week's return (nx); rows whose four weeks are not over have no label."""
    f = QUERIES["weekly_momentum_gold"](spark, sf)
    f = f.select("*", W.forward_return("close", AHEAD).alias("__y"), F.lead("date", AHEAD).over(W.by_time()).alias("until"), W.forward_return("close").alias("nx"))
    best = (F.col("__y") >= 0.02) & (W.rank_first("__y") <= 5)
    return f.withColumn("label", F.when(F.col("__y").isNotNull(), best.cast("int"))).drop("__y")


@query("model_compare")
def model_compare(spark, sf):
    """(model, n, tp, tn, fp, fn, mcc, and key figures of the portfolio of its five best scores a week): classifiers trained
    year by year on earlier years' factors and labels, judged on the years that they have not seen."""
    kw = {"labelCol": "y", "featuresCol": "features", "weightCol": "w"}
    models = {"logistic": lambda: LogisticRegression(**kw), "forest": lambda: RandomForestClassifier(**kw, numTrees=40, maxDepth=5, seed=42)}
    scored = written(walk.walk_forward(labelled(spark, sf), list(RANKED_FACTORS), models, FIRST))
    k = P.kpis_by(walk.picks(scored, 5, 0.5, 0.002, ["model"]), ["model"], per_year=52.0)
    both = walk.confusion(scored, ["model"]).join(k, "model")
    return both.select("model", "n", "tp", "tn", "fp", "fn", *[r(c, 5).alias(c) for c in ("mcc", "total_return", "cagr", "volatility", "sharpe", "calmar", "max_drawdown")])
