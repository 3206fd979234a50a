"""Walk-forward training: a model for each test year, fitted on earlier years only, and scores of unseen years."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.functions.expr import ratio
from driftline.sources.store import written


def years_of(panel: DataFrame, first: int, time: str = "date") -> list[int]:
    """Test years: those with at least `first` years of data before them. The driver gets two years."""
    low, high = panel.agg(F.min(F.year(time)), F.max(F.year(time))).first()
    return [] if low is None else list(range(low + first, high + 1))


def part(year: int, until: str = "until", time: str = "date") -> Column:
    """train, test or null by test year: a row trains if what its label is made of (up to the date `until`) ended before
    the year begins, so that labels near the edge, which look into the year, train nothing."""
    begin = F.make_date(F.lit(year), F.lit(1), F.lit(1))
    return F.when(F.year(time) == year, "test").when(F.col(until) < begin, "train")


def walk_forward(panel: DataFrame, features: list[str], models: dict[str, Callable[[], object]], first: int, label: str = "label", until: str = "until", time: str = "date") -> DataFrame:
    """(model, split, score and the panel's columns) for the rows of each test year, scored by models that were fitted on
    rows whose label was known before the year.

    models: name to a function that makes an unfitted classifier (columns y, features, w). Rows count by class weights that
    balance the classes of the training part. A year whose training part has one class gives no rows. The panel is written
    once and read for each year; the driver holds a model at a time. Rows without label, `until` or a feature are left out.
    """
    keep = panel.dropna(subset=[label, until, *features]).withColumn("y", F.col(label).cast("double"))
    rows = written(keep)
    fixed = [VectorAssembler(inputCols=features, outputCol="raw"), StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True)]
    out = None
    for year in years_of(rows, first, time):
        of = rows.withColumn("__part", part(year, until, time))
        train = of.filter("__part = 'train'")
        counts = {r.y: r["count"] for r in train.groupBy("y").count().collect()}  # a row a class
        if len(counts) < 2:
            continue
        share = F.create_map(*[F.lit(x) for y, n in counts.items() for x in (y, sum(counts.values()) / (len(counts) * n))])
        train = train.withColumn("w", share[F.col("y")])
        for name, make in models.items():
            model = Pipeline(stages=[*fixed, make()]).fit(train)
            scored = model.transform(of.filter("__part = 'test'"))
            scored = scored.select(F.lit(name).alias("model"), F.lit(year).alias("split"), *panel.columns, vector_to_array("probability")[1].alias("score"))
            out = scored if out is None else out.unionByName(scored)
    return rows.select(F.lit("").alias("model"), F.lit(0).alias("split"), *panel.columns, F.lit(0.0).alias("score")).limit(0) if out is None else out


def confusion(scored: DataFrame, group: list[str], at: float = 0.5, label: str = "label") -> DataFrame:
    """(group, n, tp, tn, fp, fn, mcc) of scores cut at `at`; zero where mcc is undefined."""
    said = F.col("score") >= at
    hit = lambda a, b: F.count_if((said == F.lit(a)) & (F.col(label) == F.lit(int(b))))
    c = scored.groupBy(*group).agg(F.count("*").alias("n"), hit(True, True).alias("tp"), hit(False, False).alias("tn"), hit(True, False).alias("fp"), hit(False, True).alias("fn"))
    den = F.expr("cast(tp + fp as double) * (tp + fn) * (tn + fp) * (tn + fn)")
    return c.withColumn("mcc", F.coalesce(ratio(F.expr("tp * tn - fp * fn"), F.sqrt(den)), F.lit(0.0)))


def picks(scored: DataFrame, n: int, least: float, cost: float, group: list[str] | None = None) -> DataFrame:
    """(group, date, gross, net, bench, n): by group and date, the mean next return (nx) of the n best scores of at least
    `least`, costs on those that were not picked on the date before, and the return of all rows by dollars traded. Dates
    without a pick are in cash. scored: group, symbol, date, close, volume, score, nx; rows without nx are left out."""
    group = group or []
    s = scored.filter("nx is not null")
    dates = s.select(*group, "date").distinct()
    dates = dates.select(*group, "date", F.row_number().over(Window.partitionBy(*group).orderBy("date")).alias("p"))  # a row a date
    best = Window.partitionBy(*group, "date").orderBy(F.desc_nulls_last("score"), "symbol")
    s = s.join(dates, [*group, "date"]).withColumn("pick", (F.row_number().over(best) <= n) & F.coalesce(F.col("score") >= least, F.lit(False)))
    own = Window.partitionBy(*group, "symbol").orderBy("date")
    s = s.withColumn("fresh", ~F.coalesce((F.lag("p").over(own) == F.col("p") - 1) & F.lag("pick").over(own), F.lit(False)))
    chosen = lambda c: F.avg(F.when(F.col("pick"), c))
    dollars, zero = F.col("close") * F.col("volume"), F.lit(0.0)
    g = s.groupBy(*group, "date").agg(chosen(F.col("nx")).alias("gross"), chosen(F.col("fresh").cast("double")).alias("turn"), ratio(F.sum(dollars * F.col("nx")), F.sum(dollars)).alias("bench"), F.count_if("pick").alias("n"))
    return g.select(*group, "date", F.coalesce("gross", zero).alias("gross"), F.coalesce(F.col("gross") - F.col("turn") * cost, zero).alias("net"), "bench", "n")
