"""Exact quantiles of groups of any size: mergeable sketches tell where a quantile lies, the rows near it which it is."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftline.sources.store import written

#: Size of a sketch (some tens of KB a group at most) and the share of ranks, on either side of a quantile, whose rows are
#: looked at: several times the sketch's error at that size.
SIZE, MARGIN = 1000, 0.01


def quantiles(df: DataFrame, group: list[str], col: str, shares: list[float], size: int = SIZE, margin: float = MARGIN) -> DataFrame:
    """(group, quantiles): for each group the quantiles of col at each of shares, in their order, interpolated between the
    two nearest values as percentile() does. Nulls are left out, and so are groups that have nothing else.

    No value of a group but its sketch stands in an aggregation buffer. Each group's sketch bounds its quantiles; rows
    below and between the bounds are counted; the rows between, two hundredths of the group each, are ranked by a window,
    which spills. Bounds that turn out not to hold a quantile's ranks (a sketch may err) give way to the whole group.
    """
    rows = written(df.select(*group, F.col(col).cast("double").alias("x")).filter("x is not null"))
    sketch = rows.groupBy(*group).agg(F.count("*").alias("n"), F.kll_sketch_agg_double("x", F.lit(size)).alias("s"), F.min("x").alias("least"), F.max("x").alias("most"))
    at = lambda p: F.kll_sketch_get_quantile_double("s", F.lit(p))
    low = lambda p: at(p - margin) if p > margin else F.col("least")
    high = lambda p: at(p + margin) if p < 1 - margin else F.col("most")
    bands = F.array(*[F.struct(F.lit(k).alias("k"), (F.lit(p) * (F.col("n") - 1)).alias("h"), low(p).alias("lo"), high(p).alias("hi")) for k, p in enumerate(shares)])
    bands = sketch.select(*[F.col(g).alias(f"__{g}") for g in group], bands.alias("bands"))
    same = [F.col(g).eqNullSafe(F.col(f"__{g}")) for g in group]
    own = [f"__{g}" for g in group]
    near = rows.join(bands, same)
    count = lambda k, c: F.count_if(c(F.col("bands")[k]))
    counts = [x for k in range(len(shares)) for x in (count(k, lambda b: F.col("x") < b["lo"]).alias(f"below{k}"), count(k, lambda b: F.col("x") <= b["hi"]).alias(f"upto{k}"))]
    known = written(near.groupBy(*own).agg(*counts, F.first("bands").alias("bands")))
    final = []
    for k in range(len(shares)):
        b, below, upto = F.col("bands")[k], F.col(f"below{k}"), F.col(f"upto{k}")
        held = (F.floor(b["h"]) >= below) & (F.ceil(b["h"]) < upto)
        never = F.lit(float("inf"))
        final.append(F.struct(F.lit(k).alias("k"), b["h"].alias("h"), F.when(held, b["lo"]).otherwise(-never).alias("lo"), F.when(held, b["hi"]).otherwise(never).alias("hi"), F.when(held, below).otherwise(0).alias("below")))
    known = known.select(*own, F.array(*final).alias("bands"))
    inside = F.filter("bands", lambda b: (F.col("x") >= b["lo"]) & (F.col("x") <= b["hi"]))
    ranked = rows.join(known, same).select(*own, "x", F.explode(inside).alias("b")).select(*own, "x", "b.*")
    place = F.row_number().over(Window.partitionBy(*own, "k").orderBy("x")) - 1 + F.col("below")
    ranked = ranked.withColumn("place", place).filter((F.col("place") == F.floor("h")) | (F.col("place") == F.ceil("h")))
    pair = ranked.groupBy(*own, "k", "h").agg(F.min("x").alias("a"), F.max("x").alias("b"))
    value = F.col("a") + (F.col("b") - F.col("a")) * (F.col("h") - F.floor("h"))
    out = pair.groupBy(*own).agg(F.array_sort(F.collect_list(F.struct("k", value.alias("v")))).alias("q"))  # a value a share
    return out.select(*[F.col(f"__{g}").alias(g) for g in group], F.col("q.v").alias("quantiles"))


def buckets(df: DataFrame, group: list[str], col: str, shares: list[float], name: str = "bucket", **kw) -> DataFrame:
    """df with the bucket (from 1) of col among its group's quantiles: one more than the distinct quantiles below it; null
    where col is."""
    q = quantiles(df, group, col, shares, **kw).select(*[F.col(g).alias(f"__{g}") for g in group], F.array_distinct("quantiles").alias("__q"))
    met = df.join(q, [F.col(g).eqNullSafe(F.col(f"__{g}")) for g in group], "left")
    return met.select(*df.columns, F.when(F.col(col).isNotNull(), 1 + F.size(F.filter("__q", lambda e: F.col(col) > e))).alias(name))


def edges(df: DataFrame, group: list[str], col: str, low: float, high: float) -> DataFrame:
    """(group, lo, hi): two quantiles as columns."""
    return quantiles(df, group, col, [low, high]).select(*group, F.col("quantiles")[0].alias("lo"), F.col("quantiles")[1].alias("hi"))
