"""Factors of periods from daily rows: one aggregation a period, then rolling features that share the shuffle by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.functions.expr import ratio
from driftline.operators import windows as W


def daily_excess(prices: DataFrame, market: DataFrame, rate: Column) -> DataFrame:
    """(symbol, date, close, volume, ret, own, index): daily returns, and the excess of each and of the market's return over
    the rate. market: (date, ret), a row a date; days without one count as no return. First days, without a return, go."""
    d = prices.select("symbol", "date", "close", "volume", W.pct_change("close").alias("ret")).filter("ret is not null")
    met = d.join(market.select("date", F.col("ret").alias("__m")), "date", "left")
    return met.select("symbol", "date", "close", "volume", "ret", (F.col("ret") - rate).alias("own"), (F.coalesce("__m", F.lit(0.0)) - rate).alias("index"))


def period_factors(daily: DataFrame, bin_: Column) -> DataFrame:
    """(symbol, date, close, volume, retvol, maxret, ill, mom1, beta) for each symbol and period: the last day's price and
    volume, deviation and maximum of returns, Amihud's illiquidity, the compounded return, and beta of the excess returns.
    One aggregation, without a window and without a join back; beta is null where the index did not vary."""
    last = lambda c: F.max_by(c, "date").alias(c)
    beta = ratio(F.covar_samp("own", "index"), F.var_samp("index"))
    g = daily.groupBy("symbol", bin_.alias("__bin")).agg(last("close"), last("volume"), F.stddev_samp("ret").alias("retvol"), F.max("ret").alias("maxret"), F.avg(ratio(F.abs("ret"), F.col("close") * F.col("volume"))).alias("ill"), (F.exp(F.sum(F.log1p("ret"))) - 1).alias("mom1"), beta.alias("beta"))
    return g.withColumnRenamed("__bin", "date")


def momenta(spans: dict[str, int], base: str = "mom1") -> list[Column]:
    """Compounded returns of the last n periods, the current one included; fewer at a key's start."""
    return [W.compound(base, n).alias(name) for name, n in spans.items()]
