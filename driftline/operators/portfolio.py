"""Weights, returns and key figures of portfolios held as long tables (symbol, date, weight)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.functions.expr import ratio
from driftline.operators import windows as W


def rebalance_periods(df: DataFrame, freq: str, time: str = "date") -> Column:
    """The period of a date: W, M, Q, 6M or Y."""
    d = F.col(time)
    return {"W": F.to_date(F.date_trunc("week", d)), "M": F.trunc(d, "month"), "Q": F.trunc(d, "quarter"), "Y": F.trunc(d, "year"), "6M": F.make_date(F.year(d), F.when(F.month(d) <= 6, 1).otherwise(7), F.lit(1))}[freq]


def topn_weights(panel: DataFrame, score: str, n: int, freq: str = "M", eligible: Column | None = None, descending: bool = True) -> DataFrame:
    """(symbol, date, close, weight): on each period's last date the n best eligible scores weigh 1/n; weights are held
    until the next such date. panel: symbol, date, close and the score."""
    ok = F.col(score).isNotNull() if eligible is None else F.col(score).isNotNull() & F.coalesce(eligible, F.lit(False))
    p = panel.select("*", rebalance_periods(panel, freq).alias("__p")).select("*", W.last_of_period("__p").alias("__reb"), F.when(ok, F.col(score)).alias("__s"))
    p = p.withColumn("__rank", W.rank_first("__s", descending))
    p = p.withColumn("__w", F.when(F.col("__reb"), F.when(F.col("__s").isNotNull() & (F.col("__rank") <= n), 1.0 / n).otherwise(0.0)))
    return p.select("symbol", "date", "close", F.coalesce(W.forward_fill("__w"), F.lit(0.0)).alias("weight"))


def backtest(weights: DataFrame, cost: float = 0.001) -> DataFrame:
    """(date, gross, cost, trades, net): weight times next return, less turnover cost. weights: symbol, date, close, weight."""
    p = weights.select("symbol", "date", "weight", W.forward_return("close").alias("next"), W.weight_change("weight").alias("dw"))
    d = p.groupBy("date").agg(F.sum(F.col("weight") * F.coalesce("next", F.lit(0.0))).alias("gross"), (F.sum(F.abs("dw")) * cost).alias("cost"), F.count_if(F.abs("dw") > 0.001).alias("trades"))
    return d.withColumn("net", F.col("gross") - F.col("cost"))


def equity_table(returns: DataFrame, col: str = "net") -> DataFrame:
    """returns with equity and drawdown. One row a date: the one series is the whole of it."""
    e = returns.withColumn("__one", F.lit(1)).withColumn("equity", W.equity(col, key="__one"))
    return e.withColumn("drawdown", W.drawdown("equity", key="__one")).drop("__one")


def kpis(equity: DataFrame, col: str = "net", per_year: float = 252.0) -> DataFrame:
    """total_return, cagr (calendar years, one at least), volatility, sharpe, calmar, max_drawdown."""
    a = equity.agg(F.max_by("equity", "date").alias("last"), F.min("drawdown").alias("max_drawdown"), F.stddev_samp(col).alias("sd"), F.avg(col).alias("mean"), F.greatest(F.datediff(F.max("date"), F.min("date")) / 365.25, F.lit(1.0)).alias("years"))
    a = a.select("*", (F.pow("last", 1 / F.col("years")) - 1).alias("cagr"))
    return a.select((F.col("last") - 1).alias("total_return"), "cagr", (F.col("sd") * per_year**0.5).alias("volatility"), (ratio("mean", "sd") * per_year**0.5).alias("sharpe"), ratio("cagr", F.abs("max_drawdown")).alias("calmar"), "max_drawdown")


def kpis_by(returns: DataFrame, group: list[str], col: str = "net", per_year: float = 252.0) -> DataFrame:
    """kpis() of each group's returns, a row a date: equity and drawdown by group, then one aggregation."""
    e = returns.select(*group, "date", col, W.equity(col, key=group).alias("equity"))
    e = e.withColumn("drawdown", W.drawdown("equity", key=group))
    a = e.groupBy(*group).agg(F.max_by("equity", "date").alias("last"), F.min("drawdown").alias("max_drawdown"), F.stddev_samp(col).alias("sd"), F.avg(col).alias("mean"), F.greatest(F.datediff(F.max("date"), F.min("date")) / 365.25, F.lit(1.0)).alias("years"))
    a = a.withColumn("cagr", F.pow("last", 1 / F.col("years")) - 1)
    return a.select(*group, (F.col("last") - 1).alias("total_return"), "cagr", (F.col("sd") * per_year**0.5).alias("volatility"), (ratio("mean", "sd") * per_year**0.5).alias("sharpe"), ratio("cagr", F.abs("max_drawdown")).alias("calmar"), "max_drawdown")


def exposure_cap(weights: DataFrame, most: float = 2.0) -> DataFrame:
    """Weights of a date scaled down where their absolute sum is above `most`."""
    total = F.sum(F.abs("weight")).over(Window.partitionBy("date"))
    return weights.withColumn("weight", F.when(total > most, F.col("weight") * most / total).otherwise(F.col("weight")))
