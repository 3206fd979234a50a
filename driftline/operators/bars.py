"""Bars: aggregation of ordered prices to periods, and calendars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bars(df: DataFrame, bin_: Column, key: str = "symbol", time: str = "date") -> DataFrame:
    """Open, high, low, close and volume by (key, bin): one aggregation, no window, no join back."""
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col(time)))
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col(time)))
    return df.groupBy(key, bin_.alias("__bin")).agg(first("open").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), last("close").alias("close"), F.sum("volume").alias("volume"), F.max(time).alias("last_date")).withColumnRenamed("__bin", time)


def daily_bars(ticks: DataFrame, key: Column, time: Column, price: Column, order: Column) -> DataFrame:
    """Bars by day from single prices; order is a total order within a day."""
    t = ticks.select(key.alias("symbol"), F.to_date(time).alias("date"), price.alias("p"), order.alias("o"))
    return t.groupBy("symbol", "date").agg(F.min_by("p", "o").alias("open"), F.max("p").alias("high"), F.min("p").alias("low"), F.max_by("p", "o").alias("close"), F.count("*").alias("volume"))


def calendar_grid(df: DataFrame, first: str, last: str, step: str = "1 day", keep: Column | None = None, key: str = "symbol", time: str = "date") -> DataFrame:
    """Every key on every day of the calendar, with the data where there is some. The calendar is a literal range: its
    size is the caller's, not the data's; each key makes its own days, without a join of keys and days."""
    days = F.explode(F.expr(f"sequence(date'{first}', date'{last}', interval {step})"))
    grid = df.select(key).distinct().select(key, days.alias(time))
    return (grid.filter(keep) if keep is not None else grid).join(df, [key, time], "left")
