"""Ordered and cross-sectional window operators over panels keyed by (symbol, date).

Every function returns a Column, so that a caller puts all of one ordering into one select and pays one shuffle and sort.
"""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from driftline.functions.expr import log1p_safe, ratio

KEY, TIME = "symbol", "date"


def by_time(key: str = KEY, time: str = TIME):
    return Window.partitionBy(key).orderBy(time)


def rows(n: int, upto: int = 0, key: str = KEY, time: str = TIME):
    """The n rows that end `upto` rows from the current one."""
    return by_time(key, time).rowsBetween(upto - n + 1, upto)


def upto_now(key: str = KEY, time: str = TIME):
    return by_time(key, time).rowsBetween(Window.unboundedPreceding, 0)


def pct_change(x: str, n: int = 1, **kw) -> Column:
    return ratio(F.col(x), F.lag(x, n).over(by_time(**kw))) - 1


def forward_return(x: str, n: int = 1, **kw) -> Column:
    return ratio(F.lead(x, n).over(by_time(**kw)), F.col(x)) - 1


def sma(x: str, n: int, least: int | None = None, **kw) -> Column:
    """Mean of the last n rows; null until `least` of them have a value (default n)."""
    w = rows(n, **kw)
    return F.when(F.count(x).over(w) >= (n if least is None else least), F.avg(x).over(w))


def rolling(agg, x: str, n: int, upto: int = 0, least: int = 1, **kw) -> Column:
    w = rows(n, upto, **kw)
    return F.when(F.count(x).over(w) >= least, agg(x).over(w))


def compound(x: str, n: int, upto: int = 0, **kw) -> Column:
    """Compounded return of the rows: exp of the sum of logs, less one."""
    return F.exp(F.sum(log1p_safe(x)).over(rows(n, upto, **kw))) - 1


def forward_fill(x: str, **kw) -> Column:
    return F.last(x, ignorenulls=True).over(upto_now(**kw))


def back_fill(x: str, key: str = KEY, time: str = TIME) -> Column:
    return F.first(x, ignorenulls=True).over(by_time(key, time).rowsBetween(0, Window.unboundedFollowing))


def equity(x: str, **kw) -> Column:
    """Running product of 1 + x, for x > -1; null returns count as zero."""
    return F.exp(F.sum(F.coalesce(log1p_safe(x), F.lit(0.0))).over(upto_now(**kw)))


def drawdown(x: str, **kw) -> Column:
    top = F.max(x).over(upto_now(**kw))
    return ratio(F.col(x) - top, top)


def weight_change(w: str, **kw) -> Column:
    return F.col(w) - F.coalesce(F.lag(w).over(by_time(**kw)), F.lit(0.0))


def true_range(high: str = "high", low: str = "low", close: str = "close", **kw) -> Column:
    before = F.lag(close).over(by_time(**kw))
    return F.greatest(F.col(high) - F.col(low), F.abs(F.col(high) - before), F.abs(F.col(low) - before))


def rank_scaled(x: str, group: str = TIME) -> Column:
    """Rank within the group scaled to [-1, 1]; null values and groups of one value give 0."""
    rank = F.rank().over(Window.partitionBy(group).orderBy(F.col(x).asc_nulls_last()))
    n = F.count(x).over(Window.partitionBy(group))
    return F.when(F.col(x).isNull() | (n <= 1), 0.0).otherwise(2.0 * (rank - 1) / (n - 1) - 1)


def rank_first(x: str, descending: bool = True, group: str = TIME, tie: str = KEY) -> Column:
    order = F.col(x).desc_nulls_last() if descending else F.col(x).asc_nulls_last()
    return F.row_number().over(Window.partitionBy(group).orderBy(order, tie))


def rank_average(x: str, descending: bool = False, group: str = TIME) -> Column:
    order = F.col(x).desc_nulls_last() if descending else F.col(x).asc_nulls_last()
    ties = F.count("*").over(Window.partitionBy(group, x))
    return F.rank().over(Window.partitionBy(group).orderBy(order)) + (ties - 1) / 2


def last_of_period(period: str, key: str | None = None, time: str = TIME) -> Column:
    """Whether the row's time is the latest of its period, over all keys or for each key."""
    group = [period] if key is None else [key, period]
    return F.col(time) == F.max(time).over(Window.partitionBy(*group))
