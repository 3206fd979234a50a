"""Column expressions: date bins, guarded arithmetic, normal distribution."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def r(x: Column | str, digits: int = 6) -> Column:
    """Rounded, without negative zero, so that sums in another order give the same value."""
    return F.round(x, digits) + F.lit(0.0)


def week_ending(day: Column | str, last: str = "FRI") -> Column:
    """The last day of the week that holds the day; a last day maps to itself."""
    return F.next_day(F.date_sub(day, 1), last)


def business_month_end(day: Column | str) -> Column:
    """The last weekday of the month; days after it belong to the next month's."""
    back = lambda d: F.date_sub(d, F.greatest(F.weekday(d) - 4, F.lit(0)))
    day = F.col(day) if isinstance(day, str) else day
    this = back(F.last_day(day))
    return F.when(day <= this, this).otherwise(back(F.last_day(F.add_months(day, 1))))


def ratio(top: Column | str, bottom: Column | str) -> Column:
    """top / bottom, null where bottom is zero."""
    return F.try_divide(top, bottom)


def log1p_safe(x: Column | str) -> Column:
    """log(1 + x), null unless x > -1."""
    x = F.col(x) if isinstance(x, str) else x
    return F.when(x > -1, F.log1p(x))


def normal_cdf(x: Column) -> Column:
    """Standard normal distribution by the five-term polynomial of Abramowitz and Stegun 26.2.17."""
    t = 1 / (1 + F.abs(x) * 0.2316419)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-x * x / 2) / 2.5066282746310002 * poly
    return F.when(x >= 0, 1 - tail).otherwise(tail)


def call_price(price: Column, strike: Column, years: float, volatility: Column, rate: float) -> Column:
    """Black and Scholes' price of a European call; null where the volatility is null."""
    spread = volatility * years**0.5
    d1 = (F.log(price / strike) + (rate + volatility * volatility / 2) * years) / spread
    return price * normal_cdf(d1) - strike * math.exp(-rate * years) * normal_cdf(d1 - spread)


def clip(x: Column, low: float | None = None, high: float | None = None) -> Column:
    x = F.greatest(x, F.lit(low)) if low is not None else x
    return F.least(x, F.lit(high)) if high is not None else x
