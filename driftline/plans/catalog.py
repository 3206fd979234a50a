"""The registered queries by operator key, each with the DuckDB SQL that it is held against.

`query(key, sql)` registers a function of (spark, sf_dir). SQL texts name shared tables of BASE (bars, weekly, ...), which
sql() puts in front of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.functions.expr import week_ending
from driftline.operators import bars as B
from driftline.sources.store import scan

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

#: Shared tables, each as SQL; later ones use earlier ones.
BASE = {
    "bars": "SELECT CAST(c_nationkey AS VARCHAR) AS symbol, CAST(o_orderdate AS DATE) AS date, arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high, min(o_totalprice) AS low, arg_max(o_totalprice, o_orderkey) AS close, count(*) AS volume FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2",
    "weekly": "SELECT symbol, date + CAST((12 - isodow(date)) % 7 AS INTEGER) AS date, arg_min(open, date) AS open, max(high) AS high, min(low) AS low, arg_max(close, date) AS close, CAST(sum(volume) AS BIGINT) AS volume, max(date) AS last_date FROM bars GROUP BY 1, 2",
    "rets": "SELECT *, close / lag(close) OVER (PARTITION BY symbol ORDER BY date) - 1 AS ret FROM bars",
    "market": "SELECT date, avg(close) AS level FROM bars GROUP BY 1",
    "fund": "SELECT CAST(s_nationkey AS VARCHAR) AS symbol, CAST(date_trunc('quarter', l_shipdate) AS DATE) AS date, round(sum(l_extendedprice), 2) AS revenue, round(sum(l_quantity), 2) AS units, round(sum(l_extendedprice * l_discount), 2) AS cost FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2",
    "changes": "SELECT CAST(user_id AS VARCHAR) AS symbol, CAST(ts AS DATE) AS date, CASE event_type WHEN 'signup' THEN 'ADD' ELSE 'REMOVE' END AS event FROM events WHERE event_type IN ('signup', 'error')",
}
NEEDS = {"weekly": ["bars"], "rets": ["bars"], "market": ["bars"]}


def sql(select: str, *tables: str) -> str:
    """select with the named shared tables, and those they need, as common table expressions."""
    names: list[str] = []
    for t in tables:
        names += [x for x in [*NEEDS.get(t, []), t] if x not in names]
    lead = ", ".join(f"{n} AS ({BASE[n]})" for n in names)
    own = select.strip()
    if not lead:
        return own
    return f"WITH {lead}, {own[5:]}" if own.upper().startswith("WITH ") else f"WITH {lead} {own}"


def query(key: str, oracle: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[key] = f
        if oracle:
            ORACLE_SQL[key] = oracle
        return f

    return add


def bars(spark: SparkSession, sf: str, only: Column | None = None) -> DataFrame:
    """Daily bars of all orders, or of those that `only` holds for."""
    orders = scan(spark, sf, "orders")
    t = (orders if only is None else orders.filter(only)).join(scan(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return B.daily_bars(t, F.col("c_nationkey").cast("string"), F.col("o_orderdate"), F.col("o_totalprice"), F.col("o_orderkey"))


def weekly(spark: SparkSession, sf: str) -> DataFrame:
    return B.bars(bars(spark, sf), week_ending("date"))


def market(spark: SparkSession, sf: str) -> DataFrame:
    return bars(spark, sf).groupBy("date").agg(F.avg("close").alias("level"))


def fundamentals(spark: SparkSession, sf: str) -> DataFrame:
    t = scan(spark, sf, "lineitem").join(scan(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    t = t.select(F.col("s_nationkey").cast("string").alias("symbol"), F.trunc("l_shipdate", "quarter").alias("date"), "l_extendedprice", "l_quantity", "l_discount")
    return t.groupBy("symbol", "date").agg(F.round(F.sum("l_extendedprice"), 2).alias("revenue"), F.round(F.sum("l_quantity"), 2).alias("units"), F.round(F.sum(F.col("l_extendedprice") * F.col("l_discount")), 2).alias("cost"))


def changes(spark: SparkSession, sf: str) -> DataFrame:
    e = scan(spark, sf, "events").filter(F.col("event_type").isin("signup", "error"))
    return e.select(F.col("user_id").cast("string").alias("symbol"), F.to_date("ts").alias("date"), F.when(F.col("event_type") == "signup", "ADD").otherwise("REMOVE").alias("event"))
