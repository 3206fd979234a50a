"""Queries of streaming jobs over events."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftline.plans.catalog import query
from driftline.streaming import bars as S
from driftline.streaming import closing


@query("stream_ohlcv", "SELECT CAST(user_id AS VARCHAR) AS symbol, CAST(ts AS DATE) AS date, arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low, arg_max(value, (ts, event_id)) AS close, count(*) AS n FROM events GROUP BY 1, 2")
def stream_ohlcv(spark, sf):
    e = S.read_stream(spark, sf, "events")
    return S.stream_bars(e.select(F.col("user_id").cast("string").alias("symbol"), F.to_date("ts").alias("date"), F.col("value").alias("price"), F.struct("ts", "event_id").alias("order")))


@query("stream_dedup_upsert", "SELECT DISTINCT CAST(user_id AS VARCHAR) AS symbol, ts AS time FROM events")
def stream_dedup_upsert(spark, sf):
    e = S.read_stream(spark, sf, "events").select(F.col("user_id").cast("string").alias("symbol"), F.col("ts").alias("time"))
    return S.stream_distinct(e, ["symbol", "time"], "time")


@query("stream_closed_bars", "SELECT CAST(user_id AS VARCHAR) AS symbol, CAST(ts AS DATE) AS date, arg_min(value, event_id) AS open, max(value) AS high, min(value) AS low, arg_max(value, event_id) AS close, count(*) AS n FROM events GROUP BY 1, 2 HAVING CAST(CAST(ts AS DATE) + 1 AS TIMESTAMP) <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY")
def stream_closed_bars(spark, sf):
    """The days that are over by the latest event less a day's lateness, each put out once by its timer."""
    e = S.read_stream(spark, sf, "events")
    return closing.closed_bars(e.select(F.col("user_id").cast("string").alias("symbol"), F.col("ts").cast("timestamp").alias("time"), F.col("value").cast("double").alias("price"), F.col("event_id").cast("long").alias("order")), "1 day")
