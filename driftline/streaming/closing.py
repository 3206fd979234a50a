"""Bars that a stream puts out once, when they are over: Spark's own aggregation by day behind a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.sources.store import new_path
from driftline.streaming.bars import run_into, table_at

OUT = "symbol string, date date, open double, high double, low double, close double, n long, month string"


def closed_bars(prices: DataFrame, lateness: str, path: str | None = None) -> DataFrame:
    """(symbol, date, open, high, low, close, n) of the days that are over: each is put out once, when the latest price is
    `lateness` past its end, and inserted into a table by month. prices: symbol, time, price (double), order (a long, total
    within a day). A price counts as long as its day is not over, however late it is; a row without a price counts in n
    alone. Days that are not over stay in the state, for when the stream goes on. Where the stream is started again on the
    same path it goes on.

    Days are those of the session's clock. The whole job is one aggregation that adds up by day before its shuffle. State holds no more days than the lateness spans and one batch brings.
    """
    spark = prices.sparkSession
    table = table_at(spark, path or new_path(spark), OUT, ["symbol", "date"], ["month"])
    wall = F.from_utc_timestamp("time", spark.conf.get("spark.sql.session.timeZone"))  # windows are cut at UTC's midnights
    timed = prices.withColumn("time", wall).withWatermark("time", lateness)
    at = F.when(F.col("price").isNotNull(), F.col("order"))
    agg = timed.groupBy("symbol", F.window("time", "1 day").alias("day")).agg(F.min_by("price", at).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", at).alias("close"), F.count("*").alias("n"))
    date = F.date_from_unix_date(F.floor(F.unix_seconds("day.start") / 86_400).cast("int"))
    bars = agg.select("symbol", date.alias("date"), "open", "high", "low", "close", "n", F.date_format(date, "yyyy-MM").alias("month"))
    return run_into(bars, "append", table, "closed", update=False).read().drop("month")
