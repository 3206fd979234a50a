"""Bars and distinct rows of a stream of prices, as Structured Streaming jobs that merge into published tables.

Each micro-batch is one version of the table, with the batch's number in its manifest: a batch that runs again after a
crash changes nothing. State and tables lie in the shared folder of spark.checkpoint.dir; a job that is started again on
them goes on where it ended.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.sources.store import new_path
from driftline.sources.versions import Table

#: How late a price may come; the batch jobs read the same stretch again.
LATENESS = "60 days"


def read_stream(spark: SparkSession, sf_dir: str, name: str, files: int | None = None) -> DataFrame:
    """A table's files, and those that come later, as a stream; `files` at once (default: all that are there)."""
    path = f"{sf_dir}/{name}.parquet"
    stream = spark.readStream.schema(spark.read.parquet(path).schema)
    return (stream.option("maxFilesPerTrigger", files) if files else stream).parquet(f"{path}*")


def table_at(spark: SparkSession, path: str, schema: str, keys: list[str], partition_by: list[str] | None = None) -> Table:
    """The table at path, which is made, without rows, if there is none."""
    table = Table(spark, path)
    return table if table.versions() else Table.create(spark.createDataFrame([], schema), path, keys, partition_by)


def run_into(stream: DataFrame, mode: str, table: Table, name: str, update: bool = True) -> Table:
    """Run the stream to the end of its input, each batch merged into the table once."""

    def merge(rows: DataFrame, number: int) -> None:
        table.merge(rows, update=update, batch=(name, number))

    job = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{table.path}/state-{name}").trigger(availableNow=True).foreachBatch(merge).start()
    job.awaitTermination()
    return table


def stream_bars(prices: DataFrame, path: str | None = None, lateness: str = LATENESS) -> DataFrame:
    """(symbol, date, open, high, low, close, n) by day, from a table by month. prices: symbol, date, price, order (total
    within a day). A price up to `lateness` late changes its stored bar; one that is later is left out. The event time is
    the day's start. Where the stream is started again on the same path it goes on."""
    spark = prices.sparkSession
    kind = prices.schema["price"].dataType.simpleString()
    table = table_at(spark, path or new_path(spark), f"symbol string, date date, open {kind}, high {kind}, low {kind}, close {kind}, n long, month string", ["symbol", "date"], ["month"])
    days = prices.withColumn("day", F.col("date").cast("timestamp")).withWatermark("day", lateness)
    agg = days.groupBy("symbol", "day").agg(F.min_by("price", "order").alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", "order").alias("close"), F.count("*").alias("n"))
    bars = agg.select("symbol", F.to_date("day").alias("date"), "open", "high", "low", "close", "n", F.date_format("day", "yyyy-MM").alias("month"))
    return run_into(bars, "update", table, "bars").read().drop("month")


def stream_distinct(rows: DataFrame, keys: list[str], time: str, path: str | None = None, lateness: str = LATENESS) -> DataFrame:
    """The keys of rows, each inserted once, from a table by month of `time`, which must be a key. State is kept for the
    lateness only; a key that comes again after it is found in the table."""
    if time not in keys:
        raise ValueError(f"{time} must be one of the keys")
    spark = rows.sparkSession
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*keys).schema)
    table = table_at(spark, path or new_path(spark), f"{fields}, month string", keys, ["month"])
    once = rows.withColumn("__at", F.col(time).cast("timestamp")).withWatermark("__at", lateness).dropDuplicatesWithinWatermark(keys)
    new = once.select(*keys, F.date_format(time, "yyyy-MM").alias("month"))
    return run_into(new, "append", table, "distinct", update=False).read().drop("month")
