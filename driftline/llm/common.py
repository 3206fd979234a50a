"""Pieces that several training-data operators share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.sources.store import new_path, remove

#: Runs of anything but ASCII white space (Java and RE2 syntax).
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: The folders of kept tables.
_KEPT: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def scratch_path(spark: SparkSession) -> str:
    """A new folder name below the folder that driver and executors share; see store.shared_folder()."""
    return new_path(spark)


def keep(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and read it back: computed once, lineage cut, safe from lost executors. What is kept
    goes with the application; release() deletes it before."""
    path = scratch_path(df.sparkSession)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _KEPT[out] = path
    return out


def release(*kept: DataFrame) -> None:
    """Delete what keep() wrote for these; nothing may read them any more."""
    for df in kept:
        if path := _KEPT.pop(df, None):
            remove(df.sparkSession, path)


@contextmanager
def rows_at_once(spark: SparkSession, rows: int) -> Iterator[None]:
    """What runs within hands at most so many rows at once to Python; the session's own number holds again after it. For
    large rows, of which Spark's 10,000 would fill a worker and the buffers on its way there."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; null stays null."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def row_key(row_id: Column, text: Column) -> Column:
    """A key of id and text: repeated rows share it, one id with two texts does not; never null."""
    body = F.coalesce(text, F.lit(""))
    return F.concat_ws(":", F.coalesce(row_id.cast("string"), F.lit("-")), F.lower(F.hex(F.xxhash64(body))))


def bucket(row_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo parts; null ids count as empty text."""
    return F.crc32(F.coalesce(row_id.cast("string"), F.lit("")).cast("binary")) % parts
