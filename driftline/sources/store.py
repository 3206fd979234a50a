"""Tables on shared storage: scans, writes, upserts and increments."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: The shared folder of each application of this process.
_FOLDERS: dict[str, str] = {}


def scan(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """This application's folder below the one that driver and executors share, which spark.checkpoint.dir names.

    Only where the master is this machine alone may it be unset; a temporary folder of the machine takes its place then.
    Elsewhere that would be another disk on each host, so it raises. The folder goes when the session's JVM ends.
    """
    app = spark.sparkContext.applicationId
    if app not in _FOLDERS:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
                raise ValueError("spark.checkpoint.dir is unset: it must name a folder that driver and executors share")
            base = tempfile.mkdtemp(prefix="spark-driftline-")
        _FOLDERS[app] = f"{base.rstrip('/')}/driftline/{app}"
        _on_hadoop(spark, _FOLDERS[app], lambda fs, path: fs.mkdirs(path) and fs.deleteOnExit(path))
    return _FOLDERS[app]


def _on_hadoop(spark: SparkSession, path: str, act: Callable) -> None:
    """act(file system, path) by Hadoop's interface, which knows every store that Spark writes to."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    act(where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where)


def new_path(spark: SparkSession) -> str:
    """The name of a new folder in this application's shared folder."""
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete what was written at path; nothing if it is gone. For tables that nothing reads any more."""
    _on_hadoop(spark, path, lambda fs, at: fs.delete(at, True))


def written(df: DataFrame, fmt: str = "parquet", partition_by: list[str] | None = None, single: bool = False, path: str | None = None, mode: str = "overwrite", **options) -> DataFrame:
    """Write df and read it back with its own schema. single: one file, for small tables. partition_by: rows are dealt
    by those columns first, so that each value is in few files."""
    path = path or new_path(df.sparkSession)
    out = df.coalesce(1) if single else df.repartition(*partition_by) if partition_by else df
    w = out.write.mode(mode).options(**options)
    (w.partitionBy(*partition_by) if partition_by else w).format(fmt).save(path)
    return df.sparkSession.read.options(**options).schema(df.schema).format(fmt).load(path).select(*df.columns)


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """All of target with the rows of source in place of those of the same key, and source's others. source must have one
    row for each key; a second run changes nothing."""
    return target.join(source.select(*keys), keys, "left_anti").unionByName(source)


def insert_only(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """target and those rows of source whose key it lacks."""
    return target.unionByName(source.join(target.select(*keys), keys, "left_anti"))


def dedup(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key in the stated order."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("__n = 1").drop("__n")


def resume_points(target: DataFrame, members: DataFrame, floor: str, today: str, key: str = "symbol", time: str = "date") -> DataFrame:
    """(key, start) of members still to load: the day after the key's last, the floor at least, before today."""
    last = target.groupBy(key).agg(F.max(time).alias("__m"))
    lit = F.lit(floor).cast("date")
    start = F.greatest(F.coalesce(F.date_add("__m", 1), lit), lit)
    return members.select(key).distinct().join(last, key, "left").select(key, start.alias("start")).filter(F.col("start") < F.lit(today).cast("date"))


def batch_plan(starts: DataFrame, size: int, key: str = "symbol") -> DataFrame:
    """(start, batch, keys): keys of one start, in order, in batches of `size`. Any number of keys may share a start."""
    from driftline.operators.ranks import positions  # which writes by this module

    placed = positions(starts.select("start", key), [F.col(key)], ["start"], "__at", "__of")
    return placed.withColumn("batch", F.floor(F.col("__at") / size)).groupBy("start", "batch").agg(F.array_sort(F.collect_list(key)).alias("keys"))


def split_period(df: DataFrame, days: int, start: str = "start", end: str = "end") -> DataFrame:
    """Each (start, end) as consecutive stretches of at most `days` days after their start; the next begins a day later."""
    begins = F.explode(F.sequence(F.col(start), F.col(end), F.expr(f"interval {days + 1} days")))
    return df.withColumn("part_start", begins).withColumn("part_end", F.least(F.date_add("part_start", days), F.col(end)))
