"""As-of and interval joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof(left: DataFrame, right: DataFrame, cols: list[str], key: str = "symbol", time: str = "date", forward: bool = False) -> DataFrame:
    """left with, for each row, cols of the right row of its key whose time is the nearest at or before (or after) it.

    A union and one ordered window instead of a range join: one shuffle by key. A matched null stays null. On equal times
    the right row counts. right must have one row for each key and time.
    """
    hit = F.struct(*cols)
    names = [c for c in left.columns if c not in (key, time)]
    a = left.select(key, time, F.struct(*names).alias("__l"), F.lit(None).cast(right.select(hit.alias("h")).schema["h"].dataType).alias("__h"), F.lit(1).alias("__side"))
    b = right.select(key, time, F.lit(None).cast(a.schema["__l"].dataType).alias("__l"), hit.alias("__h"), F.lit(0).alias("__side"))
    w = Window.partitionBy(key).orderBy(F.col(time).desc() if forward else F.col(time), "__side").rowsBetween(Window.unboundedPreceding, 0)
    found = a.unionByName(b).withColumn("__m", F.last("__h", ignorenulls=True).over(w)).filter("__side = 1")
    return found.select(key, time, *[f"__l.{n}" for n in names], *[f"__m.{c}" for c in cols])


def interval(left: DataFrame, spells: DataFrame, key: str = "symbol", time: str = "date", start: str = "start", end: str = "end") -> DataFrame:
    """Rows of left whose time lies in a spell of their key, ends included; once, however many spells overlap.

    Times and spells go through one ordered window by key: a row is kept if the latest end among the spells that started
    by then is not before it. So a key with many spells and many rows costs a sort, not their product. Rows with a null
    key or time, and spells with a null, match nothing.
    """
    body = F.struct(*left.columns)
    a = left.select(F.col(key).alias("__k"), F.col(time).alias("__t"), F.lit(1).alias("__side"), body.alias("__l"), F.lit(None).cast(spells.schema[end].dataType).alias("__e"))
    b = spells.filter(F.col(key).isNotNull() & F.col(start).isNotNull()).select(F.col(key).alias("__k"), F.col(start).alias("__t"), F.lit(0).alias("__side"), F.lit(None).cast(a.schema["__l"].dataType).alias("__l"), F.col(end).alias("__e"))
    w = Window.partitionBy("__k").orderBy("__t", "__side").rowsBetween(Window.unboundedPreceding, 0)
    met = a.filter(F.col("__k").isNotNull() & F.col("__t").isNotNull()).unionByName(b).withColumn("__reach", F.max("__e").over(w))
    return met.filter((F.col("__side") == 1) & (F.col("__reach") >= F.col("__t"))).select("__l.*")
