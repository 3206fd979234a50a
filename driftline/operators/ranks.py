"""Positions of rows in an order, without a window over all of them: range partitions, counts a partition, offsets added."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.sources.store import written

#: monotonically_increasing_id() holds the partition above these bits and the row's turn in it below.
TURN_BITS = 33


def positions(df: DataFrame, order: list[Column], group: list[str] | None = None, position: str = "position", size: str = "group_size") -> DataFrame:
    """df with the place of each row within its group (longs from 0) and the group's number of rows.

    order: of the rows within a group; rows equal in it are placed in any order, once (the placed rows are written, so
    every later read agrees). Groups stand in ascending order, nulls first; without group all rows are one.

    One range exchange of the rows: each partition numbers its own sorted rows, a window runs over one row a partition,
    and a group's start is the least place that one of its rows has. So a group of any size spreads over tasks; only rows
    that are equal in group and order share one. An empty table gives an empty result.
    """
    group = group or []
    taken = {position, size} & set(df.columns)
    if taken:
        raise ValueError(f"columns are there already: {sorted(taken)}")
    keys = [F.col(g).asc_nulls_first() for g in group] + order
    rows = written(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("__turn", F.monotonically_increasing_id()))
    part = F.shiftright("__turn", TURN_BITS)
    counts = rows.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    ahead = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    starts = counts.select("__part", F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__start"))
    placed = rows.withColumn("__part", part).join(F.broadcast(starts), "__part")
    placed = placed.withColumn("__at", F.col("__start") + F.col("__turn") - F.shiftleft("__part", TURN_BITS)).drop("__part", "__start", "__turn")
    heads = placed.groupBy(*group).agg(F.min("__at").alias("__first"), F.count("*").alias(size))
    if not group:
        return placed.crossJoin(F.broadcast(heads)).select(*df.columns, F.col("__at").alias(position), size)  # one row
    heads = heads.select(*[F.col(g).alias(f"__g{k}") for k, g in enumerate(group)], "__first", size)
    met = placed.join(heads, [F.col(g).eqNullSafe(F.col(f"__g{k}")) for k, g in enumerate(group)])
    return met.select(*df.columns, (F.col("__at") - F.col("__first")).alias(position), size)


def dense_codes(df: DataFrame, col: str, name: str = "code") -> DataFrame:
    """df with the dense rank (from 0) of col's value among its distinct values, nulls first. Rows meet their value's code
    by a join on the value."""
    codes = positions(df.select(col).distinct(), [F.col(col).asc_nulls_first()], position=name, size="__values").select(F.col(col).alias("__value"), name)
    return df.join(codes, F.col(col).eqNullSafe(F.col("__value"))).select(*df.columns, name)
