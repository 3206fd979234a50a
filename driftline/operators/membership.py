"""Membership: add and remove events to spells."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def event_dedup(events: DataFrame, key: str = "symbol", time: str = "date", kind: str = "event") -> DataFrame:
    """Events whose kind differs from the one before; additions come before removals on one day."""
    w = Window.partitionBy(key).orderBy(time, kind)
    before = F.lag(kind).over(w)
    return events.withColumn("__b", before).filter(F.col("__b").isNull() | (F.col("__b") != F.col(kind))).drop("__b")


def _ends(events: DataFrame, key: str, time: str, kind: str) -> DataFrame:
    """(key, start, end) of each ADD; end is null unless the next event is a REMOVE."""
    w = Window.partitionBy(key).orderBy(time, kind)
    e = events.select(key, time, kind, F.lead(kind).over(w).alias("nk"), F.lead(time).over(w).alias("nt"))
    return e.filter(F.col(kind) == "ADD").select(key, F.col(time).alias("start"), F.when(F.col("nk") == "REMOVE", F.col("nt")).alias("end"))


def _closed(spells: DataFrame, key: str, as_of: str) -> DataFrame:
    return spells.select(key, "start", F.coalesce("end", F.lit(as_of).cast("date")).alias("end")).filter("start <= end")


def event_to_spell(events: DataFrame, as_of: str, key: str = "symbol", time: str = "date", kind: str = "event") -> DataFrame:
    """(key, start, end) of each ADD, repeated ones too: it lasts until the next event if that is a REMOVE, else it is
    open until as_of. Spells that would end before they start are left out."""
    return _closed(_ends(events, key, time, kind), key, as_of)


def spells(events: DataFrame, as_of: str, key: str = "symbol", time: str = "date", kind: str = "event") -> DataFrame:
    """event_to_spell over events without repeats; spells of one end are one, from the earliest start."""
    e = _ends(event_dedup(events, key, time, kind), key, time, kind).groupBy(key, "end").agg(F.min("start").alias("start"))
    return _closed(e, key, as_of)


def merged(spells_: DataFrame, key: str = "symbol") -> DataFrame:
    """(key, start, end): the days that spells cover, ends included, as spells that neither overlap nor touch."""
    w = Window.partitionBy(key).orderBy("start", "end")
    reach = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    s = spells_.select(key, "start", "end", F.when(reach.isNull() | (F.col("start") > F.date_add(reach, 1)), 1).otherwise(0).alias("__new"))
    s = s.withColumn("__run", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return s.groupBy(key, "__run").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("__run")


def counts(spells_: DataFrame, dates: DataFrame, key: str = "symbol", time: str = "date") -> DataFrame:
    """(time, n): how many keys each of dates has a spell of; dates without any are left out.

    Running sums of the changes: one row a day on which spells begin or end, never one a day that they last.
    """
    m = merged(spells_, key)
    moves = m.select(F.col("start").alias(time), F.lit(1).alias("d")).unionByName(m.select(F.date_add("end", 1).alias(time), F.lit(-1).alias("d")))
    days = moves.groupBy(time).agg(F.sum("d").alias("d")).unionByName(dates.select(time, F.lit(0).cast("long").alias("d"))).groupBy(time).agg(F.sum("d").alias("d"))
    n = days.select(time, F.sum("d").over(Window.orderBy(time).rowsBetween(Window.unboundedPreceding, 0)).alias("n"))  # one row a date
    return n.join(dates.select(time).distinct(), time, "left_semi").filter("n > 0")


def snapshots(spells_: DataFrame, dates: DataFrame, key: str = "symbol", time: str = "date", days: int = 32) -> DataFrame:
    """(time, members): the keys, sorted, that each of dates has a spell of; dates without any are left out.

    Spells are cut at bins of `days` days. In a bin a spell that covers all of it is one row for the bin, and the bin's
    dates share that list; only spells that begin or end within the bin meet its dates one by one.
    """
    m = merged(spells_, key)
    number = lambda c: F.expr(f"unix_date({c}) div {days}")
    cut = m.withColumn("__bin", F.explode(F.sequence(number("start"), number("end"))))
    whole = (F.unix_date("start") <= F.col("__bin") * days) & (F.unix_date("end") >= (F.col("__bin") + 1) * days - 1)
    on = dates.select(time).distinct().withColumn("__bin", number(time))
    bins = on.select("__bin").distinct()
    cut = cut.join(bins, "__bin", "left_semi")
    all_day = cut.filter(whole).groupBy("__bin").agg(F.collect_set(key).alias("__all"))
    part = cut.filter(~whole).join(on, "__bin").filter(F.col(time).between(F.col("start"), F.col("end")))
    part = part.groupBy(time).agg(F.collect_set(key).alias("__some"))
    none = F.array().cast(all_day.schema["__all"].dataType)
    met = on.join(all_day, "__bin", "left").join(part, time, "left")
    return met.select(time, F.array_sort(F.concat(F.coalesce("__all", none), F.coalesce("__some", none))).alias("members")).filter(F.size("members") > 0)
