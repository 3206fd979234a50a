"""Incremental jobs over published tables: the last stretch of a table built anew, and batches of a stream merged."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.sources.versions import Table


def high_water_mark(table: Table, time: str = "date") -> date | None:
    """The latest time of a table as a value: what is filtered by it reaches the scan as a literal."""
    return table.read().agg(F.max(time)).first()[0]


def reload_stretch(table: Table, build: Callable[[date | None], DataFrame], days: int = 60, time: str = "date") -> int:
    """Build the table's last `days` days anew and publish them; returns the version.

    build(start) gives all rows whose time is `start` or later, made from the source's rows of those days alone; of an
    empty table start is None, which means all. Rows before start stay as they are stored, and so do the files of
    partitions that hold only such. A second run publishes the same rows.
    """
    last = high_water_mark(table, time)
    if last is None:
        return table.merge(build(None), update=False)
    start = last - timedelta(days)
    return table.replace_from(time, start, build(start))
