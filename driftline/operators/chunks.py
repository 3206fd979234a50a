"""The extension point for functions of a key's rows in time order that no built-in expresses.

A key's rows come in chunks of a bounded number, each led by the rows before it that the function looks back at, so a key
of any length spreads over tasks and one chunk is in memory.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from driftline.operators.scans import AT, BLOCK, PART, TURN, numbered


def in_chunks(df: DataFrame, function: Callable[[pa.Table, int], pa.Table], schema: StructType | str, look_back: int = 0, key: str = "symbol", time: str = "date", chunk: int = BLOCK, numbers: bool = False) -> DataFrame:
    """What function(rows, lead) returns for each chunk of each key, with the stated schema.

    rows: a chunk's rows in time order (ties by the other columns) with df's columns, and, with `numbers`, the key's place
    of each row from 0 (AT) and the chunk's number (PART). Its first `lead` rows are those before the chunk, `look_back` of
    them if the key has as many; the function answers for the others. The result may have any number of rows. Null keys
    are one key. An empty table gives an empty result.
    """
    if look_back > chunk:
        raise ValueError(f"a chunk of {chunk} rows cannot look back {look_back}")
    rows = numbered(df, None, key, time, chunk).drop(TURN)
    rows = rows.withColumn("__of", F.col(PART))
    if look_back:
        ahead = F.col(AT) % chunk >= chunk - look_back
        rows = rows.withColumn("__of", F.explode(F.when(ahead, F.array(PART, F.col(PART) + 1)).otherwise(F.array(PART))))
    names = [*df.columns, AT, PART] if numbers else df.columns
    out = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by(AT)
        of = rows.column("__of")[0].as_py()
        lead = sum(p < of for p in rows.column(PART).to_pylist())
        if lead == rows.num_rows:  # the key ended with the chunk before
            return pa.table({f.name: pa.array([], kinds[f.name]) for f in out})
        return function(rows.select(names), lead)

    from pyspark.sql.pandas.types import to_arrow_schema

    kinds = {f.name: f.type for f in to_arrow_schema(out)}
    return rows.groupBy(key, "__of").applyInArrow(run, out)
