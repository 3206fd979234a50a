"""Recursions x -> a*x + b along a key's rows (exponential and Wilder smoothing) as a distributed scan of affine maps.

Rows of a key are cut into blocks of BLOCK rows in time order. Each block composes its maps to one, all blocks in
parallel; the values at the blocks' ends are a recursion of the same kind over blocks, solved in the same way; then each
block emits its rows' values from the value that it starts with. So a key of any number of rows spreads over tasks, and no
row and no group holds more than a block.
"""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.operators.ranks import positions
from driftline.sources.store import written

BLOCK = 4096
AT, TURN, PART = "__at", "__turn", "__part"


def numbered(df: DataFrame, counted: Column | None = None, key: str = "symbol", time: str = "date", block: int = BLOCK) -> DataFrame:
    """df with each row's place in its key's time order (AT, from 0), its block (PART) and the number of rows up to it for
    which `counted` holds (TURN; default: all rows). Ties in time are in the order of the other columns that can be
    ordered."""
    rest = [F.col(f.name).asc_nulls_first() for f in df.schema if f.name not in (key, time) and not isinstance(f.dataType, T.MapType | T.VariantType)]
    rows = positions(df, [F.col(time).asc_nulls_first(), *rest], [key], AT, "__of").drop("__of").withColumn(PART, F.expr(f"{AT} div {block}"))
    if counted is None:
        return rows.withColumn(TURN, F.col(AT) + 1)
    hit = F.coalesce(counted, F.lit(False)).cast("long")
    sums = rows.groupBy(key, PART).agg(F.sum(hit).alias("__n"))  # a row a block
    before = Window.partitionBy(key).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col(key).alias("__key"), F.col(PART).alias("__block"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy(key, PART).orderBy(AT).rowsBetween(Window.unboundedPreceding, 0)
    met = rows.withColumn(TURN, F.sum(hit).over(inside)).join(sums, F.col(key).eqNullSafe(F.col("__key")) & (F.col(PART) == F.col("__block")))
    return met.select(*rows.columns, (F.col(TURN) + F.col("__before")).alias(TURN))


def affine(rows: DataFrame, maps: dict[str, tuple[Column, Column]], key: str = "symbol", block: int = BLOCK) -> DataFrame:
    """rows (numbered) with a column for each of maps: x of the row before times a, plus b; x is 0 before a key's first row.
    A row whose a or b is null leaves x as it is."""
    names = list(maps)
    fine = lambda a, b, v, none: F.when(a.isNotNull() & b.isNotNull(), v.cast("double")).otherwise(F.lit(none))
    coefs = [c for n, (a, b) in maps.items() for c in (fine(a, b, a, 1.0).alias(f"__a_{n}"), fine(a, b, b, 0.0).alias(f"__b_{n}"))]
    return _solved(written(rows.select("*", *coefs)), names, key, block)


def _run(rows: pa.Table, names: list[str], start: dict[str, float]) -> tuple[list[int], dict[str, list[float]]]:
    """The rows of a block by place, and the values of each name."""
    at = rows.column(AT).to_pylist()
    turn = sorted(range(len(at)), key=at.__getitem__)
    out = {}
    for n in names:
        a, b, x, values = rows.column(f"__a_{n}").to_pylist(), rows.column(f"__b_{n}").to_pylist(), start[n], [0.0] * len(at)
        for k in turn:
            x = a[k] * x + b[k]
            values[k] = x
        out[n] = values
    return turn, out


def _solved(rows: DataFrame, names: list[str], key: str, block: int) -> DataFrame:
    """rows (AT, PART and coefficients __a_, __b_ of each name) without coefficients, with the names' values."""
    kept = [c for c in rows.columns if not c.startswith(("__a_", "__b_"))]
    kind = rows.schema[key].dataType

    def compose(rows: pa.Table) -> pa.Table:
        turn, ends = _run(rows, names, dict.fromkeys(names, 0.0))
        out = {key: rows.column(key)[:1], AT: rows.column(PART)[:1]}
        for n in names:
            out[f"__a_{n}"] = pa.array([reduce(float.__mul__, rows.column(f"__a_{n}").to_pylist(), 1.0)])
            out[f"__b_{n}"] = pa.array([ends[n][turn[-1]]])
        return pa.table(out)

    def emit(rows: pa.Table, starts: pa.Table) -> pa.Table:
        start = {n: starts.column(n)[0].as_py() if starts.num_rows else 0.0 for n in names}
        _, values = _run(rows, names, start)
        return pa.table({c: rows.column(c) for c in kept} | {n: pa.array(v, pa.float64()) for n, v in values.items()})

    schema = T.StructType([*(rows.schema[c] for c in kept), *(T.StructField(n, T.DoubleType()) for n in names)])
    if rows.filter(F.col(PART) > 0).isEmpty():
        none = pa.table({n: pa.array([], pa.float64()) for n in names})
        return rows.groupBy(key).applyInArrow(lambda t: emit(t, none), schema)
    above = T.StructType([T.StructField(key, kind), T.StructField(AT, T.LongType()), *(T.StructField(f"__{s}_{n}", T.DoubleType()) for n in names for s in "ab")])
    blocks = written(rows.groupBy(key, PART).applyInArrow(compose, above).withColumn(PART, F.expr(f"{AT} div {block}")))
    ends = _solved(blocks, names, key, block).select(F.col(key).alias("__key"), (F.col(AT) + 1).alias("__next"), *names)
    return rows.groupBy(key, PART).cogroup(ends.groupBy("__key", "__next")).applyInArrow(emit, schema)


def done(rows: DataFrame) -> DataFrame:
    return rows.drop(AT, TURN, PART)


def smoothing(x: Column, n: int, k: Column) -> tuple[Column, Column]:
    """Wilder's step for the k-th value x as a map: the running mean up to the n-th value, a share of 1/n for each later
    one; before the first value nothing happens."""
    size = F.least(k, F.lit(n)).cast("double")
    return F.when(k >= 1, (size - 1) / F.greatest(size, F.lit(1.0))), F.when(k >= 1, x / F.greatest(size, F.lit(1.0)))


def ewm(df: DataFrame, col: str, alpha: float, name: str = "ewm", key: str = "symbol", time: str = "date", block: int = BLOCK) -> DataFrame:
    """df with the exponentially weighted mean of col, which starts with the first value. Null values leave it as it is;
    null until the first value."""
    there = F.col(col).isNotNull()
    rows = numbered(df, there, key, time, block)
    first = F.col(TURN) == 1
    a, b = F.when(first, 0.0).otherwise(1 - alpha), F.when(first, F.col(col)).otherwise(F.col(col) * alpha)
    found = affine(rows, {name: (F.when(there, a), F.when(there, b))}, key, block)
    return done(found.withColumn(name, F.when(F.col(TURN) > 0, F.col(name))))


def ewm_adjusted(df: DataFrame, cols: dict[str, str], alpha: float, key: str = "symbol", time: str = "date", block: int = BLOCK) -> DataFrame:
    """df with the exponentially weighted mean of each of cols = {new: old}, weights divided by their sum. Weights decay at
    null values too; new_n counts the values so far; null until the first. One pass for all of cols."""
    decay, maps = F.lit(1 - alpha), {}
    for new, old in cols.items():
        there = F.col(old).isNotNull().cast("double")
        maps |= {f"__num_{new}": (decay, F.coalesce(F.col(old).cast("double"), F.lit(0.0))), f"__den_{new}": (decay, there), f"__n_{new}": (F.lit(1.0), there)}
    found = affine(numbered(df, None, key, time, block), maps, key, block)
    means = [c for new in cols for c in (F.try_divide(f"__num_{new}", f"__den_{new}").alias(new), F.col(f"__n_{new}").cast("long").alias(f"{new}_n"))]
    return found.select(*df.columns, *means)


def wilder(df: DataFrame, col: str, n: int, name: str = "wilder", key: str = "symbol", time: str = "date", block: int = BLOCK) -> DataFrame:
    """df with Wilder's smoothing of col: the mean of the first n values, then (before * (n - 1) + value) / n; null until
    then. Null values leave it as it is."""
    there = F.col(col).isNotNull()
    a, b = smoothing(F.col(col), n, F.col(TURN))
    found = affine(numbered(df, there, key, time, block), {name: (F.when(there, a), F.when(there, b))}, key, block)
    return done(found.withColumn(name, F.when(F.col(TURN) >= n, F.col(name))))


def adx(df: DataFrame, n: int, atr: int = 14, key: str = "symbol", time: str = "date", block: int = BLOCK) -> DataFrame:
    """(key, time, high, low, close, adx, atr): Wilder's average directional index over n bars and average true range over
    `atr` bars. Each smoothing starts with the mean of its first values; null until then. The first bar has no move, and
    neither has one with a null, which leaves all as it was."""
    rows = numbered(df.select(key, time, "high", "low", "close"), None, key, time, block)
    before = {c: F.lag(c).over(Window.partitionBy(key).orderBy(AT)) for c in ("high", "low", "close")}
    rows = rows.select("*", *[v.alias(f"__{c}") for c, v in before.items()])
    tr = F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - F.col("__close")), F.abs(F.col("low") - F.col("__close")))
    up, down = F.col("high") - F.col("__high"), F.col("__low") - F.col("low")
    plus, minus = F.when((up > down) & (up > 0), up).otherwise(0.0), F.when((down > up) & (down > 0), down).otherwise(0.0)
    k = F.col(AT)  # moves so far
    moves = {"__a": (tr, atr), "__t": (tr, n), "__p": (plus, n), "__q": (minus, n)}
    whole = F.col("__close").isNotNull() & F.col("close").isNotNull() & up.isNotNull() & down.isNotNull()
    rows = affine(rows, {c: tuple(F.when(whole, m) for m in smoothing(x, size, k)) for c, (x, size) in moves.items()}, key, block)
    dx = F.coalesce(F.try_divide(100 * F.abs(F.col("__p") - F.col("__q")), F.col("__p") + F.col("__q")), F.lit(0.0))
    turn = k - n + 1  # values of the index so far
    rows = affine(rows, {"__d": smoothing(dx, n, turn)}, key, block)
    return rows.select(key, time, "high", "low", "close", F.when(turn >= n, F.col("__d")).alias("adx"), F.when(k >= atr, F.col("__a")).alias("atr"))
