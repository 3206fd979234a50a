"""Recursions along a key's rows (exponential and Wilder smoothing) as folds over one sorted array a key.

A fold needs a key's rows together, as any recursion does; keys are many and each holds few rows (a day's bar each), so
the work spreads by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(df: DataFrame, step, outs: dict[str, str], start: dict[str, Column], cols: list[str], key: str = "symbol", time: str = "date") -> DataFrame:
    """df with the columns that `step(state, row)` returns, row by row in time order.

    step maps the state (a struct of start's fields) and a row (a struct of cols) to a dict of start's fields; outs names
    the columns to emit by state field. Ties in time are in the order of the other columns.

    A fold that emits copies what it has emitted so far at each row. So a first one carries the state alone over blocks of
    about the root of a key's rows, and a second emits within each block: n * root(n) copied references a key.
    """
    pack = lambda d: F.struct(*[v.alias(k) for k, v in d.items()])
    first = pack(start)
    none = F.slice(F.array(first), 1, 0)
    packed = df.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(time, *cols))).alias("__rows"))
    size = F.ceil(F.sqrt(F.size("__rows"))).cast("int")
    at = F.sequence(F.lit(1), F.size("__rows"), size)
    blocks = packed.select(key, F.transform(at, lambda i: F.slice("__rows", i, size)).alias("__blocks"))

    def carry(acc: Column, block: Column) -> Column:
        return F.struct(F.aggregate(block, acc["s"], lambda s, row: pack(step(s, row))).alias("s"), F.concat(acc["before"], F.array(acc["s"])).alias("before"))

    def emit(acc: Column, row: Column) -> Column:
        new = pack(step(acc["s"], row))
        return F.struct(new.alias("s"), F.concat(acc["out"], F.array(new)).alias("out"))

    before = F.aggregate("__blocks", F.struct(first.alias("s"), none.alias("before")), carry)["before"]
    b = blocks.select(key, F.explode(F.arrays_zip(F.col("__blocks").alias("rows"), before.alias("s"))).alias("b"))
    out = F.aggregate("b.rows", F.struct(F.col("b.s").alias("s"), none.alias("out")), emit)["out"]
    done = b.select(key, F.explode(F.arrays_zip(F.col("b.rows").alias("r"), out.alias("o"))).alias("x"))
    return done.select(key, f"x.r.{time}", *[f"x.r.{c}" for c in cols], *[F.col(f"x.o.{s}").alias(name) for name, s in outs.items()])


def ewm(df: DataFrame, col: str, alpha: float, name: str = "ewm", adjust: bool = False, **kw) -> DataFrame:
    """Exponentially weighted mean. Null values leave it as it is. adjust: weights are divided by their sum."""
    null = F.lit(None).cast("double")
    if not adjust:
        return fold(df, lambda s, x: {"e": F.coalesce(F.when(s["e"].isNull(), x[col]).otherwise((1 - alpha) * s["e"] + alpha * x[col]), s["e"])}, {name: "e"}, {"e": null}, [col], **kw)

    def step(s: Column, x: Column) -> dict[str, Column]:
        here = x[col].isNotNull()
        num, den = s["num"] * (1 - alpha) + F.coalesce(x[col], F.lit(0.0)), s["den"] * (1 - alpha) + F.when(here, 1.0).otherwise(0.0)
        return {"num": num, "den": den, "n": s["n"] + here.cast("int"), "e": F.try_divide(num, den)}

    return fold(df, step, {name: "e", f"{name}_n": "n"}, {"num": F.lit(0.0), "den": F.lit(0.0), "n": F.lit(0), "e": null}, [col], **kw)


def wilder(df: DataFrame, col: str, n: int, name: str = "wilder", **kw) -> DataFrame:
    """Wilder's smoothing: the mean of the first n values, then (before * (n - 1) + value) / n; null until then."""
    null = F.lit(None).cast("double")

    def step(s: Column, x: Column) -> dict[str, Column]:
        k, total = s["k"] + x[col].isNotNull().cast("int"), s["total"] + F.coalesce(x[col], F.lit(0.0))
        later = F.coalesce((s["w"] * (n - 1) + x[col]) / n, s["w"])
        return {"k": k, "total": total, "w": F.when(s["k"] >= n, later).when(k == n, total / n)}

    return fold(df, step, {name: "w"}, {"k": F.lit(0), "total": F.lit(0.0), "w": null}, [col], **kw)


def adx(df: DataFrame, n: int, atr: int = 14, key: str = "symbol", time: str = "date") -> DataFrame:
    """(key, time, high, low, close, adx, atr): Wilder's average directional index over n bars and average true range over
    `atr` bars. Each smoothing starts with the mean of its first values; null until then. The first bar has no move."""
    null, zero = F.lit(None).cast("double"), F.lit(0.0)

    def smooth(before: Column, k: Column, x: Column, m: int) -> Column:
        """Running mean while k <= m, Wilder's step after."""
        size = F.least(k, F.lit(m))
        return before + (x - before) / F.greatest(size, F.lit(1))

    def step(s: Column, x: Column) -> dict[str, Column]:
        first = s["close"].isNull()
        k = s["k"] + F.when(first, 0).otherwise(1)
        tr = F.when(first, 0.0).otherwise(F.greatest(x["high"] - x["low"], F.abs(x["high"] - s["close"]), F.abs(x["low"] - s["close"])))
        up, down = x["high"] - s["high"], s["low"] - x["low"]
        plus = F.when((up > down) & (up > 0), up).otherwise(0.0)
        minus = F.when((down > up) & (down > 0), down).otherwise(0.0)
        moved = lambda old, v, m: F.when(first, old).otherwise(smooth(old, k, v, m))
        a, t, p, q = moved(s["a"], tr, atr), moved(s["t"], tr, n), moved(s["p"], plus, n), moved(s["q"], minus, n)
        dx = F.when(k >= n, F.coalesce(F.try_divide(100 * F.abs(p - q), p + q), zero))
        j = s["j"] + (k >= n).cast("int")
        d = F.when(k >= n, smooth(s["d"], j, dx, n)).otherwise(s["d"])
        return {"high": x["high"], "low": x["low"], "close": x["close"], "k": k, "j": j, "a": a, "t": t, "p": p, "q": q, "d": d, "adx": F.when(j >= n, d), "atr": F.when(k >= atr, a)}

    start = dict.fromkeys(("high", "low", "close"), null) | dict.fromkeys("kj", F.lit(0)) | dict.fromkeys("atpqd", zero) | dict.fromkeys(("adx", "atr"), null)
    return fold(df, step, {"adx": "adx", "atr": "atr"}, start, ["high", "low", "close"], key, time)
