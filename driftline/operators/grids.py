"""Whole grids of moving-average pairs at the price of one pass over the rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftline.functions.expr import ratio
from driftline.operators.chunks import in_chunks
from driftline.operators.scans import BLOCK

#: Means that differ by less than this share are equal: a mean here is a difference of two sums.
EQUAL = 1e-9


def config_means(series: DataFrame, configs: DataFrame, key: str = "symbol", time: str = "date", value: str = "close", chunk: int = BLOCK) -> DataFrame:
    """(configs' columns, key, time, mean) for each row of series and each of configs, whose column n is a number of rows:
    the mean of the last n values (fewer at a key's start). All lengths share one pass: a mean is a difference of two
    running sums within a chunk. configs is a list of parameters; its lengths go to the driver, up to `chunk` each."""
    lengths = sorted({r.n for r in configs.select("n").distinct().collect()})

    def means(rows: pa.Table, lead: int) -> pa.Table:
        x, place = rows.column(value).to_numpy().astype(float), rows.column("__at").to_numpy()
        sums = np.concatenate(([0.0], np.cumsum(x)))
        at = np.arange(lead, len(x))
        found = np.stack([(sums[at + 1] - sums[np.maximum(at + 1 - n, 0)]) / np.minimum(n, place[at] + 1) for n in lengths], axis=1)
        flat = pa.ListArray.from_arrays(np.arange(len(at) + 1) * len(lengths), found.ravel())
        return rows.select([key, time]).slice(lead).append_column("m", flat)

    kinds = series.select(key, time).schema
    schema = f"{key} {kinds[0].dataType.simpleString()}, {time} {kinds[1].dataType.simpleString()}, m array<double>"
    wide = in_chunks(series.select(key, time, value), means, schema, max(lengths, default=0), key, time, chunk, numbers=True)
    names = F.array(*[F.lit(n) for n in lengths])
    long = wide.select(key, time, F.explode(F.arrays_zip(names.alias("n"), F.col("m").alias("m"))).alias("x")).select(key, time, F.col("x.n").alias("__n"), F.col("x.m").alias("mean"))
    return long.join(configs, F.col("__n") == configs["n"]).select(*configs.columns, key, time, "mean")


def cross_grid(series: DataFrame, pairs: list[tuple[int, int]], per_year: float = 252.0, key: str = "symbol", time: str = "date", value: str = "close", chunk: int = BLOCK) -> DataFrame:
    """(key, short, long, n, total_return, cagr, volatility, sharpe, max_drawdown) for each pair of lengths of each key.

    The key is held from one row to the next while its value is above the short mean and that is not the long one. Rows
    count from the first that has a long mean, the second row at least; those before, and pairs without rows, give none.
    Means of n rows are differences of running sums within a chunk, so a length costs one subtraction a row, whatever n,
    and the time grows with pairs. Chunks give sums, and how far the capital rose and fell in them; key figures need
    these alone. Values are positive and not null.
    """
    longest = max(n for _, n in pairs)
    shorts, longs = np.array([s for s, _ in pairs]), np.array([n for _, n in pairs])
    lengths = sorted({*shorts.tolist(), *longs.tolist()})
    where = {n: k for k, n in enumerate(lengths)}
    at_short, at_long = [where[n] for n in shorts.tolist()], [where[n] for n in longs.tolist()]

    def figures(rows: pa.Table, lead: int) -> pa.Table:
        x, place = rows.column(value).to_numpy().astype(float), rows.column("__at").to_numpy()
        sums = np.concatenate(([0.0], np.cumsum(x)))
        means = np.full((len(lengths), len(x)), np.nan)
        for k, n in enumerate(lengths):
            means[k, n - 1 :] = (sums[n:] - sums[:-n]) / n
        if 1 in where:
            means[where[1]] = x
        ms, ml = means[at_short], means[at_long]
        with np.errstate(invalid="ignore"):
            held = (x - ms > EQUAL * x) & (np.abs(ms - ml) > EQUAL * x)
        steps = np.zeros_like(ms)
        steps[:, 1:] = np.where(held[:, :-1], x[1:] / x[:-1] - 1, 0.0)
        counts = place[None, :] >= np.maximum(longs - 1, 1)[:, None]
        counts[:, :lead] = False
        steps[~counts] = 0.0
        logs = np.cumsum(np.log1p(steps), axis=1)
        high = np.maximum.accumulate(np.where(counts, logs, -np.inf), axis=1)
        with np.errstate(invalid="ignore"):
            fall = np.where(counts, logs - high, 0.0).min(axis=1)
        n, first = counts.sum(axis=1), counts.argmax(axis=1)
        some = n > 0
        dates, m = rows.column(time), int(some.sum())
        return pa.table({
            key: pa.concat_arrays([rows.column(key).slice(0, 1).combine_chunks()] * m) if m else rows.column(key).slice(0, 0),
            "part": np.full(m, rows.column("__part")[lead].as_py()), "short": shorts[some], "long": longs[some], "n": n[some],
            "s1": steps.sum(axis=1)[some], "s2": (steps * steps).sum(axis=1)[some], "grown": logs[some, -1], "high": high[some, -1],
            "low": np.where(counts, logs, np.inf).min(axis=1)[some], "fall": fall[some], "first": dates.take(pa.array(first[some])), "last": dates.take(pa.array(np.full(m, len(x) - 1))),
        })

    kind = series.select(key, time).schema
    schema = f"{key} {kind[0].dataType.simpleString()}, part long, short long, long long, n long, s1 double, s2 double, grown double, high double, low double, fall double, first {kind[1].dataType.simpleString()}, last {kind[1].dataType.simpleString()}"
    parts = in_chunks(series.select(key, time, value), figures, schema, min(longest, chunk), key, time, chunk, numbers=True)
    # chunks of a pair in order: a row a chunk
    before = Window.partitionBy(key, "short", "long").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("base", F.coalesce(F.sum("grown").over(before), F.lit(0.0)))
    parts = parts.withColumn("top", F.max(F.col("base") + F.col("high")).over(before))
    worst = F.least(F.col("fall"), F.coalesce(F.col("base") + F.col("low") - F.col("top"), F.lit(0.0)))
    whole = parts.groupBy(key, "short", "long").agg(F.sum("n").alias("n"), F.sum("s1").alias("s1"), F.sum("s2").alias("s2"), F.sum("grown").alias("grown"), F.min(worst).alias("worst"), F.min("first").alias("first"), F.max("last").alias("last"))
    mean, n = F.col("s1") / F.col("n"), F.col("n")
    sd = F.when(n > 1, F.sqrt(F.greatest((F.col("s2") - n * mean * mean) / (n - 1), F.lit(0.0))))
    years = F.greatest(F.datediff("last", "first") / 365.25, F.lit(1.0))
    whole = whole.select("*", mean.alias("mean"), sd.alias("sd"), years.alias("years"))
    return whole.select(key, "short", "long", "n", (F.exp("grown") - 1).alias("total_return"), (F.exp(F.col("grown") / F.col("years")) - 1).alias("cagr"), (F.col("sd") * per_year**0.5).alias("volatility"), (ratio("mean", "sd") * per_year**0.5).alias("sharpe"), (F.exp("worst") - 1).alias("max_drawdown"))
