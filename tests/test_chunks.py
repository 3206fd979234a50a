"""Chunked functions of a key's rows, and grids of moving-average pairs, against plain loops."""

import math
import random
import statistics

import pyarrow as pa
import pytest

from driftline.operators.chunks import in_chunks
from driftline.operators.grids import cross_grid

SCHEMA = "symbol string, date date, close double"


def panel(spark, sizes, seed=3):
    import datetime

    rnd = random.Random(seed)
    rows, found = [], {}
    for s, n in sizes.items():
        x, found[s] = 100.0, []
        for k in range(n):
            x *= 1 + rnd.uniform(-0.08, 0.08)
            found[s].append((datetime.date(2020, 1, 1) + datetime.timedelta(7 * k), x))
        rows += [(s, d, x) for d, x in found[s]]
    rnd.shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(5), found


@pytest.mark.parametrize("chunk", [7, 4096])
def test_a_function_sees_its_rows_in_order_with_those_before(spark, chunk):
    df, found = panel(spark, {"a": 30, "b": 7, None: 3, "d": 14})

    def moves(rows: pa.Table, lead: int) -> pa.Table:
        assert lead in (0, 5) or lead == rows.num_rows - 1
        x = rows.column("close").to_pylist()
        back = [x[k] / x[k - 5] if k >= 5 else None for k in range(len(x))]
        return rows.append_column("back", pa.array(back, pa.float64())).append_column("n", pa.array([lead] * len(x))).slice(lead)

    got = {(r.symbol, r.date): r.back for r in in_chunks(df, moves, SCHEMA + ", back double, n long", 5, chunk=chunk).collect()}
    want = {(s, d): x / rows[k - 5][1] if k >= 5 else None for s, rows in found.items() for k, (d, x) in enumerate(rows)}
    assert got == want
    assert in_chunks(df.limit(0), moves, SCHEMA + ", back double, n long", 5).count() == 0
    with pytest.raises(ValueError):
        in_chunks(df, moves, SCHEMA, 8, chunk=7)


def slow_grid(rows, short, long):
    xs = [x for _, x in rows]
    mean = lambda k, n: sum(xs[k - n + 1 : k + 1]) / n if k >= n - 1 else math.nan
    held = lambda k: k >= long - 1 and xs[k] > mean(k, short) and mean(k, short) != mean(k, long) and short != 1
    steps = [(d, xs[k] / xs[k - 1] - 1 if held(k - 1) else 0.0) for k, (d, _) in enumerate(rows) if k >= max(long - 1, 1)]
    if not steps:
        return None
    capital, top, worst = 1.0, -math.inf, 0.0
    for _, x in steps:
        capital *= 1 + x
        top = max(top, capital)
        worst = min(worst, capital / top - 1)
    years = max((steps[-1][0] - steps[0][0]).days / 365.25, 1)
    only = [x for _, x in steps]
    sd = statistics.stdev(only) if len(only) > 1 else None
    return len(only), capital - 1, capital ** (1 / years) - 1, sd * 52**0.5 if sd is not None else None, statistics.mean(only) / sd * 52**0.5 if sd else None, worst


@pytest.mark.parametrize("chunk", [16, 4096])
def test_key_figures_of_all_pairs(spark, chunk):
    df, found = panel(spark, {"a": 90, "b": 16, "c": 4, "d": 1})
    pairs = [(s, n) for n in range(2, 16) for s in range(1, n)]
    got = {(r.symbol, r.short, r.long): tuple(r)[3:] for r in cross_grid(df, pairs, 52.0, chunk=chunk).collect()}
    want = {(s, *p): f for s, rows in found.items() for p in pairs if (f := slow_grid(rows, *p))}
    assert got.keys() == want.keys()
    for k, figures in want.items():
        assert all(a == b or a == pytest.approx(b, abs=1e-8) for a, b in zip(got[k], figures, strict=True)), (k, got[k], figures)
