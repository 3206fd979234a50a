"""Nearest neighbours against brute force."""

import math

import numpy as np
import pytest

from driftline.llm import neighbours as N

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, every=20, k=20):
    """All rows that take part: exact products, nearest first, smaller ids first among equals."""
    fine = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = set()
    for q, v in fine:
        if q % every == 0:
            near = sorted((-math.fsum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in fine if i != q)[:k]
            out |= {(q, rank, i, -s) for rank, (s, i) in enumerate(near, 1)}
    return out


def float32(x):
    return [float(v) for v in np.asarray(x, np.float32)]


def recall(got, want):
    a, b = {(r[0], r[2]) for r in got}, {(r[0], r[2]) for r in want}
    return len(a & b) / len(b)


def test_probing_finds_every_code_within_the_radius():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 1 << 16, (500, 8)).astype(np.uint16)
    codes[100:200] = codes[0] ^ (1 << rng.integers(0, 16, (100, 8))).astype(np.uint16)
    index = N.Index(codes)
    for radius in (0, 1, 7, 8, 9, 30, 50, 128):
        for code in codes[::50]:
            want = [i for i, c in enumerate(codes) if sum(int(a ^ b).bit_count() for a, b in zip(c, code, strict=True)) <= radius]
            assert index.within(code, radius).tolist() == want


@pytest.mark.parametrize("kind", ["sphere", "lengths", "clusters", "two components"])
def test_recall_and_exact_scores(spark, kind):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(2000, 2 if kind == "two components" else 32))
    if kind == "clusters":
        x = x[rng.integers(0, 30, 2000)] + rng.normal(size=x.shape) * 0.1
    if kind == "sphere":
        x /= np.linalg.norm(x, axis=1, keepdims=True)
    if kind == "lengths":
        x *= rng.lognormal(0, 0.5, (2000, 1))
    rows = [(k, float32(v)) for k, v in enumerate(x)]
    got = [tuple(r) for r in N.search(spark.createDataFrame(rows, SCHEMA).repartition(6), shard=700, block=40).collect()]
    want = brute(rows)
    assert len(got) == len(want) and recall(got, want) >= 0.9
    true = {(q, i): s for q, _, i, s in want}
    assert all(true[q, i] == s for q, _, i, s in got if (q, i) in true)
    for q in range(0, 2000, 400):
        mine = sorted(r[1:] for r in got if r[0] == q)
        assert [r[0] for r in mine] == list(range(1, 21)) and [(-r[2], r[1]) for r in mine] == sorted((-r[2], r[1]) for r in mine)


def test_few_rows_ties_repeats_and_rows_that_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (1, [2.0, 0.0]), (2, [2.0, 0.0]), (3, [-1.0, 1.0]), (3, [-1.0, 1.0]), (3, [4.0, 0.0]), (40, [0.0, 0.0]), (60, None), (80, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (None, [1.0, 1.0]), (0, [9.0, 9.0]), (7, [])]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS id", "2 AS v", "3 AS s")
    got = {tuple(r) for r in N.search(df).collect()}
    assert got == {r for r in brute(rows)}
    assert {r[0] for r in got} == {0, 20}
    few = [r for r in rows if r[0] in (3, 1, 20)]
    assert {tuple(r) for r in N.search(spark.createDataFrame(few, SCHEMA), k=2).collect()} == brute(few, k=2)


def test_no_rows_no_queries_and_other_widths(spark):
    df = spark.createDataFrame([(1, [1.0]), (2, [2.0])], SCHEMA)
    assert N.search(df).count() == 0 and N.search(df.limit(0)).count() == 0
    with pytest.raises(ValueError, match="components"):
        N.search(spark.createDataFrame([(0, [1.0]), (1, [1.0, 2.0])], SCHEMA)).count()


def test_copies_of_one_vector_are_a_third_of_all(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 16))
    x[::3] = x[0]
    rows = [(k, float32(v)) for k, v in enumerate(x)]
    got = {tuple(r) for r in N.search(spark.createDataFrame(rows, SCHEMA), shard=200).collect()}
    want = brute(rows)
    assert recall(got, want) >= 0.9
    assert {r for r in got if r[0] % 60 == 0} == {r for r in want if r[0] % 60 == 0}
