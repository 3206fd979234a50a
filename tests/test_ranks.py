"""Distributed positions and codes against sorted Python lists."""

import random

import pytest
from pyspark.sql import functions as F

from driftline.operators.ranks import dense_codes, positions
from driftline.sources import store


def test_positions_in_groups_with_nulls_ties_and_a_hot_group(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice(["a", "a", "a", "b", None]), rnd.choice([None, *range(40)]), k) for k in range(3000)]
    df = spark.createDataFrame(rows, "g string, v int, position_of long").repartition(7)
    got = positions(df, [F.col("v").asc_nulls_first(), F.col("position_of")], ["g"]).collect()
    for g in ("a", "b", None):
        mine = sorted((r for r in got if r.g == g), key=lambda r: r.position)
        want = sorted((x for x in rows if x[0] == g), key=lambda x: (x[1] is not None, x[1] or 0, x[2]))
        assert [(r.v, r.position_of) for r in mine] == [x[1:] for x in want]
        assert [r.position for r in mine] == list(range(len(want)))
        assert {r.group_size for r in mine} == {len(want)}


def test_positions_of_all_rows_descending_and_empty(spark):
    df = spark.range(1000).withColumn("v", F.col("id") * 7919 % 1009)
    got = positions(df, [F.desc("v")]).orderBy("position").collect()
    assert [r.v for r in got] == sorted((r.v for r in got), reverse=True)
    assert [r.position for r in got] == list(range(1000))
    assert positions(df.limit(0), [F.col("v")], ["id"]).count() == 0
    with pytest.raises(ValueError):
        positions(df.withColumn("position", F.lit(1)), [F.col("v")])


def test_codes_are_dense_and_nulls_first(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "x string")
    assert sorted((r.code, r.x) for r in dense_codes(df, "x").collect()) == [(0, None), (1, "a"), (2, "b"), (2, "b")]


def test_batches_of_one_start_shared_by_all_keys(spark):
    starts = spark.range(1000).select(F.format_string("k%04d", "id").alias("symbol"), F.lit("2024-01-01").cast("date").alias("start"))
    plan = store.batch_plan(starts, 30).orderBy("batch").collect()
    assert [len(p["keys"]) for p in plan] == [30] * 33 + [10]
    assert [k for p in plan for k in p["keys"]] == [f"k{n:04d}" for n in range(1000)]
