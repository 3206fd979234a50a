"""Published table versions: merges, replaced stretches, crashes, two writers, batches that run twice."""

import threading
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from driftline.operators.quality import RulesFailed
from driftline.sources import versions
from driftline.sources.store import new_path
from driftline.sources.versions import Conflict, Table

SCHEMA = "k int, p string, v string"


def rows(*items):
    return [(k, f"p{k % 3}" if k is not None else None, v) for k, v in items]


@pytest.fixture
def table(spark):
    return Table.create(spark.createDataFrame(rows(*[(k, "old") for k in range(9)], (None, "none")), SCHEMA), new_path(spark), ["k", "p"], ["p"])


def content(table, version=None):
    return {(r.k, r.v) for r in table.read(version).collect()}


def files(table):
    return {f: table._fs.getFileStatus(table._jvm.org.apache.hadoop.fs.Path(f)).getModificationTime() for f in table.read().inputFiles()}


def test_two_merges_one_after_the_other_and_old_versions(spark, table):
    df = lambda *x: spark.createDataFrame(rows(*x), SCHEMA)
    before = files(table)
    assert table.merge(df((0, "new"), (30, "new"))) == 1
    after = files(table)
    kept = {f for f in before if "p=p0" not in f}
    assert kept and {f: before[f] for f in kept} == {f: t for f, t in after.items() if f in kept}
    assert not any("p=p0" in f for f in set(before) & set(after))
    assert table.merge(df((0, "newer"), (1, "newer"), (None, "known"))) == 2
    old = {(k, "old") for k in range(9)} | {(None, "none")}
    assert content(table, 0) == old
    assert content(table, 1) == old - {(0, "old")} | {(0, "new"), (30, "new")}
    assert content(table) == {(k, "old") for k in range(2, 9)} | {(0, "newer"), (1, "newer"), (30, "new"), (None, "known")}
    assert table.vacuum() and content(table) == content(table, 2) and table.versions() == [2]


def test_insert_only_adds_files_and_a_second_run_publishes_nothing(spark, table):
    source = spark.createDataFrame(rows((0, "new"), (12, "new"), (None, "x")), SCHEMA)
    before = files(table)
    assert table.merge(source, update=False) == 1
    assert before.items() <= files(table).items()
    assert content(table) == {(k, "old") for k in range(9)} | {(12, "new"), (None, "none")}
    assert table.merge(source, update=False) == 1
    assert table.merge(source.limit(0)) == 1
    assert table.merge(spark.createDataFrame(rows((0, "u"), (99, "u")), SCHEMA), insert=False) == 2
    assert (0, "u") in content(table) and (99, "u") not in content(table)


def test_several_source_rows_of_a_key_or_other_columns_raise(spark, table):
    with pytest.raises(ValueError, match="several rows"):
        table.merge(spark.createDataFrame(rows((1, "a"), (1, "b")), SCHEMA))
    with pytest.raises(ValueError, match="columns"):
        table.overwrite(spark.createDataFrame([(1,)], "k int"))
    with pytest.raises(Conflict):
        Table.create(table.read(), table.path, ["k"])
    assert table.versions() == [0]


def test_a_merge_killed_before_the_swap_leaves_the_old_version(spark, table, monkeypatch):
    source = spark.createDataFrame(rows((0, "new")), SCHEMA)

    def die(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(Table, "_swap", die)
        with pytest.raises(KeyboardInterrupt):
            table.merge(source)
    assert table.versions() == [0] and (0, "old") in content(table)
    assert table.merge(source) == 1 and (0, "new") in content(table)
    assert len(table.vacuum(keep=2)) == 1
    assert (0, "old") in content(table, 0) and (0, "new") in content(table)


def test_of_two_writers_on_one_version_one_fails(spark, table, monkeypatch):
    gate, real, ends = threading.Barrier(2), Table._swap, []
    monkeypatch.setattr(Table, "_swap", lambda self, *a: (gate.wait(60), real(self, *a)))

    def write(k):
        try:
            ends.append((k, Table(spark, table.path).merge(spark.createDataFrame(rows((k, f"by{k}")), SCHEMA))))
        except Conflict:
            ends.append((k, None))

    both = [threading.Thread(target=write, args=(k,)) for k in (0, 1)]
    [t.start() for t in both]
    [t.join() for t in both]
    assert sorted(str(v) for _, v in ends) == ["1", "None"]
    winner = next(k for k, v in ends if v)
    assert (winner, f"by{winner}") in content(table) and (1 - winner, "old") in content(table)


def test_a_batch_that_runs_twice_counts_once(spark, table):
    df = lambda v: spark.createDataFrame(rows((0, v)), SCHEMA)
    assert table.merge(df("first"), batch=("job", 3)) == 1
    assert table.merge(df("again"), batch=("job", 3)) == 1
    assert table.merge(df("older"), batch=("job", 2)) == 1
    assert table.merge(df("other"), batch=("else", 0)) == 2
    assert (0, "other") in content(table)


def test_rules_that_fail_leave_the_old_version(spark, table):
    rules = {("not_null", "v"): F.col("v").isNull(), ("known", "p"): F.col("p") == "p9"}
    with pytest.raises(RulesFailed, match="not_null of v: 1 rows"):
        table.merge(spark.createDataFrame([(0, "p0", None)], SCHEMA), rules=rules)
    assert table.versions() == [0] and table.vacuum() == []
    assert table.merge(spark.createDataFrame([(0, "p0", "fine")], SCHEMA), rules=rules) == 1


def test_a_stretch_is_replaced_and_older_partitions_stay(spark):
    day = lambda n: date(2024, 1, 1) + timedelta(n)
    df = spark.createDataFrame([(day(n), f"{day(n):%Y-%m}", n) for n in range(120)], "d date, month string, v int")
    table = Table.create(df, new_path(spark), ["d"], ["month"])
    before = files(table)
    fresh = df.filter(F.col("d") >= day(70)).filter("month <> '2024-04'").withColumn("v", F.lit(-1))
    table.replace_from("d", day(70), fresh)
    after = files(table)
    assert {f: t for f, t in before.items() if "month=2024-01" in f or "month=2024-02" in f}.items() <= after.items()
    assert sorted((r.d, r.v) for r in table.read().collect()) == [(day(n), n if n < 70 else -1) for n in range(91)]
    assert {r.month for r in table.read().select("month").distinct().collect()} == {"2024-01", "2024-02", "2024-03"}


def test_partition_names_of_all_kinds(spark):
    df = spark.createDataFrame([(1, "a/b", True), (2, "x y", False), (3, None, True), (4, "ü=%", None)], "k int, p string, q boolean")
    table = Table.create(df, new_path(spark), ["k"], ["p", "q"])
    table.replace_from("k", 2, df.filter("k > 2"))
    assert {tuple(r) for r in table.read().collect()} == {(1, "a/b", True), (3, None, True), (4, "ü=%", None)}
    plain = Table.create(df, new_path(spark), ["k"])
    plain.merge(df.filter("k = 1").withColumn("p", F.lit("z")))
    assert {r.p for r in plain.read().collect()} == {"z", "x y", None, "ü=%"}
    assert versions.Table(spark, plain.path).versions() == [0, 1]


def test_the_last_days_are_built_anew_from_their_rows_alone(spark, capsys):
    """A late load: the watermark reaches the scan as a literal, older months' files stay, a second run changes nothing."""
    from driftline.sources import increments

    path, day = new_path(spark), lambda n: date(2024, 1, 1) + timedelta(n)
    ticks = spark.createDataFrame([(day(n), float(n + k)) for n in range(150) for k in (0, 1)], "d date, x double")
    ticks.write.parquet(path)
    asked = []

    def build(start):
        t = spark.read.parquet(path)
        asked.append(t if start is None else t.filter(F.col("d") >= F.lit(start)))
        return asked[-1].groupBy("d").agg(F.sum("x").alias("x"), F.count("*").alias("n")).withColumn("month", F.date_format("d", "yyyy-MM"))

    early = ticks.filter((F.col("d") < F.lit(day(100))) | (F.col("x") % 2 == 0)).groupBy("d").agg(F.sum("x").alias("x"), F.count("*").alias("n"))
    table = Table.create(early.withColumn("month", F.date_format("d", "yyyy-MM")), new_path(spark), ["d"], ["month"])
    assert increments.high_water_mark(table, "d") == day(149)
    before = files(table)
    assert increments.reload_stretch(table, build, 60, "d") == 1
    asked[-1].explain()
    assert "PushedFilters: [IsNotNull(d), GreaterThanOrEqual(d,2024-03-30)]" in capsys.readouterr().out
    after = files(table)
    assert {f: t for f, t in before.items() if "month=2024-01" in f or "month=2024-02" in f}.items() <= after.items()
    want = {(day(n), 2.0 * n + 1, 2) for n in range(150)}
    assert {(r.d, r.x, r.n) for r in table.read().collect()} == want
    increments.reload_stretch(table, build, 60, "d")
    assert {(r.d, r.x, r.n) for r in table.read().collect()} == want
    empty = Table.create(table.read().limit(0), new_path(spark), ["d"], ["month"])
    increments.reload_stretch(empty, build, 60, "d")
    assert {(r.d, r.x, r.n) for r in empty.read().collect()} == want
