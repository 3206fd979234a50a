"""Streams into published tables: any order of files, late prices, batches that run twice, jobs that start again."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from driftline.sources.store import new_path
from driftline.sources.versions import Table
from driftline.streaming import bars as S

TICKS = "symbol string, date date, price double, id long"


def ticks(n=300, seed=2):
    rnd = random.Random(seed)
    return [(rnd.choice("abc"), datetime.date(2024, 1, 1) + datetime.timedelta(rnd.randrange(50)), round(rnd.uniform(1, 9), 2), k) for k in range(n)]


def put(spark, path, rows):
    spark.createDataFrame(rows, TICKS).coalesce(1).write.mode("append").parquet(path)


def stream(spark, path):
    return spark.readStream.schema(TICKS).option("maxFilesPerTrigger", 1).parquet(path).select("symbol", "date", "price", F.col("id").alias("order"))


def want(rows):
    days = {}
    for s, d, p, k in sorted(rows, key=lambda r: r[3]):
        days.setdefault((s, d), []).append(p)
    return {(s, d, ps[0], max(ps), min(ps), ps[-1], len(ps)) for (s, d), ps in days.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_files_in_any_order_give_the_bars_of_all_ticks(spark, seed):
    rows, path = ticks(), new_path(spark)
    parts = [rows[k::4] for k in range(4)]
    random.Random(seed).shuffle(parts)
    for part in parts:
        put(spark, path, part)
    got = S.stream_bars(stream(spark, path))
    assert {tuple(r) for r in got.collect()} == want(rows)


def test_a_job_goes_on_where_it_ended_and_late_prices_mend_stored_bars(spark):
    rows, path, home = ticks(), new_path(spark), new_path(spark)
    late, early = [r for r in rows if r[3] % 5 == 0], [r for r in rows if r[3] % 5]
    put(spark, path, early)
    assert {tuple(r) for r in S.stream_bars(stream(spark, path), home).collect()} == want(early)
    versions = Table(spark, home).versions()
    assert {tuple(r) for r in S.stream_bars(stream(spark, path), home).collect()} == want(early)
    assert Table(spark, home).versions() == versions  # nothing new, no version
    put(spark, path, late)
    assert {tuple(r) for r in S.stream_bars(stream(spark, path), home).collect()} == want(rows)
    far = [("a", datetime.date(2024, 6, 1), 5.0, 1000)]
    put(spark, path, far)
    S.stream_bars(stream(spark, path), home)
    put(spark, path, [("a", datetime.date(2024, 1, 2), 99.0, 1001)])  # over sixty days late
    assert {tuple(r) for r in S.stream_bars(stream(spark, path), home).collect()} == want(rows + far)


def test_a_batch_that_runs_again_after_its_merge_counts_once(spark, monkeypatch):
    """The job dies between the merge and its own note of the batch; started again it runs the batch again."""
    rows, path, home = ticks(60), new_path(spark), new_path(spark)
    put(spark, path, rows)
    real, calls = Table.merge, []

    def die_after(self, source, **kw):
        out = real(self, source, **kw)
        calls.append((kw["batch"], out))
        if len(calls) == 1:
            raise RuntimeError("lost")
        return out

    monkeypatch.setattr(Table, "merge", die_after)
    with pytest.raises(Exception, match="STREAM_FAILED"):
        S.stream_bars(stream(spark, path), home)
    got = S.stream_bars(stream(spark, path), home)
    assert {tuple(r) for r in got.collect()} == want(rows)
    assert calls[0] == calls[1] and Table(spark, home).versions() == [0, 1]


def test_keys_are_inserted_once_however_often_they_come(spark):
    rows, path, home = ticks(80), new_path(spark), new_path(spark)
    put(spark, path, rows)
    put(spark, path, rows[:30])
    s = lambda: stream(spark, path).select("symbol", "date")
    assert sorted(map(tuple, S.stream_distinct(s(), ["symbol", "date"], "date", home).collect())) == sorted({r[:2] for r in rows})
    put(spark, path, [*rows[:10], ("z", datetime.date(2024, 1, 3), 1.0, 99)])
    assert sorted(map(tuple, S.stream_distinct(s(), ["symbol", "date"], "date", home).collect())) == sorted({r[:2] for r in rows} | {("z", datetime.date(2024, 1, 3))})
    with pytest.raises(ValueError):
        S.stream_distinct(s(), ["symbol"], "date")


def test_bars_are_put_out_once_when_they_are_over(spark):
    """Two jobs on one path: open days wait in the state between them; prices in disorder and in several files."""
    from driftline.streaming.closing import closed_bars

    rows, path, home = ticks(200), new_path(spark), new_path(spark)
    at = lambda d: datetime.datetime(d.year, d.month, d.day, 12)
    early, late = [r for r in rows if r[1] < datetime.date(2024, 1, 25)], [r for r in rows if r[1] >= datetime.date(2024, 1, 25)]
    fields = "symbol string, time timestamp, price double, order long"

    def put_times(part):
        spark.createDataFrame([(s, at(d), p, k) for s, d, p, k in part], fields).coalesce(1).write.mode("append").parquet(path)

    run = lambda: closed_bars(spark.readStream.schema(fields).parquet(path), "3 days", home)
    over = lambda part, n: {b for b in want(part) if datetime.datetime(b[1].year, b[1].month, b[1].day) + datetime.timedelta(1) <= max(at(r[1]) for r in part) - datetime.timedelta(n)}
    for part in (early[::2], early[1::2]):
        put_times(part)
    assert {tuple(r) for r in run().collect()} == over(early, 3)
    put_times(late)
    got = [tuple(r) for r in run().collect()]
    assert len(got) == len(set(got)) and set(got) == over(rows, 3)


def test_a_late_price_of_an_open_day_counts_and_rows_without_a_price_do_not_close_a_bar(spark, monkeypatch):
    """In a zone that is not UTC, and without a row that passes through Python: bars took a round trip each that way."""
    from driftline.streaming import closing

    fields, path, home = "symbol string, time timestamp, price double, order long", new_path(spark), new_path(spark)
    run_into, plans = closing.run_into, []
    monkeypatch.setattr(closing, "run_into", lambda stream, *a, **kw: (plans.append(stream._jdf.queryExecution().analyzed().toString()), run_into(stream, *a, **kw))[1])
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        at = lambda day, hour: F.to_timestamp(F.lit(f"2024-01-{day:02} {hour:02}:00:00"))

        def put_times(*rows):
            part = spark.range(1).select(F.explode(F.array(*[F.struct(F.lit("a").alias("symbol"), at(d, h).alias("time"), F.lit(p).cast("double").alias("price"), F.lit(k).cast("long").alias("order")) for d, h, p, k in rows])).alias("r")).select("r.*")
            part.coalesce(1).write.mode("append").parquet(path)

        run = lambda: sorted(map(tuple, closing.closed_bars(spark.readStream.schema(fields).parquet(path), "1 day", home).collect()))
        put_times((1, 5, 3.0, 2), (1, 23, None, 9), (1, 1, None, 1), (2, 20, 4.0, 10))
        assert run() == []
        put_times((1, 2, 2.0, 3), (2, 23, 5.0, 11))
        assert run() == []
        put_times((1, 3, 7.0, 4), (3, 1, 6.0, 12))  # later than the lateness, but its day is still open
        first = ("a", datetime.date(2024, 1, 1), 3.0, 7.0, 2.0, 7.0, 5)
        assert run() == [first]
        put_times((1, 4, 9.0, 5), (4, 0, 1.0, 13))  # the first is over, the second ends now
        assert run() == [first, ("a", datetime.date(2024, 1, 2), 4.0, 5.0, 4.0, 5.0, 2)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert plans and not any("Python" in p or "Pandas" in p for p in plans)
