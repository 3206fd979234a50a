"""Queries of joins, aggregations, windows, top-k, set operations and portfolios over the price panel."""

from __future__ import annotations

from functools import reduce
from math import isnan

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Correlation
from pyspark.sql import Window
from pyspark.sql import functions as F

from driftline.functions.expr import business_month_end, normal_cdf, r, ratio, week_ending
from driftline.operators import bars as B
from driftline.operators import grids, joins, membership, quantiles, scans
from driftline.operators import portfolio as P
from driftline.operators import windows as W
from driftline.operators.chunks import in_chunks
from driftline.plans.catalog import bars, changes, fundamentals, market, query, sql, weekly
from driftline.sources.store import dedup, scan, written

SD = ["symbol", "date"]


def over(*cols: str, order: str = "date", frame: str = "") -> str:
    return f"OVER (PARTITION BY {', '.join(cols)} ORDER BY {order} {frame})"


SYM = "PARTITION BY symbol ORDER BY date"
RET = "close / lag(close) OVER (PARTITION BY symbol ORDER BY date) - 1"
RATE = "(3.0 + (dayofyear(date) % 20) / 10.0) / 100 / 252"


def rets(spark, sf):
    return bars(spark, sf).withColumn("ret", W.pct_change("close"))


# joins


@query("inner_equi_snapshot", sql("SELECT symbol, m AS date, close, round(hi, 2) AS hi FROM (SELECT symbol, date_trunc('month', date)::DATE AS m, arg_max(close, date) AS close, max(high) AS hi FROM bars GROUP BY 1, 2)", "bars"))
def inner_equi_snapshot(spark, sf):
    b = bars(spark, sf).withColumn("m", F.trunc("date", "month"))
    snap = dedup(b, ["symbol", "m"], [F.desc("date")]).select("symbol", "m", "close")
    return snap.join(b.groupBy("symbol", "m").agg(F.max("high").alias("hi")), ["symbol", "m"]).select("symbol", F.col("m").alias("date"), "close", r("hi", 2).alias("hi"))


@query("semi_valid_keys", sql("SELECT symbol, date FROM bars WHERE symbol IN (SELECT symbol FROM bars GROUP BY 1 HAVING count(*) > 520)", "bars"))
def semi_valid_keys(spark, sf):
    b = bars(spark, sf).select(*SD)
    return b.join(b.groupBy("symbol").count().filter("count > 520").select("symbol"), "symbol", "left_semi")


@query("left_macro", sql(f"SELECT b.symbol, date, round(ret - mret, 6) AS excess FROM (SELECT symbol, date, ret FROM rets) b LEFT JOIN (SELECT date, level / lag(level) OVER (ORDER BY date) - 1 AS mret FROM market) m USING (date)", "rets", "market"))
def left_macro(spark, sf):
    m = market(spark, sf).withColumn("one", F.lit("M")).select("date", W.pct_change("level", key="one").alias("mret"))
    return rets(spark, sf).join(m, "date", "left").select("symbol", "date", r(F.col("ret") - F.col("mret")).alias("excess"))


@query("left_week_key", sql("SELECT w.symbol, w.date, round(m.level, 6) AS level FROM weekly w LEFT JOIN (SELECT date_trunc('week', date)::DATE AS wk, max(level) AS level FROM market GROUP BY 1) m ON date_trunc('week', w.date)::DATE = m.wk", "weekly", "market"))
def left_week_key(spark, sf):
    wk = lambda: F.to_date(F.date_trunc("week", "date")).alias("wk")
    m = market(spark, sf).groupBy(wk()).agg(F.max("level").alias("level"))
    return weekly(spark, sf).withColumn("wk", wk()).join(m, "wk", "left").select("symbol", "date", r("level", 6).alias("level"))


FULL_A, FULL_B = "SELECT date, close AS a FROM bars WHERE symbol = '1'", "SELECT date, close AS b FROM bars WHERE symbol = '2'"


@query("full_outer_two", sql(f"SELECT coalesce(x.date, y.date) AS date, a, b FROM ({FULL_A}) x FULL JOIN ({FULL_B}) y ON x.date = y.date", "bars"))
def full_outer_two(spark, sf):
    b = bars(spark, sf)
    one = lambda s, n: b.filter(F.col("symbol") == s).select("date", F.col("close").alias(n))
    return one("1", "a").join(one("2", "b"), "date", "full")


@query("full_outer_enrich", sql("SELECT coalesce(e.symbol, c.symbol) AS symbol, n_events, c.name FROM (SELECT symbol, count(*) AS n_events FROM changes GROUP BY 1) e FULL JOIN (SELECT CAST(c_custkey AS VARCHAR) AS symbol, c_name AS name FROM customer) c ON e.symbol = c.symbol", "changes"))
def full_outer_enrich(spark, sf):
    c = scan(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("symbol"), F.col("c_name").alias("name"))
    return changes(spark, sf).groupBy("symbol").agg(F.count("*").alias("n_events")).join(c, "symbol", "full")


@query("full_outer_master", sql("SELECT symbol, date, max(close) AS close, max(revenue) AS revenue, max(n) AS n FROM (SELECT symbol, date, close, NULL AS revenue, NULL AS n FROM bars UNION ALL SELECT symbol, date, NULL, revenue, NULL FROM fund UNION ALL SELECT symbol, date, NULL, NULL, n FROM (SELECT symbol, date, count(*) AS n FROM changes GROUP BY 1, 2)) GROUP BY 1, 2", "bars", "fund", "changes"))
def full_outer_master(spark, sf):
    parts = [bars(spark, sf).select(*SD, "close"), fundamentals(spark, sf).select(*SD, "revenue"), changes(spark, sf).groupBy(*SD).agg(F.count("*").alias("n"))]
    return reduce(lambda a, b: a.join(b, SD, "full"), parts)


SPELLS = """d AS (SELECT * FROM (SELECT *, lag(event) OVER (PARTITION BY symbol ORDER BY date, event) AS pe FROM changes) WHERE pe IS NULL OR pe <> event),
n AS (SELECT symbol, date, event, lead(event) OVER (PARTITION BY symbol ORDER BY date, event) AS ne, lead(date) OVER (PARTITION BY symbol ORDER BY date, event) AS nd FROM d),
spells AS (SELECT symbol, start, coalesce(fin, DATE '2024-02-15') AS "end" FROM (SELECT symbol, CASE WHEN ne = 'REMOVE' THEN nd END AS fin, min(date) AS start FROM n WHERE event = 'ADD' GROUP BY 1, 2) WHERE start <= coalesce(fin, DATE '2024-02-15'))"""
EVENT_DAYS = "SELECT event_id, CAST(user_id AS VARCHAR) AS symbol, CAST(ts AS DATE) AS date FROM events"


def _spells(spark, sf):
    return membership.spells(changes(spark, sf), "2024-02-15")


@query("interval_join", sql(f"WITH {SPELLS} SELECT event_id, symbol, date FROM ({EVENT_DAYS}) e WHERE EXISTS (SELECT 1 FROM spells s WHERE s.symbol = e.symbol AND e.date BETWEEN s.start AND s.\"end\")", "changes"))
def interval_join(spark, sf):
    e = scan(spark, sf, "events").select("event_id", F.col("user_id").cast("string").alias("symbol"), F.to_date("ts").alias("date"))
    return joins.interval(e, _spells(spark, sf))


@query("membership_history", sql(f'WITH {SPELLS} SELECT symbol, start, "end" FROM spells', "changes"))
def membership_history(spark, sf):
    return _spells(spark, sf)


@query("event_to_spell", sql("""SELECT symbol, start, "end" FROM (SELECT symbol, event, date AS start, CASE WHEN ne = 'REMOVE' THEN nd ELSE DATE '2024-02-15' END AS "end" FROM (SELECT *, lead(event) OVER w AS ne, lead(date) OVER w AS nd FROM changes WINDOW w AS (PARTITION BY symbol ORDER BY date, event))) WHERE event = 'ADD' AND start <= "end\"""", "changes"))
def event_to_spell(spark, sf):
    return membership.event_to_spell(changes(spark, sf), "2024-02-15")


@query("event_dedup", sql("SELECT symbol, date, event FROM (SELECT *, lag(event) OVER (PARTITION BY symbol ORDER BY date, event) AS pe FROM changes) WHERE pe IS NULL OR pe <> event", "changes"))
def event_dedup(spark, sf):
    return membership.event_dedup(changes(spark, sf))


@query("membership_snapshots", sql(f'WITH {SPELLS} SELECT c.date, count(DISTINCT s.symbol) AS n, string_agg(DISTINCT s.symbol, \',\' ORDER BY s.symbol) AS members FROM (SELECT DISTINCT date FROM changes) c JOIN spells s ON c.date BETWEEN s.start AND s."end" GROUP BY 1', "changes"))
def membership_snapshots(spark, sf):
    """The members on each date of a change."""
    s = membership.snapshots(_spells(spark, sf), changes(spark, sf).select("date").distinct())
    return s.select("date", F.size("members").cast("long").alias("n"), F.array_join("members", ",").alias("members"))


for _name, _fwd, _op in (("asof_backward", False, ">="), ("asof_forward", True, "<=")):

    @query(_name, sql(f"SELECT b.symbol, b.date, b.close, f.revenue FROM bars b ASOF LEFT JOIN fund f ON b.symbol = f.symbol AND b.date {_op} f.date", "bars", "fund"))
    def asof_query(spark, sf, fwd=_fwd):
        return joins.asof(bars(spark, sf).select(*SD, "close"), fundamentals(spark, sf), ["revenue"], forward=fwd)


@query("asof_backward_global", sql("SELECT b.symbol, b.date, round(m.level, 6) AS level FROM bars b ASOF LEFT JOIN (SELECT * FROM market WHERE dayofmonth(date) = 1) m ON b.date >= m.date", "bars", "market"))
def asof_backward_global(spark, sf):
    left = bars(spark, sf).select(*SD)
    m = market(spark, sf).filter("dayofmonth(date) = 1").select("date", F.lead("date").over(Window.orderBy("date")).alias("till"), "level")
    m = m.crossJoin(F.broadcast(left.agg(F.max("date").alias("end"))))  # one row: the last level holds to the last date, however far
    days = m.select(F.explode(F.sequence("date", F.coalesce(F.date_sub("till", 1), F.greatest("date", "end")))).alias("date"), "level")
    return left.join(days, "date", "left").select(*SD, r("level", 6).alias("level"))


@query("calendar_grid", sql("SELECT k.symbol, d.date, b.close FROM (SELECT DISTINCT symbol FROM bars) k CROSS JOIN (SELECT CAST(x AS DATE) AS date FROM (SELECT unnest(generate_series(TIMESTAMP '1999-01-01', TIMESTAMP '1999-12-31', INTERVAL 1 DAY)) AS x) WHERE isodow(x) < 6) d LEFT JOIN bars b ON b.symbol = k.symbol AND b.date = d.date", "bars"))
def calendar_grid(spark, sf):
    return B.calendar_grid(bars(spark, sf).select(*SD, "close"), "1999-01-01", "1999-12-31", keep=F.weekday("date") < 5).select(*SD, "close")


@query("inner_ratio", sql("SELECT b.symbol, b.date, round(b.close / m.level, 6) AS ratio FROM bars b LEFT JOIN market m ON b.date = m.date", "bars", "market"))
def inner_ratio(spark, sf):
    return bars(spark, sf).join(market(spark, sf), "date", "left").select("symbol", "date", r(ratio("close", "level")).alias("ratio"))


TOP5 = "SELECT symbol, date, close, dense_rank() OVER (ORDER BY date) AS p FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY close DESC, symbol) AS k FROM weekly) WHERE k <= 5"


@query("period_set_diff", sql(f"SELECT a.symbol, a.date FROM ({TOP5}) a WHERE NOT EXISTS (SELECT 1 FROM ({TOP5}) b WHERE b.symbol = a.symbol AND b.p = a.p - 1)", "weekly"))
def period_set_diff(spark, sf):
    top = weekly(spark, sf).withColumn("k", W.rank_first("close")).filter("k <= 5").select(*SD)
    dates = top.select("date").distinct().select("date", F.dense_rank().over(Window.orderBy("date")).alias("p"))
    held = top.join(dates, "date")
    return held.join(held.select("symbol", (F.col("p") + 1).alias("p")), ["symbol", "p"], "left_anti").select(*SD)


@query("intersect_calendar", "SELECT CAST(o_orderdate AS DATE) AS date FROM orders INTERSECT SELECT CAST(l_shipdate AS DATE) FROM lineitem")
def intersect_calendar(spark, sf):
    return scan(spark, sf, "orders").select(F.to_date("o_orderdate").alias("date")).intersect(scan(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("date")))


@query("intersect_keys", sql("SELECT symbol, CAST(date_trunc('quarter', date) AS DATE) AS date FROM bars INTERSECT SELECT symbol, date FROM fund", "bars", "fund"))
def intersect_keys(spark, sf):
    """The keys (symbol, quarter) that prices and fundamentals share."""
    priced = bars(spark, sf).select("symbol", F.trunc("date", "quarter").alias("date"))
    return priced.intersect(fundamentals(spark, sf).select(*SD))


@query("config_join", sql("SELECT 'ma' || CAST(n AS VARCHAR) AS config, n, w.symbol, w.date, round((w.total - coalesce(o.total, 0)) / least(n, w.k) / w.close, 6) AS ma FROM (SELECT symbol, date, close, row_number() OVER (PARTITION BY symbol ORDER BY date) AS k, sum(close) OVER (PARTITION BY symbol ORDER BY date) AS total FROM weekly) w CROSS JOIN (SELECT CAST(unnest(range(3, 50, 4)) AS INTEGER) AS n) LEFT JOIN (SELECT symbol, row_number() OVER (PARTITION BY symbol ORDER BY date) AS k, sum(close) OVER (PARTITION BY symbol ORDER BY date) AS total FROM weekly) o ON o.symbol = w.symbol AND o.k = w.k - n", "weekly"))
def config_join(spark, sf):
    """The means of a table of configurations, whatever their number, over one pass of the panel; as shares of the price."""
    configs = spark.range(3, 50, 4).select(F.concat(F.lit("ma"), F.col("id")).alias("config"), F.col("id").cast("int").alias("n"))
    w = written(weekly(spark, sf).select(*SD, "close"))
    return grids.config_means(w, configs).join(w, SD).select("config", "n", *SD, r(F.col("mean") / F.col("close")).alias("ma"))


@query("left_weights", sql("SELECT symbol, date, CASE WHEN k <= 4 THEN 0.25::DOUBLE ELSE 0.0::DOUBLE END AS weight FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY close DESC, symbol) AS k FROM weekly)", "weekly"))
def left_weights(spark, sf):
    return weekly(spark, sf).withColumn("k", W.rank_first("close")).select(*SD, F.when(F.col("k") <= 4, 0.25).otherwise(0.0).alias("weight"))


# aggregations


@query("ohlcv_weekly_fri", sql("SELECT symbol, date, open, high, low, close, volume FROM weekly", "weekly"))
def ohlcv_weekly_fri(spark, sf):
    return weekly(spark, sf).select(*SD, "open", "high", "low", "close", "volume")


def _bars_sql(bin_: str) -> str:
    return sql(f"SELECT symbol, {bin_} AS date, arg_min(open, date) AS open, max(high) AS high, min(low) AS low, arg_max(close, date) AS close, CAST(sum(volume) AS BIGINT) AS volume FROM bars GROUP BY symbol, {bin_}", "bars")


def _bme(d: str) -> str:
    return f"(last_day({d}) - CAST(greatest(isodow(last_day({d})) - 5, 0) AS INTEGER))"


for _name, _bin, _sql in (
    ("ohlcv_monthly_bm", business_month_end, f"CASE WHEN date <= {_bme('date')} THEN {_bme('date')} ELSE {_bme('CAST(last_day(date) + 1 AS DATE)')} END"),
    ("ohlcv_weekly_sun", lambda c: week_ending(c, "SUN"), "date + CAST((14 - isodow(date)) % 7 AS INTEGER)"),
):

    @query(_name, _bars_sql(_sql))
    def bars_query(spark, sf, bin_=_bin):
        return B.bars(bars(spark, sf), bin_("date")).select(*SD, "open", "high", "low", "close", "volume")


@query("ohlcv_weekly_iso", sql("SELECT symbol, max(date) AS date, arg_min(open, date) AS open, max(high) AS high, min(low) AS low, arg_max(close, date) AS close, CAST(sum(volume) AS BIGINT) AS volume FROM bars GROUP BY symbol, date_trunc('week', date)", "bars"))
def ohlcv_weekly_iso(spark, sf):
    b = B.bars(bars(spark, sf), F.to_date(F.date_trunc("week", "date")))
    return b.select("symbol", F.col("last_date").alias("date"), "open", "high", "low", "close", "volume")


@query("period_return_stats", sql("SELECT symbol, date_trunc('month', date)::DATE AS month, round(stddev_samp(ret), 6) AS retvol, round(max(ret), 6) AS maxret FROM rets GROUP BY 1, 2", "rets"))
def period_return_stats(spark, sf):
    return rets(spark, sf).groupBy("symbol", F.trunc("date", "month").alias("month")).agg(r(F.stddev_samp("ret")).alias("retvol"), r(F.max("ret")).alias("maxret"))


@query("amihud_illiquidity", sql("SELECT symbol, year(date) AS year, round(avg(abs(ret) / (close * volume)) * 1e6, 6) AS illiq FROM rets GROUP BY 1, 2", "rets"))
def amihud_illiquidity(spark, sf):
    return rets(spark, sf).groupBy("symbol", F.year("date").cast("long").alias("year")).agg(r(F.avg(ratio(F.abs("ret"), F.col("close") * F.col("volume"))) * 1e6).alias("illiq"))


@query("compound_return", sql("SELECT symbol, year(date) AS year, round(exp(sum(ln(1 + ret))) - 1, 6) AS ret FROM rets WHERE ret > -1 GROUP BY 1, 2", "rets"))
def compound_return(spark, sf):
    return rets(spark, sf).filter("ret > -1").groupBy("symbol", F.year("date").cast("long").alias("year")).agg(r(F.exp(F.sum(F.log1p("ret"))) - 1).alias("ret"))


@query("capm_beta", sql("SELECT symbol, round(covar_samp(ret, mret) / nullif(var_samp(mret), 0), 6) AS beta FROM rets JOIN (SELECT date, level / lag(level) OVER (ORDER BY date) - 1 AS mret FROM market) m USING (date) WHERE ret IS NOT NULL AND mret IS NOT NULL GROUP BY 1", "rets", "market"))
def capm_beta(spark, sf):
    m = market(spark, sf).withColumn("one", F.lit("M")).select("date", W.pct_change("level", key="one").alias("mret"))
    j = rets(spark, sf).join(m, "date").filter("ret is not null and mret is not null")
    return j.groupBy("symbol").agg(r(ratio(F.covar_samp("ret", "mret"), F.var_samp("mret"))).alias("beta"))


@query("beta_diagnostics", sql("SELECT symbol, count(*) AS days, count(*) FILTER (WHERE ret = 0) AS zero, count(*) FILTER (WHERE ret IS NULL) AS missing FROM rets GROUP BY 1", "rets"))
def beta_diagnostics(spark, sf):
    return rets(spark, sf).groupBy("symbol").agg(F.count("*").alias("days"), F.count_if(F.col("ret") == 0).alias("zero"), F.count_if(F.col("ret").isNull()).alias("missing"))


@query("pivot_symbols", sql("SELECT date, max(CASE WHEN symbol = '1' THEN close END) AS a, max(CASE WHEN symbol = '2' THEN close END) AS b, round(max(CASE WHEN symbol = '1' THEN close END) / max(CASE WHEN symbol = '2' THEN close END), 6) AS ratio FROM weekly GROUP BY 1", "weekly"))
def pivot_symbols(spark, sf):
    p = weekly(spark, sf).groupBy("date").pivot("symbol", ["1", "2"]).agg(F.first("close"))
    return p.select("date", F.col("1").alias("a"), F.col("2").alias("b"), r(ratio("1", "2")).alias("ratio"))


@query("max_by_key", sql("SELECT symbol, max(date) AS last FROM bars GROUP BY 1", "bars"))
def max_by_key(spark, sf):
    return bars(spark, sf).groupBy("symbol").agg(F.max("date").alias("last"))


@query("count_by_key", sql("SELECT symbol, count(*) AS n FROM bars GROUP BY 1", "bars"))
def count_by_key(spark, sf):
    return bars(spark, sf).groupBy("symbol").agg(F.count("*").alias("n"))


@query("min_start_per_end", sql("SELECT symbol, CASE WHEN event = 'ADD' THEN NULL ELSE date END AS fin, min(date) AS start FROM changes GROUP BY 1, 2", "changes"))
def min_start_per_end(spark, sf):
    return changes(spark, sf).groupBy("symbol", F.when(F.col("event") != "ADD", F.col("date")).alias("fin")).agg(F.min("date").alias("start"))


@query("dedup_keys", "SELECT symbol, date, id FROM (SELECT CAST(c_nationkey AS VARCHAR) AS symbol, CAST(o_orderdate AS DATE) AS date, o_orderkey AS id, row_number() OVER (PARTITION BY c_nationkey, CAST(o_orderdate AS DATE) ORDER BY o_orderkey) AS k FROM orders JOIN customer ON o_custkey = c_custkey) WHERE k = 1")
def dedup_keys(spark, sf):
    t = scan(spark, sf, "orders").join(scan(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return dedup(t.select(F.col("c_nationkey").cast("string").alias("symbol"), F.to_date("o_orderdate").alias("date"), F.col("o_orderkey").alias("id")), SD, ["id"])


@query("distinct_values", sql("SELECT date, count(DISTINCT symbol) AS n FROM bars GROUP BY 1", "bars"))
def distinct_values(spark, sf):
    return bars(spark, sf).groupBy("date").agg(F.countDistinct("symbol").alias("n"))


@query("dollar_volume_benchmark", sql("SELECT date, round(sum(close * volume * nx) / sum(close * volume), 6) AS bench FROM (SELECT *, lead(close) OVER (PARTITION BY symbol ORDER BY date) / close - 1 AS nx FROM weekly) WHERE nx IS NOT NULL GROUP BY 1", "weekly"))
def dollar_volume_benchmark(spark, sf):
    w = weekly(spark, sf).withColumn("nx", W.forward_return("close")).filter("nx is not null").withColumn("w", F.col("close") * F.col("volume"))
    return w.groupBy("date").agg(r(ratio(F.sum(F.col("w") * F.col("nx")), F.sum("w"))).alias("bench"))


@query("value_counts", "SELECT label, count(*) AS n FROM embeddings GROUP BY 1")
def value_counts(spark, sf):
    return scan(spark, sf, "embeddings").groupBy("label").agg(F.count("*").alias("n"))


@query("class_weights", "SELECT label, round(sum(n) OVER () / (count(*) OVER () * n), 6) AS weight FROM (SELECT label, count(*) AS n FROM embeddings GROUP BY 1)")
def class_weights(spark, sf):
    g, w = scan(spark, sf, "embeddings").groupBy("label").agg(F.count("*").alias("n")), Window.partitionBy()
    return g.select("label", r(F.sum("n").over(w) / (F.count("*").over(w) * F.col("n"))).alias("weight"))


@query("null_counts", sql("SELECT count(*) FILTER (WHERE ret IS NULL) AS ret, count(*) FILTER (WHERE close IS NULL) AS close FROM rets", "rets"))
def null_counts(spark, sf):
    return rets(spark, sf).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in ("ret", "close")])


def _corr(spark, sf):
    """(a, b, corr) of all pairs of the embedding's components, a before b, named f0, f1, ...; rows with a null are left
    out. One matrix of the components' products is added up over the tasks; its size is the width squared, whatever the
    rows. A component that does not vary has a null correlation."""
    e = scan(spark, sf, "embeddings").filter("forall(embedding, x -> x is not null)").select(array_to_vector(F.col("embedding").cast("array<double>")).alias("v"))
    m = Correlation.corr(e, "v").first()[0].toArray()
    at = [(f"f{a}", f"f{b}", None if isnan(m[a, b]) else float(m[a, b])) for a in range(len(m)) for b in range(a + 1, len(m))]
    return spark.createDataFrame(at, "a string, b string, corr double")


CORR = "SELECT 'f' || i AS a, 'f' || j AS b, corr(CAST(embedding[i + 1] AS DOUBLE), CAST(embedding[j + 1] AS DOUBLE)) AS corr FROM embeddings JOIN (SELECT i, j FROM range(64) x(i), range(64) y(j) WHERE i < j) ON TRUE WHERE embedding IS NOT NULL GROUP BY i, j"


@query("correlation_matrix", f"SELECT a, b, round(corr, 6) AS corr FROM ({CORR})")
def correlation_matrix(spark, sf):
    return _corr(spark, sf).select("a", "b", r("corr").alias("corr"))


@query("corr_filter", f"SELECT DISTINCT b AS dropped FROM ({CORR}) WHERE abs(corr) > 0.05")
def corr_filter(spark, sf):
    return _corr(spark, sf).filter(F.abs("corr") > 0.05).select(F.col("b").alias("dropped")).distinct()


@query("top_corr_pairs", f"SELECT a, b, round(corr, 6) AS corr FROM ({CORR}) ORDER BY abs(corr) DESC NULLS LAST, a, b LIMIT 5")
def top_corr_pairs(spark, sf):
    return _corr(spark, sf).orderBy(F.desc_nulls_last(F.abs("corr")), "a", "b").limit(5).select("a", "b", r("corr").alias("corr"))


@query("confusion_mcc", "SELECT tp, tn, fp, fn, round(CASE WHEN (tp + fp) * (tp + fn) * (tn + fp) * (tn + fn) = 0 THEN 0 ELSE (tp * tn - fp * fn) / sqrt((tp + fp)::DOUBLE * (tp + fn) * (tn + fp) * (tn + fn)) END, 6) AS mcc FROM (SELECT count(*) FILTER (WHERE quality = 1 AND toxic = 1) AS tp, count(*) FILTER (WHERE quality = 0 AND toxic = 0) AS tn, count(*) FILTER (WHERE quality = 0 AND toxic = 1) AS fp, count(*) FILTER (WHERE quality = 1 AND toxic = 0) AS fn FROM labels)")
def confusion_mcc(spark, sf):
    hit = lambda q, t: F.count_if((F.col("quality") == q) & (F.col("toxic") == t))
    c = scan(spark, sf, "labels").agg(hit(1, 1).alias("tp"), hit(0, 0).alias("tn"), hit(0, 1).alias("fp"), hit(1, 0).alias("fn"))
    den = F.expr("cast(tp + fp as double) * (tp + fn) * (tn + fp) * (tn + fn)")
    return c.select("*", r(F.coalesce(ratio(F.expr("tp * tn - fp * fn"), F.sqrt(den)), F.lit(0.0))).alias("mcc"))


@query("r2_oos", "SELECT round(1 - sum((quality - toxic) * (quality - toxic)) / sum(quality * quality), 6) AS r2 FROM labels")
def r2_oos(spark, sf):
    e = F.col("quality") - F.col("toxic")
    return scan(spark, sf, "labels").agg(r(1 - ratio(F.sum(e * e), F.sum(F.col("quality") * F.col("quality")))).alias("r2"))


def avg_rank(x: str, part: str) -> str:
    return f"(rank() OVER (PARTITION BY {part} ORDER BY {x}) + (count(*) OVER (PARTITION BY {part}, {x}) - 1) / 2.0)"


@query("spearman_ic", sql(f"SELECT date, round(coalesce(CASE WHEN isnan(c) THEN 0 ELSE c END, 0), 6) AS ic FROM (SELECT date, corr(a, b) AS c FROM (SELECT date, {avg_rank('close', 'date')} AS a, {avg_rank('volume', 'date')} AS b FROM weekly) GROUP BY 1)", "weekly"))
def spearman_ic(spark, sf):
    w = weekly(spark, sf).select("date", W.rank_average("close").alias("a"), W.rank_average("volume").alias("b"))
    c = ratio(F.covar_pop("a", "b"), F.stddev_pop("a") * F.stddev_pop("b"))  # null, not an error, where ranks do not vary
    return w.groupBy("date").agg(r(F.coalesce(c, F.lit(0.0))).alias("ic"))


@query("period_last_price", sql("SELECT symbol, last_day(date) AS period, arg_max(close, date) AS close FROM bars GROUP BY 1, 2", "bars"))
def period_last_price(spark, sf):
    return bars(spark, sf).groupBy("symbol", F.last_day("date").alias("period")).agg(F.max_by("close", "date").alias("close"))


# windows: (key, column, SQL expression, digits, panel)
SIMPLE = [
    ("daily_return", lambda: W.pct_change("close"), RET, 6, "bars"),
    ("pct_change_n", lambda: W.pct_change("close", 4), f"close / lag(close, 4) OVER ({SYM}) - 1", 6, "weekly"),
    ("next_return", lambda: W.forward_return("close"), f"lead(close) OVER ({SYM}) / close - 1", 6, "weekly"),
    ("forward_return_n", lambda: W.forward_return("close", 4), f"lead(close, 4) OVER ({SYM}) / close - 1", 6, "weekly"),
    ("sma", lambda: W.sma("close", 10), f"CASE WHEN count(close) OVER ({SYM} ROWS 9 PRECEDING) = 10 THEN avg(close) OVER ({SYM} ROWS 9 PRECEDING) END", 3, "weekly"),
    ("sma_min1", lambda: W.sma("close", 10, 1), f"avg(close) OVER ({SYM} ROWS 9 PRECEDING)", 3, "weekly"),
    ("high52", lambda: F.col("close") / W.rolling(F.max, "close", 52), f"close / max(close) OVER ({SYM} ROWS 51 PRECEDING)", 6, "weekly"),
    ("bollinger", lambda: W.rolling(F.avg, "close", 20, -1) - 2 * W.rolling(F.stddev_samp, "close", 20, -1), f"avg(close) OVER ({SYM} ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) - 2 * stddev_samp(close) OVER ({SYM} ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)", 3, "weekly"),
    ("donchian", lambda: W.rolling(F.max, "high", 20, -1), f"max(high) OVER ({SYM} ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)", 3, "weekly"),
    ("true_range", lambda: W.true_range(), f"greatest(high - low, abs(high - lag(close) OVER ({SYM})), abs(low - lag(close) OVER ({SYM})))", 3, "weekly"),
    ("shift_weights", lambda: F.lag("close").over(W.by_time()), f"lag(close) OVER ({SYM})", 3, "weekly"),
    ("ytd_anchor", lambda: F.col("close") / F.first("close").over(Window.partitionBy("symbol", F.year("date")).orderBy("date")) - 1, "close / first_value(close) OVER (PARTITION BY symbol, year(date) ORDER BY date) - 1", 6, "weekly"),
    ("cs_rank_norm", lambda: W.rank_scaled("close"), "CASE WHEN count(close) OVER (PARTITION BY date) <= 1 THEN 0.0 ELSE 2.0 * (rank() OVER (PARTITION BY date ORDER BY close) - 1) / (count(close) OVER (PARTITION BY date) - 1) - 1 END", 6, "weekly"),
    ("rank_first", lambda: W.rank_first("volume").cast("double"), "row_number() OVER (PARTITION BY date ORDER BY volume DESC, symbol)::DOUBLE", 1, "weekly"),
    ("rank_average", lambda: W.rank_average("volume"), avg_rank("volume", "date"), 1, "weekly"),
]
for _name, _col, _sql, _digits, _panel in SIMPLE:

    @query(_name, sql(f"SELECT symbol, date, round({_sql}, {_digits}) AS value FROM {_panel}", _panel))
    def window_query(spark, sf, col=_col, digits=_digits, panel=bars if _panel == "bars" else weekly):
        return panel(spark, sf).select(*SD, r(col(), digits).alias("value"))


# windows over daily returns
RETS = [
    ("rolling_compound", lambda: W.compound("ret", 13), f"exp(sum(CASE WHEN ret > -1 THEN ln(1 + ret) END) OVER ({SYM} ROWS 12 PRECEDING)) - 1", 5),
    ("rolling_compound_offset", lambda: W.compound("ret", 25, -27), f"exp(sum(CASE WHEN ret > -1 THEN ln(1 + ret) END) OVER ({SYM} ROWS BETWEEN 51 PRECEDING AND 27 PRECEDING)) - 1", 5),
    ("realized_vol_63d", lambda: W.rolling(F.stddev_samp, "ret", 63) * 252**0.5 * 100, f"stddev_samp(ret) OVER ({SYM} ROWS 62 PRECEDING) * sqrt(252) * 100", 4),
    ("rolling_vol_clip", lambda: F.greatest(F.coalesce(W.rolling(F.stddev_samp, "ret", 30) * 252**0.5, F.lit(0.15)), F.lit(0.15)), f"greatest(coalesce(stddev_samp(ret) OVER ({SYM} ROWS 29 PRECEDING) * sqrt(252), 0.15), 0.15)", 5),
    ("excess_return_label", lambda: F.lead("ret").over(W.by_time()) - (3.0 + (F.dayofyear("date") % 20) / 10.0) / 100 / 252, f"lead(ret) OVER ({SYM}) - {RATE}", 6),
]
for _name, _col, _sql, _digits in RETS:

    @query(_name, sql(f"SELECT symbol, date, round({_sql}, {_digits}) AS value FROM rets", "rets"))
    def returns_query(spark, sf, col=_col, digits=_digits):
        return rets(spark, sf).select(*SD, r(col(), digits).alias("value"))


@query("index_ma_56w", sql("SELECT date, round(avg(level) OVER (ORDER BY date ROWS 55 PRECEDING), 2) AS ma FROM market", "market"))
def index_ma_56w(spark, sf):
    return market(spark, sf).withColumn("symbol", F.lit("M")).select("date", r(W.sma("level", 56, 1), 2).alias("ma"))


@query("last_row_of_period", sql("SELECT symbol, max(date) AS date FROM bars GROUP BY symbol, date_trunc('week', date)", "bars"))
def last_row_of_period(spark, sf):
    b = bars(spark, sf).withColumn("wk", F.date_trunc("week", "date"))
    return dedup(b, ["symbol", "wk"], [F.desc("date")]).select(*SD)


GAPS = "SELECT symbol, date, CASE WHEN volume > 1 THEN close END AS x FROM bars"
for _name, _f, _fn, _frame in (("forward_fill", W.forward_fill, "last_value", "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"), ("back_fill", W.back_fill, "first_value", "ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING")):

    @query(_name, sql(f"SELECT symbol, date, {_fn}(x IGNORE NULLS) OVER ({SYM} {_frame}) AS x FROM ({GAPS})", "bars"))
    def fill_query(spark, sf, fill=_f):
        return bars(spark, sf).select(*SD, F.when(F.col("volume") > 1, F.col("close")).alias("x")).select(*SD, fill("x").alias("x"))


@query("quantile_bucket", sql("SELECT symbol, date, 1 + CAST(close > q1 AS INTEGER) + CASE WHEN q2 > q1 THEN CAST(close > q2 AS INTEGER) ELSE 0 END + CASE WHEN q3 > q2 THEN CAST(close > q3 AS INTEGER) ELSE 0 END AS bucket FROM weekly JOIN (SELECT date, quantile_cont(close, 0.25) AS q1, quantile_cont(close, 0.5) AS q2, quantile_cont(close, 0.75) AS q3 FROM weekly GROUP BY 1) USING (date)", "weekly"))
def quantile_bucket(spark, sf):
    w = weekly(spark, sf).select(*SD, "close")
    return quantiles.buckets(w, ["date"], "close", [0.25, 0.5, 0.75]).select(*SD, "bucket")


CROSS = "CASE WHEN close > fast AND fast > slow THEN 1 WHEN close < fast AND fast < slow THEN -1 WHEN abs(close / slow - 1) < 0.02 THEN 0 END"
MAS = "SELECT *, avg(close) OVER (PARTITION BY symbol ORDER BY date ROWS 3 PRECEDING) AS fast, avg(close) OVER (PARTITION BY symbol ORDER BY date ROWS 11 PRECEDING) AS slow FROM weekly"


@query("state_ffill", sql(f"SELECT symbol, date, last_value(s IGNORE NULLS) OVER ({SYM} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS state FROM (SELECT symbol, date, {CROSS} AS s FROM ({MAS}))", "weekly"))
def state_ffill(spark, sf):
    w = weekly(spark, sf).select("*", W.sma("close", 4, 1).alias("fast"), W.sma("close", 12, 1).alias("slow"))
    return w.withColumn("s", F.expr(CROSS)).select(*SD, W.forward_fill("s").alias("state"))


@query("weight_change", sql(f"SELECT symbol, date, w - coalesce(lag(w) OVER ({SYM}), 0) AS dw FROM (SELECT symbol, date, CASE WHEN row_number() OVER (PARTITION BY date ORDER BY close DESC, symbol) <= 4 THEN 0.25::DOUBLE ELSE 0.0::DOUBLE END AS w FROM weekly)", "weekly"))
def weight_change(spark, sf):
    return left_weights(spark, sf).select(*SD, W.weight_change("weight").alias("dw"))


EQ = f"SELECT symbol, date, exp(sum(coalesce(CASE WHEN ret > -1 THEN ln(1 + ret) END, 0)) OVER ({SYM} ROWS UNBOUNDED PRECEDING)) AS eq FROM (SELECT symbol, date, {RET} AS ret FROM weekly)"


def _equity(spark, sf):
    return weekly(spark, sf).select(*SD, W.pct_change("close").alias("ret")).select(*SD, W.equity("ret").alias("eq"))


@query("equity_curve", sql(f"SELECT symbol, date, round(eq, 6) AS eq FROM ({EQ})", "weekly"))
def equity_curve(spark, sf):
    return _equity(spark, sf).select(*SD, r("eq").alias("eq"))


@query("drawdown", sql(f"SELECT symbol, date, round((eq - m) / m, 6) AS dd FROM (SELECT *, max(eq) OVER ({SYM} ROWS UNBOUNDED PRECEDING) AS m FROM ({EQ}))", "weekly"))
def drawdown(spark, sf):
    return _equity(spark, sf).select(*SD, r(W.drawdown("eq")).alias("dd"))


@query("holding_blocks", sql(f"SELECT symbol, min(date) AS entry, max(date) AS last, count(*) AS weeks FROM (SELECT *, sum(new) OVER ({SYM} ROWS UNBOUNDED PRECEDING) AS b FROM (SELECT *, CASE WHEN h AND NOT coalesce(lag(h) OVER ({SYM}), false) THEN 1 ELSE 0 END AS new FROM (SELECT symbol, date, close > 150000 AS h FROM weekly))) WHERE h GROUP BY symbol, b", "weekly"))
def holding_blocks(spark, sf):
    w = weekly(spark, sf).select(*SD, (F.col("close") > 150000).alias("h"))
    new = (F.col("h") & ~F.coalesce(F.lag("h").over(W.by_time()), F.lit(False))).cast("int")
    b = w.withColumn("new", new).withColumn("b", F.sum("new").over(W.upto_now())).filter("h")
    return b.groupBy("symbol", "b").agg(F.min("date").alias("entry"), F.max("date").alias("last"), F.count("*").alias("weeks")).drop("b")


@query("rebalance_calendar", sql("SELECT symbol, date FROM (SELECT *, max(date) OVER (PARTITION BY date_trunc('month', date)) AS m FROM weekly) WHERE date = m", "weekly"))
def rebalance_calendar(spark, sf):
    w = weekly(spark, sf)
    return w.withColumn("p", P.rebalance_periods(w, "M")).withColumn("x", W.last_of_period("p")).filter("x").select(*SD)


@query("rebalance_calendar_keyed", sql("SELECT symbol, max(date) AS date FROM weekly GROUP BY symbol, date_trunc('quarter', date)", "weekly"))
def rebalance_calendar_keyed(spark, sf):
    w = weekly(spark, sf)
    return w.withColumn("p", P.rebalance_periods(w, "Q")).withColumn("x", W.last_of_period("p", "symbol")).filter("x").select(*SD)


@query("burn_in_drop", sql(f"SELECT symbol, date FROM (SELECT *, row_number() OVER ({SYM}) AS k FROM weekly) WHERE k > 20", "weekly"))
def burn_in_drop(spark, sf):
    return weekly(spark, sf).withColumn("k", F.row_number().over(W.by_time())).filter("k > 20").select(*SD)



def recursive(steps: str) -> str:
    """SQL of steps, some of them recursive, over the weekly panel numbered as s (symbol, date, close, tr, d, k)."""
    lead = sql("SELECT 1", "weekly").removesuffix(" SELECT 1").replace("WITH ", "WITH RECURSIVE ", 1)
    last = f"lag(close) OVER ({SYM})"
    return f"{lead}, s AS (SELECT symbol, date, close, greatest(high - low, abs(high - {last}), abs(low - {last})) AS tr, coalesce(close - {last}, 0) AS d, row_number() OVER ({SYM}) AS k FROM weekly), {steps}"


NEXT = "FROM e JOIN s ON s.symbol = e.symbol AND s.k = e.k + 1"


@query("ewm_recursive", recursive(f"e AS (SELECT symbol, date, k, close AS v FROM s WHERE k = 1 UNION ALL SELECT s.symbol, s.date, s.k, 0.9 * e.v + 0.1 * s.close {NEXT}) SELECT symbol, date, round(v, 3) AS value FROM e"))
def ewm_recursive(spark, sf):
    return scans.ewm(weekly(spark, sf).select(*SD, "close"), "close", 0.1).select(*SD, r("ewm", 3).alias("value"))


@query("atr_wilder", recursive(f"e AS (SELECT symbol, date, k, tr AS t, NULL::DOUBLE AS v FROM s WHERE k = 1 UNION ALL SELECT s.symbol, s.date, s.k, e.t + s.tr, CASE WHEN e.k >= 14 THEN (e.v * 13 + s.tr) / 14 WHEN s.k = 14 THEN (e.t + s.tr) / 14 END {NEXT}) SELECT symbol, date, round(v, 3) AS value FROM e"))
def atr_wilder(spark, sf):
    w = weekly(spark, sf).select(*SD, W.true_range().alias("tr"))
    return scans.wilder(w, "tr", 14, "atr").select(*SD, r("atr", 3).alias("value"))


@query("ewm_adjusted", recursive(f"e AS (SELECT symbol, date, k, close AS a, 1.0::DOUBLE AS b FROM s WHERE k = 1 UNION ALL SELECT s.symbol, s.date, s.k, 0.9 * e.a + s.close, 0.9 * e.b + 1 {NEXT}) SELECT symbol, date, round(a / b, 3) AS value FROM e"))
def ewm_adjusted(spark, sf):
    return scans.ewm_adjusted(weekly(spark, sf).select(*SD, "close"), {"ewm": "close"}, 0.1).select(*SD, r("ewm", 3).alias("value"))


@query("rsi_wilder", recursive(f"e AS (SELECT symbol, date, k, 0.0::DOUBLE AS u, 0.0::DOUBLE AS v FROM s WHERE k = 1 UNION ALL SELECT s.symbol, s.date, s.k, e.u * 13 / 14 + greatest(s.d, 0), e.v * 13 / 14 + greatest(-s.d, 0) {NEXT}) SELECT symbol, date, round(100 - 100 / (1 + u / nullif(v, 0)), 4) AS value FROM e WHERE k >= 14"))
def rsi_wilder(spark, sf):
    d = weekly(spark, sf).select(*SD, (F.col("close") - F.lag("close").over(W.by_time())).alias("d"))
    d = d.select(*SD, F.greatest("d", F.lit(0.0)).alias("gain"), F.greatest(-F.col("d"), F.lit(0.0)).alias("loss"))
    both = scans.ewm_adjusted(d, {"up": "gain", "down": "loss"}, 1 / 14)
    return both.filter("up_n >= 14").select(*SD, r(100 - 100 / (1 + ratio("up", "down")), 4).alias("value"))


# top-k and set operations

RANKED = "SELECT symbol, date, close FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY close {d}, symbol) AS k FROM weekly) WHERE k <= {n}"
for _name, _desc, _n in (("top_n_per_date", True, 3), ("bottom_n_per_date", False, 3), ("head_per_group", True, 10)):

    @query(_name, sql(RANKED.format(d="DESC" if _desc else "ASC", n=_n), "weekly"))
    def topn_query(spark, sf, descending=_desc, n=_n):
        return weekly(spark, sf).withColumn("k", W.rank_first("close", descending)).filter(F.col("k") <= n).select(*SD, "close")


@query("order_by", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey")
def order_by(spark, sf):
    return scan(spark, sf, "customer").select("c_custkey", "c_acctbal").orderBy(F.desc("c_acctbal"), "c_custkey")


@query("best_config", "SELECT p_brand, round(avg(p_retailprice), 4) AS score FROM part GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5")
def best_config(spark, sf):
    return scan(spark, sf, "part").groupBy("p_brand").agg(r(F.avg("p_retailprice"), 4).alias("score")).orderBy(F.desc("score"), "p_brand").limit(5)


@query("latest_run", "SELECT coalesce((SELECT arg_max(event_id, ts) FROM events WHERE event_type LIKE 'purch%'), (SELECT arg_max(event_id, value) FROM events)) AS run")
def latest_run(spark, sf):
    e = scan(spark, sf, "events")
    return e.agg(F.coalesce(F.max_by("event_id", F.when(F.col("event_type").like("purch%"), F.col("ts"))), F.max_by("event_id", "value")).alias("run"))


@query("recent_holdings", sql("SELECT symbol, date, close FROM weekly ORDER BY date DESC, close DESC, symbol LIMIT 20", "weekly"))
def recent_holdings(spark, sf):
    return weekly(spark, sf).select(*SD, "close").orderBy(F.desc("date"), F.desc("close"), "symbol").limit(20)


@query("union_by_name", sql("SELECT symbol, date, 'ADD' AS event FROM changes WHERE event = 'ADD' UNION SELECT symbol, date, 'REMOVE' FROM changes WHERE event = 'REMOVE'", "changes"))
def union_by_name(spark, sf):
    c = changes(spark, sf)
    return c.filter("event = 'ADD'").unionByName(c.filter("event = 'REMOVE'").select("event", "date", "symbol")).distinct()


@query("union_missing_columns", sql("SELECT symbol, date, close, volume FROM bars UNION ALL SELECT 'INDEX', date, round(level, 6), NULL FROM market", "bars", "market"))
def union_missing_columns(spark, sf):
    m = market(spark, sf).select(F.lit("INDEX").alias("symbol"), "date", r("level", 6).alias("close"))
    return bars(spark, sf).select(*SD, "close", "volume").unionByName(m, allowMissingColumns=True)


@query("except_symbols", "SELECT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01' EXCEPT SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01'")
def except_symbols(spark, sf):
    o = scan(spark, sf, "orders")
    return o.filter("o_orderdate < timestamp'1996-01-01'").select("o_custkey").subtract(o.filter("o_orderdate >= timestamp'2001-01-01'").select("o_custkey"))


@query("entry_exit_diff", sql("SELECT symbol, CASE WHEN n > 0 AND o = 0 THEN 'bought' WHEN n = 0 AND o > 0 THEN 'sold' ELSE 'kept' END AS move FROM (SELECT symbol, max(CASE WHEN year(date) = 2000 THEN 1 ELSE 0 END) AS n, max(CASE WHEN year(date) = 1995 THEN 1 ELSE 0 END) AS o FROM bars WHERE close > 400000 GROUP BY 1)", "bars"))
def entry_exit_diff(spark, sf):
    h = bars(spark, sf).filter("close > 400000")
    was = lambda y: F.max((F.year("date") == y).cast("int"))
    g = h.groupBy("symbol").agg(was(2000).alias("n"), was(1995).alias("o"))
    return g.select("symbol", F.when(F.expr("n > 0 and o = 0"), "bought").when(F.expr("n = 0 and o > 0"), "sold").otherwise("kept").alias("move"))


# portfolios: top 5 by twelve-week momentum, monthly, held

MOM = f"SELECT symbol, date, close, close / lag(close, 12) OVER ({SYM}) - 1 AS mom FROM weekly"
WEIGHTS = f"""m AS ({MOM}), p AS (SELECT *, max(date) OVER (PARTITION BY date_trunc('month', date)) = date AS reb FROM m),
k AS (SELECT *, row_number() OVER (PARTITION BY date ORDER BY mom DESC NULLS LAST, symbol) AS rk FROM p),
x AS (SELECT *, CASE WHEN reb THEN CASE WHEN mom IS NOT NULL AND rk <= 5 THEN 0.2::DOUBLE ELSE 0.0::DOUBLE END END AS w0 FROM k),
weights AS (SELECT symbol, date, close, coalesce(last_value(w0 IGNORE NULLS) OVER ({SYM} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0.0::DOUBLE) AS weight FROM x)"""
NET = WEIGHTS + f""", t AS (SELECT symbol, date, weight, lead(close) OVER ({SYM}) / close - 1 AS nx, weight - coalesce(lag(weight) OVER ({SYM}), 0) AS dw FROM weights),
net AS (SELECT date, sum(weight * coalesce(nx, 0)) AS gross, sum(abs(dw)) * 0.001::DOUBLE AS cost, count(*) FILTER (WHERE abs(dw) > 0.001) AS trades FROM t GROUP BY 1)"""
EQUITY = NET + """, eq0 AS (SELECT *, gross - cost AS net, exp(sum(coalesce(CASE WHEN gross - cost > -1 THEN ln(1 + gross - cost) END, 0)) OVER (ORDER BY date ROWS UNBOUNDED PRECEDING)) AS equity FROM net),
eq AS (SELECT *, equity / max(equity) OVER (ORDER BY date ROWS UNBOUNDED PRECEDING) - 1 AS drawdown FROM eq0)"""


def momentum(spark, sf):
    return weekly(spark, sf).select(*SD, "close", W.pct_change("close", 12).alias("mom"))


def weights(spark, sf):
    return P.topn_weights(momentum(spark, sf), "mom", 5)


@query("topn_momentum_weights", sql(f"WITH {WEIGHTS} SELECT symbol, date, weight FROM weights", "weekly"))
def topn_momentum_weights(spark, sf):
    return weights(spark, sf).select(*SD, "weight")


@query("portfolio_period_sum", sql(f"WITH {NET} SELECT date, round(gross, 6) AS gross, round(cost, 6) AS cost, trades FROM net", "weekly"))
def portfolio_period_sum(spark, sf):
    return P.backtest(weights(spark, sf)).select("date", r("gross").alias("gross"), r("cost").alias("cost"), "trades")


@query("portfolio_backtest", sql(f"WITH {EQUITY} SELECT date, round(net, 6) AS net, round(equity, 5) AS equity, round(drawdown, 6) AS drawdown FROM eq", "weekly"))
def portfolio_backtest(spark, sf):
    """Each date's return after costs, the capital that it leads to and how far that is below its peak."""
    e = P.equity_table(P.backtest(weights(spark, sf)))
    return e.select("date", r("net").alias("net"), r("equity", 5).alias("equity"), r("drawdown").alias("drawdown"))


@query("perf_kpis", sql(f"WITH {EQUITY} SELECT round(l - 1, 5) AS total_return, round(pow(l, 1 / y) - 1, 5) AS cagr, round(sd * sqrt(52), 5) AS volatility, round(mn / sd * sqrt(52), 5) AS sharpe, round((pow(l, 1 / y) - 1) / abs(dd), 5) AS calmar, round(dd, 5) AS max_drawdown FROM (SELECT arg_max(equity, date) AS l, min(drawdown) AS dd, stddev_samp(net) AS sd, avg(net) AS mn, greatest((max(date) - min(date)) / 365.25, 1) AS y FROM eq)", "weekly"))
def perf_kpis(spark, sf):
    k = P.kpis(P.equity_table(P.backtest(weights(spark, sf))), per_year=52.0)
    return k.select(*[r(c, 5).alias(c) for c in k.columns])


@query("sortino", sql(f"WITH {NET} SELECT round(avg(x) / stddev_samp(CASE WHEN x < 0 THEN x END) * sqrt(52), 5) AS sortino FROM (SELECT least(greatest(gross - cost, -0.5), 0.5) AS x FROM net)", "weekly"))
def sortino(spark, sf):
    x = P.backtest(weights(spark, sf)).select(F.least(F.greatest("net", F.lit(-0.5)), F.lit(0.5)).alias("x"))
    return x.agg(r(ratio(F.avg("x"), F.stddev_samp(F.when(F.col("x") < 0, F.col("x")))) * 52**0.5, 5).alias("sortino"))


@query("probabilistic_sharpe", sql(f"""WITH {NET}, vs AS (SELECT gross - cost AS v FROM net), ms AS (SELECT avg(v) AS m, stddev_pop(v) AS s, count(*) AS n FROM vs),
q AS (SELECT any_value(m / s) AS sr, any_value(n) AS n, avg(pow((v - m) / s, 3)) AS g, avg(pow((v - m) / s, 4)) AS k FROM vs, ms), z AS (SELECT sr * sqrt(n - 1) / sqrt(1 - g * sr + (k - 1) / 4 * sr * sr) AS z FROM q),
u AS (SELECT z, 1 / (1 + abs(z) * 0.2316419::DOUBLE) AS t FROM z), c AS (SELECT z, exp(-z * z / 2) / sqrt(2 * pi()) * t * (0.319381530::DOUBLE + t * (-0.356563782::DOUBLE + t * (1.781477937::DOUBLE + t * (-1.821255978::DOUBLE + t * 1.330274429::DOUBLE)))) AS tail FROM u)
SELECT round(CASE WHEN z >= 0 THEN 1 - tail ELSE tail END, 5) AS psr FROM c""", "weekly"))
def probabilistic_sharpe(spark, sf):
    b = P.backtest(weights(spark, sf)).agg(F.avg("net").alias("m"), F.stddev_pop("net").alias("s"), F.skewness("net").alias("g"), (F.kurtosis("net") + 3).alias("k"), F.count("*").alias("n"))
    sr = ratio("m", "s")
    return b.select(r(normal_cdf(sr * F.sqrt(F.col("n") - 1) / F.sqrt(1 - F.col("g") * sr + (F.col("k") - 1) / 4 * sr * sr)), 5).alias("psr"))


@query("trade_counts", sql(f"WITH {NET} SELECT date, count(*) FILTER (WHERE dw > 0.001) AS buys, count(*) FILTER (WHERE dw < -0.001) AS sells FROM t GROUP BY 1", "weekly"))
def trade_counts(spark, sf):
    return weights(spark, sf).select("date", W.weight_change("weight").alias("dw")).groupBy("date").agg(F.count_if(F.col("dw") > 0.001).alias("buys"), F.count_if(F.col("dw") < -0.001).alias("sells"))


@query("turnover_exposure_means", sql(f"WITH {NET} SELECT round(avg(tv), 6) AS turnover, round(avg(ex), 6) AS exposure FROM (SELECT date, sum(abs(dw)) AS tv, sum(abs(weight)) AS ex FROM t GROUP BY 1)", "weekly"))
def turnover_exposure_means(spark, sf):
    w = weights(spark, sf).select("date", "weight", W.weight_change("weight").alias("dw"))
    return w.groupBy("date").agg(F.sum(F.abs("dw")).alias("tv"), F.sum(F.abs("weight")).alias("ex")).agg(r(F.avg("tv")).alias("turnover"), r(F.avg("ex")).alias("exposure"))


@query("exposure_cap", sql("SELECT symbol, date, round(CASE WHEN t > 2 THEN w * 2 / t ELSE w END, 6) AS weight FROM (SELECT *, sum(abs(w)) OVER (PARTITION BY date) AS t FROM (SELECT symbol, date, close / 200000 AS w FROM weekly))", "weekly"))
def exposure_cap(spark, sf):
    return P.exposure_cap(weekly(spark, sf).select(*SD, (F.col("close") / 200000).alias("weight"))).select(*SD, r("weight").alias("weight"))


@query("inverse_vol_weights", sql("SELECT symbol, year, round((1 / v) / sum(1 / v) OVER (PARTITION BY year), 6) AS weight FROM (SELECT symbol, year(date) AS year, stddev_samp(ret) AS v FROM rets GROUP BY 1, 2)", "rets"))
def inverse_vol_weights(spark, sf):
    g = rets(spark, sf).groupBy("symbol", F.year("date").cast("long").alias("year")).agg(F.stddev_samp("ret").alias("v")).withColumn("i", ratio(F.lit(1.0), "v"))
    return g.select("symbol", "year", r(F.col("i") / F.sum("i").over(Window.partitionBy("year"))).alias("weight"))


@query("position_journal", sql(f"""WITH {WEIGHTS}, j AS (SELECT symbol, date, close, weight, weight - coalesce(lag(weight) OVER ({SYM}), 0) AS dw FROM weights), t AS (SELECT * FROM j WHERE abs(dw) > 0.001)
SELECT 'position' AS kind, symbol, date, round(weight, 6) AS weight, NULL::DOUBLE AS price FROM j WHERE weight > 0
UNION ALL SELECT CASE WHEN dw > 0 THEN 'buy' ELSE 'sell' END, symbol, date, round(dw, 6), close FROM t
UNION ALL SELECT 'last', symbol, date, round(dw, 6), close FROM t WHERE date = (SELECT max(date) FROM t)""", "weekly"))
def position_journal(spark, sf):
    """Positions held, each trade with its price, and once more the moves of the last date that had any."""
    j = weights(spark, sf).select(*SD, "close", "weight", W.weight_change("weight").alias("dw"))
    t = j.filter(F.abs("dw") > 0.001)
    last = t.join(t.agg(F.max("date").alias("date")), "date")  # one row
    trade = lambda df, kind: df.select(kind.alias("kind"), *SD, r("dw").alias("weight"), F.col("close").alias("price"))
    held = j.filter("weight > 0").select(F.lit("position").alias("kind"), *SD, r("weight").alias("weight"), F.lit(None).cast("double").alias("price"))
    return held.union(trade(t, F.when(F.col("dw") > 0, "buy").otherwise("sell"))).union(trade(last, F.lit("last")))


@query("label_topn_period", sql("SELECT symbol, y, close, CASE WHEN nx >= 0.05 AND rk <= 5 THEN 1 ELSE 0 END AS label FROM (SELECT *, row_number() OVER (PARTITION BY y ORDER BY nx DESC NULLS LAST, symbol) AS rk FROM (SELECT *, lead(close) OVER (PARTITION BY symbol ORDER BY y) / close - 1 AS nx FROM (SELECT symbol, CAST(date_trunc('year', date) AS DATE) AS y, arg_max(close, date) AS close FROM bars GROUP BY 1, 2)))", "bars"))
def label_topn_period(spark, sf):
    y = bars(spark, sf).groupBy("symbol", F.trunc("date", "year").alias("y")).agg(F.max_by("close", "date").alias("close"))
    y = y.withColumn("nx", W.forward_return("close", time="y")).withColumn("rk", W.rank_first("nx", group="y"))
    return y.select("symbol", "y", "close", F.coalesce(((F.col("nx") >= 0.05) & (F.col("rk") <= 5)).cast("int"), F.lit(0)).alias("label"))


@query("time_split", sql("SELECT symbol, date, CASE WHEN year(date) <= y - 3 THEN 'train' WHEN year(date) <= y - 2 THEN 'val' ELSE 'test' END AS part FROM weekly, (SELECT max(year(date)) AS y FROM weekly)", "weekly"))
def time_split(spark, sf):
    """The last two years of the data test, the one before validates, all earlier ones train."""
    w = weekly(spark, sf).select(*SD)
    last = w.agg(F.max(F.year("date"))).first()[0]  # a value
    y = F.year("date")
    return w.select(*SD, F.when(y <= last - 3, "train").when(y <= last - 2, "val").otherwise("test").alias("part"))


MEANS = (4, 12, 25, 50)


@query("ma_distance", sql(f"SELECT symbol, date, {', '.join(f'round(close / m{n} - 1, 6) AS dist{n}' for n in MEANS)}, {', '.join(f'round(abs(m{a} - m{b}) / close, 6) AS gap{a}_{b}' for a in MEANS for b in MEANS if a < b)} FROM (SELECT *, {', '.join(f'avg(close) OVER ({SYM} ROWS {n - 1} PRECEDING) AS m{n}' for n in MEANS)} FROM weekly)", "weekly"))
def ma_distance(spark, sf):
    """How far the price is from its means, and they from each other, as shares of the mean and of the price."""
    m = weekly(spark, sf).select(*SD, "close", *[W.sma("close", n, 1).alias(f"m{n}") for n in MEANS])
    gaps = [r(F.abs(F.col(f"m{a}") - F.col(f"m{b}")) / F.col("close")).alias(f"gap{a}_{b}") for a in MEANS for b in MEANS if a < b]
    return m.select(*SD, *[r(F.col("close") / F.col(f"m{n}") - 1).alias(f"dist{n}") for n in MEANS], *gaps)


@query("generic_grouped_map", sql(f"WITH k AS (SELECT symbol, date, close, row_number() OVER ({SYM}) AS k FROM bars) SELECT a.symbol, a.date, a.k - max(b.k) FILTER (WHERE b.close = a.top) AS since FROM (SELECT *, max(close) OVER ({SYM} ROWS 19 PRECEDING) AS top FROM k) a JOIN k b ON b.symbol = a.symbol AND b.k BETWEEN a.k - 19 AND a.k GROUP BY a.symbol, a.date, a.k", "bars"))
def generic_grouped_map(spark, sf):
    """A user's function of a key's rows with a declared schema: bars since the highest close of the last twenty."""

    def since_high(rows: pa.Table, lead: int) -> pa.Table:
        x = np.concatenate([np.full(19, -np.inf), rows.column("close").to_numpy()])
        back = np.lib.stride_tricks.sliding_window_view(x, 20)[:, ::-1].argmax(axis=1)
        return pa.table({"symbol": rows.column("symbol"), "date": rows.column("date"), "since": back}).slice(lead)

    return in_chunks(bars(spark, sf).select(*SD, "close"), since_high, "symbol string, date date, since long", 19)
