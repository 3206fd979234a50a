"""Queries of composite jobs, second part: macro and crash tables, signal states, rotations, performance, landed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.functions.expr import r, ratio
from driftline.operators import joins, scans, walk
from driftline.operators import portfolio as P
from driftline.operators import windows as W
from driftline.plans.catalog import bars, fundamentals, market, query, sql, weekly
from driftline.plans.composites import VALUE, full, value
from driftline.plans.panel import SD, SYM, WEIGHTS, recursive, weights
from driftline.sources.store import dedup, scan

HELD = f"OVER ({SYM} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def rounded(df: DataFrame, digits: int = 6, keys: tuple[str, ...] = ("symbol", "date")) -> DataFrame:
    """df with its columns of doubles rounded."""
    return df.select(*keys, *[r(c, digits).alias(c) if t == "double" else c for c, t in df.dtypes if c not in keys])


def rounded_sql(select: str, *cols: str, digits: int = 6) -> str:
    return f"SELECT symbol, date, {', '.join(f'round({c}, {digits}) AS {c}' for c in cols)} FROM ({select})"


# gold tables that grow out of each other: momentum and ratios, trend flags, crash ratio, growth, valuation

FLAGS = f"SELECT *, CASE WHEN close > m56 THEN 1 ELSE 0 END AS bull, CASE WHEN close < m56 THEN 1 ELSE 0 END AS bear FROM (SELECT *, avg(close) OVER ({SYM} ROWS 55 PRECEDING) AS m56 FROM ({VALUE}))"
PIVOT = "SELECT date, max(CASE WHEN symbol = '1' THEN close END) / max(CASE WHEN symbol = '2' THEN close END) AS crash FROM weekly GROUP BY 1"
CRASH = f"SELECT v.*, p.crash FROM ({FLAGS}) v LEFT JOIN ({PIVOT}) p ON v.date = p.date"
GROWN = f"SELECT symbol, date, revenue / lag(revenue) OVER ({SYM}) - 1 AS growth, revenue - lag(revenue) OVER ({SYM}) AS surprise, revenue AS sales, units AS pieces, cost AS spent FROM fund"
GROWTH = f"SELECT c.*, g.growth, g.surprise, g.sales, g.pieces, g.spent FROM ({CRASH}) c ASOF LEFT JOIN ({GROWN}) g ON c.symbol = g.symbol AND c.date >= g.date"
MASTER = f"SELECT *, CASE WHEN spent > 0 THEN sales / spent END AS cover, CASE WHEN pieces > 0 THEN spent / pieces END AS unit_cost, CASE WHEN sales > 0 THEN ln(sales) END AS log_sales FROM ({GROWTH})"
RATIOS = ("mom", "price", "share")


def flagged(spark, sf):
    v = value(spark, sf).withColumn("m56", W.sma("close", 56, 1))
    return v.select("*", (F.col("close") > F.col("m56")).cast("int").alias("bull"), (F.col("close") < F.col("m56")).cast("int").alias("bear")).drop("m56")


def crashed(spark, sf):
    p = weekly(spark, sf).groupBy("date").pivot("symbol", ["1", "2"]).agg(F.first("close"))
    return flagged(spark, sf).join(p.select("date", ratio("1", "2").alias("crash")), "date", "left")


def grown(spark, sf):
    f = fundamentals(spark, sf)
    g = f.select(*SD, W.pct_change("revenue").alias("growth"), (F.col("revenue") - F.lag("revenue").over(W.by_time())).alias("surprise"), F.col("revenue").alias("sales"), F.col("units").alias("pieces"), F.col("cost").alias("spent"))
    return joins.asof(crashed(spark, sf), g, ["growth", "surprise", "sales", "pieces", "spent"])


def guarded(top: str, bottom: str) -> Column:
    return F.when(F.col(bottom) > 0, F.col(top) / F.col(bottom))


@query("value_momentum_gold", sql(rounded_sql(VALUE, "close", *RATIOS), "weekly", "fund"))
def value_momentum_gold(spark, sf):
    return rounded(value(spark, sf).select(*SD, "close", *RATIOS))


@query("trend_gold", sql(rounded_sql(FLAGS, "close", *RATIOS, "bull", "bear"), "weekly", "fund"))
def trend_gold(spark, sf):
    return rounded(flagged(spark, sf).select(*SD, "close", *RATIOS, "bull", "bear"))


@query("crash_gold", sql(rounded_sql(CRASH, "close", *RATIOS, "bull", "bear", "crash"), "weekly", "fund"))
def crash_gold(spark, sf):
    return rounded(crashed(spark, sf).select(*SD, "close", *RATIOS, "bull", "bear", "crash"))


@query("growth_crash_gold", sql(rounded_sql(GROWTH, "close", *RATIOS, "bull", "bear", "crash", "growth"), "weekly", "fund"))
def growth_crash_gold(spark, sf):
    return rounded(grown(spark, sf).select(*SD, "close", *RATIOS, "bull", "bear", "crash", "growth"))


@query("master_gold", sql(rounded_sql(MASTER, "close", *RATIOS, "bull", "bear", "crash", "growth", "surprise", "cover", "unit_cost", "log_sales", digits=4), "weekly", "fund"))
def master_gold(spark, sf):
    """The widest table; raw per-unit columns are dropped after their guarded ratios (null where the base is not above zero)."""
    g = grown(spark, sf).select("*", guarded("sales", "spent").alias("cover"), guarded("spent", "pieces").alias("unit_cost"), F.when(F.col("sales") > 0, F.log("sales")).alias("log_sales"))
    return rounded(g.drop("sales", "pieces", "spent").select(*SD, "close", *RATIOS, "bull", "bear", "crash", "growth", "surprise", "cover", "unit_cost", "log_sales"), 4)


RVOL = f"SELECT date, stddev_samp(ret) OVER (ORDER BY date ROWS 62 PRECEDING) * sqrt(252) * 100 AS close FROM (SELECT date, level / lag(level) OVER (ORDER BY date) - 1 AS ret FROM market)"


@query("crash_silver", sql(f"WITH rv AS ({RVOL}), one AS (SELECT date, close FROM bars WHERE symbol = '1'), both_ AS (SELECT 'ONE' AS symbol, date, close FROM one UNION ALL SELECT 'RVOL', date, close FROM rv) SELECT symbol, b.date, round(b.close, 4) AS close, round(one.close / rv.close, 4) AS ratio FROM both_ b LEFT JOIN one ON one.date = b.date LEFT JOIN rv ON rv.date = b.date", "bars", "market"))
def crash_silver(spark, sf):
    """One symbol beside realised volatility, which is emitted as a symbol of its own, and their ratio on common dates."""
    m = market(spark, sf).withColumn("symbol", F.lit("RVOL"))
    rv = m.select(*SD, W.pct_change("level").alias("ret")).select(*SD, (W.rolling(F.stddev_samp, "ret", 63) * 252**0.5 * 100).alias("close"))
    one = bars(spark, sf).filter("symbol = '1'").select(F.lit("ONE").alias("symbol"), "date", "close")
    both = one.unionByName(rv)  # one shuffle by date instead of two joins back
    day = Window.partitionBy("date")
    of = lambda s: F.max(F.when(F.col("symbol") == s, F.col("close"))).over(day)
    return both.select(*SD, r("close", 4).alias("close"), r(ratio(of("ONE"), of("RVOL")), 4).alias("ratio"))


INDEX = "SELECT 'INDEX' AS symbol, date, avg(close) AS close FROM weekly GROUP BY 2"


@query("gold_index", sql(f"SELECT symbol, date, round(close, 6) AS close, round(fast, 6) AS fast, round(slow, 6) AS slow, round(mom, 6) AS mom FROM (SELECT symbol, date, close, {full(4)} AS fast, {full(12)} AS slow, close / lag(close, 12) OVER ({SYM}) - 1 AS mom FROM ({INDEX})) WHERE slow IS NOT NULL AND mom IS NOT NULL", "weekly"))
def gold_index(spark, sf):
    i = weekly(spark, sf).groupBy("date").agg(F.avg("close").alias("close")).withColumn("symbol", F.lit("INDEX"))
    g = i.select(*SD, "close", W.sma("close", 4).alias("fast"), W.sma("close", 12).alias("slow"), W.pct_change("close", 12).alias("mom")).dropna()
    return g.select(*SD, r("close").alias("close"), r("fast").alias("fast"), r("slow").alias("slow"), r("mom").alias("mom"))


ROWS_BACK, MONTHS_BACK, LINES = (1, 4, 12, 26), (1, 3, 6, 12), (4, 12, 25, 50)
CLASSIC = f"""WITH w AS (SELECT *, {', '.join(f'avg(close) OVER ({SYM} ROWS {n - 1} PRECEDING) AS m{n}' for n in LINES)}, close - lag(close) OVER ({SYM}) AS d FROM weekly),
v AS (SELECT *, avg(greatest(d, 0)) OVER ({SYM} ROWS 13 PRECEDING) AS up, avg(greatest(-d, 0)) OVER ({SYM} ROWS 13 PRECEDING) AS down, close / first_value(close) OVER (PARTITION BY symbol, year(date) ORDER BY date) - 1 AS ytd FROM w),
p AS (SELECT symbol, date, {', '.join(f'close / lag(close, {n}) OVER ({SYM}) - 1 AS perf{n}, volume / nullif(lag(volume, {n}) OVER ({SYM}), 0) - 1 AS vol{n}' for n in MONTHS_BACK)} FROM (SELECT symbol, last_day(date) AS date, arg_max(close, date) AS close, CAST(arg_max(volume, date) AS DOUBLE) AS volume FROM weekly GROUP BY 1, 2))
SELECT v.symbol, v.date, {', '.join(f'round(close / nullif(lag(close, {n}) OVER (PARTITION BY v.symbol ORDER BY v.date), 0) - 1, 6) AS ret{n}' for n in ROWS_BACK)}, {', '.join(f'round(close / m{n} - 1, 6) AS dist{n}' for n in LINES)}, {', '.join(f'round(abs(m{a} - m{b}) / close, 6) AS gap{a}_{b}' for a in LINES for b in LINES if a < b)}, round(100 - 100 / (1 + up / nullif(down, 0)), 4) AS rsi, round(ytd, 6) AS ytd, {', '.join(f'round({c}{n}, 6) AS {c}{n}' for n in MONTHS_BACK for c in ('perf', 'vol'))},
CAST(year(v.date) AS INTEGER) AS year, CAST(month(v.date) AS INTEGER) AS month, CAST(weekofyear(v.date) AS INTEGER) AS week, CAST(quarter(v.date) AS INTEGER) AS quarter FROM v ASOF LEFT JOIN p ON p.symbol = v.symbol AND v.date >= p.date"""


@query("feature_table_classic", sql(CLASSIC, "weekly"))
def feature_table_classic(spark, sf):
    """Returns, distances from means and between them, RSI, the year so far, price and volume against earlier month ends
    as of the row, and parts of the date: one shuffle by symbol for the windows, the as-of join and its month ends."""
    w = weekly(spark, sf)
    months = w.groupBy("symbol", F.last_day("date").alias("d")).agg(F.max_by("close", "date").alias("c"), F.max_by("volume", "date").cast("double").alias("v")).withColumnRenamed("d", "date")
    months = months.select(*SD, *[x for n in MONTHS_BACK for x in (W.pct_change("c", n).alias(f"perf{n}"), W.pct_change("v", n).alias(f"vol{n}"))])
    first = F.first("close").over(Window.partitionBy("symbol", F.year("date")).orderBy("date"))
    w = w.select(*SD, "close", *[W.pct_change("close", n).alias(f"ret{n}") for n in ROWS_BACK], *[W.sma("close", n, 1).alias(f"m{n}") for n in LINES], (F.col("close") / first - 1).alias("ytd"), (F.col("close") - F.lag("close").over(W.by_time())).alias("d"))
    w = w.withColumn("gain", F.greatest("d", F.lit(0.0))).withColumn("loss", F.greatest(-F.col("d"), F.lit(0.0)))
    w = w.withColumn("rsi", 100 - 100 / (1 + ratio(W.sma("gain", 14, 1), W.sma("loss", 14, 1))))
    past = [f"{c}{n}" for n in MONTHS_BACK for c in ("perf", "vol")]
    f = joins.asof(w, months, past)
    gaps = [r(F.abs(F.col(f"m{a}") - F.col(f"m{b}")) / F.col("close")).alias(f"gap{a}_{b}") for a in LINES for b in LINES if a < b]
    plain = [r(c).alias(c) for c in [*(f"ret{n}" for n in ROWS_BACK), "ytd", *past]]
    return f.select(*SD, *plain, *[r(F.col("close") / F.col(f"m{n}") - 1).alias(f"dist{n}") for n in LINES], *gaps, r("rsi", 4).alias("rsi"), F.year("date").alias("year"), F.month("date").alias("month"), F.weekofyear("date").alias("week"), F.quarter("date").alias("quarter"))


# signal states

DUAL_OK = "((fast > slow AND close > slow) OR (fast < slow AND close > fast))"
DUAL = f"SELECT symbol, date, close, {full(4)} AS fast, {full(12)} AS slow, close / lag(close, 12) OVER ({SYM}) - 1 AS mom, max(date) OVER (PARTITION BY symbol, date_trunc('month', date)) = date AS reb FROM weekly"


@query("ma_dual_momentum_signals", sql(f"WITH d AS ({DUAL}), k AS (SELECT *, CASE WHEN reb AND {DUAL_OK} THEN row_number() OVER (PARTITION BY date ORDER BY CASE WHEN reb AND {DUAL_OK} THEN mom END DESC NULLS LAST, symbol) END AS rk FROM d), s AS (SELECT symbol, date, mom, slow, CASE WHEN reb THEN CASE WHEN rk <= 5 AND mom IS NOT NULL THEN 0.2::DOUBLE ELSE 0.0::DOUBLE END END AS w0 FROM k) SELECT symbol, date, weight FROM (SELECT symbol, date, mom, slow, coalesce(last_value(w0 IGNORE NULLS) {HELD}, 0.0::DOUBLE) AS weight FROM s) WHERE mom IS NOT NULL AND slow IS NOT NULL", "weekly"))
def ma_dual_momentum_signals(spark, sf):
    """Price above the slow mean in an uptrend, or above the fast one in a downtrend; each symbol's own last date of a
    month rebalances; the five best momenta hold a fifth each until the next."""
    w = weekly(spark, sf).withColumn("p", F.trunc("date", "month"))
    d = w.select(*SD, "close", W.sma("close", 4).alias("fast"), W.sma("close", 12).alias("slow"), W.pct_change("close", 12).alias("mom"), W.last_of_period("p", "symbol").alias("reb"))
    d = d.withColumn("s", F.when(F.expr(f"reb AND {DUAL_OK}"), F.col("mom"))).withColumn("rk", W.rank_first("s"))
    d = d.withColumn("w0", F.when(F.col("reb"), F.when(F.col("s").isNotNull() & (F.col("rk") <= 5), 0.2).otherwise(0.0)))
    return d.select(*SD, "mom", "slow", F.coalesce(W.forward_fill("w0"), F.lit(0.0)).alias("weight")).filter("mom is not null and slow is not null").select(*SD, "weight")


def prior(agg: str, x: str, n: int) -> str:
    """Rolling aggregate over the n rows before the current one, null until there are n."""
    w = f"OVER ({SYM} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    return f"CASE WHEN count({x}) {w} >= {n} THEN {agg}({x}) {w} END"


LONG_LINE = "CASE WHEN short >= long THEN long ELSE short END"
SHORT_LINE = "CASE WHEN short <= long THEN long ELSE short END"
UP = f"CASE WHEN close < {LONG_LINE} THEN 0 WHEN close > top AND close > {LONG_LINE} THEN 1 END"
DOWN = f"CASE WHEN close > {SHORT_LINE} THEN 0 WHEN close < bottom AND close < {SHORT_LINE} THEN -1 END"
TURTLE = f"SELECT symbol, date, close, {prior('max', 'high', 8)} AS top, {prior('min', 'low', 8)} AS bottom, {prior('avg', 'close', 4)} AS short, {prior('avg', 'close', 12)} AS long, greatest(high - low, abs(high - lag(close) OVER ({SYM})), abs(low - lag(close) OVER ({SYM}))) AS tr FROM weekly"


@query("turtle_signals", recursive(f"t AS ({TURTLE}), e AS (SELECT symbol, date, k, tr AS v FROM s WHERE k = 1 UNION ALL SELECT s.symbol, s.date, s.k, 9 / 11.0::DOUBLE * e.v + 2 / 11.0::DOUBLE * s.tr FROM e JOIN s ON s.symbol = e.symbol AND s.k = e.k + 1), n AS (SELECT t.*, e.v AS n, {UP} AS u, {DOWN} AS d FROM t JOIN e ON e.symbol = t.symbol AND e.date = t.date), st AS (SELECT symbol, date, close, n, long, coalesce(last_value(u IGNORE NULLS) {HELD}, 0) + coalesce(last_value(d IGNORE NULLS) {HELD}, 0) AS state FROM n), w AS (SELECT *, CASE WHEN state <> 0 AND n > 0 THEN 0.01::DOUBLE / (n / close) * state ELSE 0.0::DOUBLE END AS w FROM st), h AS (SELECT *, sum(abs(w)) OVER (PARTITION BY date) AS heat FROM w) SELECT symbol, date, CAST(state AS INTEGER) AS state, round(CASE WHEN heat > 2 THEN w * 2 / heat ELSE w END, 6) AS weight FROM h WHERE long IS NOT NULL AND n IS NOT NULL"))
def turtle_signals(spark, sf):
    """Breakouts long and short, each carried until its exit line; sized by the exponential mean of true range over a span
    of ten; exposure capped at two."""
    t = weekly(spark, sf).select(*SD, "close", W.rolling(F.max, "high", 8, -1, 8).alias("top"), W.rolling(F.min, "low", 8, -1, 8).alias("bottom"), W.rolling(F.avg, "close", 4, -1, 4).alias("short"), W.rolling(F.avg, "close", 12, -1, 12).alias("long"), W.true_range().alias("tr"))
    t = scans.ewm(t, "tr", 2 / 11, "n").select(*SD, "close", "long", "n", F.expr(UP).alias("u"), F.expr(DOWN).alias("d"))
    carried = lambda c: F.coalesce(W.forward_fill(c), F.lit(0))
    s = t.select(*SD, "close", "long", "n", (carried("u") + carried("d")).alias("state"))
    s = s.withColumn("weight", F.when((F.col("state") != 0) & (F.col("n") > 0), ratio(F.lit(0.01), F.col("n") / F.col("close")) * F.col("state")).otherwise(0.0))
    return P.exposure_cap(s).filter("long is not null and n is not null").select(*SD, "state", r("weight").alias("weight"))


def mean_reversion(panel: DataFrame, window: int, bands: float, low: float, high: float, trend: int) -> DataFrame:
    """(symbol, date, weight) over symbol, date, close: entries outside shifted Bollinger bands with an earlier RSI (14 rows)
    below low or above high and a trend filter. Two passes: entries are carried, rows where the carried position meets its
    exit become flat, and the result is carried again. Each position weighs a tenth; exposure is capped at two."""
    w = panel.select(*SD, "close", (F.col("close") - F.lag("close").over(W.by_time())).alias("d"))
    w = w.select(*SD, "close", F.greatest(F.coalesce("d", F.lit(0.0)), F.lit(0.0)).alias("gain"), F.greatest(-F.coalesce("d", F.lit(0.0)), F.lit(0.0)).alias("loss"))
    rows = scans.numbered(w)
    share = F.lit(13 / 14)
    f = scans.affine(rows, {"up": (share, F.col("gain")), "down": (share, F.col("loss"))}).withColumn("k", F.col(scans.TURN))
    f = f.withColumn("rsi", F.when(F.col("k") >= 14, F.coalesce(100 - 100 / (1 + ratio("up", "down")), F.when(F.col("up") > 0, 100.0))))
    f = f.select(*SD, "close", W.rolling(F.avg, "close", window, -1, window).alias("mean"), W.rolling(F.stddev_samp, "close", window, -1, window).alias("sd"), F.lag("rsi").over(W.by_time()).alias("rsi"), W.rolling(F.avg, "close", trend, -1, trend).alias("trend"))
    entry = F.when(F.expr(f"close > mean + {bands} * sd and rsi > {high} and close < trend"), -1).when(F.expr(f"close < mean - {bands} * sd and rsi < {low} and close > trend"), 1)
    f = f.withColumn("e", entry).withColumn("pos", F.coalesce(W.forward_fill("e"), F.lit(0)))
    f = f.withColumn("e", F.when(F.expr("(pos = 1 and close >= mean) or (pos = -1 and close <= mean)"), 0).otherwise(F.col("e")))
    f = f.withColumn("weight", F.coalesce(W.forward_fill("e"), F.lit(0)) * 0.1)
    return P.exposure_cap(f).filter("trend is not null").select(*SD, r("weight").alias("weight"))


REVERSION = recursive(f"""e AS (SELECT symbol, date, k, 0.0::DOUBLE AS u, 0.0::DOUBLE AS v FROM s WHERE k = 1 UNION ALL SELECT s.symbol, s.date, s.k, e.u * 13 / 14 + greatest(s.d, 0), e.v * 13 / 14 + greatest(-s.d, 0) FROM e JOIN s ON s.symbol = e.symbol AND s.k = e.k + 1),
x AS (SELECT s.symbol, s.date, s.close, CASE WHEN e.k >= 14 THEN coalesce(100 - 100 / (1 + u / nullif(v, 0)), CASE WHEN u > 0 THEN 100 END) END AS rsi FROM e JOIN s ON s.symbol = e.symbol AND s.k = e.k),
y AS (SELECT symbol, date, close, {prior('avg', 'close', 4)} AS mean, {prior('stddev_samp', 'close', 4)} AS sd, lag(rsi) OVER ({SYM}) AS rsi, {prior('avg', 'close', 40)} AS trend FROM x),
z AS (SELECT *, CASE WHEN close > mean + 0.5::DOUBLE * sd AND rsi > 50 AND close < trend THEN -1 WHEN close < mean - 0.5::DOUBLE * sd AND rsi < 50 AND close > trend THEN 1 END AS e FROM y),
p AS (SELECT *, coalesce(last_value(e IGNORE NULLS) {HELD}, 0) AS pos FROM z), q AS (SELECT *, CASE WHEN (pos = 1 AND close >= mean) OR (pos = -1 AND close <= mean) THEN 0 ELSE e END AS e2 FROM p),
w AS (SELECT symbol, date, trend, coalesce(last_value(e2 IGNORE NULLS) {HELD}, 0) * 0.1::DOUBLE AS w FROM q), h AS (SELECT *, sum(abs(w)) OVER (PARTITION BY date) AS heat FROM w)
SELECT symbol, date, round(CASE WHEN heat > 2 THEN w * 2 / heat ELSE w END, 6) + 0.0 AS weight FROM h WHERE trend IS NOT NULL""")


@query("mean_reversion_signals", REVERSION)
def mean_reversion_signals(spark, sf):
    return mean_reversion(weekly(spark, sf), 4, 0.5, 50, 50, 40)


LEVER = f"SELECT symbol, date, close, {full(4)} AS f, {full(12)} AS s FROM ({INDEX})"
LEVER_STATE = "CASE WHEN (f > s AND p < s) OR (f < s AND p < s) THEN 0 WHEN (f > s AND p > s) OR (f < s AND p > f) THEN 1 END"


@query("tactical_ma_leverage", sql(f"WITH a AS (SELECT symbol, date, close, s AS long, lag(f) OVER ({SYM}) AS f, lag(s) OVER ({SYM}) AS s, lag(close) OVER ({SYM}) AS p FROM ({LEVER})), b AS (SELECT symbol, date, long, close / p - 1 AS ret, coalesce(last_value({LEVER_STATE} IGNORE NULLS) {HELD}, 0) * 1.5::DOUBLE AS w FROM a) SELECT date, w AS weight, round(w * ret - greatest(w - 1, 0) * 0.04 / 52, 6) AS net FROM b WHERE ret IS NOT NULL AND long IS NOT NULL", "weekly"))
def tactical_ma_leverage(spark, sf):
    """The index held at one and a half times while last week's means say so; borrowing costs four percent a year."""
    i = weekly(spark, sf).groupBy("date").agg(F.avg("close").alias("close")).withColumn("symbol", F.lit("INDEX"))
    a = i.select(*SD, "close", W.sma("close", 4).alias("fast"), W.sma("close", 12).alias("long"))
    back = lambda c: F.lag(c).over(W.by_time())
    a = a.select(*SD, "long", W.pct_change("close").alias("ret"), back("fast").alias("f"), back("long").alias("s"), back("close").alias("p")).withColumn("state", F.expr(LEVER_STATE))
    a = a.withColumn("weight", F.coalesce(W.forward_fill("state"), F.lit(0)) * 1.5).filter("ret is not null and long is not null")
    return a.select("date", "weight", r(F.col("weight") * F.col("ret") - F.greatest(F.col("weight") - 1, F.lit(0.0)) * 0.04 / 52).alias("net"))


GTAA = f"SELECT symbol, date, close / lag(close, 12) OVER ({SYM}) - 1 AS mom, ret, CASE WHEN count(ret) OVER ({SYM} ROWS 11 PRECEDING) >= 12 THEN stddev_samp(ret) OVER ({SYM} ROWS 11 PRECEDING) END AS vol, max(date) OVER (PARTITION BY date_trunc('month', date)) = date AS reb FROM (SELECT *, close / lag(close) OVER ({SYM}) - 1 AS ret FROM weekly)"


@query("gtaa_inverse_vol", sql(f"WITH g AS ({GTAA}), k AS (SELECT *, CASE WHEN mom > 0 AND row_number() OVER (PARTITION BY date ORDER BY mom DESC NULLS LAST, symbol) <= 5 THEN 1 / vol END AS iv FROM g), w AS (SELECT symbol, date, ret, CASE WHEN reb THEN coalesce(iv / sum(iv) OVER (PARTITION BY date) * 1.5, 0) END AS w0 FROM k), h AS (SELECT symbol, date, ret, coalesce(last_value(w0 IGNORE NULLS) {HELD}, 0) AS w FROM w), p AS (SELECT symbol, date, ret, coalesce(lag(w) OVER ({SYM}), 0) AS w FROM h), c AS (SELECT *, w - coalesce(lag(w) OVER ({SYM}), 0) AS dw FROM p) SELECT date, round(sum(w * coalesce(ret, 0)) - sum(abs(dw)) * 0.001 - greatest(sum(w) - 1, 0) * 0.04 / 52, 6) AS net FROM c GROUP BY 1", "weekly"))
def gtaa_inverse_vol(spark, sf):
    """The five best positive momenta by inverse volatility, times one and a half, monthly; applied a week later; fees on
    what is traded and on what is borrowed."""
    w = weekly(spark, sf)
    g = w.select(*SD, W.pct_change("close").alias("ret"), W.pct_change("close", 12).alias("mom"), P.rebalance_periods(w, "M").alias("p"))
    g = g.select(*SD, "ret", "mom", W.rolling(F.stddev_samp, "ret", 12, least=12).alias("vol"), W.last_of_period("p").alias("reb"))
    g = g.withColumn("iv", F.when((F.col("mom") > 0) & (W.rank_first("mom") <= 5), ratio(F.lit(1.0), "vol")))
    g = g.withColumn("w0", F.when(F.col("reb"), F.coalesce(ratio("iv", F.sum("iv").over(Window.partitionBy("date"))) * 1.5, F.lit(0.0))))
    g = g.select(*SD, "ret", F.coalesce(W.forward_fill("w0"), F.lit(0.0)).alias("now"))
    g = g.select(*SD, "ret", F.coalesce(F.lag("now").over(W.by_time()), F.lit(0.0)).alias("w")).select("date", "ret", "w", W.weight_change("w").alias("dw"))
    cost = F.sum(F.abs("dw")) * 0.001 + F.greatest(F.sum("w") - 1, F.lit(0.0)) * 0.04 / 52
    return g.groupBy("date").agg(r(F.sum(F.col("w") * F.coalesce("ret", F.lit(0.0))) - cost).alias("net"))


# rotations: enter at a rank, stay up to a buffer, leave below a mean


def rotation(panel: DataFrame, n: int, buffer: int, enter: Column, leave: Column, descending: bool = True, weight: float = 1.0) -> DataFrame:
    """(symbol, date, close, weight) of a set-wise rotation over symbol, date, close, mom.

    On a month's last date the n best momenta among `enter` are taken and held ones outside the best `buffer` are left;
    on any date `leave` ends a holding. Each holding weighs weight / n. Holdings are states carried by symbol, so more
    than n may be held for a while, unlike in a loop with n slots.
    """
    p = panel.withColumn("ok", F.coalesce(enter, F.lit(False)) & F.col("mom").isNotNull()).withColumn("out", F.coalesce(leave, F.lit(False)))
    p = p.withColumn("reb", W.last_of_period("period")).withColumn("s", F.when(F.col("ok"), F.col("mom"))).withColumn("rk", W.rank_first("s", descending))
    event = F.when(F.col("out"), 0).when(F.col("reb") & F.col("ok") & (F.col("rk") <= n), 1).when(F.col("reb") & (~F.col("ok") | (F.col("rk") > buffer)), 0)
    return p.withColumn("e", event).select(*SD, "close", (F.coalesce(W.forward_fill("e"), F.lit(0)) * (weight / n)).alias("weight"))


def rotation_sql(panel: str, n: int, buffer: int, enter: str, leave: str, desc: bool = True, weight: float = 1.0) -> str:
    return f"""q AS (SELECT *, coalesce({enter}, false) AND mom IS NOT NULL AS ok, coalesce({leave}, false) AS out_, max(date) OVER (PARTITION BY date_trunc('month', date)) = date AS reb FROM ({panel})),
q2 AS (SELECT *, row_number() OVER (PARTITION BY date ORDER BY CASE WHEN ok THEN mom END {'DESC' if desc else 'ASC'} NULLS LAST, symbol) AS rk FROM q),
q3 AS (SELECT *, CASE WHEN out_ THEN 0 WHEN reb AND ok AND rk <= {n} THEN 1 WHEN reb AND (NOT ok OR rk > {buffer}) THEN 0 END AS e FROM q2),
weights AS (SELECT symbol, date, close, coalesce(last_value(e IGNORE NULLS) {HELD}, 0) * {weight / n}::DOUBLE AS weight FROM q3)"""


ROTATE = f"SELECT w.*, i.l > i.m AS bull FROM (SELECT symbol, date, close, {full(4)} AS fast, {full(12)} AS slow, close / lag(close, 12) OVER ({SYM}) - 1 AS mom FROM weekly) w JOIN (SELECT date, l, avg(l) OVER (ORDER BY date ROWS 19 PRECEDING) AS m FROM (SELECT date, avg(close) AS l FROM weekly GROUP BY 1)) i ON w.date = i.date"
CASES = {
    "regime_rotation_weights": (5, 8, "bull AND close > slow", "NOT bull OR close < slow", True, 1.0),
    "loser_rotation_weights": (5, 5, "close < fast AND close < slow", "close > slow", False, 1.0),
    "momentum_rotation_no_macro": (10, 15, "close > slow", "close < slow", True, 1.5),
}


def rotated(spark, sf, name):
    n, buffer, enter, leave, descending, weight = CASES[name]
    w = weekly(spark, sf)
    i = w.groupBy("date").agg(F.avg("close").alias("l")).select("date", (F.col("l") > F.avg("l").over(Window.orderBy("date").rowsBetween(-19, 0))).alias("bull"))
    p = w.select(*SD, "close", W.sma("close", 4).alias("fast"), W.sma("close", 12).alias("slow"), W.pct_change("close", 12).alias("mom"), P.rebalance_periods(w, "M").alias("period")).join(i, "date")
    return rotation(p, n, buffer, F.expr(enter), F.expr(leave), descending, weight)


for _name, _case in CASES.items():

    @query(_name, sql(f"WITH {rotation_sql(ROTATE, *_case)} SELECT symbol, date, round(weight, 6) AS weight FROM weights", "weekly"))
    def rotation_query(spark, sf, name=_name):
        return rotated(spark, sf, name).select(*SD, r("weight").alias("weight"))


@query("regime_rotation_returns", sql(f"WITH {rotation_sql(ROTATE, *CASES['regime_rotation_weights'])}, t AS (SELECT date, weight, lead(close) OVER ({SYM}) / close - 1 AS nx, weight - coalesce(lag(weight) OVER ({SYM}), 0) AS dw FROM weights) SELECT date, round(sum(weight * coalesce(nx, 0)), 6) AS gross, round(sum(weight * coalesce(nx, 0)) - sum(abs(dw)) * 0.001, 6) AS net FROM t GROUP BY 1", "weekly"))
def regime_rotation_returns(spark, sf):
    return P.backtest(rotated(spark, sf, "regime_rotation_weights")).select("date", r("gross").alias("gross"), r("net").alias("net"))


FX = "SELECT symbol, date, high, low, close FROM weekly UNION ALL SELECT symbol || '_INV', date, 1 / low, 1 / high, 1 / close FROM weekly"
FX_STATE = f"SELECT symbol, date, close, {prior('max', 'high', 8)} AS top, {full(8)} AS mid, {full(16)} AS stop, close / lag(close, 12) OVER ({SYM}) - 1 AS mom FROM ({FX})"


@query("fx_breakout_carry", sql(f"WITH {rotation_sql(f'SELECT * FROM ({FX_STATE})', 3, 1000000, 'close > top AND close > mid', 'close < stop')}, c AS (SELECT symbol, date, weight, close, CAST(replace(symbol, '_INV', '') AS INTEGER) % 5 / 100.0 * CASE WHEN symbol LIKE '%_INV' THEN -1 ELSE 1 END / 52 AS carry FROM weights) SELECT symbol, date, round(weight, 6) AS weight, round(lead(close) OVER ({SYM}) / close - 1 + carry, 6) AS ret FROM c", "weekly").replace("reb AND (NOT ok OR rk > 1000000)", "false"))
def fx_breakout_carry(spark, sf):
    """Each series beside its reciprocal; a monthly breakout above the earlier highs enters, a close below the slow mean
    leaves; the return includes a yearly carry by symbol, with the other sign for the reciprocal."""
    w = weekly(spark, sf)
    sides = F.array(F.struct("symbol", "high", "low", "close"), F.struct(F.concat("symbol", F.lit("_INV")).alias("symbol"), (1 / F.col("low")).alias("high"), (1 / F.col("high")).alias("low"), (1 / F.col("close")).alias("close")))
    s = w.select("date", F.explode(sides).alias("x")).select("date", "x.*")
    s = s.select(*SD, "close", W.rolling(F.max, "high", 8, -1, 8).alias("top"), W.sma("close", 8).alias("mid"), W.sma("close", 16).alias("stop"), W.pct_change("close", 12).alias("mom"), P.rebalance_periods(s, "M").alias("period"))
    p = s.select("*", F.coalesce(F.expr("close > top and close > mid"), F.lit(False)).alias("ok"), W.last_of_period("period").alias("reb"))
    p = p.withColumn("s", F.when(F.col("ok"), F.col("mom"))).withColumn("rk", W.rank_first("s"))
    p = p.withColumn("e", F.when(F.col("close") < F.col("stop"), 0).when(F.col("reb") & F.col("s").isNotNull() & (F.col("rk") <= 3), 1))
    sign = F.when(F.col("symbol").endswith("_INV"), -1).otherwise(1)
    carry = F.regexp_replace("symbol", "_INV", "").cast("int") % 5 / 100.0 * sign / 52
    return p.select(*SD, r(F.coalesce(W.forward_fill("e"), F.lit(0)) * (1.0 / 3)).alias("weight"), r(W.forward_return("close") + carry).alias("ret"))


# performance


@query("portfolio_performance", sql(f"""WITH {WEIGHTS}, a AS (SELECT symbol, date, close / lag(close) OVER ({SYM}) - 1 AS ret, coalesce(lag(weight) OVER ({SYM}), 0) AS w FROM weights),
b AS (SELECT *, w - coalesce(lag(w) OVER ({SYM}), 0) AS dw FROM a),
n AS (SELECT date, sum(w * coalesce(ret, 0)) + (1 - sum(w)) * (pow(1.03, 1 / 52.0) - 1) - greatest(sum(w) - 1, 0) * (pow(1.05, 1 / 52.0) - 1) - sum(abs(dw)) * 0.001 AS net, avg(ret) AS bench FROM b GROUP BY 1),
e AS (SELECT date, net, 100 * exp(sum(ln(1 + net)) OVER (ORDER BY date)) AS equity, 100 * exp(sum(ln(1 + coalesce(bench, 0))) OVER (ORDER BY date)) AS bench FROM n)
SELECT date, round(net, 6) AS net, round(equity, 4) AS equity, round((equity - m) / m, 6) AS drawdown, round(bench, 4) AS bench FROM (SELECT *, max(equity) OVER (ORDER BY date) AS m FROM e)""", "weekly"))
def portfolio_performance(spark, sf):
    """Last week's weights on this week's returns, with yield on cash, cost of margin and fees; equity from 100 beside an
    equally weighted benchmark. The windows without a key see one row a week."""
    a = weights(spark, sf).select(*SD, W.pct_change("close").alias("ret"), F.coalesce(F.lag("weight").over(W.by_time()), F.lit(0.0)).alias("w"))
    a = a.select("date", "ret", "w", W.weight_change("w").alias("dw"))
    cash, margin = 1.03 ** (1 / 52) - 1, 1.05 ** (1 / 52) - 1
    net = F.sum(F.col("w") * F.coalesce("ret", F.lit(0.0))) + (1 - F.sum("w")) * cash - F.greatest(F.sum("w") - 1, F.lit(0.0)) * margin - F.sum(F.abs("dw")) * 0.001
    n = a.groupBy("date").agg(net.alias("net"), F.avg("ret").alias("bench")).withColumn("one", F.lit(1))
    e = n.select("date", "one", "net", (100 * W.equity("net", key="one")).alias("equity"), (100 * W.equity("bench", key="one")).alias("bench"))
    return e.select("date", r("net").alias("net"), r("equity", 4).alias("equity"), r(W.drawdown("equity", key="one")).alias("drawdown"), r("bench", 4).alias("bench"))


SCORED = f"SELECT symbol, date, close, volume, sin(CAST(symbol AS DOUBLE) * 7 + date_diff('day', DATE '1992-01-01', date) / 7) AS score, lead(close) OVER ({SYM}) / close - 1 AS nx FROM weekly"
PICKED = f"SELECT *, row_number() OVER (PARTITION BY date ORDER BY score DESC, symbol) AS k, dense_rank() OVER (ORDER BY date) AS p FROM ({SCORED}) WHERE nx IS NOT NULL"


def scored(spark, sf) -> DataFrame:
    """The weekly panel with a score made from symbol and week, and the next return."""
    days = F.datediff("date", F.lit("1992-01-01").cast("date"))
    return weekly(spark, sf).select(*SD, "close", "volume", F.sin(F.col("symbol").cast("double") * 7 + days / 7).alias("score"), W.forward_return("close").alias("nx"))


@query("score_portfolio", sql(f"WITH s AS ({PICKED}), t AS (SELECT * FROM s WHERE k <= 5 AND score >= 0.1), f AS (SELECT t.*, NOT EXISTS (SELECT 1 FROM t o WHERE o.symbol = t.symbol AND o.p = t.p - 1) AS fresh FROM t), b AS (SELECT date, sum(close * volume * nx) / sum(close * volume) AS bench FROM s GROUP BY 1) SELECT b.date, round(coalesce(g.gross, 0), 6) AS gross, round(coalesce(g.net, 0), 6) AS net, round(b.bench, 6) AS bench, coalesce(g.n, 0) AS n FROM b LEFT JOIN (SELECT date, avg(nx) AS gross, avg(nx) - avg(CASE WHEN fresh THEN 1.0::DOUBLE ELSE 0 END) * 0.002 AS net, count(*) AS n FROM f GROUP BY 1) g ON b.date = g.date", "weekly"))
def score_portfolio(spark, sf):
    """The five best scores of at least 0.1 each week, costs on new entries, beside the dollar-volume benchmark; weeks
    without a pick stay in cash."""
    return walk.picks(scored(spark, sf), 5, 0.1, 0.002).select("date", r("gross").alias("gross"), r("net").alias("net"), r("bench").alias("bench"), "n")


@query("fixed_fee_backtest", sql(f"""WITH {WEIGHTS}, t AS (SELECT date, weight * (lead(close) OVER ({SYM}) / close - 1) AS g, CASE WHEN abs(weight - coalesce(lag(weight) OVER ({SYM}), 0)) > 0.001 THEN 1 ELSE 0 END AS traded FROM weights),
flows AS (SELECT date, coalesce(sum(g), 0) AS ret, 10.0::DOUBLE - sum(traded) * 2.0::DOUBLE AS flow FROM t GROUP BY 1),
growth AS (SELECT *, exp(sum(ln(1 + ret)) OVER (ORDER BY date)) AS grown FROM flows),
paid_in AS (SELECT *, sum(flow / coalesce(before, 1)) OVER (ORDER BY date) AS paid FROM (SELECT *, lag(grown) OVER (ORDER BY date) AS before FROM growth))
SELECT date, round(ret, 6) AS ret, round(grown * (1000 + paid), 3) AS capital FROM paid_in""", "weekly"))
def fixed_fee_backtest(spark, sf):
    """Capital with a saving each week and a flat fee for each trade, c = (c + saving - fees) * (1 + return), in closed
    form: growth times the start plus what was paid in, each payment divided by the growth before it."""
    t = weights(spark, sf).select("date", (F.col("weight") * W.forward_return("close")).alias("g"), (F.abs(W.weight_change("weight")) > 0.001).cast("int").alias("traded"))
    n = t.groupBy("date").agg(F.coalesce(F.sum("g"), F.lit(0.0)).alias("ret"), (10.0 - F.sum("traded") * 2.0).alias("flow")).withColumn("one", F.lit(1))
    p = n.select("*", W.equity("ret", key="one").alias("grown"))
    p = p.withColumn("before", F.coalesce(F.lag("grown").over(W.by_time("one")), F.lit(1.0)))
    return p.select("date", r("ret").alias("ret"), r(F.col("grown") * (1000 + F.sum(F.col("flow") / F.col("before")).over(W.upto_now("one"))), 3).alias("capital"))


# pairs, splits and landed tables


@query("pair_sample", sql(f"WITH s AS (SELECT symbol, date, nx, row_number() OVER (PARTITION BY date ORDER BY md5(concat('7|', symbol, '|', CAST(date AS VARCHAR))), symbol) AS k, count(*) OVER (PARTITION BY date) AS n FROM ({SCORED}) WHERE nx IS NOT NULL) SELECT a.date, j, a.symbol AS a, b.symbol AS b, CASE WHEN a.nx > b.nx THEN 1 ELSE -1 END AS label FROM s a CROSS JOIN (SELECT CAST(unnest([1, 2, 3]) AS INTEGER) AS j) JOIN s b ON a.date = b.date AND b.k = (a.k + j - 1) % a.n + 1 WHERE a.n > j", "weekly"))
def pair_sample(spark, sf):
    return pairs(scored(spark, sf).filter("nx is not null"), 3, 7)


def pairs(rows: DataFrame, each: int, seed: int) -> DataFrame:
    """(date, j, a, b, label): for each row the `each` rows after it in its date's order by a seeded hash, the last followed
    by the first, labelled by which return nx is higher. So every row is in as many pairs as any other, no pair is of a
    row with itself, and none is made that is thrown away: two windows, no join."""
    s = rows.select("symbol", "date", "nx", F.md5(F.concat_ws("|", F.lit(seed), "symbol", F.col("date").cast("string"))).alias("h"))
    order, other = Window.partitionBy("date").orderBy("h", "symbol"), F.struct("symbol", "nx")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.count("*").over(whole) - F.row_number().over(order)  # rows after this one
    s = s.select("date", "symbol", "nx", left.alias("left"), F.count("*").over(whole).alias("n"), *[F.lead(other, j).over(order).alias(f"next{j}") for j in range(1, each + 1)], *[F.nth_value(other, j).over(whole).alias(f"first{j}") for j in range(1, each + 1)])
    first = F.array(*[F.col(f"first{j}") for j in range(1, each + 1)])
    turn = lambda j: F.struct(F.lit(j).alias("j"), F.coalesce(f"next{j}", F.get(first, (F.lit(j) - F.col("left") - 1).cast("int"))).alias("o"))
    s = s.select("date", "symbol", "nx", "n", F.explode(F.array(*map(turn, range(1, each + 1)))).alias("p")).filter("n > p.j")
    return s.select("date", F.col("p.j").alias("j"), F.col("symbol").alias("a"), F.col("p.o.symbol").alias("b"), F.when(F.col("nx") > F.col("p.o.nx"), 1).otherwise(-1).alias("label"))


@query("date_split", sql("SELECT symbol, date, CASE WHEN date < DATE '1998-07-01' THEN 'train' WHEN date < DATE '2000-01-01' THEN 'val' ELSE 'test' END AS part FROM weekly", "weekly"))
def date_split(spark, sf):
    before = lambda d: F.col("date") < F.lit(d).cast("date")
    return weekly(spark, sf).select(*SD, F.when(before("1998-07-01"), "train").when(before("2000-01-01"), "val").otherwise("test").alias("part"))


@query("expanding_splits", sql("SELECT y AS split, CASE WHEN year(date) < y - 1 THEN 'train' WHEN year(date) < y THEN 'val' ELSE 'test' END AS part, count(*) AS n, max(date) AS last FROM weekly JOIN (SELECT DISTINCT year(date) AS y FROM weekly) ON year(date) <= y WHERE y >= (SELECT min(year(date)) FROM weekly) + 3 GROUP BY 1, 2", "weekly"))
def expanding_splits(spark, sf):
    """A split for each year with three or more before it: the last of those validates, all earlier ones train. Sums by
    year come before rows are repeated for the splits that they are part of, so a year is one row in each. model_compare
    trains on such splits."""
    by = weekly(spark, sf).groupBy(F.year("date").alias("y")).agg(F.count("*").alias("n"), F.max("date").alias("last"))
    years = Window.orderBy("y").rowsBetween(0, Window.unboundedFollowing)  # one row a year
    w = by.select("*", F.collect_list("y").over(years).alias("__on"), F.min("y").over(Window.partitionBy()).alias("__first"))
    w = w.select("y", "n", "last", F.explode("__on").alias("split"), "__first").filter("split >= __first + 3")
    kind = F.when(F.col("y") < F.col("split") - 1, "train").when(F.col("y") < F.col("split"), "val").otherwise("test")
    return w.groupBy("split", kind.alias("part")).agg(F.sum("n").alias("n"), F.max("last").alias("last"))


@query("fundamentals_bronze", "SELECT symbol, date, id, round(revenue, 2) AS revenue, flag FROM (SELECT CAST(l_suppkey AS VARCHAR) AS symbol, CAST(l_shipdate AS DATE) AS date, l_orderkey AS id, l_extendedprice AS revenue, CAST(l_returnflag AS VARCHAR) AS flag, row_number() OVER (PARTITION BY l_suppkey, CAST(l_shipdate AS DATE) ORDER BY l_orderkey, l_extendedprice, l_returnflag) AS k FROM lineitem) WHERE k = 1")
def fundamentals_bronze(spark, sf):
    """Landed rows: typed, one a symbol and date."""
    t = scan(spark, sf, "lineitem").select(F.col("l_suppkey").cast("string").alias("symbol"), F.to_date("l_shipdate").alias("date"), F.col("l_orderkey").alias("id"), F.col("l_extendedprice").alias("revenue"), F.col("l_returnflag").cast("string").alias("flag"))
    return dedup(t, SD, ["id", "revenue", "flag"]).select(*SD, "id", r("revenue", 2).alias("revenue"), "flag")


@query("members_bronze", "SELECT DISTINCT CAST(s_suppkey AS VARCHAR) AS symbol, trim(s_name) AS name, n_name AS sector FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def members_bronze(spark, sf):
    t = scan(spark, sf, "supplier").join(scan(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return t.select(F.col("s_suppkey").cast("string").alias("symbol"), F.trim("s_name").alias("name"), F.col("n_name").alias("sector")).distinct()
