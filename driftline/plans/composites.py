"""Queries of composite jobs: factor tables, gold tables, weights by rule, labels, sweeps and lookups over the panel."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from driftline.functions.expr import business_month_end, r, ratio, week_ending
from driftline.operators import bars as B
from driftline.operators import factors, grids, joins, quantiles, scans
from driftline.operators import portfolio as P
from driftline.operators import windows as W
from driftline.operators.chunks import in_chunks
from driftline.plans.catalog import QUERIES, bars, fundamentals, market, query, sql, weekly
from driftline.plans.panel import EVENT_DAYS, RATE, SD, SPELLS, SYM, WEIGHTS, _bme, _spells, avg_rank, momentum, rets, weights
from driftline.sources.store import new_path, scan, written
from driftline.sources.versions import Table

WEEK = "date + CAST((12 - isodow(date)) % 7 AS INTEGER)"

# features


@query("rsi_sma", sql(f"WITH d AS (SELECT symbol, date, close - lag(close) OVER ({SYM}) AS d FROM weekly), a AS (SELECT symbol, date, avg(greatest(d, 0)) OVER ({SYM} ROWS 13 PRECEDING) AS up, avg(greatest(-d, 0)) OVER ({SYM} ROWS 13 PRECEDING) AS down FROM d), x AS (SELECT symbol, date, 100 - 100 / (1 + up / nullif(down, 0)) AS rsi FROM a) SELECT symbol, date, round(rsi, 4) AS rsi, round(avg(rsi) OVER ({SYM} ROWS 99 PRECEDING), 4) AS rsi_mean FROM x", "weekly"))
def rsi_sma(spark, sf):
    d = weekly(spark, sf).select(*SD, (F.col("close") - F.lag("close").over(W.by_time())).alias("d"))
    d = d.select(*SD, F.greatest("d", F.lit(0.0)).alias("up"), F.greatest(-F.col("d"), F.lit(0.0)).alias("down"))
    x = d.select(*SD, (100 - 100 / (1 + ratio(W.sma("up", 14, 1), W.sma("down", 14, 1)))).alias("rsi"))
    return x.select(*SD, r("rsi", 4).alias("rsi"), r(W.sma("rsi", 100, 1), 4).alias("rsi_mean"))


#: Wilder's index over 20 bars and true range over 14 as recursive SQL: moves, their means, the index, its mean.
ADX = sql(f"""WITH RECURSIVE s AS (SELECT symbol, date, high, low, close, row_number() OVER ({SYM}) - 1 AS k, greatest(high - low, abs(high - lag(close) OVER ({SYM})), abs(low - lag(close) OVER ({SYM}))) AS tr, high - lag(high) OVER ({SYM}) AS up, lag(low) OVER ({SYM}) - low AS down FROM bars),
e AS (SELECT symbol, k, 0.0::DOUBLE AS a, 0.0::DOUBLE AS p, 0.0::DOUBLE AS q FROM s WHERE k = 0 UNION ALL SELECT s.symbol, s.k, a + (tr - a) / least(s.k, 14), p + (CASE WHEN up > down AND up > 0 THEN up ELSE 0 END - p) / least(s.k, 20), q + (CASE WHEN down > up AND down > 0 THEN down ELSE 0 END - q) / least(s.k, 20) FROM e JOIN s ON s.symbol = e.symbol AND s.k = e.k + 1),
x AS (SELECT symbol, k, coalesce(100 * abs(p - q) / nullif(p + q, 0), 0) AS dx FROM e),
f AS (SELECT symbol, k, dx AS d FROM x WHERE k = 20 UNION ALL SELECT x.symbol, x.k, d + (dx - d) / least(x.k - 19, 20) FROM f JOIN x ON x.symbol = f.symbol AND x.k = f.k + 1),
adx AS (SELECT s.symbol, s.date, s.close, CASE WHEN s.k >= 39 THEN f.d END AS adx, CASE WHEN s.k >= 14 THEN e.a END AS atr FROM s JOIN e ON e.symbol = s.symbol AND e.k = s.k LEFT JOIN f ON f.symbol = s.symbol AND f.k = s.k) SELECT 1""", "bars").removesuffix(" SELECT 1").replace("WITH bars", "WITH RECURSIVE bars", 1).replace(", RECURSIVE s", ", s", 1)


@query("adx_wilder", ADX + " SELECT symbol, date, round(adx, 4) AS value FROM adx")
def adx_wilder(spark, sf):
    return scans.adx(bars(spark, sf), 20).select(*SD, r("adx", 4).alias("value"))


MONTHS = "SELECT symbol, last_day(date) AS date, arg_max(close, date) AS x FROM bars GROUP BY 1, 2"
#: Months that momenta look back.
HORIZONS = (1, 3, 6, 12)
VOLUMES = "SELECT symbol, last_day(date) AS date, CAST(sum(volume) AS DOUBLE) AS x FROM bars GROUP BY 1, 2"

for _name, _src, _agg in (("period_momentum_asof", MONTHS, lambda: F.max_by("close", "date")), ("volume_momentum", VOLUMES, lambda: F.sum("volume").cast("double"))):

    @query(_name, sql(f"WITH p AS (SELECT symbol, date, {', '.join(f"x / lag(x, {n}) OVER ({SYM}) - 1 AS m{n}" for n in HORIZONS)} FROM ({_src})) SELECT b.symbol, b.date, {', '.join(f"round(m{n}, 6) AS m{n}" for n in HORIZONS)} FROM bars b ASOF LEFT JOIN p ON b.symbol = p.symbol AND b.date >= p.date", "bars"))
    def period_momentum(spark, sf, agg=_agg):
        b = bars(spark, sf)
        m = b.groupBy("symbol", F.last_day("date").alias("d")).agg(agg().alias("x")).withColumnRenamed("d", "date")
        m = m.select(*SD, *[W.pct_change("x", n).alias(f"m{n}") for n in HORIZONS])
        names = [f"m{n}" for n in HORIZONS]
        return joins.asof(b.select(*SD, "close"), m, names).select(*SD, *[r(c).alias(c) for c in names])


def stored(df: DataFrame, schema: str) -> DataFrame:
    """df as a gold table: cast to the fixed schema, written to shared storage and read back with it."""
    fixed = StructType.fromDDL(schema)
    return written(df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fixed]))


EXCESS = f"""mk AS (SELECT date, level / lag(level) OVER (ORDER BY date) - 1 AS mret FROM market),
x AS (SELECT r.symbol, r.date, r.close, r.volume, r.ret, r.ret - {RATE.replace('dayofyear(date)', 'dayofyear(r.date)')} AS own, coalesce(mret, 0) - {RATE.replace('dayofyear(date)', 'dayofyear(r.date)')} AS idx FROM rets r LEFT JOIN mk ON mk.date = r.date WHERE ret IS NOT NULL)"""
PERIOD = "g AS (SELECT symbol, {bin} AS date, arg_max(close, date) AS close, arg_max(volume, date) AS volume, stddev_samp(ret) AS retvol, max(ret) AS maxret, avg(abs(ret) / (close * volume)) AS ill, exp(sum(ln(1 + ret))) - 1 AS mom1, covar_samp(own, idx) / nullif(var_samp(idx), 0) AS beta FROM x GROUP BY 1, 2)"


def grown(n: int, upto: int = 0, col: str = "mom1") -> str:
    return f"exp(sum(ln(1 + {col})) OVER ({SYM} ROWS BETWEEN {n + upto - 1} PRECEDING AND {upto if upto else 'CURRENT ROW'}{' PRECEDING' if upto else ''})) - 1"


def excess(spark, sf) -> DataFrame:
    """Daily returns of the panel in excess of the rate, beside those of its mean price."""
    m = market(spark, sf).withColumn("one", F.lit("M")).select("date", W.pct_change("level", key="one").alias("ret"))
    return factors.daily_excess(bars(spark, sf), m, (3.0 + (F.dayofyear("date") % 20) / 10.0) / 100 / 252)


FACTORS = f"WITH {EXCESS}, {PERIOD} SELECT symbol, date, close, volume, round(retvol, 6) AS retvol, round(maxret, 6) AS maxret, round(ill * 1e9, 5) AS ill, round(beta, 4) AS beta, round(mom1, 6) AS mom1, {', '.join(f'round({grown(n)}, 5) AS mom{n}' for n in (3, 6, 12))} FROM g QUALIFY retvol IS NOT NULL AND beta IS NOT NULL"

for _name, _sql, _bin in (("monthly_factor_table", "last_day(date)", F.last_day), ("weekly_factor_table", WEEK, week_ending)):

    @query(_name, sql(FACTORS.replace("{bin}", _sql), "rets", "market"))
    def factor_table(spark, sf, bin_=_bin):
        """Price, volume, deviation, maximum, illiquidity, beta and compounded returns of each period; rows that lack one go."""
        f = factors.period_factors(excess(spark, sf), bin_("date"))
        f = f.select("*", *factors.momenta({"mom3": 3, "mom6": 6, "mom12": 12})).dropna()
        return f.select(*SD, "close", "volume", r("retvol").alias("retvol"), r("maxret").alias("maxret"), r(F.col("ill") * 1e9, 5).alias("ill"), r("beta", 4).alias("beta"), r("mom1").alias("mom1"), *[r(c, 5).alias(c) for c in ("mom3", "mom6", "mom12")])


@query("monthly_factor_gold", sql(FACTORS.replace("{bin}", "last_day(date)"), "rets", "market"))
def monthly_factor_gold(spark, sf):
    """The monthly table as published by symbol; its rows must keep the rules."""
    rules = {("not_null", c): F.col(c).isNull() for c in ("retvol", "beta", "mom12")}
    return Table.create(QUERIES["monthly_factor_table"](spark, sf), new_path(spark), SD, ["symbol"], rules).read()


def full(n: int) -> str:
    w = f"OVER ({SYM} ROWS {n - 1} PRECEDING)"
    return f"CASE WHEN count(close) {w} >= {n} THEN avg(close) {w} END"


ETF = sql(f"SELECT symbol, date, close, round(fast, 4) AS fast, round(slow, 4) AS slow, round(mom, 6) AS mom FROM (SELECT symbol, date, close, {full(4)} AS fast, {full(12)} AS slow, close / lag(close, 12) OVER ({SYM}) - 1 AS mom FROM weekly) WHERE fast IS NOT NULL AND slow IS NOT NULL AND mom IS NOT NULL", "weekly")


@query("grouped_map_etf", ETF)
def grouped_map_etf(spark, sf):
    """Means of 4 and 12 weeks and the momentum of 12, by a function of a symbol's rows in time order."""

    def features(rows: pa.Table, lead: int) -> pa.Table:
        x = rows.column("close").to_pandas()
        out = {"fast": x.rolling(4).mean(), "slow": x.rolling(12).mean(), "mom": x / x.shift(12) - 1}
        new = rows.append_column("fast", pa.array(out["fast"])).append_column("slow", pa.array(out["slow"])).append_column("mom", pa.array(out["mom"], from_pandas=True))
        return new.slice(lead)

    w = in_chunks(weekly(spark, sf).select(*SD, "close"), features, "symbol string, date date, close double, fast double, slow double, mom double", 12)
    return w.dropna().select(*SD, "close", r("fast", 4).alias("fast"), r("slow", 4).alias("slow"), r("mom").alias("mom"))


@query("gold_etf", ETF)
def gold_etf(spark, sf):
    return stored(grouped_map_etf(spark, sf), "symbol string, date date, close double, fast double, slow double, mom double")


STOCK = ADX + f""", wk AS (SELECT symbol, {WEEK} AS date, arg_max(close, date) AS close, arg_max(adx, date) AS adx, arg_max(atr, date) AS atr FROM adx GROUP BY 1, 2),
st AS (SELECT symbol, date, close, adx, atr, {full(4)} AS fast, {full(12)} AS slow, atr / nullif(close, 0) AS atr_pct, close / lag(close, 12) OVER ({SYM}) - 1 AS mom FROM wk)"""


def stock_features(spark, sf) -> DataFrame:
    d = scans.adx(bars(spark, sf), 20, atr=14)
    w = d.groupBy("symbol", week_ending("date").alias("d")).agg(*[F.max_by(c, "date").alias(c) for c in ("close", "adx", "atr")]).withColumnRenamed("d", "date")
    return w.select("*", W.sma("close", 4).alias("fast"), W.sma("close", 12).alias("slow"), W.pct_change("close", 12).alias("mom"), ratio("atr", "close").alias("atr_pct"))


STOCK_ROWS = STOCK + " SELECT symbol, date, close, round(adx, 4) AS adx, round(atr, 4) AS atr, round(fast, 4) AS fast, round(slow, 4) AS slow, round(atr_pct, 4) AS atr_pct, round(mom, 4) AS mom FROM st WHERE adx IS NOT NULL AND atr IS NOT NULL AND slow IS NOT NULL AND mom IS NOT NULL AND atr_pct IS NOT NULL"


@query("grouped_map_stock", STOCK_ROWS)
def grouped_map_stock(spark, sf):
    return stock_features(spark, sf).dropna().select(*SD, "close", *[r(c, 4).alias(c) for c in ("adx", "atr", "fast", "slow", "atr_pct", "mom")])


@query("gold_stock", STOCK_ROWS)
def gold_stock(spark, sf):
    return stored(grouped_map_stock(spark, sf), "symbol string, date date, close double, adx double, atr double, fast double, slow double, atr_pct double, mom double")


def eligible(panel: DataFrame, least_adx: float = 20.0, most_atr: float = 0.15) -> Column:
    """Whether a row may be held: its trend is up and, where the panel has the columns, its index is above least_adx and
    its range, as a share of the price, below most_atr. Null where that cannot be told."""
    ok = F.expr("fast > slow and close > slow")
    ok = ok & (F.col("adx") > least_adx) if "adx" in panel.columns else ok
    return ok & (F.col("atr_pct") < most_atr) if "atr_pct" in panel.columns else ok


@query("eligibility", STOCK + " SELECT symbol, date, fast > slow AND close > slow AND adx > 20 AND atr_pct < 0.9 AS eligible, fast > slow AND close > slow AS trend FROM st")
def eligibility(spark, sf):
    """By all rules, and on a panel without index and range by the trend alone. (The panel's ranges are wide.)"""
    p = stock_features(spark, sf)
    return p.select(*SD, eligible(p, most_atr=0.9).alias("eligible"), eligible(p.select(*SD, "close", "fast", "slow")).alias("trend"))


# tables by layer


DAYS = "SELECT symbol, unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY))::DATE AS date FROM (SELECT symbol, min(date) AS lo, max(date) AS hi FROM bars GROUP BY 1)"
BRONZE = f"""SELECT 'D' AS freq, d.symbol, d.date, b.open, b.high, b.low, b.close, coalesce(b.volume, 0) AS volume FROM ({DAYS}) d LEFT JOIN bars b ON b.symbol = d.symbol AND b.date = d.date WHERE isodow(d.date) < 6 OR b.date IS NOT NULL
UNION ALL SELECT 'W', symbol, date, open, high, low, close, volume FROM weekly
UNION ALL SELECT 'M', symbol, CASE WHEN date <= {_bme('date')} THEN {_bme('date')} ELSE {_bme('CAST(last_day(date) + 1 AS DATE)')} END, arg_min(open, date), max(high), min(low), arg_max(close, date), sum(volume)::BIGINT FROM bars GROUP BY 2, 3"""


def bronze(spark, sf):
    """Bars of three frequencies: every weekday between a symbol's first and last bar (without trade: null prices, no
    volume; bars of other days stay), weeks by their Friday, months by their last weekday."""
    d = bars(spark, sf)
    cols = [*SD, "open", "high", "low", "close", "volume"]
    span = d.groupBy("symbol").agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    days = span.select("symbol", F.explode(F.sequence("lo", "hi")).alias("date")).filter(F.weekday("date") < 5)
    empty = days.join(d.select(*SD), SD, "left_anti")
    daily = d.select(*cols).unionByName(empty.withColumn("volume", F.lit(0).cast("long")), allowMissingColumns=True)
    tag = lambda df, f: df.select(F.lit(f).alias("freq"), *cols)
    return tag(daily, "D").unionByName(tag(B.bars(d, week_ending("date")), "W")).unionByName(tag(B.bars(d, business_month_end("date")), "M"))


@query("bronze_multi_frequency", sql(BRONZE, "weekly"))
def bronze_multi_frequency(spark, sf):
    return bronze(spark, sf)


TRADED = "open > 0 and close > 0 and low > 0 and high > low and high >= close and low <= close and volume > 0"


@query("silver_quality", sql(f"SELECT freq, count(*) AS n, count(*) FILTER (WHERE {TRADED}) AS kept FROM ({BRONZE}) GROUP BY 1", "weekly"))
def silver_quality(spark, sf):
    """Bronze bars are stored once and validated into a table for each frequency, each published only if its rows keep the
    rules, which are counted over what was written. Returns the rows read and those in the tables."""
    raw = Table.create(bronze(spark, sf), new_path(spark), ["freq", *SD], ["freq"])
    rules = {("positive", c): ~(F.col(c) > 0) | F.col(c).isNull() for c in ("open", "high", "low", "close")} | {("order", "high"): F.col("high") <= F.col("low")}
    kept = None
    for freq in ("D", "W", "M"):
        silver = Table.create(raw.read().filter(F.col("freq") == freq).filter(TRADED), new_path(spark), SD, rules=rules)
        n = silver.read().groupBy("freq").agg(F.count("*").alias("kept"))
        kept = n if kept is None else kept.union(n)
    return raw.read().groupBy("freq").agg(F.count("*").alias("n")).join(kept, "freq", "left").select("freq", "n", F.coalesce("kept", F.lit(0)).alias("kept"))


@query("silver_weekly_members", sql(f"WITH {SPELLS}, e AS (SELECT x.*, v.value FROM ({EVENT_DAYS}) x JOIN events v USING (event_id)) SELECT symbol, {WEEK} AS date, arg_min(value, event_id) AS open, max(value) AS high, min(value) AS low, arg_max(value, event_id) AS close, count(*) AS n FROM e WHERE EXISTS (SELECT 1 FROM spells s WHERE s.symbol = e.symbol AND e.date BETWEEN s.start AND s.\"end\") GROUP BY 1, 2", "changes"))
def silver_weekly_members(spark, sf):
    e = scan(spark, sf, "events").select("event_id", F.col("user_id").cast("string").alias("symbol"), F.to_date("ts").alias("date"), "value")
    return joins.interval(e, _spells(spark, sf)).groupBy("symbol", week_ending("date").alias("d")).agg(F.min_by("value", "event_id").alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", "event_id").alias("close"), F.count("*").alias("n")).withColumnRenamed("d", "date")


def scaled(x: str) -> str:
    return f"round(CASE WHEN {x} IS NULL OR count({x}) OVER (PARTITION BY date) <= 1 THEN 0 ELSE 2.0 * (rank() OVER (PARTITION BY date ORDER BY {x} NULLS LAST) - 1) / (count({x}) OVER (PARTITION BY date) - 1) - 1 END, 6) AS {x}"


SPANS = {"mom1m": 4, "mom3m": 13, "mom6m": 26, "mom12m": 52, "mom36m": 156, "mom60m": 260}
RANKED_FACTORS = ("retvol", "maxret", "ill", "beta", "mom1w", *SPANS, "chmom", "high52", "dist_ma4", "dist_ma12", "dist_ma25", "dist_ma50")
GOLD = f"""WITH {EXCESS}, {PERIOD.replace('{bin}', WEEK)}, h AS (SELECT *, mom1 AS mom1w, {', '.join(f'{grown(n)} AS {c}' for c, n in SPANS.items())}, {grown(25, 27)} AS past, close / max(close) OVER ({SYM} ROWS 51 PRECEDING) AS high52, {', '.join(f'close / avg(close) OVER ({SYM} ROWS {n - 1} PRECEDING) - 1 AS dist_ma{n}' for n in (4, 12, 25, 50))} FROM g),
f AS (SELECT symbol, date, close, volume, {', '.join(f'round({c if c != "chmom" else "mom6m - past"}, {12 if c == "ill" else 6}) + 0.0 AS {c}' for c in RANKED_FACTORS)} FROM h)
SELECT symbol, date, close, volume, {', '.join(map(scaled, RANKED_FACTORS))} FROM f"""


@query("weekly_momentum_gold", sql(GOLD, "rets", "market"))
def weekly_momentum_gold(spark, sf):
    """Seventeen weekly factors, each ranked among its week's symbols to [-1, 1]; nulls are 0. All rolling features share
    the shuffle by symbol, all ranks that by week."""
    f = factors.period_factors(excess(spark, sf), week_ending("date")).withColumnRenamed("mom1", "mom1w")
    far = [(F.col("close") / W.sma("close", n, 1) - 1).alias(f"dist_ma{n}") for n in (4, 12, 25, 50)]
    f = f.select("*", *factors.momenta(SPANS, "mom1w"), W.compound("mom1w", 25, -27).alias("past"), (F.col("close") / W.rolling(F.max, "close", 52)).alias("high52"), *far)
    f = f.withColumn("chmom", F.col("mom6m") - F.col("past"))
    f = f.select(*SD, "close", "volume", *[r(c, 12 if c == "ill" else 6).alias(c) for c in RANKED_FACTORS])
    return f.select(*SD, "close", "volume", *[r(W.rank_scaled(c)).alias(c) for c in RANKED_FACTORS])


@query("prices_bronze", sql("SELECT symbol, date, round(coalesce(open, 0), 2) AS open, round(coalesce(close, 0), 2) AS close, volume FROM bars WHERE symbol NOT IN ('0', '24')", "bars"))
def prices_bronze(spark, sf):
    b = bars(spark, sf).filter(~F.col("symbol").isin("0", "24")).dropDuplicates(SD).fillna(0.0, ["open", "close"])
    return b.select(*SD, r("open", 2).alias("open"), r("close", 2).alias("close"), "volume")


@query("rates_bronze", sql(f"SELECT DISTINCT date, round({RATE}, 9) AS rate FROM bars", "bars"))
def rates_bronze(spark, sf):
    return bars(spark, sf).select("date").distinct().select("date", r((3.0 + (F.dayofyear("date") % 20) / 10.0) / 100 / 252, 9).alias("rate"))


# weights by rule: top n of a score among the eligible on each month's last date, held


def held(panel: str, score: str, ok: str = "true", n: int = 5, desc: bool = True) -> str:
    return sql(f"""WITH m AS ({panel}), p AS (SELECT *, max(date) OVER (PARTITION BY date_trunc('month', date)) = date AS reb, CASE WHEN {ok} THEN {score} END AS s FROM m),
k AS (SELECT *, row_number() OVER (PARTITION BY date ORDER BY s {'DESC' if desc else 'ASC'} NULLS LAST, symbol) AS rk FROM p),
x AS (SELECT *, CASE WHEN reb THEN CASE WHEN s IS NOT NULL AND rk <= {n} THEN {1 / n}::DOUBLE ELSE 0.0::DOUBLE END END AS w0 FROM k)
SELECT symbol, date, coalesce(last_value(w0 IGNORE NULLS) OVER ({SYM} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0.0::DOUBLE) AS weight FROM x""", "weekly", "fund", "market")


TREND = f"SELECT symbol, date, close, {full(12)} AS slow, close / lag(close, 12) OVER ({SYM}) - 1 AS mom FROM weekly"
VALUE = f"SELECT b.*, f.revenue / f.units AS price, f.cost / f.revenue AS share FROM (SELECT symbol, date, close, close / lag(close, 12) OVER ({SYM}) - 1 AS mom FROM weekly) b ASOF LEFT JOIN fund f ON b.symbol = f.symbol AND b.date >= f.date"
REGIME = f"SELECT t.*, l > m AS bull FROM ({TREND}) t JOIN (SELECT date, l, avg(l) OVER (ORDER BY date ROWS 19 PRECEDING) AS m FROM (SELECT date, avg(close) AS l FROM weekly GROUP BY 1)) i USING (date)"


def trend(spark, sf):
    return momentum(spark, sf).withColumn("slow", W.sma("close", 12))


def value(spark, sf):
    v = joins.asof(momentum(spark, sf), fundamentals(spark, sf), ["revenue", "units", "cost"])
    return v.select(*SD, "close", "mom", ratio("revenue", "units").alias("price"), ratio("cost", "revenue").alias("share"))


def chosen(panel, score, **kw):
    return P.topn_weights(panel, score, 5, **kw).select(*SD, "weight")


@query("topn_trend_weights", held(TREND, "mom", "close > slow AND mom > 0.02"))
def topn_trend_weights(spark, sf):
    return chosen(trend(spark, sf), "mom", eligible=F.expr("close > slow and mom > 0.02"))


@query("topn_macro_cash_weights", held(REGIME, "mom", "bull AND close > slow"))
def topn_macro_cash_weights(spark, sf):
    i = weekly(spark, sf).groupBy("date").agg(F.avg("close").alias("l"))
    i = i.select("date", (F.col("l") > F.avg("l").over(Window.orderBy("date").rowsBetween(-19, 0))).alias("bull"))
    return chosen(trend(spark, sf).join(i, "date"), "mom", eligible=F.expr("bull and close > slow"))


@query("factor_topn_weights", held(VALUE, "price", desc=False))
def factor_topn_weights(spark, sf):
    return chosen(value(spark, sf), "price", descending=False)


@query("filter_then_rank_weights", held(VALUE, "mom", "share < 0.05"))
def filter_then_rank_weights(spark, sf):
    return chosen(value(spark, sf), "mom", eligible=F.col("share") < 0.05)


@query("two_stage_pool_weights", held(f"SELECT *, row_number() OVER (PARTITION BY date ORDER BY mom DESC NULLS LAST, symbol) AS pool FROM ({VALUE})", "price", "pool <= 10", desc=False))
def two_stage_pool_weights(spark, sf):
    return chosen(value(spark, sf).withColumn("pool", W.rank_first("mom")), "price", eligible=F.col("pool") <= 10, descending=False)


@query("combined_rank_weights", held(f"SELECT *, {avg_rank('share', 'date')} + {avg_rank('price', 'date')} AS mix FROM ({VALUE}) WHERE share IS NOT NULL", "mix", desc=False))
def combined_rank_weights(spark, sf):
    v = value(spark, sf).filter("share is not null")
    return chosen(v.withColumn("mix", W.rank_average("share") + W.rank_average("price")), "mix", descending=False)


@query("vol_target_weights", sql(f"""WITH v AS (SELECT symbol, date, ret, CASE WHEN count(ret) OVER w >= 12 THEN stddev_samp(ret) OVER w END AS v FROM (SELECT *, close / lag(close) OVER ({SYM}) - 1 AS ret FROM weekly) WINDOW w AS ({SYM} ROWS 11 PRECEDING)),
t AS (SELECT *, CASE WHEN v IS NOT NULL THEN least(0.15::DOUBLE / nullif(v * sqrt(52), 0), 2) END AS weight FROM v), n AS (SELECT *, p * ret - greatest(p - 1, 0) * 0.04::DOUBLE / 52 AS net FROM (SELECT *, coalesce(lag(weight) OVER ({SYM}), 0) AS p FROM t) WHERE v IS NOT NULL AND ret IS NOT NULL)
SELECT symbol, date, round(weight, 6) AS weight, round(net, 6) + 0.0 AS net, round(exp(sum(CASE WHEN net > -1 THEN ln(1 + net) ELSE 0 END) OVER ({SYM} ROWS UNBOUNDED PRECEDING)), 5) AS capital FROM n""", "weekly"))
def vol_target_weights(spark, sf):
    """Weights that bring twelve weeks' volatility to a target, two at the most; last week's weight earns this week's
    return, what is above one pays margin interest, and the capital grows by the rest."""
    w = weekly(spark, sf).select(*SD, W.pct_change("close").alias("ret")).select(*SD, "ret", W.rolling(F.stddev_samp, "ret", 12, least=12).alias("v"))
    w = w.withColumn("weight", F.when(F.col("v").isNotNull(), F.least(ratio(F.lit(0.15), F.col("v") * 52**0.5), F.lit(2.0))))
    w = w.select("*", F.coalesce(F.lag("weight").over(W.by_time()), F.lit(0.0)).alias("p")).filter("v is not null and ret is not null")
    w = w.withColumn("net", F.col("p") * F.col("ret") - F.greatest(F.col("p") - 1, F.lit(0.0)) * 0.04 / 52)
    return w.select(*SD, r("weight").alias("weight"), r("net").alias("net"), r(W.equity("net"), 5).alias("capital"))


# sweeps

#: All lengths up to 49, the short one below the long one.
PAIRS = [(s, n) for n in range(2, 50) for s in range(1, n)]
GRID = f"""WITH w AS (SELECT symbol, date, close, row_number() OVER ({SYM}) AS k, lag(close) OVER ({SYM}) AS before, sum(close) OVER ({SYM}) AS total FROM weekly),
m AS (SELECT w.symbol, w.k, n, CASE WHEN n = 1 THEN w.close ELSE (w.total - coalesce(o.total, 0)) / n END AS mean FROM w, (SELECT unnest(range(1, 50)) AS n) LEFT JOIN w o ON o.symbol = w.symbol AND o.k = w.k - n WHERE w.k >= n),
p AS (SELECT short, long FROM (SELECT unnest(range(1, 50)) AS short), (SELECT unnest(range(1, 50)) AS long) WHERE short < long),
g AS (SELECT w.symbol, w.date, short, long, CASE WHEN y.close - s.mean > 1e-9 * y.close AND abs(s.mean - l.mean) > 1e-9 * y.close THEN w.close / w.before - 1 ELSE 0 END AS x FROM w JOIN p ON w.k >= long AND w.k >= 2 JOIN w y ON y.symbol = w.symbol AND y.k = w.k - 1 LEFT JOIN m s ON s.symbol = w.symbol AND s.k = w.k - 1 AND s.n = short LEFT JOIN m l ON l.symbol = w.symbol AND l.k = w.k - 1 AND l.n = long),
e AS (SELECT *, sum(ln(1 + x)) OVER o AS c FROM g WINDOW o AS (PARTITION BY symbol, short, long ORDER BY date)),
f AS (SELECT *, c - max(c) OVER (PARTITION BY symbol, short, long ORDER BY date) AS fall FROM e),
t AS (SELECT symbol, short, long, count(*) AS n, avg(x) AS mean, stddev_samp(x) AS sd, arg_max(c, date) AS grown, min(fall) AS worst, greatest((max(date) - min(date)) / 365.25, 1) AS years FROM f GROUP BY 1, 2, 3)
SELECT symbol, short, long, n, round(exp(grown) - 1, 5) AS total_return, round(exp(grown / years) - 1, 5) AS cagr, round(sd * sqrt(52), 5) AS volatility, round(mean / nullif(sd, 0) * sqrt(52), 5) AS sharpe, round(exp(worst) - 1, 5) AS max_drawdown FROM t"""


@query("ma_cross_grid", sql(GRID, "weekly"))
def ma_cross_grid(spark, sf):
    """Key figures of all 1,176 pairs of lengths for each symbol."""
    g = grids.cross_grid(weekly(spark, sf).select(*SD, "close"), PAIRS, 52.0)
    return g.select("symbol", "short", "long", "n", *[r(c, 5).alias(c) for c in ("total_return", "cagr", "volatility", "sharpe", "max_drawdown")])


#: Weeks that momentum looks back, names held, and cost of what is traded: all of them with all.
SWEEP = [(back, n, cost) for back in (4, 8, 12, 26, 52) for n in (1, 3, 5, 8) for cost in (0.001, 0.005)]
BACKS = sorted({b for b, _, _ in SWEEP})
SWEPT = f"""WITH b AS (SELECT unnest({BACKS}) AS back), r AS (SELECT *, row_number() OVER ({SYM}) AS k FROM weekly), m AS (SELECT b.back, r.symbol, r.date, r.close / o.close - 1 AS mom, lead(r.close) OVER (PARTITION BY b.back, r.symbol ORDER BY r.date) / r.close - 1 AS nx FROM r CROSS JOIN b LEFT JOIN r o ON o.symbol = r.symbol AND o.k = r.k - b.back),
p AS (SELECT *, max(date) OVER (PARTITION BY back, date_trunc('month', date)) = date AS reb, row_number() OVER (PARTITION BY back, date ORDER BY mom DESC NULLS LAST, symbol) AS rk FROM m),
c AS (SELECT p.*, n, CASE WHEN reb THEN CASE WHEN mom IS NOT NULL AND rk <= n THEN 1.0::DOUBLE / n ELSE 0.0::DOUBLE END END AS w0 FROM p, (SELECT unnest({sorted({n for _, n, _ in SWEEP})}) AS n)),
h AS (SELECT back, n, symbol, date, nx, coalesce(last_value(w0 IGNORE NULLS) OVER (PARTITION BY back, n, symbol ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS w FROM c), d AS (SELECT *, w - coalesce(lag(w) OVER (PARTITION BY back, n, symbol ORDER BY date), 0) AS dw FROM h),
s AS (SELECT back, n, date, sum(w * coalesce(nx, 0)) AS gross, sum(abs(dw)) AS turn FROM d GROUP BY 1, 2, 3), t AS (SELECT back, n, cost, date, gross - turn * cost AS net FROM s, (SELECT unnest([0.001::DOUBLE, 0.005::DOUBLE]) AS cost)),
e AS (SELECT *, exp(sum(CASE WHEN net > -1 THEN ln(1 + net) ELSE 0 END) OVER (PARTITION BY back, n, cost ORDER BY date ROWS UNBOUNDED PRECEDING)) AS equity FROM t), f AS (SELECT *, equity / max(equity) OVER (PARTITION BY back, n, cost ORDER BY date ROWS UNBOUNDED PRECEDING) - 1 AS fall FROM e),
g AS (SELECT back, n, cost, arg_max(equity, date) AS l, min(fall) AS dd, stddev_samp(net) AS sd, avg(net) AS mn, greatest((max(date) - min(date)) / 365.25, 1) AS y FROM f GROUP BY 1, 2, 3)
SELECT back, n, cost, round(l - 1, 5) AS total_return, round(pow(l, 1 / y) - 1, 5) AS cagr, round(sd * sqrt(52), 5) AS volatility, round(mn / sd * sqrt(52), 5) AS sharpe, round((pow(l, 1 / y) - 1) / abs(dd), 5) AS calmar, round(dd, 5) AS max_drawdown FROM g"""


@query("param_sweep", sql(SWEPT, "weekly"))
def param_sweep(spark, sf):
    """Key figures of each of forty configurations in one job: look-backs share the pass over the panel, numbers of names
    share its ranks, costs share the sums by date. Rows are repeated only where a parameter first matters."""
    w = weekly(spark, sf).withColumn("p", F.trunc("date", "month"))
    one = w.select(*SD, W.last_of_period("p").alias("reb"), W.forward_return("close").alias("nx"), *[W.pct_change("close", b).alias(f"mom{b}") for b in BACKS])
    one = one.select(*SD, "reb", "nx", F.explode(F.array(*[F.struct(F.lit(b).alias("back"), F.col(f"mom{b}").alias("mom")) for b in BACKS])).alias("c"))
    rank = F.row_number().over(Window.partitionBy("c.back", "date").orderBy(F.col("c.mom").desc_nulls_last(), "symbol"))
    ranked = one.select(*SD, "reb", "nx", "c.back", "c.mom", rank.alias("rk"))
    c = ranked.withColumn("n", F.explode(F.array(*[F.lit(n) for n in sorted({n for _, n, _ in SWEEP})])))
    c = c.withColumn("w0", F.when(F.col("reb"), F.when(F.col("mom").isNotNull() & (F.col("rk") <= F.col("n")), 1.0 / F.col("n")).otherwise(0.0)))
    key = ["back", "n", "symbol"]
    h = c.select(*key, "date", "nx", F.coalesce(W.forward_fill("w0", key=key), F.lit(0.0)).alias("w")).select("*", W.weight_change("w", key=key).alias("dw"))
    by = h.groupBy("back", "n", "date").agg(F.sum(F.col("w") * F.coalesce("nx", F.lit(0.0))).alias("gross"), F.sum(F.abs("dw")).alias("turn"))
    by = by.withColumn("cost", F.explode(F.array(*[F.lit(x) for x in sorted({x for _, _, x in SWEEP})]))).withColumn("net", F.col("gross") - F.col("turn") * F.col("cost"))
    k = P.kpis_by(by, ["back", "n", "cost"], per_year=52.0)
    return k.select("back", "n", "cost", *[r(x, 5).alias(x) for x in ("total_return", "cagr", "volatility", "sharpe", "calmar", "max_drawdown")])


@query("long_short_value_weighted", sql(f"WITH m AS (SELECT symbol, last_day(date) AS date, arg_max(close, date) AS close, sum(close * volume) AS dv FROM bars GROUP BY 1, 2), f AS (SELECT *, close / lag(close, 3) OVER ({SYM}) - 1 AS mom, lead(close) OVER ({SYM}) / close - 1 AS nx FROM m), e AS (SELECT date, quantile_cont(mom, 0.1) AS lo, quantile_cont(mom, 0.9) AS hi FROM f WHERE mom IS NOT NULL AND nx IS NOT NULL GROUP BY 1) SELECT date, round(sum(nx * dv) FILTER (WHERE mom > hi) / sum(dv) FILTER (WHERE mom > hi) - sum(nx * dv) FILTER (WHERE mom <= lo) / sum(dv) FILTER (WHERE mom <= lo), 6) AS spread FROM f JOIN e USING (date) WHERE mom IS NOT NULL AND nx IS NOT NULL GROUP BY 1", "bars"))
def long_short_value_weighted(spark, sf):
    m = bars(spark, sf).groupBy("symbol", F.last_day("date").alias("d")).agg(F.max_by("close", "date").alias("close"), F.sum(F.col("close") * F.col("volume")).alias("dv")).withColumnRenamed("d", "date")
    f = m.select(*SD, "dv", W.pct_change("close", 3).alias("mom"), W.forward_return("close").alias("nx")).dropna()
    e = quantiles.edges(f, ["date"], "mom", 0.1, 0.9)
    side = lambda c: ratio(F.sum(F.when(c, F.col("nx") * F.col("dv"))), F.sum(F.when(c, F.col("dv"))))
    return f.join(e, "date").groupBy("date").agg(r(side(F.col("mom") > F.col("hi")) - side(F.col("mom") <= F.col("lo"))).alias("spread"))


@query("decile_error_rate", sql(f"WITH f AS (SELECT symbol, date, close / lag(close, 12) OVER ({SYM}) - 1 AS mom, lead(close) OVER ({SYM}) / close - 1 AS nx FROM weekly), v AS (SELECT * FROM f WHERE mom IS NOT NULL AND nx IS NOT NULL), e AS (SELECT date, quantile_cont(mom, 0.1) AS lo, quantile_cont(mom, 0.9) AS hi FROM v GROUP BY 1) SELECT round(avg(CASE WHEN nx < 0 THEN 1.0 ELSE 0.0 END) FILTER (WHERE mom > hi), 6) AS top_error, round(avg(CASE WHEN nx > 0 THEN 1.0 ELSE 0.0 END) FILTER (WHERE mom <= lo), 6) AS bottom_error FROM v JOIN e USING (date)", "weekly"))
def decile_error_rate(spark, sf):
    f = momentum(spark, sf).select(*SD, "mom", W.forward_return("close").alias("nx")).dropna()
    e = quantiles.edges(f, ["date"], "mom", 0.1, 0.9)
    share = lambda where, bad: r(F.avg(F.when(where, bad.cast("double"))))
    return f.join(e, "date").agg(share(F.col("mom") > F.col("hi"), F.col("nx") < 0).alias("top_error"), share(F.col("mom") <= F.col("lo"), F.col("nx") > 0).alias("bottom_error"))


# labels and lookups


@query("label_topn_forward", sql(f"SELECT symbol, date, CASE WHEN nx >= 0.02 AND row_number() OVER (PARTITION BY date ORDER BY nx DESC NULLS LAST, symbol) <= 5 THEN 1 ELSE 0 END AS label FROM (SELECT symbol, date, lead(close, 4) OVER ({SYM}) / close - 1 AS nx FROM weekly)", "weekly"))
def label_topn_forward(spark, sf):
    w = weekly(spark, sf).select(*SD, W.forward_return("close", 4).alias("nx")).withColumn("rk", W.rank_first("nx"))
    return w.select(*SD, F.coalesce(((F.col("nx") >= 0.02) & (F.col("rk") <= 5)).cast("int"), F.lit(0)).alias("label"))


for _name, _sql, _col in (("label_period_return", f"lead(x) OVER ({SYM}) / x - 1", lambda: W.forward_return("x")), ("label_same_period", f"x / lag(x) OVER ({SYM}) - 1", lambda: W.pct_change("x"))):

    @query(_name, sql(f"WITH p AS (SELECT symbol, date, {_sql} AS y FROM ({MONTHS})) SELECT b.symbol, b.date, round(y, 6) AS y FROM bars b ASOF LEFT JOIN p ON b.symbol = p.symbol AND b.date <= p.date", "bars"))
    def label_period(spark, sf, col=_col):
        b = bars(spark, sf)
        m = b.groupBy("symbol", F.last_day("date").alias("d")).agg(F.max_by("close", "date").alias("x")).withColumnRenamed("d", "date")
        return joins.asof(b.select(*SD, "close"), m.select(*SD, col().alias("y")), ["y"], forward=True).select(*SD, r("y").alias("y"))


@query("per_row_lookup", sql(f"WITH {WEIGHTS}, h AS (SELECT *, lag(weight) OVER ({SYM}) AS pw, lag(date) OVER ({SYM}) AS pd FROM weights), g AS (SELECT *, last_value(CASE WHEN weight > 0 AND coalesce(pw, 0) = 0 THEN date END IGNORE NULLS) OVER ({SYM} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS entry FROM h) SELECT g.symbol, g.date, g.entry, e.close AS at_entry, b.close AS before, n.close AS now FROM g LEFT JOIN weekly e ON e.symbol = g.symbol AND e.date = g.entry LEFT JOIN weekly b ON b.symbol = g.symbol AND b.date = g.pd LEFT JOIN weekly n ON n.symbol = g.symbol AND n.date = g.date WHERE g.weight > 0", "weekly"))
def per_row_lookup(spark, sf):
    """Prices of a holding when it was entered, on the date before and now: all are rows of its own key in time order,
    so one window does the work of three joins."""
    new = F.when((F.col("weight") > 0) & (F.coalesce(F.lag("weight").over(W.by_time()), F.lit(0.0)) == 0), F.struct("date", "close"))
    p = weights(spark, sf).select(*SD, "close", "weight", new.alias("new"), F.lag("close").over(W.by_time()).alias("before")).withColumn("e", W.forward_fill("new")).filter("weight > 0")
    return p.select(*SD, F.col("e.date").alias("entry"), F.col("e.close").alias("at_entry"), "before", F.col("close").alias("now"))
