"""Queries of scans, sinks, increments, projections and filters."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.functions.expr import call_price, clip, r
from driftline.operators import quality
from driftline.operators import windows as W
from driftline.operators.ranks import dense_codes
from driftline.plans.catalog import bars, fundamentals, market, query, sql, weekly
from driftline.sources import increments, store
from driftline.sources.store import scan
from driftline.sources.versions import Table


@query("scan_table", "SELECT * FROM nation")
def scan_table(spark, sf):
    return scan(spark, sf, "nation")


@query("scan_files_union", "SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS day FROM orders")
def scan_files_union(spark, sf):
    o = scan(spark, sf, "orders").select("o_custkey", F.to_date("o_orderdate").alias("day"), "o_orderkey")
    return o.unionByName(o).dropDuplicates(["o_custkey", "day"]).drop("o_orderkey")


@query("scan_serving", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def scan_serving(spark, sf):
    return store.written(scan(spark, sf, "supplier"))


@query("scan_filter_project", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01'")
def scan_filter_project(spark, sf):
    return scan(spark, sf, "orders").filter("o_orderdate >= timestamp'1999-01-01'").select("o_orderkey", "o_custkey", "o_totalprice")


@query("sql_view_scan", "SELECT o_custkey, o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'")
def sql_view_scan(spark, sf):
    scan(spark, sf, "orders").createOrReplaceTempView("driftline_orders")
    return spark.sql("SELECT o_custkey, o_orderkey, o_totalprice FROM driftline_orders WHERE o_orderdate >= timestamp'2000-01-01' ORDER BY o_custkey, o_orderkey")


@query("typed_create", sql("SELECT date, len(list(symbol)) AS n, array_to_string(list_sort(list(symbol)), ',') AS tickers FROM bars GROUP BY date", "bars"))
def typed_create(spark, sf):
    schema = T.StructType([T.StructField("date", T.DateType()), T.StructField("tickers", T.ArrayType(T.StringType()))])
    snap = bars(spark, sf).groupBy("date").agg(F.array_sort(F.collect_set("symbol")).alias("tickers"))
    return store.written(snap.to(schema)).select("date", F.size("tickers").cast("long").alias("n"), F.array_join("tickers", ",").alias("tickers"))


@query("coerce_cast", "SELECT event_id, TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k, TRY_CAST(event_type AS DOUBLE) AS bad, CAST(ts AS DATE) AS day FROM events")
def coerce_cast(spark, sf):
    e = scan(spark, sf, "events")
    return e.select("event_id", F.regexp_extract("props", "([0-9]+)", 1).try_cast("long").alias("k"), F.col("event_type").try_cast("double").alias("bad"), F.to_date("ts").alias("day"))


@query("write_overwrite", "SELECT p_partkey, p_brand FROM part")
def write_overwrite(spark, sf):
    path, df = store.new_path(spark), scan(spark, sf, "part").select("p_partkey", "p_brand")
    store.written(df.limit(1), path=path)
    return store.written(df, path=path)


@query("write_merge_schema", "SELECT p_partkey, p_brand, CASE WHEN p_partkey % 2 = 1 THEN p_size END AS p_size FROM part")
def write_merge_schema(spark, sf):
    path, df = store.new_path(spark), scan(spark, sf, "part")
    store.written(df.filter("p_partkey % 2 = 0").select("p_partkey", "p_brand"), path=path)
    store.written(df.filter("p_partkey % 2 = 1").select("p_partkey", "p_brand", "p_size"), path=path, mode="append")
    return spark.read.option("mergeSchema", "true").parquet(path).select("p_partkey", "p_brand", "p_size")


@query("write_partitioned", "SELECT s_suppkey, s_acctbal, s_nationkey FROM supplier")
def write_partitioned(spark, sf):
    return store.written(scan(spark, sf, "supplier").select("s_suppkey", "s_acctbal", "s_nationkey"), partition_by=["s_nationkey"])


@query("write_single_file", "SELECT * FROM region")
def write_single_file(spark, sf):
    return store.written(scan(spark, sf, "region"), single=True)


@query("write_serving", "SELECT n_nationkey, n_name FROM nation")
def write_serving(spark, sf):
    return store.written(scan(spark, sf, "nation").select("n_nationkey", "n_name"))


def _customers(spark, sf):
    """Balances by customer, in parts that follow from the key."""
    return scan(spark, sf, "customer").select("c_custkey", "c_acctbal", F.pmod("c_custkey", F.lit(16)).alias("part"))


def _raised(c):
    return c.filter("c_custkey % 3 = 0").withColumn("c_acctbal", F.round(F.col("c_acctbal") + 1, 2))


@query("upsert_update_insert", "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN round(c_acctbal + 1, 2) ELSE c_acctbal END AS c_acctbal FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 = 0")
def upsert_update_insert(spark, sf):
    """A stored table of half the customers takes in a third of all, twice; what is read is its last version."""
    c = _customers(spark, sf)
    table = Table.create(c.filter("c_custkey % 2 = 0"), store.new_path(spark), ["c_custkey", "part"], ["part"])
    for _ in range(2):
        table.merge(_raised(c))
    return table.read().select("c_custkey", "c_acctbal")


@query("upsert_insert_only", "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal ELSE round(c_acctbal + 1, 2) END AS c_acctbal FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 = 0")
def upsert_insert_only(spark, sf):
    c = _customers(spark, sf)
    table = Table.create(c.filter("c_custkey % 2 = 0"), store.new_path(spark), ["c_custkey", "part"], ["part"])
    for _ in range(2):
        table.merge(_raised(c), update=False)
    return table.read().select("c_custkey", "c_acctbal")


@query("export_text", "SELECT s_suppkey, s_name, s_acctbal, 'csv' AS kind FROM supplier UNION ALL SELECT s_suppkey, s_name, s_acctbal, 'json' AS kind FROM supplier")
def export_text(spark, sf):
    s = scan(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    return store.written(s, "csv", header="true").withColumn("kind", F.lit("csv")).union(store.written(s, "json").withColumn("kind", F.lit("json")))


@query("project_rewrite", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def project_rewrite(spark, sf):
    return store.written(scan(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"))


NUMBERS = ("o_orderkey", "o_custkey", "o_totalprice")
STATS = {"count": "count({c})", "mean": "round(avg({c}), 4)", "stddev": "round(stddev_samp({c}), 4)", "min": "min({c})", "max": "max({c})"}
DESCRIBE = " UNION ALL ".join(
    [f"SELECT '{k}' AS part, '{c}' AS name, CAST({f.format(c=c)} AS DOUBLE) AS number, NULL::VARCHAR AS text FROM orders" for c in NUMBERS for k, f in STATS.items()]
    + [f"SELECT 'type', '{c}', {k}::DOUBLE, '{t}'" for k, (c, t) in enumerate((("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz")))]
    + [f"SELECT * FROM (SELECT '{part}', CAST(o_orderkey AS VARCHAR), o_totalprice, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) FROM orders ORDER BY o_orderdate {way}, o_orderkey {way} LIMIT 5)" for part, way in (("oldest", "ASC"), ("newest", "DESC"))]
)


@query("describe_table", DESCRIBE)
def describe_table(spark, sf):
    """What a first look at a table shows, as rows (part, name, number, text): columns and types, figures of the numeric
    ones from one aggregation, the five oldest and newest rows."""
    o = scan(spark, sf, "orders").select(*NUMBERS, "o_orderdate")
    figures = {"count": F.count, "mean": lambda c: r(F.avg(c), 4), "stddev": lambda c: r(F.stddev_samp(c), 4), "min": F.min, "max": F.max}
    row = lambda part, name, number, text: F.struct(F.lit(part).alias("part"), name.alias("name"), number.cast("double").alias("number"), text.cast("string").alias("text"))
    one = o.agg(*[f(c).alias(f"{k}_{c}") for c in NUMBERS for k, f in figures.items()])
    stats = one.select(F.explode(F.array(*[row(k, F.lit(c), F.col(f"{k}_{c}"), F.lit(None)) for c in NUMBERS for k in figures])).alias("x")).select("x.*")
    kinds = spark.createDataFrame([("type", f.name, float(k), f.dataType.simpleString()) for k, f in enumerate(o.schema)], "part string, name string, number double, text string")
    ends = []
    for part, way in (("oldest", F.asc), ("newest", F.desc)):
        ends.append(o.orderBy(way("o_orderdate"), way("o_orderkey")).limit(5).select(row(part, F.col("o_orderkey").cast("string"), F.col("o_totalprice"), F.to_date("o_orderdate")).alias("x")).select("x.*"))
    return stats.union(kinds).union(ends[0]).union(ends[1])


@query("high_water_mark", sql("SELECT max(date) AS hwm, count(*) > 0 AS is_incremental FROM bars", "bars"))
def high_water_mark(spark, sf):
    return bars(spark, sf).agg(F.max("date").alias("hwm"), (F.count("*") > 0).alias("is_incremental"))


@query("lookback_window", sql("SELECT symbol, date, open, high, low, close, volume FROM bars", "bars"))
def lookback_window(spark, sf):
    """A stored table of bars by month whose last sixty days lack every other order, as an early load does: those days are
    built anew from their orders and published; what is read is the whole table."""
    month = lambda b: b.withColumn("month", F.date_format("date", "yyyy-MM"))
    last = scan(spark, sf, "orders").agg(F.max("o_orderdate")).first()[0]
    early = (F.col("o_orderdate") < F.lit(last) - F.expr("interval 60 days")) | (F.col("o_orderkey") % 2 == 0)
    table = Table.create(month(bars(spark, sf, early)), store.new_path(spark), ["symbol", "date"], ["month"])
    increments.reload_stretch(table, lambda start: month(bars(spark, sf, F.col("o_orderdate") >= F.lit(start).cast("timestamp"))), 60)
    return table.read().drop("month")


@query("per_key_resume", sql("SELECT CAST(n_nationkey AS VARCHAR) AS symbol, greatest(coalesce(m + 1, DATE '1995-01-01'), DATE '1995-01-01') AS start FROM nation LEFT JOIN (SELECT symbol, max(date) AS m FROM bars WHERE volume = 1 GROUP BY 1) b ON b.symbol = CAST(n_nationkey AS VARCHAR) WHERE greatest(coalesce(m + 1, DATE '1995-01-01'), DATE '1995-01-01') < DATE '2001-08-01'", "bars"))
def per_key_resume(spark, sf):
    return store.resume_points(bars(spark, sf).filter("volume = 1"), scan(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("symbol")), "1995-01-01", "2001-08-01")


@query("new_rows_only", sql("SELECT symbol, max(date) + 1 AS start FROM bars GROUP BY 1 HAVING max(date) + 1 < DATE '2001-08-01'", "bars"))
def new_rows_only(spark, sf):
    return bars(spark, sf).groupBy("symbol").agg(F.date_add(F.max("date"), 1).alias("start")).filter("start < date'2001-08-01'")


@query("batch_plan", "SELECT start, batch, string_agg(k, ',' ORDER BY k) AS keys FROM (SELECT start, k, CAST(floor((row_number() OVER (PARTITION BY start ORDER BY k) - 1) / 20) AS BIGINT) AS batch FROM (SELECT CAST(o_custkey AS VARCHAR) AS k, CAST(date_trunc('year', max(o_orderdate)) AS DATE) AS start FROM orders GROUP BY 1)) GROUP BY 1, 2")
def batch_plan(spark, sf):
    s = scan(spark, sf, "orders").groupBy(F.col("o_custkey").cast("string").alias("symbol")).agg(F.trunc(F.max("o_orderdate"), "year").alias("start"))
    return store.batch_plan(s, 20).withColumn("keys", F.array_join("keys", ","))


@query("split_period", sql("SELECT symbol, CAST(s AS DATE) AS part_start, least(CAST(s AS DATE) + 90, hi) AS part_end FROM (SELECT symbol, hi, unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 91 DAY)) AS s FROM (SELECT symbol, min(date) AS lo, max(date) AS hi FROM bars GROUP BY 1))", "bars"))
def split_period(spark, sf):
    p = bars(spark, sf).groupBy("symbol").agg(F.min("date").alias("start"), F.max("date").alias("end"))
    return store.split_period(p, 90).select("symbol", "part_start", "part_end")


@query("standardize_columns", sql("SELECT symbol AS Ticker, date AS Date, round(close * 1.01, 4) AS Close FROM bars", "bars"))
def standardize_columns(spark, sf):
    b = bars(spark, sf).select(F.col("symbol").alias("Ticker"), F.col("date").alias("Date"), F.col("close").alias("Close"), r(F.col("close") * 1.01, 4).alias("AdjClose"))
    low = {c.lower(): c for c in b.columns}
    return b.drop(low["close"]).withColumnRenamed(low["adjclose"], "Close") if "adjclose" in low else b


@query("rename_by_map", "SELECT o_orderkey AS id, o_custkey AS symbol, o_totalprice AS price FROM orders")
def rename_by_map(spark, sf):
    names = {"O_ORDERKEY": "id", "O_CUSTKEY": "symbol", "O_TOTALPRICE": "price"}
    o = scan(spark, sf, "orders")
    found = {c: names[c.upper()] for c in o.columns if c.upper() in names}
    return o.withColumnsRenamed(found).select(*found.values())


@query("coalesce_close", "SELECT event_id, coalesce(CASE WHEN event_id % 3 <> 0 THEN value END, value * 2) AS close, CAST(NULL AS BIGINT) AS volume FROM events")
def coalesce_close(spark, sf):
    e = scan(spark, sf, "events").withColumn("adj", F.when(F.col("event_id") % 3 != 0, F.col("value")))
    return e.select("event_id", F.coalesce("adj", F.col("value") * 2).alias("close"), F.lit(None).cast("long").alias("volume"))


@query("fill_constants", "SELECT event_id, coalesce(CASE WHEN event_id % 4 <> 0 THEN value END, 0.0) AS value, coalesce(CASE WHEN event_id % 5 <> 0 THEN user_id END, 1) AS user_id FROM events")
def fill_constants(spark, sf):
    e = scan(spark, sf, "events").select("event_id", F.when(F.col("event_id") % 4 != 0, F.col("value")).alias("value"), F.when(F.col("event_id") % 5 != 0, F.col("user_id")).alias("user_id"))
    return e.fillna({"value": 0.0, "user_id": 1})


@query("drop_nulls", sql("SELECT symbol, date, round(ret, 6) AS ret FROM rets WHERE ret IS NOT NULL", "rets"))
def drop_nulls(spark, sf):
    return bars(spark, sf).select("symbol", "date", r(W.pct_change("close")).alias("ret")).dropna(subset=["ret"])


@query("inf_to_null", "SELECT event_id, round(10.0 / value, 6) AS x FROM events WHERE value <> 0")
def inf_to_null(spark, sf):
    x = F.when(F.col("value") == 0, F.lit(float("inf"))).otherwise(F.try_divide(F.lit(10.0), "value"))
    e = scan(spark, sf, "events").select("event_id", x.alias("x"))
    return e.select("event_id", r(F.when(F.isnan("x") | (F.abs("x") == float("inf")), None).otherwise(F.col("x"))).alias("x")).dropna()


@query("dedupe_column_names", sql("SELECT b.symbol, b.date, close, round(level, 6) AS level FROM bars b JOIN market m ON b.date = m.date", "bars", "market"))
def dedupe_column_names(spark, sf):
    seen, b, m = [], bars(spark, sf).select("symbol", "date", "close"), market(spark, sf).withColumn("close", F.lit(0.0))
    seen += b.columns
    return b.join(m.select("date", *[c for c in m.columns if c not in seen]), "date").select("symbol", "date", "close", r("level", 6).alias("level"))


@query("drop_if_exists", "SELECT n_nationkey, n_name FROM nation")
def drop_if_exists(spark, sf):
    return scan(spark, sf, "nation").drop("n_regionkey", "not_there")


@query("date_parts", sql("SELECT symbol, date, isodow(date) - 1 AS dow, month(date) AS month, year(date) AS year FROM bars", "bars"))
def date_parts(spark, sf):
    return bars(spark, sf).select("symbol", "date", F.weekday("date").cast("long").alias("dow"), F.month("date").cast("long").alias("month"), F.year("date").cast("long").alias("year"))


@query("encode_category", "SELECT c_custkey, dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS code FROM customer")
def encode_category(spark, sf):
    return dense_codes(scan(spark, sf, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment").select("c_custkey", "code")


@query("valuation_ratios", sql("SELECT symbol, date, CASE WHEN cost > 0 THEN round(revenue / cost, 4) END AS p_cost, CASE WHEN revenue > 0 THEN round(units / revenue, 6) END AS yield, CASE WHEN revenue > 0 THEN round(ln(revenue), 6) END AS log_rev FROM fund", "fund"))
def valuation_ratios(spark, sf):
    guard = lambda top, bottom, digits=6: F.when(F.col(bottom) > 0, r(F.col(top) / F.col(bottom), digits))
    return fundamentals(spark, sf).select("symbol", "date", guard("revenue", "cost", 4).alias("p_cost"), guard("units", "revenue").alias("yield"), F.when(F.col("revenue") > 0, r(F.log("revenue"))).alias("log_rev"))


@query("earnings_surprise", sql("SELECT symbol, date, CASE WHEN est <> 0 THEN round((revenue - est) / abs(est), 6) END AS surprise FROM (SELECT *, lag(revenue) OVER (PARTITION BY symbol ORDER BY date) AS est FROM fund) WHERE symbol NOT IN ('3', '7')", "fund"))
def earnings_surprise(spark, sf):
    f = fundamentals(spark, sf).withColumn("est", F.lag("revenue").over(W.by_time())).filter(~F.col("symbol").isin("3", "7"))
    return f.select("symbol", "date", F.when(F.col("est") != 0, r((F.col("revenue") - F.col("est")) / F.abs("est"))).alias("surprise"))


RATE = "(3.0 + (dayofyear(date) % 20) / 10.0) / 100"


@query("risk_free_rates", sql(f"SELECT date, round({RATE} / 252, 9) AS daily, round({RATE} / 52, 9) AS weekly, round({RATE} / 12, 9) AS monthly FROM (SELECT DISTINCT date FROM bars)", "bars"))
def risk_free_rates(spark, sf):
    rate = (3.0 + (F.dayofyear("date") % 20) / 10.0) / 100
    return bars(spark, sf).select("date").distinct().select("date", r(rate / 252, 9).alias("daily"), r(rate / 52, 9).alias("weekly"), r(rate / 12, 9).alias("monthly"))


@query("inverse_series", sql("SELECT symbol, date, high, low, close FROM bars UNION ALL SELECT symbol || '_INV', date, 1 / low, 1 / high, 1 / close FROM bars", "bars"))
def inverse_series(spark, sf):
    b = bars(spark, sf).select("symbol", "date", "high", "low", "close")
    return b.unionByName(b.select(F.concat("symbol", F.lit("_INV")).alias("symbol"), "date", (1 / F.col("low")).alias("high"), (1 / F.col("high")).alias("low"), (1 / F.col("close")).alias("close")))


@query("carry_yield", "SELECT a.n_name || b.n_name AS pair, round((a.n_regionkey - b.n_regionkey) / 100.0 / 52, 9) AS carry FROM nation a JOIN nation b ON a.n_regionkey <> b.n_regionkey AND a.n_nationkey = (b.n_nationkey + 1) % 25")
def carry_yield(spark, sf):
    n = scan(spark, sf, "nation")
    a, b = n.select(F.col("n_name").alias("x"), F.col("n_regionkey").alias("rx"), F.col("n_nationkey").alias("kx")), n.select(F.col("n_name").alias("y"), F.col("n_regionkey").alias("ry"), ((F.col("n_nationkey") + 1) % 25).alias("kx"))
    return a.join(b, "kx").filter("rx <> ry").select(F.concat("x", "y").alias("pair"), r((F.col("rx") - F.col("ry")) / 100.0 / 52, 9).alias("carry"))


@query("synthetic_symbol", sql("SELECT symbol, date, close FROM bars UNION ALL SELECT 'MARKET', date, round(level, 6) FROM market", "bars", "market"))
def synthetic_symbol(spark, sf):
    return bars(spark, sf).select("symbol", "date", "close").unionByName(market(spark, sf).select(F.lit("MARKET").alias("symbol"), "date", r("level", 6).alias("close")))


MA = "SELECT *, avg(close) OVER (PARTITION BY symbol ORDER BY date ROWS 3 PRECEDING) AS fast, avg(close) OVER (PARTITION BY symbol ORDER BY date ROWS 11 PRECEDING) AS slow FROM weekly"


def _ma(spark, sf):
    return weekly(spark, sf).select("symbol", "date", "close", W.sma("close", 4, 1).alias("fast"), W.sma("close", 12, 1).alias("slow"))


@query("regime_flag", sql(f"SELECT symbol, date, CASE WHEN (fast > slow AND close > slow) OR (fast < slow AND close > fast) THEN 'Bull' ELSE 'Bear' END AS regime FROM ({MA})", "weekly"))
def regime_flag(spark, sf):
    up = F.expr("(fast > slow and close > slow) or (fast < slow and close > fast)")
    return _ma(spark, sf).select("symbol", "date", F.when(up, "Bull").otherwise("Bear").alias("regime"))


@query("regime_flag_strict", sql(f"SELECT symbol, date, CASE WHEN fast > slow AND close > slow THEN 'Bull' ELSE 'Bear' END AS regime FROM ({MA})", "weekly"))
def regime_flag_strict(spark, sf):
    return _ma(spark, sf).select("symbol", "date", F.when(F.expr("fast > slow and close > slow"), "Bull").otherwise("Bear").alias("regime"))


@query("trend_flags_ma56", sql("SELECT date, CASE WHEN level > ma THEN 1 ELSE 0 END AS bull, CASE WHEN level < ma THEN 1 ELSE 0 END AS bear FROM (SELECT *, avg(level) OVER (ORDER BY date ROWS 55 PRECEDING) AS ma FROM market)", "market"))
def trend_flags_ma56(spark, sf):
    m = market(spark, sf).withColumn("symbol", F.lit("M")).withColumn("ma", W.sma("level", 56, 1))
    return m.select("date", (F.col("level") > F.col("ma")).cast("int").alias("bull"), (F.col("level") < F.col("ma")).cast("int").alias("bear"))


CDF = "(CASE WHEN {x} >= 0 THEN 1 - {t} ELSE {t} END)"


def _cdf_sql(x: str) -> str:
    t = f"(1 / (1 + abs({x}) * 0.2316419))"
    tail = f"(exp(-({x}) * ({x}) / 2) / 2.5066282746310002 * ({t} * (0.319381530 + {t} * (-0.356563782 + {t} * (1.781477937 + {t} * (-1.821255978 + {t} * 1.330274429))))))"
    return CDF.format(x=x, t=tail)


def _call_sql(price: str, strike: str, t: float, iv: str, rate: float = 0.04) -> str:
    d1 = f"((ln({price} / {strike}) + ({rate} + {iv} * {iv} / 2) * {t}::DOUBLE) / ({iv} * sqrt({t}::DOUBLE)))"
    return f"({price} * {_cdf_sql(d1)} - {strike} * exp(-{rate}::DOUBLE * {t}) * {_cdf_sql(f'({d1} - {iv} * sqrt({t}::DOUBLE))')})"


OPTION = f"""WITH v AS (SELECT symbol, date, close, lead(close) OVER w AS nx, ret FROM (SELECT *, close / lag(close) OVER (PARTITION BY symbol ORDER BY date) - 1 AS ret FROM weekly) WINDOW w AS (PARTITION BY symbol ORDER BY date)),
s AS (SELECT *, CASE WHEN count(ret) OVER y >= 12 THEN stddev_samp(ret) OVER y END * sqrt(52) * 1.2::DOUBLE AS iv FROM v WINDOW y AS (PARTITION BY symbol ORDER BY date ROWS 11 PRECEDING)),
p AS (SELECT symbol, date, {_call_sql('close', '(close * 0.9)', 180 / 365, 'iv')} * 1.02 AS paid, {_call_sql('nx', '(close * 0.9)', 173 / 365, 'iv')} * 0.98 AS got FROM s WHERE iv > 0)
SELECT symbol, date, round(paid, 4) AS paid, round(got, 4) AS got, round(greatest(CASE WHEN paid > 0 THEN (got - paid) / paid ELSE 0 END, -1), 5) AS ret FROM p WHERE got IS NOT NULL"""


@query("option_return", sql(OPTION, "weekly"))
def option_return(spark, sf):
    """What a call at nine tenths of the price earns in a week: bought at 180 days to expiry with volatility from twelve
    weeks' returns, marked up; sold on the next price a week later; both at a spread of two percent; -1 at the least."""
    w = weekly(spark, sf).select("symbol", "date", "close", W.forward_return("close").alias("next"), W.pct_change("close").alias("ret"), F.lead("close").over(W.by_time()).alias("nx"))
    w = w.withColumn("iv", W.rolling(F.stddev_samp, "ret", 12, least=12) * F.sqrt(F.lit(52)) * 1.2).filter("iv > 0 and nx is not null")
    paid = call_price(F.col("close"), F.col("close") * 0.9, 180 / 365, F.col("iv"), 0.04) * 1.02
    got = call_price(F.col("nx"), F.col("close") * 0.9, 173 / 365, F.col("iv"), 0.04) * 0.98
    p = w.select("symbol", "date", paid.alias("paid"), got.alias("got"))
    gain = F.when(F.col("paid") > 0, (F.col("got") - F.col("paid")) / F.col("paid")).otherwise(0.0)
    return p.select("symbol", "date", r("paid", 4).alias("paid"), r("got", 4).alias("got"), r(clip(gain, low=-1.0), 5).alias("ret"))


@query("call_markup_branches", sql("SELECT symbol, date, round(CASE WHEN ret IS NULL THEN NULL ELSE CASE CAST(symbol AS INTEGER) % 3 WHEN 0 THEN ret WHEN 1 THEN greatest(ret * 3, -1) ELSE greatest(ret * 2 - 0.01, -1) END END, 6) AS value FROM rets", "rets"))
def call_markup_branches(spark, sf):
    b = bars(spark, sf).select("symbol", "date", W.pct_change("close").alias("ret"))
    kind, x = F.col("symbol").cast("int") % 3, F.col("ret")
    floor = lambda v: F.when(x.isNotNull(), clip(v, low=-1.0))
    return b.select("symbol", "date", r(F.when(kind == 0, x).when(kind == 1, floor(x * 3)).otherwise(floor(x * 2 - 0.01))).alias("value"))


ORACLE_NULL = "CASE WHEN ret IS NOT NULL THEN {} END"


@query("clip", sql(f"SELECT symbol, date, round({ORACLE_NULL.format('least(greatest(ret, -0.5), 0.5)')}, 6) AS ret FROM rets", "rets"))
def clip_query(spark, sf):
    b = bars(spark, sf).select("symbol", "date", W.pct_change("close").alias("ret"))
    return b.select("symbol", "date", r(F.when(F.col("ret").isNotNull(), clip(F.col("ret"), -0.5, 0.5))).alias("ret"))


@query("case_fold_keys", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def case_fold_keys(spark, sf):
    o = scan(spark, sf, "orders").select(F.lower("o_orderpriority").alias("k"))
    names = scan(spark, sf, "orders").select("o_orderpriority", F.upper("o_orderpriority").alias("u")).distinct()
    return o.groupBy(F.upper("k").alias("u")).agg(F.count("*").alias("n")).join(names, "u").select("o_orderpriority", "n")


@query("pullback_flag", sql("SELECT symbol, date, coalesce(ret < 0, false) AS pullback FROM rets", "rets"))
def pullback_flag(spark, sf):
    return bars(spark, sf).select("symbol", "date", F.coalesce(W.pct_change("close") < 0, F.lit(False)).alias("pullback"))


DIRTY = "SELECT event_id, CASE WHEN event_id % 7 IN (0, 1) THEN NULL ELSE value END AS close, CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 7 = 2 THEN value / 2 ELSE value * 1.1 END AS high, CASE WHEN event_id % 7 = 0 THEN NULL ELSE value * 0.9 END AS low, CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_id % 5 END AS volume FROM events"


def _dirty(spark, sf):
    k, v = F.col("event_id") % 7, F.col("value")
    return scan(spark, sf, "events").select("event_id", F.when(~k.isin(0, 1), v).alias("close"), F.when(k == 2, v / 2).when(k != 0, v * 1.1).alias("high"), F.when(k != 0, v * 0.9).alias("low"), F.when(k != 0, F.col("event_id") % 5).alias("volume"))


GOOD = "(close IS NULL AND high IS NULL AND low IS NULL AND volume IS NULL) OR (close > 0 AND high > 0 AND low > 0 AND volume >= 0 AND high >= close AND high >= low AND low <= close)"


@query("ohlcv_quality", f"SELECT event_id FROM ({DIRTY}) WHERE {GOOD}")
def ohlcv_quality(spark, sf):
    return _dirty(spark, sf).dropDuplicates(["event_id"]).filter(GOOD).select("event_id")


@query("row_retention_report", f"SELECT count(*) AS before, count(*) FILTER (WHERE close IS NOT NULL) AS not_null, count(*) FILTER (WHERE {GOOD}) AS good FROM ({DIRTY})")
def row_retention_report(spark, sf):
    return _dirty(spark, sf).agg(F.count("*").alias("before"), F.count("close").alias("not_null"), F.count_if(F.expr(GOOD)).alias("good"))


@query("positive_filter", "SELECT event_id, value FROM events WHERE value > 0")
def positive_filter(spark, sf):
    return scan(spark, sf, "events").filter("value > 0").select("event_id", "value")


@query("exclude_list", "SELECT n_nationkey, n_name FROM nation WHERE n_regionkey NOT IN (1, 3)")
def exclude_list(spark, sf):
    return scan(spark, sf, "nation").filter(~F.col("n_regionkey").isin(1, 3)).select("n_nationkey", "n_name")


@query("min_history", "SELECT event_id, user_id FROM events WHERE user_id IN (SELECT user_id FROM events GROUP BY 1 HAVING count(*) > 65)")
def min_history(spark, sf):
    e = scan(spark, sf, "events").select("event_id", "user_id")
    return e.join(e.groupBy("user_id").count().filter("count > 65").select("user_id"), "user_id", "left_semi")


@query("min_history_group", sql("SELECT symbol, date FROM (SELECT *, count(*) OVER (PARTITION BY symbol) AS n FROM bars) WHERE n >= 12 + 5", "bars"))
def min_history_group(spark, sf):
    return bars(spark, sf).withColumn("n", F.count("*").over(Window.partitionBy("symbol"))).filter("n >= 17").select("symbol", "date")


@query("date_range", sql(f"SELECT symbol, date, round(slow, 4) AS slow FROM ({MA}) WHERE date BETWEEN DATE '1998-01-01' AND DATE '1999-12-31'", "weekly"))
def date_range(spark, sf):
    return _ma(spark, sf).filter("date between date'1998-01-01' and date'1999-12-31'").select("symbol", "date", r("slow", 4).alias("slow"))


@query("threshold_topn", sql("SELECT symbol, date, close FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY close DESC, symbol) AS k FROM weekly WHERE close >= 100000) WHERE k <= 5", "weekly"))
def threshold_topn(spark, sf):
    return weekly(spark, sf).filter("close >= 100000").withColumn("k", W.rank_first("close")).filter("k <= 5").select("symbol", "date", "close")


@query("fundamental_filters", sql("SELECT symbol, date FROM fund WHERE cost > 0 AND revenue / cost <= 25 AND units >= 10", "fund"))
def fundamental_filters(spark, sf):
    return fundamentals(spark, sf).filter("cost > 0").filter("revenue / cost <= 25 and units >= 10").select("symbol", "date")


@query("expect_suite", f"SELECT 'not_null' AS rule, 'close' AS col, count(*) FILTER (WHERE close IS NULL) AS failures FROM ({DIRTY}) UNION ALL SELECT 'not_null', 'high', count(*) FILTER (WHERE high IS NULL) FROM ({DIRTY}) UNION ALL SELECT 'positive', 'low', count(*) FILTER (WHERE NOT low > 0) FROM ({DIRTY})")
def expect_suite(spark, sf):
    rules = {("not_null", "close"): F.col("close").isNull(), ("not_null", "high"): F.col("high").isNull(), ("positive", "low"): ~(F.col("low") > 0)}
    return quality.counted_over(_dirty(spark, sf), rules, store.written)


@query("expect_not_null", f"SELECT count(*) FILTER (WHERE close IS NULL) AS failures, count(*) FILTER (WHERE close IS NULL) = 0 AS success FROM ({DIRTY})")
def expect_not_null(spark, sf):
    n = F.count_if(F.col("close").isNull())
    return _dirty(spark, sf).agg(n.alias("failures"), (n == 0).alias("success"))


@query("expect_non_empty", "SELECT count(*) > 0 AS success FROM events")
def expect_non_empty(spark, sf):
    return scan(spark, sf, "events").agg((F.count("*") > 0).alias("success"))
