"""Mixing sources to target weights, by hash order and distributed prefix sums. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, keep

#: Leading hex digits of a document's key that name its range within the source: 4,096 ranges for each source.
RANGE_DIGITS = 3


def source_targets(totals: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, epochs: float = 2.0) -> DataFrame:
    """(source, source_size, target) from (source, source_size), a row for each source.

    Sources in code-point order, null last, weigh weights[0], weights[1], ..., repeating. All targets together are share
    times all sizes; none is above epochs times its source's size, and what that cuts off goes to the others by weight.
    With the sources in the order in which they fill up, running sums give the level at which the rest share: no loop.
    The windows see one row a source, never the documents.
    """
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    rows = totals.select("source", "source_size", F.element_at(F.array(*[F.lit(w) for w in weights]), turn + 1).cast("double").alias("w"))
    rows = rows.withColumn("cap", F.col("source_size") * F.lit(float(epochs)))
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before, whole = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0.0)
    rows = rows.select("*", (F.sum("source_size").over(whole) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), zero)).alias("left"), (F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), zero)).alias("w_left"))
    rows = rows.withColumn("level", F.col("left") / F.col("w_left")).withColumn("open", F.col("cap") / F.col("w") >= F.col("level"))
    rows = rows.withColumn("level", F.first(F.when(F.col("open"), F.col("level")), ignorenulls=True).over(whole))
    return rows.select("source", "source_size", F.coalesce(F.least("cap", F.col("level") * F.col("w")), F.col("cap")).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, epochs: float = 2.0, seed: str = "mix") -> DataFrame:
    """(id, source, size, source_size, target, taken) for each row of docs.

    size: words of the text (null: 0). taken: words that the mix takes, repeats counted. Each source is walked in the
    order of its documents' hashed ids as often as its target allows; the last pass is cut at the target's word, so a
    source's taken words are its target rounded down. Null sources are one source. Rows that repeat an id share its key
    and are taken one after the other; null ids are told apart by their texts. Other columns are not read; an empty table gives an empty result.

    The keys are hashes, so equal slices of the key range hold equal shares of a source: each is a group of its own,
    however large the source, and only the slices' sums are added up across them.
    """
    name = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("-"), F.md5(F.coalesce(F.col(text_col), F.lit("")))))
    key = F.md5(F.concat_ws("|", F.lit(seed), name))
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long").alias("size"), key.alias("key"))
    rows = rows.groupBy("id", "source", "size", "key").agg(F.count("*").alias("copies"))  # rows that repeat are one from here on
    rows = keep(rows.withColumn("slice", F.substring("key", 1, RANGE_DIGITS)))
    slices = keep(rows.groupBy("source", "slice").agg(F.sum(F.col("size") * F.col("copies")).alias("words")))
    target = source_targets(slices.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, epochs)
    ahead = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = slices.select("source", "slice", F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("start"))
    same = lambda a, b, *cols: [a[c].eqNullSafe(b[c]) for c in cols]
    starts = starts.join(target, same(starts, target, "source")).select(starts["source"], "slice", "start", "source_size", "target")
    inside = Window.partitionBy("source", "slice").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    summed = rows.withColumn("within", F.coalesce(F.sum(F.col("size") * F.col("copies")).over(inside), F.lit(0)))
    placed = summed.join(starts, same(summed, starts, "source", "slice")).select("id", summed["source"], "size", "source_size", "target", "copies", (F.col("start") + F.col("within")).alias("first"))
    placed = placed.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).withColumn("before", F.col("first") + F.col("copy") * F.col("size"))
    goal = F.floor("target").cast("long")
    passes = F.when(F.col("source_size") > 0, F.expr("cast(target as bigint) div source_size")).otherwise(F.lit(0))
    last = F.greatest(F.least(goal - passes * F.col("source_size") - F.col("before"), F.col("size")), F.lit(0))
    return placed.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", (passes * F.col("size") + last).cast("long").alias("taken"))


#: DuckDB SQL for mix() over documents.
ORACLE = r"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size, md5(concat('mix|', coalesce(CAST(doc_id AS VARCHAR), concat('-', md5(coalesce(text, '')))))) AS k FROM documents),
t AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST(CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS w, source_size * 2.0::DOUBLE AS cap FROM t),
r AS (SELECT *, (sum(source_size) OVER ()) * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / w, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
  sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY cap / w, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS w_rest FROM w),
l AS (SELECT min(cap / w) AS first_open FROM r WHERE cap / w >= rest / w_rest),
v AS (SELECT min(rest / w_rest) AS level FROM r, l WHERE cap / w = first_open),
g AS (SELECT source, source_size, coalesce(least(cap, level * w), cap) AS target FROM r, v),
p AS (SELECT d.doc_id, d.source, d.size, g.source_size, g.target, CASE WHEN g.source_size > 0 THEN CAST(floor(g.target) AS BIGINT) // g.source_size ELSE 0 END AS passes,
  CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS ahead
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, source, size, source_size, target, CAST(passes * size + greatest(least(CAST(floor(target) AS BIGINT) - passes * source_size - ahead, size), 0) AS BIGINT) AS taken FROM p"""
