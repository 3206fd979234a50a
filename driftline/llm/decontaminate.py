"""Benchmark decontamination: a prefix-filtered join of document words with benchmark windows, verified exactly.

Containment of a whole window needs all its words, so a prefix of one suffices: the window's rarest word in the corpus.
Documents are looked up word by word in the windows' rarest words; position and length bounds and the comparison of the
whole slice are part of that join, so only true occurrences leave it. DataFrame functions only.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, keep, row_key

#: What stands between words, after A-Z became a-z.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Rows, and bytes of their words, that are broadcast at once; more are joined block by block.
BLOCK, BYTES = 400_000, 1 << 26


def words(text: Column) -> Column:
    """The words of the text; an empty array for null."""
    return F.coalesce(F.array_remove(F.split(ascii_lower(text), GAP), ""), F.array().cast("array<string>"))


def windows(items: DataFrame, item_id: str, text_col: str, size: int) -> DataFrame:
    """(gram, item): each window of each item once, the item's id as text. However many items share a window, no row grows."""
    w = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), words(F.col(text_col)).alias("w")).filter("size(w) > 0")
    at = w.select("item", "w", F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))).alias("at"))
    return at.select(F.slice("w", F.col("at"), F.lit(size)).alias("gram"), "item").distinct()


def _blocks(rows: DataFrame, key: str, block: int, size: int = BYTES) -> list[DataFrame]:
    """rows in parts of about `block` rows and `size` bytes of the column or fewer, by hash of the column."""
    text = F.col(key).cast("string")
    n, length = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()
    parts = max(1, math.ceil(n / block), math.ceil(length / size))
    return [rows if parts == 1 else rows.filter(F.pmod(F.xxhash64(key), F.lit(parts)) == i) for i in range(parts)]


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, parts)


def occurrences(docs: DataFrame, wins: DataFrame, block: int = BLOCK) -> DataFrame:
    """(key, start, len, gram) for every place (word number from 0) where a window (gram) occurs in docs (key, w).

    Two passes over the documents' words: one counts those that windows have, one looks up the rarest of each window.
    A side is broadcast only in blocks of at most about `block` rows and BYTES bytes, measured before.
    """
    wins = wins.select("gram").distinct().withColumn("len", F.size("gram"))
    vocabulary = keep(wins.select(F.explode("gram").alias("word")).distinct())
    counts = [docs.select(F.explode("w").alias("word")).join(F.broadcast(v), "word") for v in _blocks(vocabulary, "word", block)]
    rarity = keep(_union(counts).groupBy("word").agg(F.count("*").alias("n")))
    placed = wins.select("gram", "len", F.posexplode("gram").alias("offset", "word"))
    rare = placed.join(rarity, "word").groupBy("gram").agg(F.min(F.struct("n", "word", "offset")).alias("r"), F.count("*").alias("known"), F.first("len").alias("len"))
    probes = keep(rare.filter("known = len").select(F.col("r.word").alias("word"), F.col("r.offset").alias("offset"), "gram", "len"))
    seen = docs.select("key", "w", F.posexplode("w").alias("pos", "word"))
    found = []
    for p in _blocks(probes, "gram", block):
        p = F.broadcast(p)
        fits = F.expr("pos >= offset and pos - offset + len <= size(w) and slice(w, pos - offset + 1, len) = gram")
        found.append(seen.join(p, (seen["word"] == p["word"]) & fits).select("key", (F.col("pos") - F.col("offset")).alias("start"), "len", "gram"))
    return _union(found)


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 13, share: int = 20) -> DataFrame:
    """(id, n_words, n_hit, n_items, items_sha256, contaminated) for each row of docs.

    A window is `window` consecutive words of an item, or all words of a shorter one; a document word is hit if an
    occurrence of a window covers it. contaminated: n_hit > 0 and share * n_hit >= n_words. items_sha256 is of the ids of
    items with occurring windows, as text, sorted, joined by commas; of the empty string if there are none. Null text has
    no words, on either side. Rows that repeat id and text get the same result each. Other columns are not read; an empty
    benchmark hits nothing; empty documents give an empty result.
    """
    rows = docs.select(F.col(id_col).alias("id"), row_key(F.col(id_col), F.col(text_col)).alias("key"), words(F.col(text_col)).alias("w"))
    wins = keep(windows(items, item_id, item_text, window))
    found = keep(occurrences(rows.select("key", "w"), wins))
    spans = found.groupBy("key").agg(F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("len")).alias("end")))).alias("spans"))
    named = found.select("key", "gram").distinct().join(wins, "gram").select("key", "item").distinct().groupBy("key").agg(F.array_sort(F.collect_list("item")).alias("items"))
    per_doc = spans.join(named, "key")
    covered = F.aggregate("spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("till")), lambda s, x: F.struct((s["n"] + F.greatest(x["end"] - F.greatest(x["start"], s["till"]), F.lit(0))).alias("n"), F.greatest(s["till"], x["end"]).alias("till")), lambda s: s["n"])
    hits = per_doc.select("key", covered.cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))
    out = rows.select("id", "key", F.size("w").cast("long").alias("n_words")).join(hits, "key", "left")
    n_hit = F.coalesce("n_hit", F.lit(0))
    return out.select(F.col("id").alias(id_col), "n_words", n_hit.cast("long").alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"))


#: DuckDB SQL for decontaminate() over documents and benchmark.
ORACLE = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bi AS (SELECT item_id, w, least(len(w), 13) AS l, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i FROM bw WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, l, array_to_string(list_slice(w, i, i + l - 1), ' ') AS gram FROM bi),
lens AS (SELECT DISTINCT l FROM win),
di AS (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM dw, lens WHERE len(w) >= l),
occ AS (SELECT d.doc_id, d.i, d.l, win.item_id FROM (SELECT doc_id, i, l, array_to_string(list_slice(w, i, i + l - 1), ' ') AS gram FROM di) d JOIN win ON d.l = win.l AND d.gram = win.gram),
pos AS (SELECT doc_id, unnest(range(i, i + l)) AS p FROM (SELECT DISTINCT doc_id, i, l FROM occ)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM pos GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM occ) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN hit ON hit.doc_id = dw.doc_id LEFT JOIN it ON it.doc_id = dw.doc_id"""
