"""Phrase collocations against counting everything."""

import random
import re
from collections import Counter

import pytest

from driftline.llm import phrases

SCHEMA = "text string, lang string"


def slow(rows, least, most, longest=5, cover=100):
    """(lang, rank, phrase, a, l, r, n, score) by counting all phrases."""
    low, out = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), set()
    by = {}
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(low)):
            by.setdefault("und" if lang is None else lang, []).append(re.findall(r"[^\x20\x09]+", piece))
    for lang, all_words in by.items():
        n = sum(map(len, all_words))
        f = Counter(tuple(ws[i : i + m]) for ws in all_words for m in range(1, longest + 1) for i in range(len(ws) - m + 1))
        found = {q: a for q, a in f.items() if a >= least and len(q) > 1}
        hidden = {q[i : i + m] for q, a in found.items() for m in range(2, len(q)) for i in range(len(q) - m + 1) if 100 * a >= cover * f[q[i : i + m]]}
        best = []
        for q in found.keys() - hidden:
            score, k = min((1000 * f[q] * n // (f[q[:k]] * f[q[k:]]), k) for k in range(1, len(q)))
            best.append((-score, -f[q], " ".join(q).encode(), f[q[:k]], f[q[k:]]))
        for rank, (s, a, q, l, r) in enumerate(sorted(best)[:most], 1):  # noqa: E741
            out.add((lang, rank, q.decode(), -a, l, r, n, -s))
    return out


def texts(n=400, seed=1):
    rnd = random.Random(seed)
    words = [f"w{k}" for k in range(60)] + ["É", " x", "Ab", "aB", "z\x1cz"]
    weights = [1 / (k + 1) for k in range(len(words))]
    rows = []
    for _ in range(n):
        ws = rnd.choices(words, weights, k=rnd.randrange(0, 40))
        if rnd.random() < 0.5:
            ws[len(ws) // 2 : len(ws) // 2] = rnd.choice(["alpha beta gamma delta eps zeta", "kilo lima", "x x x x x x x"]).split()
        rows.append(("".join(w + rnd.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b"]) for w in ws), rnd.choice(["en", "en", "en", "de", None])))
    return [*rows, ("", "en"), (None, "en"), (" .,", "fr"), ("one", "xx"), rows[0], rows[0], ("long " * 3000 + "tail", "en")]


@pytest.mark.parametrize(("least", "most", "step", "cover"), [(5, 15, 4, 100), (3, 10_000, 64, 80)])
def test_waves_give_what_counting_everything_gives(spark, least, most, step, cover):
    rows = texts()
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS a", "2 AS h", "3 AS q").repartition(5)
    got = phrases.collocations(docs, least=least, most=most, step=step, cover=cover)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {tuple(r) for r in got.collect()} == slow(rows, least, most, cover=cover)


def test_a_settled_language_leaves_the_search(spark, monkeypatch):
    """A language of many rare collocations needs no growth from its common words."""
    rows = [(f"r{k} s{k}. the the of. the of", "en") for k in range(50)] * 5
    seen, real = [], phrases.grown
    monkeypatch.setattr(phrases, "grown", lambda texts, m, last, *a: (seen.append((last, texts.select("lang").distinct().count())), real(texts, m, last, *a))[1])
    got = phrases.collocations(spark.createDataFrame(rows, SCHEMA), least=5, most=20, step=4)
    assert {tuple(r) for r in got.collect()} == slow(rows, 5, 20)
    assert seen[0] == (0, 1) and all(langs == 0 for last, langs in seen if last > 0)


def test_shorter_phrases_and_wrong_parameters(spark):
    rows = texts(150, seed=7)
    assert {tuple(r) for r in phrases.collocations(spark.createDataFrame(rows, SCHEMA), least=4, most=30, longest=3).collect()} == slow(rows, 4, 30, longest=3)
    with pytest.raises(ValueError):
        phrases.collocations(spark.createDataFrame(rows, SCHEMA), longest=6)
    assert phrases.collocations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_words_of_one_hash_start_the_search_anew(spark, monkeypatch):
    rows, real = [("a b a b c", "en")] * 6, phrases.word_counts
    tried = []

    def collide(rows, seed):
        tried.append(seed)
        out = real(rows, seed)
        return out.withColumn("h", out["h"] * 0 + 1) if seed == 42 else out

    monkeypatch.setattr(phrases, "word_counts", collide)
    assert {tuple(r) for r in phrases.collocations(spark.createDataFrame(rows, SCHEMA), least=2).collect()} == slow(rows, 2, 2000)
    assert tried == [42, 43]


def test_bitmaps_hold_what_is_put_in(spark):
    marks = phrases.bitmap(spark.sql("SELECT xxhash64(id) AS x FROM range(1000) UNION ALL SELECT -1L UNION ALL SELECT 0L"), "x", 16)
    import numpy as np

    xs = np.array([r.x for r in spark.sql("SELECT xxhash64(id) AS x FROM range(1000)").collect()] + [-1, 0], np.int64).view(np.uint64)
    assert phrases._in(marks, xs).all() and marks.size == 1024
