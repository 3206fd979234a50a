"""Phrase collocations by best-first branch and bound.

A phrase q = w1..wm with a occurrences, cut into parts of l and r occurrences, scores a*n / (l*r); since a <= l and a <= r,
no cut gives more than n / max(f(w1), f(wm)). So words are dealt to classes by their counts, and phrases grow from the
rarest class on, whose bound is the highest: to the right from a first word and to the left from a last word, and only
where the part that has been counted (prefix or suffix) reaches the least count, as no extension occurs more often. What
has been counted when a class is done holds every phrase whose first and last words are in it or in rarer ones, all their
parts, and all phrases that are one word longer. A language is settled, and leaves the search, when as many surviving
phrases as are asked for score above the bound of all that is left; then ties are settled as well.

Tasks tokenise texts twice: for the counts of words, and to write, for each text, the 64-bit hashes of the words that may
be frequent. Growth reads those alone. What is known to be frequent is broadcast as bitmaps of a fixed number of bits: a
false hit costs a row, never a count, since counts are added up by the words' hashes, which are told apart exactly (two
words of one hash make the search start anew with another seed).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import keep, release, rows_at_once

#: Bytes that end a piece, as one newline, and the two white-space characters within pieces.
_TABLE = bytes.maketrans(b".,;:!?\x0b\x0c\x0d\t", b"\n" * 9 + b" ")
#: Bits of a bitmap: 4 MB. Beyond some tens of millions of frequent phrases more rows are counted in vain, none wrongly.
BITS = 25
#: Distinct words (or bytes of them) that a task counts before it hands them on; words whose hash it remembers.
HELD, HELD_BYTES = 100_000, 8 << 20
#: Hashes in a row of written texts (one text at least), hashes looked at together, and texts handed to Python at once.
ROW, TOGETHER, BATCH = 1024, 1 << 19, 500
#: Each class of words ends at so many times the count of the one before.
STEP = 64
#: First-stage rankings of a language before its last one.
SALTS = 64
LONGEST = 5
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(29)


def pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of each piece of a text; A-Z count as a-z."""
    for piece in text.lower().translate(_TABLE).split(b"\n"):
        if words := piece.split():  # blanks are all the white space that is left
            yield words


def _key(lang: str, seed: int) -> int:
    return xxhash.xxh64_intdigest(lang.encode(), seed)


def word_counts(rows: DataFrame, seed: int) -> DataFrame:
    """(lang, word, h, c) for each word of rows (lang, body); h is its hash in that language, never 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, counts in seen.items():
                of = _key(lang, seed)
                words = list(counts)
                hashes = np.fromiter((xxhash.xxh64_intdigest(w, of) for w in words), np.uint64, len(words)) | np.uint64(1)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(words), pa.string()), pa.array(words, pa.binary()).cast(pa.string()), pa.array(hashes.view(np.int64)), pa.array(list(counts.values()), pa.int64())], ["lang", "word", "h", "c"])
            seen.clear()

        weight = 0
        for b in batches:
            for lang, body in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                counts, text = seen.setdefault(lang, Counter()), body.as_py()
                for words in pieces(text):
                    counts.update(words)
                weight += len(text)
                if weight > HELD_BYTES:
                    weight = 0
                    if sum(map(len, seen.values())) > HELD or len(text) > HELD_BYTES:
                        yield from flush()
        yield from flush()

    return rows.mapInArrow(run, "lang string, word string, h long, c long").groupBy("lang", "word", "h").agg(F.sum("c").alias("c"))


def bitmap(hashes: DataFrame, col: str, bits: int = BITS) -> np.ndarray:
    """The bits that the hashes' highest ones name, as words of 64: the driver gets at most 2 ** (bits - 6) of them."""
    at = F.shiftrightunsigned(F.col(col), 64 - bits)
    words = hashes.groupBy(F.shiftright(at, 6).alias("at")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned({col}, {64 - bits}) & 63 as int))")).alias("w")).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[words.column("at").to_numpy()] = words.column("w").to_numpy().view(np.uint64)
    return out


def _in(marks: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash's bit is set."""
    at = hashes >> np.uint64(64 - (marks.size.bit_length() + 5))
    return (marks[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _mixed(words: list[np.ndarray]) -> np.ndarray:
    """The hashes of phrases from those of their words: for bitmaps and sorting only."""
    h = words[0]
    for word in words[1:]:
        x = (h ^ (h >> _SHIFT)) * _ODD + word
        h = (x ^ (x >> _SHIFT)) * _ODD
    return h


def encode(rows: DataFrame, classes: list[np.ndarray], seed: int) -> DataFrame:
    """(lang, ids, kinds): the hashes of the words that may be frequent, text by text, others as one 0 between them, and
    the classes of them (0 for the rarest). Words without a neighbour that may be frequent are left out, as they make no
    phrase."""
    shared = rows.sparkSession.sparkContext.broadcast(classes)  # a bitmap a class: a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = shared.value
        some = np.bitwise_or.reduce(marks).view(np.uint8).tobytes()  # little-endian: bit i is in byte i // 8

        class Known(dict):
            """The hash of a word that may be frequent, 0 of others."""

            def __init__(self, lang: str) -> None:
                self.of = _key(lang, seed)

            def __missing__(self, word: bytes) -> int:
                h = xxhash.xxh64_intdigest(word, self.of) | 1
                bit = h >> 64 - BITS
                if len(self) > HELD:
                    self.clear()
                self[word] = h = h if some[bit >> 3] >> (bit & 7) & 1 else 0
                return h

        known: dict[str, Known] = {}
        waiting: dict[str, list[np.ndarray]] = {}

        def row(lang: str) -> pa.RecordBatch:
            ids = np.concatenate(waiting.pop(lang))
            kinds = np.full(ids.size, len(marks), np.uint8)
            for k in reversed(range(len(marks))):
                kinds[_in(marks[k], ids)] = k
            return pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([ids.tobytes()], pa.binary()), pa.array([kinds.tobytes()], pa.binary())], ["lang", "ids", "kinds"])

        for b in batches:
            for lang, body in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                if len(known) > 64:
                    known.clear()
                look = known.setdefault(lang, Known(lang)).__getitem__
                flat = [0]
                for words in pieces(body.as_py()):
                    flat.extend(map(look, words))
                    flat.append(0)
                ids = np.array(flat, np.uint64)
                there = ids != 0
                beside = np.zeros(ids.size + 1, bool)
                beside[1:-1] = there[1:] & there[:-1]
                useful = beside[1:] | beside[:-1]
                ids[~useful] = 0
                ids = ids[useful | np.concatenate(([False], useful[:-1]))]  # one 0 after each run
                if ids.size:
                    waiting.setdefault(lang, []).extend((ids, np.zeros(1, np.uint64)))
                    if sum(x.size for x in waiting[lang]) >= ROW:
                        yield row(lang)
                if len(waiting) > 64:
                    yield from [row(x) for x in list(waiting)]
        yield from [row(x) for x in list(waiting)]

    return rows.mapInArrow(run, "lang string, ids binary, kinds binary")


def grown(texts: DataFrame, m: int, last: int, first: int, frequent: np.ndarray | None) -> DataFrame:
    """(w1, ..., wm, a): phrases of m words of texts with their counts: those whose first or last word is of a class up to `last` but neither of one up to `first`, and whose part without the other end is frequent."""
    shared = texts.sparkSession.sparkContext.broadcast(frequent)  # one bitmap: a fixed size

    def count(ids: np.ndarray, kinds: np.ndarray) -> pa.RecordBatch | None:
        n = ids.size - m + 1
        if n <= 0:
            return None
        whole = np.ones(n, bool)
        for k in range(m):
            whole &= ids[k : n + k] != 0
        head, tail = kinds[:n], kinds[m - 1 : m - 1 + n]
        at = np.nonzero(whole & ((head <= last) | (tail <= last)) & ~((head <= first) | (tail <= first)))[0]
        words = [ids[at + k] for k in range(m)]

        if m > 2:
            ok = ((kinds[at] <= last) & _in(shared.value, _mixed(words[:-1]))) | ((kinds[at + m - 1] <= last) & _in(shared.value, _mixed(words[1:])))
            words = [w[ok] for w in words]
        h = _mixed(words)
        turn = np.argsort(h, kind="stable")
        words, h = [w[turn] for w in words], h[turn]
        if not h.size:
            return None
        new = np.zeros(h.size, bool)
        new[0] = True
        for w in words:
            new[1:] |= w[1:] != w[:-1]
        start = np.nonzero(new)[0]
        counts = np.diff(np.append(start, h.size))
        return pa.RecordBatch.from_arrays([pa.array(c) for c in [*(w[start].view(np.int64) for w in words), counts]], [*WORDS[:m], "a"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, kinds, size = [], [], 0
        for b in batches:
            for x, y in zip(b.column(0), b.column(1), strict=True):
                ids.append(np.frombuffer(x.as_buffer(), np.uint64))
                kinds.append(np.frombuffer(y.as_buffer(), np.uint8))
                size += ids[-1].size
                if size >= TOGETHER:
                    if (out := count(np.concatenate(ids), np.concatenate(kinds))) is not None:
                        yield out
                    ids, kinds, size = [], [], 0
        if ids and (out := count(np.concatenate(ids), np.concatenate(kinds))) is not None:
            yield out

    rows = texts.select("ids", "kinds").mapInArrow(run, ", ".join(f"{c} long" for c in [*WORDS[:m], "a"]))
    return rows.groupBy(*WORDS[:m]).agg(F.sum("a").alias("a"))


WORDS = [f"w{k}" for k in range(1, LONGEST + 1)]


def hashed(phrases: DataFrame, m: int) -> DataFrame:
    """(h): the hash of each phrase of m words, as growth makes it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_mixed([c.to_numpy().view(np.uint64) for c in b.columns]).view(np.int64))], ["h"])

    return phrases.select(*WORDS[:m]).mapInArrow(run, "h long")


def _part(start: Column, size: Column) -> Column:
    """`size` words of the array q from `start` (from 1), padded with 0."""
    return F.slice(F.concat(F.slice("q", start, size), F.array_repeat(F.lit(0).cast("long"), LONGEST)), 1, LONGEST)


def survivors(counted: DataFrame, words: DataFrame, cover: int) -> DataFrame:
    """(lang, q, m, a, l, r, n, score) for the phrases of counted (q: array of LONGEST hashes, m words, a; those of one
    word included) whose parts are all there, without those that a phrase one word longer covers.

    A longer phrase that covers one has, between them, phrases one word longer at each step that do so too.
    """
    whole = counted.filter("m > 1")
    cut = F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k")
    cuts = whole.select("q", "m", "a", cut).select("q", "m", "a", "k", _part(F.lit(1), F.col("k")).alias("left"), _part(F.col("k") + 1, F.col("m") - F.col("k")).alias("right"))
    l, r = counted.select(F.col("q").alias("left"), F.col("a").alias("l")), counted.select(F.col("q").alias("right"), F.col("a").alias("r"))  # noqa: E741
    met = cuts.join(l, "left").join(r, "right")
    known = words.select(F.col("h").alias("first"), "lang", "n")
    met = met.withColumn("first", F.element_at("q", 1)).join(known, "first")
    wide = "decimal(38,0)"
    score = F.expr(f"(cast(1000 as {wide}) * a * n) div (cast(l as {wide}) * r)")
    scored = met.withColumn("score", score).groupBy("lang", "n", "q", "m", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"), F.count("*").alias("found"))
    scored = scored.filter("found = m - 1").select("lang", "n", "q", "m", "a", "b.score", "b.l", "b.r")  # else an end is of a class to come
    inner = whole.filter("m > 2").select(F.explode(F.array(_part(F.lit(1), F.col("m") - 1), _part(F.lit(2), F.col("m") - 1))).alias("q"), F.col("a").alias("longer"))
    inner = inner.groupBy("q").agg(F.max("longer").alias("longer"))
    kept = scored.join(inner, "q", "left").filter(f"longer is null or longer * 100L < a * {cover}L")
    return kept.select("lang", "q", "m", "a", "l", "r", "n", "score")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 100, most: int = 2000, longest: int = LONGEST, cover: int = 100, step: int = STEP, seed: int = 42) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's `most` best phrases of 2 to `longest` (5 at most) words.

    Words are runs of anything but blanks and tabs within pieces, which end at .,;:!? and line ends; A-Z count as a-z.
    n: words of the language; a: occurrences of the phrase, `least` or more; l, r: those of its parts at the lowest-scoring
    cut (ties: the first cut); score: floor(1000 * a * n / (l * r)). Phrases that occur, to `cover` hundredths or more,
    within one longer phrase are left out. Ranks are by score and a, descending, then by the phrase's bytes. Null text
    counts as empty, null languages as und; a language without phrases has no rows; whole texts and repeated rows count;
    other columns are not read; an empty table gives an empty result. A word without an end is one word; texts are held
    one at a time.
    """
    if not 2 <= longest <= LONGEST or least < 1 or not 0 < cover <= 100:
        raise ValueError("longest is 2 to 5, least 1 or more, cover 1 to 100")
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("binary").alias("body")).filter("body is not null")
    with rows_at_once(docs.sparkSession, BATCH):
        return _searched(rows, least, most, longest, cover, step, seed)


def _searched(rows: DataFrame, least: int, most: int, longest: int, cover: int, step: int, seed: int) -> DataFrame:
    """collocations() of rows (lang, body). What Python does is written before this returns."""
    counts = keep(word_counts(rows, seed))
    if not counts.groupBy("h").count().filter("count > 1").isEmpty():
        release(counts)
        return _searched(rows, least, most, longest, cover, step, seed + 1)
    n = counts.groupBy("lang").agg(F.sum("c").alias("n"))
    words = keep(counts.filter(F.col("c") >= least).join(n, "lang"))
    top = words.agg(F.max("c")).first()[0] or least
    ends = [least * step - 1]
    while ends[-1] < top:
        ends.append((ends[-1] + 1) * step - 1)
    lows = [0, *[e + 1 for e in ends[:-1]]]
    texts = keep(encode(rows, [bitmap(words.filter(F.col("c").between(lo, hi)), "h") for lo, hi in zip(lows, ends, strict=True)], seed))
    release(counts)
    single = words.select(F.array(F.col("h"), *[F.lit(0).cast("long")] * (LONGEST - 1)).alias("q"), F.lit(1).alias("m"), F.col("c").alias("a"))
    counted, done, settled = single, [], []
    marks: dict[int, np.ndarray] = {}
    for k, end in enumerate(ends):
        for m in range(2, longest + 1):
            if m > 2 and not marks[m - 1].any():
                break
            open_ = texts.filter(~F.col("lang").isin(settled)) if settled else texts
            new = keep(grown(open_, m, k, k - 1 if k else -1, marks.get(m - 1)).filter(F.col("a") >= least))
            counted = counted.union(new.select(F.array(*WORDS[:m], *[F.lit(0).cast("long")] * (LONGEST - m)), F.lit(m), "a"))
            marks[m] = marks.get(m, np.uint64(0)) | bitmap(hashed(new, m), "h")
        best = keep(survivors(counted, words, cover))
        if k == len(ends) - 1:
            done.append(best.filter(~F.col("lang").isin(settled)) if settled else best)
            break
        bound = F.expr(f"(cast(1000 as decimal(38,0)) * n) div {end + 1}")
        sure = [r.lang for r in best.filter(F.col("score") > bound).groupBy("lang").count().filter(F.col("count") >= most).collect() if r.lang not in settled]  # languages
        if sure:
            done.append(best.filter(F.col("lang").isin(sure) & (F.col("score") > bound)))
            settled += sure
            if words.filter(~F.col("lang").isin(settled)).isEmpty():
                break
    found = done[0]
    for x in done[1:]:
        found = found.union(x)
    return _ranked(found, words, most)


def _ranked(found: DataFrame, words: DataFrame, most: int) -> DataFrame:
    """The best of each language: first among parts of it, then among what those leave."""
    spelt = found.select("*", F.posexplode(F.slice("q", 1, F.col("m"))).alias("at", "h")).join(words.select("h", "word"), "h")
    keys = ["lang", "q", "a", "l", "r", "n", "score"]
    spelt = spelt.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("ws")).withColumn("phrase", F.array_join(F.col("ws.word"), " "))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = spelt.withColumn("salt", F.pmod(F.hash("phrase"), F.lit(SALTS)))
    few = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= most)
    last = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= most)
    return last.select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


#: DuckDB SQL for collocations() over documents.
ORACLE = r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece, generate_subscripts(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]'), 1) AS p FROM documents WHERE text IS NOT NULL),
s AS (SELECT lang, doc_id, p, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM t),
u AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM s),
n AS (SELECT lang, count(*) AS n FROM u GROUP BY 1),
g AS (SELECT lang, m, array_to_string(list_slice(ws, i, i + m - 1), ' ') AS q FROM u, (SELECT unnest([1, 2, 3, 4, 5]) AS m) WHERE i + m - 1 <= len(ws)),
f AS (SELECT lang, m, q, count(*) AS a FROM g GROUP BY 1, 2, 3 HAVING count(*) >= 100),
c AS (SELECT f.lang, f.m, q, a, unnest(range(1, m)) AS k, string_split(q, ' ') AS w FROM f WHERE m > 1),
x AS (SELECT c.lang, c.q, c.a, c.k, l.a AS l, r.a AS r, n.n, (1000::HUGEINT * c.a * n.n) // (l.a::HUGEINT * r.a) AS score FROM c JOIN n ON n.lang = c.lang
  JOIN f l ON l.lang = c.lang AND l.m = c.k AND l.q = array_to_string(list_slice(w, 1, k), ' ') JOIN f r ON r.lang = c.lang AND r.m = c.m - c.k AND r.q = array_to_string(list_slice(w, k + 1, c.m), ' ')),
b AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, q ORDER BY score, k) = 1),
z AS (SELECT b.* FROM b WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.lang = b.lang AND 100 * f.a >= 100 * b.a AND len(f.q) > len(b.q) AND contains(' ' || f.q || ' ', ' ' || b.q || ' '))),
o AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(q)) AS rank, q AS phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM z)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, score FROM o WHERE rank <= 2000"""
