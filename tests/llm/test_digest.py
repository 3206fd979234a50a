import hashlib
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from driftline.llm.digest import TAG, beside, canonical, caseless, digests, folded, held, wide_hash


def same_classes(spark, texts):
    """folded() makes two texts one exactly where their canonical caseless forms are one."""
    texts = sorted(set(texts))
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(8)
    by_form, by_fold = {}, {}
    for r in df.select("t", folded(F.col("t")).alias("f")).collect():
        by_form.setdefault(caseless(r.t), {}).setdefault(r.f, r.t)
        by_fold.setdefault(r.f, {}).setdefault(caseless(r.t), r.t)
    apart = [[ascii(t) for t in x.values()] for x in by_form.values() if len(x) > 1]
    merged = [[ascii(t) for t in x.values()] for x in by_fold.values() if len(x) > 1]
    assert not apart and not merged, (len(apart), apart[:5], len(merged), merged[:5])


def forms(t):
    return [t, *(unicodedata.normalize(k, t) for k in ("NFC", "NFD")), t.casefold(), t.upper(), t.lower(), unicodedata.normalize("NFD", t.upper())]


def test_folds_are_those_of_the_unicode_database(spark):
    """Every code point that changes in any form, in all forms, and a stretch of all others."""
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    moved = [c for c in every if any(x != c for x in forms(c))]
    known = set(moved)
    still = [c for c in every if c not in known]
    assert len(moved) > 15_000
    same_classes(spark, [f"a{x}" for c in moved for x in forms(c)])
    same_classes(spark, ["x".join(still[a : a + 64]) for a in range(0, len(still), 64)])


def test_sequences_of_marks_and_jamo(spark):
    """Random letters, marks in any order, jamo and syllables."""
    rnd = random.Random(2)
    pool = [*"aeoAEÅéǭệſßẞİΐΆςσΣαᾳᾼﬃŉKÅΩ", *map(chr, (0x300, 0x301, 0x302, 0x304, 0x308, 0x323, 0x327, 0x345, 0x344, 0x338, 0x30C))]
    pool += [*"かがはばパ", "\u3099", "\u309a", "\u0627", "\u0653", "\u0654", "\u0928", "\u093c", "\u0929", "\u0958", "\u09c7", "\u09be", "\u09d7", "\u0b47", "\u1100", "\u1161", "\u11a8", "\u1112", "\u1175", "\u11a7", "가", "각", "힣", "\uf900", "\U0002f800", "\U00011099", "\U000110ba", "\u0e38", "\u0e48", "\U0001f600", " "]
    texts = ["".join(rnd.choices(pool, k=rnd.randint(1, 6))) for _ in range(6000)]
    same_classes(spark, [x for t in texts for x in forms(t)])


def test_long_texts_fold(spark):
    """Long stretches with and without rare characters pass whole."""
    texts = ["e\u0301" * 30_000, "é" * 30_000, "E" * 50_000 + "\u0301", "\u0301" * 5000, "각" * 9000, "\u1100\u1161\u11a8" * 9000]
    got = [r.f for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").coalesce(1).select("i", folded(F.col("t")).alias("f")).orderBy("i").collect()]
    assert got[0] == got[1] == texts[1] and got[2] == "e" * 49_999 + "é" and got[3] == texts[3] and got[4] == got[5] == texts[4]


def test_canonical_folds(spark):
    pairs = [("Straße  X\n", " STRASSE x"), ("Été", "éTÉ"), ("", " \t"), (None, "")]
    for r in spark.createDataFrame(pairs, "a string, b string").select(canonical(F.col("a")).alias("a"), canonical(F.col("b")).alias("b")).collect():
        assert r.a == r.b


@pytest.mark.parametrize("digits", [32, 1, 0])
def test_against_brute_force(spark, digits):
    """Also where fingerprints are so narrow that different texts share them."""
    rows = [(5, "five " * 9), (1, "abcdefgh"), (3, None), (2, "ABCDefgh"), (9, ""), (7, "the end of it all"), (8, "x" * 100), (8, "x" * 100)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, key string, fp string")
    got = digests(df, hash_of=lambda c: F.substring(wide_hash(c), 1, digits)).collect()
    order = sorted({(i, t or "") for i, t in rows})
    want = {}
    for k, (i, t) in enumerate(order):
        nxt = order[(k + 1) % len(order)][1]
        q = len(t) // 4
        edited = t[: len(t) - q] + nxt[:q]
        want[i] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), float(" ".join(edited.lower().split()) == " ".join(t.lower().split())), float(" ".join(nxt.lower().split()) == " ".join(t.lower().split())))
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in got} == want
    fp = {r.doc_id: r.fingerprint for r in got}
    assert fp[1] == fp[2] and fp[3] == fp[9] and len(set(fp.values())) == 5
    assert digests(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_plan_holds_no_tables(spark, capsys):
    """The driver writes the plan out at each stage that ends: tables in it would fill its memory."""
    digests(spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")).explain("formatted")
    plan = capsys.readouterr().out
    assert "edited" in plan and len(plan) < 100_000 and "ǭ" not in plan


def test_stored_tables_fold_as_literals(spark):
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{x}" for c in every if c == TAG or unicodedata.combining(c) or caseless(c) != c for x in forms(c)]
    texts += ["a\u0323\u0301" * 50, "\u1100\u1161\u11a8각" * 50, "Straße ẞ \U0001f600", "plain", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(8)
    rows, given = beside(df, held(spark))
    out = rows.select(folded(F.col("t"), given).alias("stored"), folded(F.col("t")).alias("literal"))
    assert out.count() == len(texts) and out.filter(~F.col("stored").eqNullSafe(F.col("literal"))).isEmpty()


def test_digests_of_odd_texts(spark):
    """Both paths through digests(): equal fingerprints exactly for canonically caseless equal texts."""
    texts = [x for t in ("Ǭ ffi straße éa", "e\u0323\u0301 각 ᾳ", "plain text here", "ΣΑΣ \u0345α") for x in forms(t)] + ["ffi ffi", "각 각", "É", "é"]
    got = digests(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    form = [" ".join(caseless(t).split()) for t in texts]
    fp = {r.doc_id: r.fingerprint for r in got}
    assert len(got) == len(texts) and all((fp[i] == fp[j]) == (form[i] == form[j]) for i in fp for j in fp)
    for r in got:
        t, nxt = texts[r.doc_id], texts[(r.doc_id + 1) % len(texts)]
        edited = t[: len(t) - len(t) // 4] + nxt[: len(t) // 4]
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (r.edited_fingerprint == r.fingerprint) == (r.near_edited == 1.0) == (" ".join(caseless(edited).split()) == form[r.doc_id])
        assert (r.near_next == 1.0) == (form[r.doc_id] == form[(r.doc_id + 1) % len(texts)])
