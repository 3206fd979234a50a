"""Canonical exact digests of documents, with DataFrame functions only.

Canonical text: Unicode normalisation and full case folding (canonical caseless matching), white space folded to single
spaces. Its fingerprint is two XXH64 values with different seeds (128 bits). Texts of one fingerprint are compared byte by
byte with the first of them; one that differs gets a fingerprint of its own.

Nearly all texts hold only characters that stand for themselves, or for one other character, whatever stands beside them;
these are translated. Texts with combining marks, jamo or characters that fold to several are taken apart: each character
is looked up, marks are put in canonical order, and what is one of the former characters is put together again, so that
both kinds of text meet.

The tables for this are columns of a stored row that is broadcast. As literals they would stand in each plan once for each
use; Spark's driver writes a plan out at every stage that ends, so its memory would fill with such texts.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import cache
from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import keep, row_key

#: Unicode white space beyond what Java's \s has.
SPACE = "[\\s\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+"
#: Hangul syllables are arithmetic of leading, vowel and trailing jamo.
SYLLABLES, LEADING, VOWELS, TRAILING, N_SYLLABLES, N_LEADING, N_VOWELS, N_TRAILING = 0xAC00, 0x1100, 0x1161, 0x11A7, 11172, 19, 21, 28
#: Ranges without rare characters that are looked at first.
SAFE = 12
#: A noncharacter that stands before marks while a text is taken apart; where a text has one, it counts as a mark.
TAG = "\uffff"
#: Fixed value: the mark that folds to a letter, but is put in order as a mark.
IOTA = "\u0345"
#: Places of a table that is looked up.
SLOTS = 2048
#: Columns as which expressions get the tables.
Given = dict[str, Column]


def caseless(text: str) -> str:
    """The canonical decomposition of the folded canonical decomposition: equal for canonically caseless equal texts."""
    nfd = lambda t: unicodedata.normalize("NFD", t)
    return nfd(nfd(text).casefold())


@dataclass
class Tables:
    """From the Unicode database. moved: characters that stand for one other, whatever is beside them; taken: what other
    characters are taken apart to; joined: what is put together again; classes: the combining classes of marks; rare:
    characters that make moved too little for a text; safe: some long ranges without rare characters. In taken, TAG stands
    before each mark, so that patterns need no class of marks."""

    moved: dict[str, str]
    taken: dict[str, str]
    joined: dict[str, str]
    classes: dict[str, str]
    rare: str
    safe: str


@cache
def tables() -> Tables:
    every = [chr(c) for c in chain(range(0xD800), range(0xE000, 0x110000))]
    classes = {c: f"{unicodedata.combining(c):03d}" for c in every if unicodedata.combining(c)}
    parts = (unicodedata.decomposition(c).split() for c in every)
    seconds = {chr(int(p[1], 16)) for p in parts if len(p) == 2 and p[0][0] != "<"} - classes.keys()  # starters that compose with one before
    jamo = {chr(c) for c in (*range(VOWELS, VOWELS + N_VOWELS), *range(TRAILING + 1, TRAILING + N_TRAILING))}
    tagged = lambda text: "".join(TAG + x if x in classes else x for x in text)
    moved, taken, joined, rare = {}, {}, {}, {*jamo, *classes, *seconds}
    for c in every:
        d = caseless(c)
        if d == c or SYLLABLES <= ord(c) < SYLLABLES + N_SYLLABLES:
            continue
        one = unicodedata.normalize("NFC", d)
        if c in rare or len(one) > 1 or any(x not in classes for x in d[1:]) or d[0] in classes or d[0] in seconds:
            taken[c] = tagged("".join(x if x == IOTA else caseless(x) for x in unicodedata.normalize("NFD", c)))
            rare.add(c)
            continue
        if one != c:
            moved[c] = one
        if one != d:
            taken[one], joined[d] = tagged(d), one
    taken |= {c: tagged(c) for c in classes if c not in taken}
    taken[TAG] = TAG * 2
    rare -= {"ß", "ẞ"}  # too frequent: replaced before
    bounds = sorted(map(ord, rare))
    gaps = sorted(((b - a - 1, a + 1) for a, b in zip([-1, *bounds], [*bounds, 0x10000], strict=True) if b <= 0x10000), reverse=True)[:SAFE]
    safe = [chr(c) for n, a in gaps for c in range(a, a + n)]
    return Tables(moved, taken, joined, classes, _class_of(rare), _class_of(safe))


def _class_of(chars: Iterable[str]) -> str:
    """The inside of a character class of Java's patterns, by ranges."""
    ranges: list[list[int]] = []
    for c in sorted(map(ord, chars)):
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return "".join(f"\\x{{{a:X}}}" if a == b else f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges)


@cache
def _places(name: str) -> str:
    """A table as text with a place for each crc32 modulo SLOTS."""
    places = [""] * SLOTS
    for k, v in getattr(tables(), name).items():
        places[zlib.crc32(k.encode()) % SLOTS] += f"{k}\2{v}\1"
    return "\3".join(places)


def literals() -> Given:
    """The tables as literals, for a few expressions over any frame."""
    t = tables()
    texts = {"moved": "".join(t.moved), "meant": "".join(t.moved.values()), "rare": f"[{t.rare}]", "unsafe": f"[^{t.safe}]"}
    return {k: F.lit(v) for k, v in texts.items()} | {k: F.split(F.lit(_places(k)), "\3") for k in ("taken", "joined", "classes")}


def held(spark: SparkSession) -> DataFrame:
    """One row with the tables in a column unicode; beside() puts it beside other rows."""
    return keep(spark.range(0, 1, 1, 1).select(F.struct(*(c.alias(k) for k, c in literals().items())).alias("unicode")))


def beside(rows: DataFrame, row: DataFrame) -> tuple[DataFrame, Given]:
    """rows with the row of held(), and the tables in it."""
    return rows.crossJoin(F.broadcast(row)), {k: F.col("unicode")[k] for k in row.schema["unicode"].dataType.names}


def lookup(key: Column, places: Column) -> Column:
    """A table's value of the key or null, from its array of places: no entry is compared but those of the key's place."""
    place = F.element_at(places, (F.crc32(key.cast("binary")) % SLOTS + 1).cast("int"))
    return F.try_element_at(F.str_to_map(place, F.lit("\1"), F.lit("\2")), key)


def _pieces(text: Column, pattern: str, use: Callable[..., Column]) -> Column:
    """text with use(piece) in place of each match of the pattern, whose matches cover the text."""
    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(f"(?s){pattern}"), F.lit(0)), use), "")


def _syllable(p: Column) -> Column:
    """Two or three jamo, or a syllable and a trailing jamo, as one syllable; those that do not compose as they are."""
    first, second, third = F.ascii(p), F.ascii(F.substring(p, 2, 1)), F.ascii(F.substring(p, 3, 1))
    spelt = SYLLABLES + ((first - LEADING) * N_VOWELS + second - VOWELS) * N_TRAILING + F.greatest(third - TRAILING, F.lit(0))
    closed = F.when((first - SYLLABLES) % N_TRAILING == 0, first + second - TRAILING)
    code = F.when(first < SYLLABLES, spelt).otherwise(closed)
    return F.coalesce(F.decode(F.unhex(F.lpad(F.hex(code), 4, "0")), "UTF-16BE"), p)


def _rebuilt(text: Column, given: Given) -> Column:
    """Text of moved characters taken apart, its marks put in order, and put together again."""
    limit, mark, bare = "{1,256}+", r"(?:\x{FFFF}.)++", lambda p: F.regexp_replace(p, r"(?s)\x{FFFF}(.)", "$1")
    keyed = lambda c, i: F.struct(F.coalesce(lookup(F.substring(c, 2, 1), given["classes"]), F.lit("")).alias("k"), i.alias("i"), c.alias("c"))
    ordered = lambda p: F.array_join(F.transform(F.array_sort(F.transform(F.regexp_extract_all(p, F.lit(r"(?s)\x{FFFF}."), F.lit(0)), keyed)), lambda x: x["c"]), "")
    out = _pieces(text, ".", lambda c: F.coalesce(lookup(c, given["taken"]), c))
    out = _pieces(out, rf"{mark}|[^\x{{FFFF}}]{limit}", lambda p: F.when(p.startswith(TAG) & (F.char_length(p) > 2), ordered(p)).otherwise(p))
    out = F.replace(out, F.lit(TAG + IOTA), F.lit(caseless(IOTA)))
    out = _pieces(out, rf"[^\x{{FFFF}}]{mark}|{mark}|(?:[^\x{{FFFF}}](?!\x{{FFFF}})){limit}", lambda p: F.when(p.contains(TAG), F.coalesce(lookup(bare(p), given["joined"]), bare(p))).otherwise(p))
    span = lambda a, n: f"[\\x{{{a:X}}}-\\x{{{a + n - 1:X}}}]"
    lead, vowel, tail, full = span(LEADING, N_LEADING), span(VOWELS, N_VOWELS), span(TRAILING + 1, N_TRAILING - 1), span(SYLLABLES, N_SYLLABLES)
    spelt = f"{lead}{vowel}{tail}?|{full}{tail}"
    return _pieces(out, f"{spelt}|(?:(?!{lead}{vowel}|{full}{tail}).){limit}", lambda p: F.when(p.rlike(f"^(?:{spelt})$"), _syllable(p)).otherwise(p))


def folded(text: Column, given: Given | None = None) -> Column:
    """One text for all that are canonically caseless equal (by the Unicode database that Python has)."""
    given = given or literals()
    plain = F.call_function("translate", F.replace(F.replace(text, F.lit("ß"), F.lit("ss")), F.lit("ẞ"), F.lit("ss")), given["moved"], given["meant"])
    odd = (F.regexp_instr(text, given["unsafe"]) > 0) & (F.regexp_instr(text, given["rare"]) > 0)  # unlike rlike, keeps a column's compiled pattern
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).when(odd, _rebuilt(plain, given)).otherwise(plain)


def canonical(text: Column, given: Given | None = None) -> Column:
    """The canonical text; empty for null."""
    return F.btrim(F.regexp_replace(folded(F.coalesce(text, F.lit("")), given), SPACE, " "))


def wide_hash(body: Column) -> Column:
    """128 bits of XXH64 with two seeds, as 32 lower-case hex digits."""
    part = lambda h: F.lpad(F.hex(h), 16, "0")
    return F.lower(F.concat(part(F.xxhash64(body)), part(F.xxhash64(F.lit(1), body))))


def _index(rows: DataFrame) -> DataFrame:
    """(key, id, n, fp, copies, next_key, rep, multi) for each distinct key of rows (key, id, n, fp).

    The order is ascending id, nulls first, then key; the last is followed by the first. Rows are dealt by ranges of the
    order, so each window sees one range; a second window sees the ranges' first rows, one row a range.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("id").asc_nulls_first(), F.col("key")]
    ranges = keep(rows.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()))
    heads = ranges.groupBy("part").agg(F.min_by("key", F.struct("id", "key")).alias("head"))
    by_part, whole = Window.orderBy("part"), Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select("part", F.coalesce(F.lead("head").over(by_part), F.first("head").over(whole)).alias("after"))
    within = ranges.withColumn("next_key", F.lead("key").over(Window.partitionBy("part").orderBy(*order)))
    linked = within.join(heads, "part").withColumn("next_key", F.coalesce("next_key", "after")).drop("after", "part")
    groups = keep(ranges.groupBy("fp").agg(F.min_by("key", F.struct("id", "key")).alias("rep"), (F.count("*") > 1).alias("multi")))
    return linked.join(groups, "fp")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_of: Callable[[Column], Column] = wide_hash) -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for each row of docs.

    The edited text is the text with its last quarter (rounded down, in code points) replaced by the first as many code
    points, or all, of the next row's text. near_*: 1.0 where the canonical texts are equal, else 0.0; an exact digest
    knows nothing between. Null text counts as empty. Rows that repeat id and text stand once in the order and each get
    its result; null ids come first. hash_of gives a canonical text's fingerprint; whatever it is, texts of one fingerprint
    are compared, and those that differ from the first of them get longer fingerprints. Other columns are not read; an empty table gives an empty result.

    Whole texts are dealt once, by key; quarters of texts a second time, and those texts that share a fingerprint.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).alias("id"), text.alias("text"), row_key(F.col(id_col), F.col(text_col)).alias("key"))
    unicode = held(docs.sparkSession)
    wide, given = beside(base, unicode)
    wide = wide.select("key", "id", F.char_length("text").alias("n"), canonical(F.col("text"), given).alias("body"))
    rows = keep(wide.select("key", "id", "n", hash_of(F.col("body")).alias("fp")))
    distinct = rows.groupBy("key").agg(F.first("id").alias("id"), F.first("n").alias("n"), F.first("fp").alias("fp"), F.count("*").alias("copies"))
    index = keep(_index(distinct))
    before = index.select(F.col("next_key").alias("key"), F.col("key").alias("prev_key"), F.floor(F.col("n") / 4).cast("int").alias("want"))
    plan = index.join(before, "key").select("key", "fp", "prev_key", "want", (F.col("rep") == F.col("key")).alias("is_rep"), "multi", "copies")
    bodies = base.select("key", "text")  # the same columns everywhere: dealt by key once, then used again
    placed = bodies.join(plan.hint("shuffle_hash"), "key")
    heads = placed.select(F.col("prev_key").alias("key"), F.expr("left(text, want)").alias("head"), F.col("fp").alias("next_fp"))
    shared = beside(placed.filter("multi"), unicode)[0].select("key", "fp", "is_rep", canonical(F.col("text"), given).alias("body"))
    first = shared.filter("is_rep").select("fp", F.col("body").alias("first_body"))
    if not index.filter("copies > 1").isEmpty():
        heads, first = heads.dropDuplicates(["key"]), first.dropDuplicates(["fp"])
    differs = shared.join(first, "fp").filter("body <> first_body").select("key", F.sha2("body", 256).alias("own")).distinct()
    n, quarter = F.char_length("text"), F.floor(F.char_length("text") / 4).cast("int")
    whole = bodies.join(index.select("key", "id", "fp", "next_key").hint("shuffle_hash"), "key").join(heads.hint("shuffle_hash"), "key")
    edited = whole.select("id", "key", "next_key", "text", "fp", "next_fp", n.alias("n_chars"), F.concat(F.substring("text", F.lit(1), n - quarter), "head").alias("edited"))
    edited = beside(edited, unicode)[0].withColumn("body", canonical(F.col("edited"), given)).withColumn("edited_fp", hash_of(F.col("body")))
    same = (F.col("fp") == F.col("edited_fp")) & (canonical(F.col("text"), given) == F.col("body"))
    out = edited.select("id", "key", "next_key", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fp", "edited_fp", "next_fp", F.when(same, 1.0).otherwise(0.0).alias("near_edited"))
    out = out.join(differs, "key", "left").join(differs.select(F.col("key").alias("next_key"), F.col("own").alias("next_own")), "next_key", "left")
    own = F.when(F.col("near_edited") == 1, F.col("own"))  # an edited text that is the same has the same fingerprint
    out = out.withColumns({"fp": F.concat_ws("-", "fp", "own"), "next_fp": F.concat_ws("-", "next_fp", "next_own"), "edited_fp": F.concat_ws("-", "edited_fp", own)})
    return out.select(
        F.col("id").alias(id_col),
        F.col("n_chars").cast("long").alias("n_chars"),
        "edited_sha256",
        F.col("fp").alias("fingerprint"),
        F.col("edited_fp").alias("edited_fingerprint"),
        "near_edited",
        F.when(F.col("fp") == F.col("next_fp"), 1.0).otherwise(0.0).alias("near_next"),
    )
