"""URL filter: rules by host and path first, then a weighted vocabulary found with Aho-Corasick."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, UPPER

#: Words of which one in a url rejects it, and words of which two different ones do. General words of adult
#: pages, gambling, pill and counterfeit trade, piracy and link farms; larger lists are read with read_terms().
STRICT = """
bdsm blowjob bukkake camgirl camgirls camsex casino casinos cialis creampie cumshot cunnilingus deepthroat dildo dildos
erotica escort-girls escorts femdom fetish fleshlight gangbang gonzo-porn hentai horny hotwife incest kamagra keygen
keygens levitra lolita milf milfs nudes onlyfans-leak orgasm orgy pornhub porn porno pornos pornstar pornstars propecia
redtube rimjob roulette sexcam sexcams sexchat sexshop sextape shemale slotmachine sportsbook strapon stripchat stripper
strippers swingers threesome tramadol upskirt valium viagra voyeur vulva warez webcamsex whores xanax xhamster xnxx
xvideos xxx youporn
""".split()
SOFT = """
ad adclick adult adults ads adserver affiliate amateur anal babe babes bet bets betting bikini bingo blackjack bonus
boobs busty cam cams cash cheap clickbait click counterfeit coupon crack cracked dating dealer discount doubler dvdrip
earn erotic escort fake farm flirt free fuck gamble gambling giveaway guaranteed hack hacked hardcore hookup hot
income jackpot kinky kiss latex leaked lingerie loan loans lottery lotto lucky lust luxury massage mature meds miracle
naked naughty nude nudity offers online-pharmacy pawn payday penis pharmacy pill pills pirate poker popunder
prescription promo prize profit pussy replica rich scam sex sexy singles slot slots slut spam spins stake strip teen
teens teenie tits toy toys torrent torrents track tracker tracking unlimited vagina webcam weight whore win winner
winning xx
""".split()
#: Fixed values: (decision, host, path prefix).
RULES = (("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/"))


def host_path(url: Column) -> tuple[Column, Column]:
    """Host and path of a url; both empty for null or without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url)))
    host = F.coalesce(F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))
    return host, path


def _rule(host: Column, path: Column, rules: Iterable[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The rule that fits (its text) and its decision, both null if none does. The longest text wins."""
    text, decision = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, at, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == at) | host.endswith(f".{at}")) & path.startswith(start)
        text, decision = F.when(fits, F.lit(at + start)).otherwise(text), F.when(fits, F.lit(what)).otherwise(decision)
    return text, decision


def read_terms(spark: SparkSession, path: str) -> list[str]:
    """The terms of a text file, one a line, each once, without blank lines and lines that # opens. They are held by the
    driver and every task, so the list must fit in memory: some millions do."""
    line = F.trim("value")
    rows = spark.read.text(path).select(F.translate(line, UPPER, LOWER).alias("t")).filter("t <> '' and not startswith(t, '#')")
    return sorted(r.t for r in rows.distinct().collect())


def term_hits(urls: DataFrame, col: str, strict: Iterable[str], soft: Iterable[str]) -> Column:
    """A column struct(n_strict, n_soft) over the string column: distinct terms that stand alone in it.

    A term stands alone when no ASCII letter or digit touches it. Terms and text are compared after A-Z to a-z; a term of
    both lists is strict. The lists go to the tasks once, by broadcast.
    """
    table = str.maketrans(UPPER, LOWER)
    kinds = {t.translate(table): False for t in soft} | {t.translate(table): True for t in strict}
    shared = urls.sparkSession.sparkContext.broadcast({t: k for t, k in kinds.items() if t})
    alnum = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")

    @F.pandas_udf("n_strict long, n_soft long")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        machine = ahocorasick.Automaton()
        for term, is_strict in shared.value.items():
            machine.add_word(term, (term, is_strict))
        machine.make_automaton()
        for urls in batches:
            rows = []
            for url in urls:
                text, hits = (url or "").translate(table), {}
                for end, (term, is_strict) in machine.iter(text) if shared.value else ():
                    first = end - len(term) + 1
                    if not (first and text[first - 1] in alnum) and not (end + 1 < len(text) and text[end + 1] in alnum):
                        hits[term] = is_strict
                n = sum(hits.values())
                rows.append((n, len(hits) - n))
            yield pd.DataFrame(rows, columns=["n_strict", "n_soft"])

    return find(F.col(col))


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, strict: Iterable[str] = STRICT, soft: Iterable[str] = SOFT, several: int = 2) -> DataFrame:
    """(id, host, path, rule, verdict, n_strict, n_soft, weight) for each row of pages.

    A rule decides where one fits; elsewhere one strict term blocks, or `several` distinct soft ones: weight, which is one
    for a strict term and 1 / several for a soft one, is at least one. A null or empty url has empty host and path, no rule
    and verdict allow. Repeated rows are judged each; other columns of pages are not read; an empty table gives an empty
    result, empty lists block nothing.
    """
    rows = pages.select(F.col(id_col), F.col(url_col).alias("url"))
    host, path = host_path(F.col("url"))
    rows = rows.select(id_col, "url", host.alias("host"), path.alias("path"))
    rule, decision = _rule(F.col("host"), F.col("path"), rules)
    rows = rows.select("*", rule.alias("rule"), decision.alias("decision"), term_hits(rows, "url", strict, soft).alias("hits"))
    n_strict, n_soft = F.col("hits.n_strict"), F.col("hits.n_soft")
    method = F.when((n_strict > 0) | (n_soft >= several), "block").otherwise("allow")
    return rows.select(id_col, "host", "path", "rule", F.coalesce("decision", method).alias("verdict"), n_strict.alias("n_strict"), n_soft.alias("n_soft"), (n_strict + n_soft / F.lit(float(several))).alias("weight"))


def oracle() -> str:
    """DuckDB SQL for the same result, the terms found by a pattern each."""
    low = f"translate(coalesce(url, ''), '{UPPER}', '{LOWER}')"
    hit = lambda terms: " + ".join(f"(CASE WHEN regexp_matches(low, '(^|[^a-z0-9]){t}([^a-z0-9]|$)') THEN 1 ELSE 0 END)" for t in terms)
    fits = lambda h, p: f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))"
    order = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    return f"""
WITH cut AS (SELECT page_id, {low} AS low, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
part AS (SELECT page_id, low, translate(coalesce(regexp_extract(rest, '^([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
  coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM cut),
hits AS (SELECT *, CAST({hit(STRICT)} AS BIGINT) AS n_strict, CAST({hit([t for t in SOFT if t not in STRICT])} AS BIGINT) AS n_soft,
  CASE {' '.join(f"WHEN {fits(h, p)} THEN '{h}{p}'" for _, h, p in order)} END AS rule,
  CASE {' '.join(f"WHEN {fits(h, p)} THEN '{d}'" for d, h, p in order)} END AS decision FROM part)
SELECT page_id, host, path, rule, coalesce(decision, CASE WHEN n_strict + 0.5 * n_soft >= 1 THEN 'block' ELSE 'allow' END) AS verdict,
  n_strict, n_soft, CAST(n_strict + 0.5 * n_soft AS DOUBLE) AS weight FROM hits"""
