"""Main text of web pages by the distribution of text over line blocks.

Markup is stripped to lines, one for each block of the page. A line's weight is the length of its text outside links;
lines of boilerplate regions (menus, adverts, forms, comments and the like) weigh nothing; where the page marks an article
or main region, its lines weigh more and others nothing. On every page sums over sliding windows of lines surge where text
begins and fall against the level since then where it ends; the text between is kept. A stretch of text then takes in the
light lines at its ends that stand in the same element, and the heading and short lines before it.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Lines in a window; window sum from which text begins and under which it ends.
WINDOW, SURGE = 3, 60
#: Share of the level of the text before under which it ends as well, up to so many times SURGE.
FALL, FALL_MOST = 0.15, 3
#: Text of an article beside a larger one that makes it a teaser: less than this, and less than a third of the larger one;
#: and text of a stretch that is dropped as a notice if it stands in no element of the largest one.
TEASER, ALONE = 500, 150

#: Elements whose content is no text, boilerplate elements, elements that begin a line.
RAW = "script style noscript template svg math iframe object select textarea title".split()
BOILERPLATE = "nav header footer aside form menu dialog button head fieldset".split()
BLOCKS = "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
VOID = "area base br col embed hr img input link meta param source track wbr".split()
#: Words of class, id or role that mark boilerplate.
#: A hyphenated name counts if all its parts are such words, numbers or AFFIXES; FAINT words and elements are never wrappers
#: of a page that has other text.
MARKED = "ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted related replies reply respond share sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget".split()
AFFIXES = "area bar block bottom box button buttons container desktop element entry global group inner item items left link links list main mobile outer page panel post primary right secondary section site slot text title top unit wrap wrapper".split()
FAINT = "aside button dialog footer menu nav ad ads advert advertisement advertising breadcrumb breadcrumbs comment comments consent cookie cookies copyright disqus gdpr navigation newsletter pager pagination related replies reply respond sharing social sponsor sponsored".split()
#: Parts that turn a marking word after them into its opposite, and first parts that mark whatever follows.
NEGATING = "no not non has had with without hide hidden".split()
LEADING = "cookie cookies gdpr consent disqus advert advertisement".split()
#: Elements that hold other blocks; lists, paragraphs and their like are of the element around them.
HOLDERS = "article aside body center details dialog div footer form header html main menu nav section td th".split()
#: Elements that may stand in a head; any other one ends it.
HEAD = "html head base link meta script style noscript template title".split()

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:=\s*+(?:\"[^\"]*+\"|'[^']*+')|[^>])*+)(?:>|\Z)", re.S)
END_RAW = {x: re.compile(rf"</{x}\s*(?:>|\Z)", re.I) for x in RAW}
#: Any attribute with a value, so that what another one's quotes hold is no class; quotes open a value right behind its = only.
ATTRIBUTE = re.compile(r"([^\s=/>\"']++)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++))")
#: The slash of an element that ends itself; one that ends an unquoted value is of the value.
CLOSED = re.compile(r"(?:^|[\s\"'])/\s*$")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
SPACE = re.compile(r"\s+")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_RAW, _BOILER, _BLOCK, _VOID, _MARKED, _AFFIX, _FAINT, _HEAD = map(frozenset, (RAW, BOILERPLATE, BLOCKS, VOID, MARKED, AFFIXES, FAINT, HEAD))
_NEGATING, _LEADING, _HOLDER = map(frozenset, (NEGATING, LEADING, HOLDERS))
ROOT = -1  # of lines that stand in no holder but body and html


@dataclass
class Line:
    text: str
    plain: int  # length of text outside links, boilerplate or not
    mark: int  # innermost marked element around it, or -1
    in_article: bool
    around: int  # innermost marked element around the innermost article, or -1
    heading: bool
    region: int  # innermost article or main element around it, or -1
    holder: int  # innermost holder around it, or ROOT
    listed: bool  # in a list
    boilerplate: bool = False
    weight: int = 0


@dataclass
class Mark:
    name: str
    outer: int  # the next marked element around it, or -1
    faint: bool


def _marks(attributes: str) -> tuple[frozenset[str], bool]:
    """The marking words of class, id and role: names that are one, that have one and else only affixes, that end in one
    (reader-comments, siteFooter; not no-comments) or begin with a leading one. And whether the role is main."""
    found: set[str] = set()
    main = False
    for m in ATTRIBUTE.finditer(attributes):
        if (kind := m[1].lower()) not in ("class", "id", "role"):
            continue
        for name in (m[2] or m[3] or m[4] or "").split():
            main |= kind == "role" and name.lower() == "main"
            parts = [p.lower() for p in WORDS.findall(name)]
            if all(p in _MARKED or p in _AFFIX or p.isdigit() for p in parts):
                found |= _MARKED.intersection(parts)
            elif _NEGATING.isdisjoint(parts):
                found |= {p for p in (parts[-1],) if p in _MARKED} | {p for p in (parts[0],) if p in _LEADING}
    return frozenset(found), main


def _condemned(found: list[Line], marks: list[Mark]) -> list[bool]:
    """For each marked element whether it, or one around it, is boilerplate. Those are spared that hold the article or most
    of the page's unlinked text.

    Text in faint elements (comments, menus and the like) does not count beside other text; where there is none, a faint
    element with most of the text is spared too, one that is a menu by its name only if it holds an article. Sums go from
    inner to outer elements, which have the smaller numbers, once.
    """
    n = len(marks)
    faint = [False] * n  # it or one around it
    for k, x in enumerate(marks):
        faint[k] = x.faint or (x.outer >= 0 and faint[x.outer])
    held, article, held_all, has_article = [0] * n, [0] * n, [0] * n, [False] * n
    total = total_article = total_all = 0
    for x in found:
        strong = x.mark < 0 or not faint[x.mark]
        total_all += x.plain
        total += x.plain * strong
        total_article += x.plain * (strong and x.in_article)
        if x.mark >= 0:
            held_all[x.mark] += x.plain
            held[x.mark] += x.plain * strong
            article[x.mark] += x.plain * (strong and x.in_article)
        if x.in_article and x.plain and x.around >= 0:
            has_article[x.around] = True
    for k in range(n - 1, -1, -1):
        if (up := marks[k].outer) >= 0:
            held_all[up] += held_all[k]
            held[up] += held[k]
            article[up] += article[k]
            has_article[up] |= has_article[k]
    out = [True] * n
    for k, x in enumerate(marks):
        if not x.faint:
            spared = 2 * held[k] > total and 2 * article[k] >= total_article
        else:
            spared = total < SURGE and 2 * held_all[k] > total_all and (has_article[k] or x.name not in _FAINT)
        out[k] = not spared or (x.outer >= 0 and out[x.outer])
    return out


def lines(page: str) -> list[Line]:
    """The page's lines, in order; boilerplate lines are kept in place, marked. The time is in proportion to the page,
    however deep its elements are open: each knows what stands around it."""
    out: list[Line] = []
    # open elements: name, innermost mark, in an article, innermost mark around the innermost article, in a heading,
    # innermost region, innermost holder, in a list
    stack: list[tuple[str, int, bool, int, bool, int, int, bool]] = []
    regions: list[int] = []  # the region around each
    opened: Counter[str] = Counter()
    marks: list[Mark] = []
    texts: list[str] = []
    plain, at, links, holders = 0, 0, 0, ROOT  # length of the line's text outside links; offset; open links; last holder

    def push(name: str, words: frozenset[str] | None, article: bool) -> None:
        nonlocal holders
        _, mark, inside, around, heading, region, holder, listed = stack[-1] if stack else ("", -1, False, -1, False, -1, ROOT, False)
        if words is not None:
            marks.append(Mark(name, mark, name in _FAINT or name == "head" or not words.isdisjoint(_FAINT)))
        here = len(marks) - 1 if words is not None else mark
        if article:
            regions.append(region)
            region = len(regions) - 1
        if name in _HOLDER and name not in ("html", "body"):
            holders += 1
            holder, listed = holders, False
        stack.append((name, here, inside or article, here if article else around, heading or name in HEADINGS, region, holder, listed or name in ("ul", "ol", "dl")))
        opened[name] += 1

    def cut(depth: int) -> None:
        for x in stack[depth:]:
            opened[x[0]] -= 1
        del stack[depth:]

    def leave_head() -> None:
        if opened["head"]:
            depth = next((k for k in range(min(len(stack), 4)) if stack[k][0] == "head"), None)
            if depth is not None:
                close_line()
                cut(depth)

    def close_line() -> None:
        nonlocal plain
        text = SPACE.sub(" ", "".join(texts)).strip()
        if text:
            out.append(Line(text, plain, *(stack[-1][1:] if stack else (-1, False, -1, False, -1, ROOT, False))))
        texts.clear()
        plain = 0

    def add(text: str) -> None:
        nonlocal plain
        if text:
            if not text.isspace():
                leave_head()
            text = entities.unescape(text)
            texts.append(text)
            if not links:
                plain += len(text.strip())

    while at < len(page):
        m = TOKEN.search(page, at)
        if not m:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        name = (m[3] or "").lower()
        if m[1]:
            add(entities.escape(m[1]))
        if not name:
            continue
        if m[2]:
            if name == "a":
                links = max(0, links - 1)
            if name in _BLOCK:
                close_line()
            if opened[name]:
                cut(next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name))
            continue
        if name not in _HEAD:
            leave_head()
        if name in _RAW:
            end = END_RAW[name].search(page, at)
            at = end.end() if end else len(page)
            continue
        if name == "br":
            texts.append(" ")
            continue
        if name in _BLOCK:
            close_line()
            if stack and stack[-1][0] == "p":
                cut(len(stack) - 1)
        if name in _VOID or CLOSED.search(m[4]):
            continue
        if name == "a":
            links += 1
            continue
        words, main = _marks(m[4]) if m[4] and name not in ("html", "body", "main") else (frozenset(), False)
        if name in _BLOCK:
            links = 0
            push(name, words if name in _BOILER or words else None, name in ("article", "main") or main)
        elif words:
            push(name, words, False)
    close_line()
    condemned = _condemned(out, marks)
    for x in out:
        x.boilerplate = x.mark >= 0 and condemned[x.mark]
    _weigh(out, regions)
    return out


def _weigh(found: list[Line], regions: list[int]) -> None:
    """Set the weights of lines. Lines of articles weigh SURGE more than their text, links among them, and all others then
    nothing, unless no article has text; an article that is a teaser beside another one is none."""
    held = [0] * len(regions)
    for x in found:
        x.weight = 0 if x.boilerplate else x.plain
        if x.region >= 0:
            held[x.region] += x.weight
    largest: dict[int, int] = {}
    for k in range(len(regions) - 1, -1, -1):  # inner ones have the larger numbers
        if regions[k] >= 0:
            held[regions[k]] += held[k]
        largest[regions[k]] = max(largest.get(regions[k], 0), held[k])
    article = [False] * len(regions)
    for k, up in enumerate(regions):
        teaser = held[k] < TEASER and 3 * held[k] < largest[up]
        article[k] = not teaser and (up < 0 or article[up])
    if any(article[x.region] and x.weight for x in found if x.region >= 0):
        for x in found:
            x.weight = x.weight + SURGE if x.region >= 0 and article[x.region] and not x.boilerplate else 0


def _stretches(weights: list[int], window: int, surge: int) -> list[tuple[int, int]]:
    """Where text stands: from a line that opens a window whose sum reaches `surge` (or the greatest sum) and that is no
    light one before heavier ones, to the line before a window whose sum falls under `surge`, or far under the level of the
    windows since the beginning. Light lines at the end are not of it."""
    sums = [sum(weights[k : k + window]) for k in range(len(weights))]
    need = min(surge, max(sums, default=0))
    if not need:
        return []
    out, begin, level = [], -1, 0
    for k, s in enumerate(sums):
        if begin < 0:
            if s >= need and weights[k] and (weights[k] >= need or 4 * weights[k] >= s):
                begin, level = k, 0
        elif s < need or s < min(FALL * level / (k - begin), FALL_MOST * surge):
            out.append((begin, k))
            begin = -1
            if weights[k] >= need:
                begin, level = k, 0
        level += s
    if begin >= 0:
        out.append((begin, len(weights)))
    ends = []
    for a, b in out:
        while b > a + 1 and weights[b - 1] < need and 4 * weights[b - 1] < max(weights[max(a, b - window) : b]):
            b -= 1
        ends.append((a, b))
    return ends


class _Ends:
    """For each line how far a text that begins or ends with it spreads; all lines are looked at once."""

    def __init__(self, found: list[Line]) -> None:
        self.found = found
        self.first: dict[int, int] = {}
        self.last: dict[int, int] = {}
        n = len(found)
        self.back, self.on = list(range(n)), list(range(n))  # of lines of the page itself: the unbroken run's ends
        for k, x in enumerate(found):
            if x.holder == ROOT:
                if k and found[k - 1].holder == ROOT and (found[k - 1].plain or found[k - 1].heading):
                    self.back[k] = self.back[k - 1]
            elif x.plain or x.heading or not x.listed:
                self.first.setdefault(x.holder, k)
                self.last[x.holder] = k
        for k in range(n - 2, -1, -1):
            if found[k].holder == found[k + 1].holder == ROOT and found[k + 1].plain:
                self.on[k] = self.on[k + 1]

    def spread(self, a: int, b: int) -> tuple[int, int]:
        """The stretch from a to before b with the lines at its ends that are of the text as well: those of the same
        element, to its first and last lines that are no list's links; where that is the page itself, those without a
        break; and a heading before it, with short unlinked lines between."""
        found = self.found
        first, last = found[a].holder, found[b - 1].holder
        a = self.back[a] if first == ROOT else min(a, self.first.get(first, a))
        b = max(b, (self.on[b - 1] if last == ROOT else self.last.get(last, b - 1)) + 1)
        k = a
        while k and a - k < 6 and 0 < found[k - 1].plain < SURGE and not found[k - 1].heading:
            k -= 1
        if k and found[k - 1].heading:
            a = k - 1
            while a and found[a - 1].heading:
                a -= 1
        return a, b


def main_text(page: str | None, window: int = WINDOW, surge: int = SURGE) -> str:
    """The main text of a page; empty if there is none. Surges and falls of the lines' weights decide on every page; see
    _weigh(), _stretches() and _Ends."""
    found = [x for x in lines(page or "") if not x.boilerplate]
    raised = any(x.weight > x.plain for x in found)
    stretches = _stretches([x.weight for x in found], window, surge)
    if raised:  # an article: what is outside weighs nothing
        return " ".join(x.text for a, b in stretches for x in found[a:b] if x.weight)
    size = lambda s: sum(x.weight for x in found[s[0] : s[1]])
    main = max(stretches, key=size, default=(0, 0))
    homes = {x.holder for x in found[main[0] : main[1]]}
    kept = [s for s in stretches if s == main or size(s) >= ALONE or homes.intersection(x.holder for x in found[s[0] : s[1]])]
    ends, steps, text, depth = _Ends(found), [0] * (len(found) + 1), [], 0
    for s in kept:
        a, b = ends.spread(*s)
        steps[a] += 1
        steps[b] -= 1
    for k, x in enumerate(found):
        depth += steps[k]
        if depth and (x.plain or not x.listed):  # lists of links are none of the text
            text.append(x.text)
    return " ".join(text)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) for each row of pages: the main text of the whole html and its code points.

    Null or empty html, and pages without main text, give an empty text. Character references are decoded, white space
    inside a line is one space, lines are joined by one. Rows that repeat are extracted each; other columns are not read;
    an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h).encode("utf-8", "replace").decode() for h in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [id_col, url_col, "text", "n_chars"])

    rows = pages.select(F.col(id_col), F.col(url_col), F.col(html_col))
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:2], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]))


#: DuckDB SQL for extract() over pages that mark their article, whose markup and references are those of the tables.
ORACLE = r"""
WITH a AS (SELECT page_id, url, coalesce(regexp_extract(html, '(?s)<article>(.*?)(</article>|$)', 1), '') AS body FROM pages),
b AS (SELECT page_id, url, regexp_replace(regexp_replace(body, '</?(p|h1|br)>', ' ', 'g'), '<[^>]*>', '', 'g') AS body FROM a),
c AS (SELECT page_id, url, regexp_replace(replace(body, '&quot;', '"'), '&amp;?', '&', 'g') AS body FROM b),
d AS (SELECT page_id, url, trim(regexp_replace(body, '\s+', ' ', 'g')) AS text FROM c)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM d"""
