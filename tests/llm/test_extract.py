import html
import re
import time

import pytest

from driftline.llm.extract import extract, main_text

TEXT = "The harbour was quiet that morning, and nobody had expected the boats to return so early in the year. "


def truth(page):
    body = re.search(r"(?s)<article>(.*?)(</article>|$)", page)[1]
    return re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", re.sub(r"</?(?:p|h1|br)>", " ", body)))).strip()


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_articles_of_the_tables(spark, sf):
    for r in spark.read.parquet(f"/root/testdata/{sf}/pages.parquet").collect():
        assert main_text(r.html) == truth(r.html)


def test_odd_attributes():
    """Quotes open a value behind its = only; what stands in another attribute's value is no class."""
    for tag in ("p title=don't", 'p title="a > b"', "p data-x='class=\"ad\"'", "p title=it's class=text", 'p title="class=ad"', "p class = 'news share-price'", "p data-class=ad"):
        assert main_text(f"<article><{tag}>{TEXT}</p><p>{TEXT}</p></article>") == (TEXT * 2).strip(), tag
    assert main_text(f"<article class='news share-price'><p>{TEXT}</p></article>") == TEXT.strip()
    assert main_text(f'<article><p>{TEXT}</p><p><a href="x>There</a> it was.</p></article>') == f"{TEXT}There it was."
    assert main_text(f"<article><p>{TEXT}</p><p class=ad>Buy.</p><p><a href=/x/>Link</a> end.</p></article>") == f"{TEXT}Link end."
    linked = "".join(f"<p><a href='/{k}'>Part {k}</a></p>" for k in range(4))
    assert main_text(f"<article><p>{TEXT}</p>{linked}<p>{TEXT}</p></article>") == f"{TEXT}Part 0 Part 1 Part 2 Part 3 {TEXT.strip()}"


def test_open_elements_take_time_in_proportion():
    def took(n):
        t = time.process_time()
        main_text("<div class=ad>x" * n + "</span>" * n + "<div>" * n + "<p>y" * n + '<a href="' * n)
        return time.process_time() - t

    took(500)
    assert took(50_000) < 10 * max(took(12_500), 0.05)


def test_boilerplate_goes():
    page = f"""<html><head><title>T</title><script>var a = "<p>no</p>";</script></head><body>
    <div id="cookie-notice"><p>{TEXT}</p></div><ul class="menu"><li><a href="/">Home</a></li></ul>
    <div class="content"><h1>Boats &amp; harbours</h1><p>{TEXT}<b>Bo</b>ld.</p><form><p>{TEXT}</p></form><!-- <p>{TEXT}</p> -->
    <p>Short.</p><p>{TEXT}</p></div><section class="comments"><p>{TEXT * 3}</p></section><aside>{TEXT}</aside>
    <footer><p>{TEXT}</p></footer></body></html>"""
    assert main_text(page) == f"Boats & harbours {TEXT}Bold. Short. {TEXT.strip()}"


def test_without_regions_links_weigh_nothing():
    menu = "".join(f"<li><a href='/{i}'>Some section {i}</a></li>" for i in range(9))
    page = f"<ul>{menu}</ul><p>{TEXT * 2}</p><p>{TEXT}</p><ul>{menu}</ul>"
    assert main_text(page) == (TEXT * 3).strip()


def test_edge_rows(spark):
    rows = [(1, None, None, 1), (2, "u", "", 1), (3, "u", "plain < text", 1), (4, "u", "<p>" + "word " * 60000, 1), (4, "u", "<script>x", 1)]
    got = sorted((r.page_id, r.n_chars) for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string, text int")).collect())
    assert got == [(1, 0), (2, 0), (3, 12), (4, 0), (4, 299999)]


def test_marked_wrappers_do_not_take_the_article():
    body = f"<h1>Boats</h1><p>{TEXT}</p><p>{TEXT * 2}</p>"
    want = f"Boats {TEXT}{TEXT * 2}".strip()
    menu, side = "<nav><p>Go to start</p></nav>", f"<div class='sidebar'><p>{TEXT}</p></div>"
    for name in ("content with-sidebar", "no-comments", "notice-board", "widget", "sidebar-wrap"):
        assert main_text(f"<body>{menu}<div class='{name}'>{body}</div></body>") == want, name
        assert main_text(f"<body>{menu}<div class='{name}'><article>{body}</article></div></body>") == want, name
    assert main_text(f"<body><article class='post no-comments'>{body}</article></body>") == want
    assert main_text(f"<html><head><title>T</title><meta charset='utf-8'><body>{body}</body></html>") == want
    assert main_text(f"<head><title>T</title><link rel='x'>{body}") == want
    assert main_text(f"<body><form action='/x'>{menu}{body}{side}</form></body>") == want
    assert main_text(f"<body>{menu}<main>{body}</main><section class='comments'><article>{TEXT * 9}</article></section></body>") == want
    assert main_text(f"<body>{menu}<div>{body}</div><div id='comments'><p>{TEXT * 9}</p></div>{side}</body>") == want


def test_nothing_of_an_article_is_cut():
    links = "".join(f"<li><a href='/{i}'>Source {i}</a></li>" for i in range(5))
    said = " ".join(f"Source {i}" for i in range(5))
    head, body, end = "<h1>Boats</h1><p>By Ann</p><p>1 May</p>", f"<p>{(TEXT * 900).strip()}</p>", f"<h2>After</h2><p>{(TEXT * 80).strip()}</p>"
    want = ["Boats By Ann 1 May", (TEXT * 900).strip(), said, "After", (TEXT * 80).strip(), said]
    assert main_text(f"<ul>{links}</ul><article>{head}{body}<ul>{links}</ul>{end}<ul>{links}</ul></article><p>{TEXT}</p>") == " ".join(want)
    assert main_text(f"<ul>{links}</ul><div>{head}{body}<ul>{links}</ul>{end}</div><ul>{links}</ul>") == " ".join([*want[:2], *want[3:5]])
    linked = "<h1><a href='/b'>Boats</a></h1><p>A</p><p>B</p><p>C</p>"
    assert main_text(f"<ul>{links}</ul>{linked}{body}") == f"Boats A B C {(TEXT * 900).strip()}"


def test_articles_without_their_mark_are_found_by_their_lines(spark):
    """The tables' pages with every article element renamed to a plain one: surges and falls alone find the same text."""
    for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect():
        assert main_text(r.html.replace("<article", "<div").replace("</article", "</div")) == truth(r.html)


def test_short_boilerplate_beside_the_text_goes():
    article = f"<p>{TEXT}</p><p>{TEXT * 2}</p>"
    want = f"{TEXT}{TEXT * 2}".strip()
    before, after = "<div>Acme Daily</div><div>Home | World | Sport | Contact us</div>", "<div>Copyright 2020 Acme Media</div><div>Terms of use apply.</div>"
    for tag in ("div class='content'", "article", "section"):
        page = f"<body>{before}<{tag}>{article}</{tag.split()[0]}>{after}</body>"
        assert main_text(page) == want, tag
        for name in ("reader-comments", "user-comments", "siteFooter", "cookie-law-info", "comment-list", "post-comments"):
            assert main_text(f"<body>{before}<{tag}>{article}<div class='{name}'><p>{TEXT}</p></div></{tag.split()[0]}><div class='{name}'><p>{TEXT}</p></div>{after}") == want, (tag, name)
    assert main_text(f"<article>{article}</article><article><h3>More</h3><p>A teaser of another story.</p></article>") == want
    assert main_text(f"<article>{article}</article><article><p>{TEXT * 2}</p></article>") == f"{want} {TEXT * 2}".strip()


def test_linked_and_short_lines_of_the_text_stay():
    linked = "<p><a href='/a'>A whole paragraph that is a link to another page of this site</a></p><p><a href='/b'>One</a></p><p><a href='/c'>Two</a></p>"
    page = f"<div>Acme Daily</div><div class='content'><p>{TEXT}</p>{linked}<p>Short close.</p></div><div>Terms of use</div>"
    assert main_text(page) == f"{TEXT}A whole paragraph that is a link to another page of this site One Two Short close."


def unmarked_pages():
    """Pages without any semantic tag or telling name, and the text of each."""
    import random

    rnd, words = random.Random(12), TEXT.lower().replace(".", "").replace(",", "").split()
    say = lambda n: " ".join(rnd.choices(words, k=n)).capitalize() + "."
    for k in range(48):
        title, blocks = say(6), [say(rnd.choice([6, 25, 40, 80])) for _ in range(rnd.randrange(3, 12))]
        blocks[0], blocks[-1] = say(40), say(rnd.choice([8, 40]))
        wrap = [lambda x: f"<div class='c{k}'>{x}</div>", lambda x: f"<div><div>{x}</div></div>", lambda x: f"<table><tr><td>{x}</td></tr></table>", lambda x: f"<center>{x}</center>"][k % 4]
        body = [f"<h1>{title}</h1>", *(f"<p>{b}</p>" for b in blocks)] if k % 3 else [f"<h2>{title}</h2>", *(f"<div>{b}</div>" for b in blocks)]
        menu = "".join(f"<li><a href='/{n}'>{say(2)}</a></li>" for n in range(rnd.randrange(3, 9)))
        top = rnd.choice([f"<ul>{menu}</ul>", f"<div>{say(2)}</div><div>{say(5)}</div>", f"<div><a href='/'>{say(3)}</a></div><ul>{menu}</ul>"])
        low = rnd.choice([f"<ul>{menu}</ul><div>{say(4)}</div>", f"<div>{say(5)}</div><div>{say(4)}</div>", f"<div><a href='/x'>{say(9)}</a></div>"])
        yield f"<html><body>{top}{wrap(''.join(body))}{low}</body></html>", " ".join([title, *blocks])


def test_precision_and_recall_on_pages_without_semantic_tags():
    from collections import Counter

    both = said = true = 0
    for page, want in unmarked_pages():
        a, b = Counter(main_text(page).split()), Counter(want.split())
        both, said, true = both + (a & b).total(), said + a.total(), true + b.total()
    print(f"precision {both / said:.4f}, recall {both / true:.4f}")
    assert both / said > 0.97 and both / true > 0.97


def test_many_stretches_take_time_in_proportion():
    def took(n):
        t = time.process_time()
        main_text("".join(f"<p>{TEXT}</p><p><a href='/'>x</a></p><ul><li><a>y</a><li><a>z</a></ul>" for _ in range(n)) + f"<div>{'<p>ab</p>' * n}</div>")
        return time.process_time() - t

    took(100)
    assert took(8000) < 8 * max(took(2000), 0.05)
