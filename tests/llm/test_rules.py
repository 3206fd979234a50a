"""Decontamination, mixing, URL rules, WARC and quotes against plain Python on small tables with awkward rows."""

import gzip
import hashlib
import random
import re

import duckdb
import pytest

from driftline.llm import decontaminate, mixing, quotes, urlfilter, warc

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORDS.findall((text or "").translate(LOWER))


def slow_decontaminate(docs, items, size=13):
    wins = {}
    for item, text in items:
        w = words(text)
        for i in range(max(len(w) - size, 0) + 1 if w else 0):
            wins.setdefault(tuple(w[i : i + size]), set()).add(str(item))
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for g, ids in wins.items():
            for i in range(len(w) - len(g) + 1):
                if tuple(w[i : i + len(g)]) == g:
                    hit |= set(range(i, i + len(g)))
                    found |= ids
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [3, 400_000])
def test_decontaminate_is_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate.occurrences, "__defaults__", (block,))
    rnd = random.Random(3)
    some = lambda n: " ".join(rnd.choice(["a", "B", "c", "dé", "e5"]) for _ in range(n))
    items = [(f"i{n}", some(n)) for n in (1, 2, 5, 12, 13, 14, 30)] + [("none", None), ("gap", " .-"), ("i5", "x y")]
    docs = [(i, some(rnd.choice([0, 1, 5, 20, 200]))) for i in range(12)]
    docs += [(100, f"{some(20)}. {items[6][1].upper()}! {some(400)}"), (101, items[5][1]), (102, None), (103, ""), (101, items[5][1]), (None, "x Y"), (104, "a " * 3000)]
    d = spark.createDataFrame([(i, t, "x", "y") for i, t in docs], "doc_id long, text string, word string, gram string")
    b = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id string, text string, doc_id int")
    assert sorted(map(tuple, decontaminate.decontaminate(d, b).collect()), key=str) == slow_decontaminate(docs, items)


def test_decontaminate_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    b = spark.createDataFrame([("i", "a b")], "item_id string, text string")
    (row,) = decontaminate.decontaminate(d, b.limit(0)).collect()
    assert (row.n_words, row.n_hit, row.contaminated) == (2, 0, False)
    assert decontaminate.decontaminate(d.limit(0), b).count() == 0


def slow_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), share * sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > most * sizes[s]}
        for s in over or open_:
            target[s] = most * sizes[s] if over else level * weight[s]
        left -= sum(target[s] for s in over)
        open_ -= over or open_
    return target


def test_mix_targets_and_budgets(spark):
    rnd = random.Random(5)
    rows = [(i, " ".join(["w"] * rnd.choice([0, 1, 7, 40])), rnd.choice(["hot"] * 6 + ["b", "a", None, "é"])) for i in range(300)]
    rows += [(900, None, "a"), (901, "", "only empty"), (5, "x y z", "hot"), (None, "p q", "b")]
    df = spark.createDataFrame([(i, t, s, 1, 2) for i, t, s in rows], "doc_id long, text string, source string, size int, taken int")
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(df.repartition(3)).collect()))
    sizes, taken = {}, {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    target = slow_targets(sizes)
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, t in target.items():
        assert taken[s] == int(t + 1e-9)
    assert mixing.mix(df.limit(0)).count() == 0


def test_mix_is_its_sql(spark):
    rows = [(i, "w " * (i % 9), "abc"[i % 3] if i % 7 else None) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    documents = docs.toPandas()
    con = duckdb.connect()
    con.register("documents", documents)
    mine = {r.doc_id: r.taken for r in mixing.mix(docs).collect()}
    assert mine == {r[0]: r[-1] for r in con.sql(mixing.ORACLE).fetchall()}


def test_url_rules_and_terms(spark):
    cases = [
        ("http://a.COM/en/x", "a.com", "/en/x", "com/en/", "block"),
        ("http://example.com/en/7#f", "example.com", "/en/7", "example.com/en/7", "allow"),
        ("http://notexample.com/en/7", "notexample.com", "/en/7", "com/en/", "block"),
        ("https://w.example.net/de/8?q", "w.example.net", "/de/8", "example.net/de/8", "block"),
        ("https://casino.net/de/1", "casino.net", "/de/1", "net/de/", "allow"),
        ("http://x.io/casino", "x.io", "/casino", None, "block"),
        ("http://x.io/casinoz", "x.io", "/casinoz", None, "allow"),
        ("http://x.io/free-free", "x.io", "/free-free", None, "allow"),
        ("http://x.io/free-poker", "x.io", "/free-poker", None, "block"),
        ("http://x.io", "x.io", "", None, "allow"),
        ("no mark", "", "", None, "allow"),
        ("", "", "", None, "allow"),
        (None, "", "", None, "allow"),
    ]
    df = spark.createDataFrame([(i, c[0], "h") for i, c in enumerate(cases)], "page_id long, url string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlfilter.judge_urls(df).collect()}
    assert got == {i: c[1:] for i, c in enumerate(cases)}
    assert urlfilter.judge_urls(df.limit(0)).count() == 0
    none = urlfilter.judge_urls(df, rules=(), strict=(), soft=()).collect()
    assert {(r.verdict, r.n_strict, r.n_soft) for r in none} == {("allow", 0, 0)}
    only_soft = urlfilter.judge_urls(df, rules=(), strict=(), soft=("Free", "poker", "x")).collect()
    assert {r.page_id for r in only_soft if r.verdict == "block"} == {7, 8}


def test_url_terms_from_a_file(spark, tmp_path):
    (tmp_path / "terms.txt").write_text("# words\nCasino\n\n  bets \nbets\n")
    assert urlfilter.read_terms(spark, str(tmp_path / "terms.txt")) == ["bets", "casino"]


def test_warc_round_trip(spark):
    big = "<p>" + "ä" * 200 + "</p>"
    magic = "x" * 100 + "\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    rows = [(7, "http://a", big), (3, "http://b\r\nWARC-Type: x", big), (9, None, big), (1, "u", magic), (2, "u", "short"), (4, "u", "short"), (5, "u", None), (6, "u", ""), (8, "u", "y\r\n" * 50_000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")
    got = {r.page_id: r for r in warc.round_trip(df).collect()}
    assert len(got) == len(rows)
    for i, _, html in rows:
        data = (html or "").encode()
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(data), hashlib.sha256(data).hexdigest())
        assert (got[i].record_type, got[i].refers_to) == (("revisit", 3) if i in (7, 9) else ("response", None))
    assert warc.round_trip(df.limit(0)).count() == 0


def test_warc_members_and_cut_streams(spark, tmp_path, monkeypatch):
    """All gzip members of an archive are read, wherever they are split; a cut one raises."""
    page = lambda i, body: f"HTTP/1.1 200 OK\r\n\r\n{body}".encode()
    blocks = [page(i, f"<p>{i}</p>" * (1 + 400 * i) + ("\r\nWARC/1.1\r\nContent-Length: 99999999\r\n\r\n" if i == 2 else "")) for i in range(6)]
    records = [f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: r{i}\r\nContent-Length: {len(b)}\r\n\r\n".encode() + b + b"\r\n\r\n" for i, b in enumerate(blocks)]
    whole = b"".join(records)
    files = {"records": [*records], "uneven": [whole[a : a + 777] for a in range(0, len(whole), 777)], "one": [whole]}
    want = sorted((f"r{i}", hashlib.sha256(b.partition(b"\r\n\r\n")[2]).hexdigest()) for i, b in enumerate(blocks))
    for name, members in files.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.warc.gz").write_bytes(b"".join(map(gzip.compress, members)) + b"\0" * 9)
        assert sorted((r.record_id, r.digest) for r in warc.read_archives(spark, str(tmp_path / name)).collect()) == want
    for size in (1, 7, 100):
        monkeypatch.setattr(warc, "PIECE", size)
        assert b"".join(warc.pieces(gzip.compress(whole))) == whole
        assert sorted((x[4], x[8]) for x in warc.candidates(warc.pieces(whole)) if x[8] and x[2] == 0) == want
    with pytest.raises(ValueError):
        list(warc.pieces(gzip.compress(records[0]) + gzip.compress(records[5])[:-9]))


def test_warc_hostile_payloads(spark):
    """Lengths that are no ASCII numbers, marks by the hundred thousand and headers without an end are payload bytes."""
    head = "WARC/1.1\r\nContent-Length: "
    bodies = [f"{head}²\r\n\r\n", f"{head}{'9' * 5000}\r\n\r\n", f"{head}-5\r\n\r\n", f"\r\n\r\n{head}7\r\n\r\n1234567\r\n\r\n" * 20_000, "WARC/1.0\r\n" * 100_000, "\r\n\r\nWARC/1.1\r\n" * 50_000, f"\r\n\r\n{head}1000000\r\n\r\n" * 30_000, "\r\n\r\nWARC/1.1\r\nno end: " + "x" * 3_000_000, "HTTP/1.1 200 OK", ""]
    rows = [(i, f"http://x/{i}", b) for i, b in enumerate(bodies)] + [(None, "u", f"\r\n\r\n{head}²")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type) for r in warc.round_trip(df).collect()}
    assert got == {i: (len(b.encode()), hashlib.sha256(b.encode()).hexdigest(), "response") for i, _, b in rows}


def test_warc_candidates_take_time_in_proportion():
    """Twice the marks take about twice the time, whatever they claim."""
    import time

    def took(n):
        data = b"WARC/1.1\r\nContent-Length: %d\r\n\r\n" % (n * 40) + b"\r\n\r\nWARC/1.1\r\nContent-Length: 99999999\r\n\r\n" * n
        t = time.process_time()
        assert sum(1 for _ in warc.candidates(data[a : a + 1000] for a in range(0, len(data), 1000))) >= n - 1
        return time.process_time() - t

    took(2000)
    assert took(80_000) < 10 * max(took(20_000), 0.05)


def slow_chain(data):
    """Offsets reached from the start, record by record."""
    at, out = 0, []
    while m := re.compile(rb"WARC/1\.[01]\r\n(?:.*\r\n)*?Content-Length: ([0-9]+)\r\n\r\n").match(data, at):
        if m.end() + int(m[1]) > len(data):
            break
        out.append(at)
        at = m.end() + int(m[1]) + 4
    return out


@pytest.mark.parametrize("most", [0, 3, 1_000_000])
def test_warc_chains_are_those_of_a_walk(spark, tmp_path, monkeypatch, most):
    """Random payloads of marks that lead into true records, into each other and nowhere."""
    monkeypatch.setattr(warc, "NAMED", most)
    rnd = random.Random(9)
    want = {}
    for k in range(12):
        data = b""
        for _ in range(rnd.choice([0, 1, 3, 9])):
            body = b"".join(b"\r\n\r\nWARC/1.1\r\nContent-Length: %d\r\n\r\n" % rnd.choice([0, 3, 36, 40, 76, 80, 116, 400]) + b"x" * rnd.choice([0, 0, 3, 36]) for _ in range(rnd.choice([0, 1, 5, 12])))
            data += b"WARC/1.0\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(body), body)
        (tmp_path / f"{k}.warc").write_bytes(data)
        want[k] = slow_chain(data)
    monkeypatch.setattr(warc, "PIECE", 50)
    found = {}
    schema = warc.FIELDS
    rows = [(str(k), *x) for k in want for x in warc.candidates(warc.pieces((tmp_path / f"{k}.warc").read_bytes()))]
    all_found = spark.createDataFrame(rows, schema)
    for r in all_found.join(warc._chains(all_found), ["file", "path"]).collect():
        found.setdefault(int(r.file), []).append(r.at)
    assert {k: sorted(v) for k, v in found.items()} == {k: v for k, v in want.items() if v}


def test_warc_blocks_without_http_header(spark, tmp_path):
    """The payload of a record that is no HTTP message is its whole block, blank lines included."""
    block = b"software: x\r\n\r\nmore\r\n"
    data = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(block), block)
    cut = b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 50\r\n\r\nHTTP/1.1 200 OK\r\n\r\nabc"
    (tmp_path / "a.warc").write_bytes(data * 3 + cut)
    got = [(r.n_bytes, r.digest) for r in warc.read_archives(spark, str(tmp_path)).collect()]
    assert got == [(len(block), hashlib.sha256(block).hexdigest())] * 3


def test_warc_files_are_bounded_by_bytes(spark, tmp_path):
    rows = [(i, "u", str(i) * n) for i, n in enumerate([10] * 20 + [900] * 6 + [5000] * 2)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    warc.write_archives(df, str(tmp_path / "w"), records=8, compression="none", size=2000)
    read = warc.read_archives(spark, str(tmp_path / "w"))
    assert sorted(r.n_bytes for r in read.collect()) == sorted(len(h) for _, _, h in rows)
    for r in read.groupBy("file").agg({"n_bytes": "sum", "*": "count"}).collect():
        assert r["count(1)"] <= 8 and (r["sum(n_bytes)"] <= 2000 or r["count(1)"] == 1)


def test_quotes_make_reply_chains(spark):
    mail = [
        ("c", 0, "user", "How are you?\nTell me."),
        ("c", 1, "bot", "> how  ARE you?\nFine."),
        ("c", 2, "user", "> Fine.\n>> How are you?\nGood"),
        ("c", 3, "bot", "> Tell me.\nI did"),
        ("c", 4, "user", "> never said\nhm"),
        ("d", 0, "user", "> Fine.\nother talk"),
        ("d", 1, "bot", None),
        ("d", None, "bot", "> other talk\nlost"),
    ]
    df = spark.createDataFrame([(*m, 5) for m in mail], "conv_id string, turn int, role string, text string, line int")
    got = {(r.conv_id, r.turn): (r.text, r.n_quoted, r.reply_to, r.root_turn, r.depth) for r in quotes.link_quotes(df).collect()}
    assert got == {
        ("c", 0): ("How are you?\nTell me.", 0, None, 0, 0),
        ("c", 1): ("Fine.", 1, 0, 0, 1),
        ("c", 2): ("Good", 2, 1, 0, 2),
        ("c", 3): ("I did", 1, 0, 0, 1),
        ("c", 4): ("> never said\nhm", 1, None, 4, 0),
        ("d", 0): ("> Fine.\nother talk", 1, None, 0, 0),
        ("d", 1): ("", 0, None, 1, 0),
        ("d", None): ("> other talk\nlost", 1, None, None, 0),
    }
    assert quotes.link_quotes(df.limit(0)).count() == 0


def test_quotes_of_nobody_stay(spark):
    """Code that > opens, short words that nobody said alone, and quotations of later turns are content."""
    mail = [
        ("c", 0, "a", "Thanks for all of it, and thanks again.\nSee you on Monday morning at ten."),
        ("c", 1, "b", ">>> import os\n>>> os.getcwd()\nTry this."),
        ("c", 2, "a", "> thanks\nwelcome"),
        ("c", 3, "b", "> said much later than this message was\nno"),
        ("c", 4, "a", "said much later than this message was"),
        ("c", 5, "b", "On Mon, 1 May 2024 at 10:00 Ann Lee\n<ann@x.org> wrote:\n\n> See you on\n> Monday morning at ten.\n\nYes. She wrote:\nnothing"),
        ("c", 6, "b", "He said:\n> not in here at all\nend"),
    ]
    df = spark.createDataFrame(mail, "conv_id string, turn int, role string, text string")
    got = {r.turn: (r.text, r.reply_to) for r in quotes.link_quotes(df).collect()}
    assert got == {t: (text, None) for _, t, _, text in mail if t != 5} | {5: ("Yes. She wrote:\nnothing", 0)}


def test_random_threads(spark):
    """Messages that quote earlier ones whole or by sentences, in lines of any width, nested and beside quotations of
    nobody, under lines that name authors: what they say themselves and whom they answer is known from how they are made."""
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("bdfgklmnprst") + rnd.choice("aeiouäé") for _ in range(rnd.randint(1, 3)))
    sentence = lambda n: " ".join(word() for _ in range(n)).capitalize() + rnd.choice(".!?")

    def wrapped(text, mark):
        width, lines = rnd.randint(15, 90), [""]
        for w in text.split():
            if lines[-1] and len(lines[-1]) + len(w) >= width:
                lines.append("")
            lines[-1] = f"{lines[-1]} {w}".strip()
        return "\n".join(f"{mark}{rnd.choice(['', ' '])}{x}" for x in lines)

    rows, want, own = [], {}, {}
    for c in range(12):
        for t in range(rnd.randint(2, 14)):
            said = "\n".join(" ".join(sentence(rnd.randint(5, 20)) for _ in range(rnd.randint(1, 4))) for _ in range(rnd.randint(1, 3)))
            text, shown, reply = said, said, None
            if t and rnd.random() < 0.8:
                up = rnd.randrange(t)
                body = own[c, up] if rnd.random() < 0.6 else rnd.choice(re.split(r"(?<=[.!?])\s", own[c, up]))
                nested = wrapped(own[c, rnd.randrange(t)], ">>") + "\n" if rnd.random() < 0.4 else ""
                head = rnd.choice(["", "Ann Lee wrote:\n", "On Mon, 1 May, Ann Lee\n<a@b.org> wrote:\n\n", "Am Montag schrieb X:\n"])
                text, reply = f"{head}{wrapped(body.swapcase(), '>')}\n{nested}{said}", up
            elif rnd.random() < 0.5:
                text = shown = f"{wrapped(sentence(rnd.randint(1, 30)), '>')}\n{said}"
            own[c, t] = said
            rows.append((c, t, "r", text))
            want[c, t] = (shown.strip(), reply)
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string").repartition(5)
    assert {(r.conv_id, r.turn): (r.text, r.reply_to) for r in quotes.link_quotes(df).collect()} == want


def test_quoted_mail_is_its_sql(spark):
    rows = [(c, t, "user", f"line {t} of {c}\n" + " ".join(f"w{t}.{k}" for k in range(t * 7)) + "x" * (t * 20)) for c in range(3) for t in range(9)] + [(5, 0, "a", None), (5, 1, "b", "one"), (5, 2, None, " two\n")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    conversations = df.toPandas()
    con = duckdb.connect()
    con.register("conversations", conversations)
    mine = quotes.link_quotes(quotes.quoted_mail(df))
    key = lambda rows: sorted(tuple(None if v != v else v for v in r) for r in rows)
    assert key(map(tuple, mine.collect())) == key(con.sql(quotes.ORACLE).fetchall())


def test_quoted_mail_round_trip(spark):
    """Unquoting the mail made of a table gives the table's texts, each replying to the turn that it quotes."""
    rows = [("c", t, "user", f"line {t}\nmore of {t}") for t in range(12)]
    df = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    got = {r.turn: r for r in quotes.link_quotes(quotes.quoted_mail(df)).collect()}
    for _, t, _, text in rows:
        assert got[t].text == text
        assert got[t].reply_to == (None if t == 0 else t - 2 if t % 3 == 0 else t - 1)
        assert got[t].root_turn == 0


def test_long_and_short_chains_end_at_their_starts(spark):
    """A chain of 70 replies beside short ones: roots and depths are those of a walk up the chain."""
    rows = [("long", t, "user", f"> said {t - 1}\nsaid {t}") for t in range(71)]
    rows += [(f"c{n}", t, "user", f"> said {t - 1}\nsaid {t}") for n in range(9) for t in range(n % 4 + 1)]
    df = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    got = {(r.conv_id, r.turn): (r.reply_to, r.root_turn, r.depth) for r in quotes.link_quotes(df).collect()}
    assert got == {(c, t): (t - 1 if t else None, 0, t) for c, t, _, _ in rows}
