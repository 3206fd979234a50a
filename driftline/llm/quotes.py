"""Quotation linking: messages that quote others become reply-ordered conversations without quotes.

A message's lines are parsed into quote levels (the leading > marks); lines of one level that follow each other are a
passage. Passages are compared as folded words, so line breaks and case do not matter: a long one by hashes of word windows,
of which winnowing picks those that any common stretch shares, a short one whole. What a passage quotes is the earlier
message of its conversation whose own words have most of its hashes. Passages that link go from the text, with the line
that names their author; others stay. Replies point to earlier messages, and pointer jumping finds each thread's root.
DataFrame functions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import keep

#: Quote marks that open a line: any number of >, with spaces between.
OPENING = r"^[ \t]*(?:>[ \t]*)+"
#: Words in a window, and windows in a row of which the least hash is taken: stretches of SHORT words always share one.
GRAM, SPAN = 5, 8
SHORT = GRAM + SPAN - 1
#: How a line ends that says whose words follow, and how one begins that is broken before its end.
WROTE = ("wrote", "writes", "said", "schrieb", "a écrit", "escribió")
WHEN = ("On", "Am", "Le", "El")
ATTRIBUTION = rf"(?i)(?:^|\n)(?:(?:{'|'.join(WHEN)}) [^\n]*\n)?[^\n]*(?<![\p{{L}}])(?:{'|'.join(WROTE)})(?: [^\n:]*)?[ \t]*:\s*\z"


def quote_level(line: Column) -> Column:
    """How many > open the line."""
    return F.char_length(F.regexp_replace(F.regexp_extract(line, OPENING, 0), "[ \t]", ""))


#: A line of quoted_mail(), without the space that ends it.
LINE = r"(.{1,70}|\S+)(?: |$)"


def normal(line: Column) -> Column:
    """The line without quote marks, in lower case, white space folded."""
    return F.btrim(F.regexp_replace(F.lower(F.regexp_replace(line, OPENING, "")), r"\s+", " "))


def let(value: Column, use) -> Column:
    """use(value), with value computed once a row: a column that a function of elements names may be put in its place by
    the optimiser, and is then computed for each element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def parsed(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, key, runs) from (conv, turn, role, text): runs of lines of one level, struct(level, lines). key
    tells apart the texts of a message."""

    def runs(lines: Column, levels: Column, first: Column) -> Column:
        return F.transform(first, lambda i, k: F.struct(F.get(levels, i).alias("level"), F.slice(lines, i + 1, F.coalesce(F.get(first, k + 1), F.size(lines)) - i).alias("lines")))

    def cut(lines: Column, levels: Column) -> Column:
        first = F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: (i == 0) | (F.get(levels, i) != F.get(levels, i - 1)))
        return let(first, lambda at: runs(lines, levels, at))

    found = let(F.split("text", "\n"), lambda lines: let(F.transform(lines, quote_level), lambda levels: cut(lines, levels)))
    return rows.select("conv", "turn", "role", F.xxhash64("text").alias("key"), found.alias("runs"))


def _hashes(passages: DataFrame) -> DataFrame:
    """passages (with level, lines) with size, their words, and hashes, under which they are looked up.

    Long passages: the least of each SPAN hashes of word windows in a row. Short ones: the whole. Own words (level 0) are
    also there by the short lines and sentences in them, short quotations also by their lines."""
    whole = lambda words: F.xxhash64(F.lit("whole"), words)
    none = F.array().cast("array<bigint>")
    count = lambda x: F.size(F.split(x, " "))
    own = F.col("level") == 0

    def least(words: Column) -> Column:
        over = lambda x, n, use: F.transform(F.sequence(F.lit(0), F.size(x) - n), lambda i: use(*[F.get(x, i + k) for k in range(n)]))
        return let(F.transform(words, lambda x: F.xxhash64(x)), lambda h: let(over(h, GRAM, F.xxhash64), lambda w: over(w, SPAN, F.least)))

    def found(line: Column, body: Column, words: Column) -> Column:
        short = F.size(words) < SHORT
        lines = F.transform(F.filter(line, lambda x: count(x) < SHORT), whole)
        sentences = F.transform(F.filter(F.split(body, "(?<=[.!?]) "), lambda x: (count(x) < SHORT) & (count(x) >= GRAM)), whole)
        all_of = F.concat(F.when(short, F.array(whole(body))).otherwise(least(words)), F.when(own | short, lines).otherwise(none), F.when(own, sentences).otherwise(none))
        return F.struct(F.size(words).alias("size"), F.array_distinct(all_of).alias("hashes"))

    lines = F.filter(F.transform("lines", normal), lambda x: x != "")
    split = lambda line, body: let(F.split(body, " "), lambda words: found(line, body, words))
    hashed = passages.withColumn("x", let(lines, lambda line: F.when(F.size(line) > 0, let(F.array_join(line, " "), lambda body: split(line, body)))))
    return hashed.filter("x is not null").select(*passages.columns, "x.size", "x.hashes")


def linked(rows: DataFrame) -> DataFrame:
    """(conv, turn, key, run, level, size, source): the passages of parsed() rows that quote an earlier message.

    For each hash of a passage the latest earlier turn that has it in its own words is taken, by a running maximum over
    turns instead of pairs; the turn that most of them name is the source (of several the latest), if at least half of all
    name it."""
    passages = rows.filter("conv is not null and turn is not null").select("conv", "turn", "key", F.posexplode("runs").alias("run", "x"))
    hashed = _hashes(passages.select("conv", "turn", "key", "run", "x.level", "x.lines"))
    ref = F.struct("key", "run", "level", "size", F.size("hashes").alias("n"))
    said = hashed.select("conv", "turn", "level", "size", ref.alias("ref"), F.posexplode("hashes").alias("place", "hash"))
    weight = F.when((F.col("size") < SHORT) & (F.col("place") == 0), F.col("ref.n")).otherwise(1)  # a short passage whole is enough
    said = said.groupBy("conv", "hash", "turn").agg(F.max(F.when(F.col("level") == 0, F.col("turn"))).alias("own"), F.collect_set(F.when(F.col("level") > 0, F.struct("ref", weight.alias("weight")))).alias("refs"))
    before = Window.partitionBy("conv", "hash").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    found = said.withColumn("source", F.max("own").over(before)).filter("source is not null and size(refs) > 0")
    votes = found.select("conv", "turn", "source", F.explode("refs").alias("x")).groupBy("conv", "turn", F.col("x.ref").alias("r"), "source").agg(F.sum("x.weight").alias("m"))
    best = votes.groupBy("conv", "turn", "r").agg(F.max(F.struct("m", "source")).alias("b")).filter("2 * b.m >= r.n")
    return best.select("conv", "turn", "r.key", "r.run", "r.level", "r.size", "b.source")


def link_quotes(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, n_quoted, reply_to, root_turn, depth) for each row of messages.

    text: the message without the passages that link and the line before each that names its author, trimmed; quotations
    of what no earlier message said stay as they are. n_quoted: its lines that > opens. reply_to: the source of its
    longest passage of level one that links, of several the first; null if there is none. root_turn and depth: the start of
    the message's chain of replies and its distance. Ordered by (conv_id, root_turn, turn) the rows are conversations in
    reply order.

    A message is known by conversation and turn; rows that repeat both are one message with several texts: each row is
    returned, all with the reply that their quotes together give. Null texts are empty; rows with null conversation or
    turn are returned without links, as their own roots. Other columns are not read; an empty table gives an empty result.

    Conversations of any length are spread by (conversation, hash), never gathered in one task. What many turns say is
    reduced to distinct (conversation, hash, turn) first.
    """
    rows = parsed(messages.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text")))
    links = keep(linked(rows))
    parents = keep(links.filter("level = 1").groupBy("conv", "turn").agg(F.min_by("source", F.struct((-F.col("size")).alias("size"), "run", "key")).alias("reply_to")))
    gone = links.groupBy("conv", "turn").agg(F.collect_list(F.struct("key", "run")).alias("gone"))
    known = gone.join(_roots(parents), ["conv", "turn"], "left")
    out = rows.join(known, ["conv", "turn"], "left")
    out = out.withColumn("gone", F.coalesce(F.transform(F.filter("gone", lambda x: x["key"] == F.col("key")), lambda x: x["run"]), F.array().cast("array<int>")))
    goes = lambda i: F.array_contains(F.col("gone"), i)
    body = lambda r: F.array_join(r["lines"], "\n")
    shown = F.transform("runs", lambda r, i: F.when(~goes(i), F.when((r["level"] == 0) & goes(i + 1), F.regexp_replace(body(r), ATTRIBUTION, "")).otherwise(body(r))))
    quoted = F.aggregate("runs", F.lit(0), lambda n, r: n + F.when(r["level"] > 0, F.size(r["lines"])).otherwise(0))
    return out.select(
        F.col("conv").alias(conv_col),
        F.col("turn").alias(turn_col),
        F.col("role").alias(role_col),
        F.btrim(F.array_join(F.filter(shown, lambda x: x.isNotNull()), "\n"), F.lit(" \n\r\t")).alias(text_col),
        quoted.cast("long").alias("n_quoted"),
        "reply_to",
        F.coalesce("root_turn", "turn").alias("root_turn"),
        F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
    )


def _roots(parents: DataFrame) -> DataFrame:
    """(conv, turn, reply_to, root_turn, depth) by pointer jumping: each round doubles what a pointer skips.

    A message whose pointer has reached the start of its chain is only looked up from then on; rounds go on with the
    others, so one long chain does not bring all messages back again and again.
    """
    walking = parents.select("conv", "turn", "reply_to", F.col("reply_to").alias("root_turn"), F.lit(1).cast("long").alias("depth"))
    there: list[DataFrame] = []
    while True:
        known = reduce(DataFrame.union, [d.withColumn("ended", F.lit(True)) for d in there], walking.withColumn("ended", F.lit(False)))
        ahead = known.select("conv", F.col("turn").alias("root_turn"), F.col("root_turn").alias("next"), F.col("depth").alias("more"), "ended")
        stepped = walking.join(ahead, ["conv", "root_turn"], "left")
        stepped = keep(stepped.select("conv", "turn", "reply_to", F.coalesce("next", "root_turn").alias("root_turn"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.coalesce("ended", F.lit(True)).alias("ended")))
        there.append(stepped.filter("ended").drop("ended"))
        walking = stepped.filter("not ended").drop("ended")
        if walking.isEmpty():
            return reduce(DataFrame.union, there)


def quoted_mail(conversations: DataFrame) -> DataFrame:
    """conversations as mail: from turn 1 on, each message quotes one before it whole, in lines of at most WIDTH characters
    (or one word), under a line that names its author.

    Every third turn quotes the one two before it (turn 1 has only turn 0), the others the one before; that message's own
    quotation follows, a level deeper. Messages are joined with their conversation's earlier ones by turn number.
    """
    base = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    back = lambda t: F.when((t % 3 == 0) & (t > 1), 2).otherwise(1)
    said = base.select("conv_id", F.col("turn").alias("up"), F.col("text").alias("up_text"), F.col("role").alias("up_role"))
    quoted = base.withColumn("up", F.col("turn") - back(F.col("turn"))).withColumn("up2", F.col("up") - back(F.col("up")))
    quoted = quoted.join(said, ["conv_id", "up"], "left").join(said.select("conv_id", F.col("up").alias("up2"), F.col("up_text").alias("up2_text")), ["conv_id", "up2"], "left")
    mark = lambda c, m: F.regexp_replace(F.btrim(F.regexp_replace(c, r"\s+", " ")), LINE, f"{m}$1\n")
    wrote = F.when(F.col("up_text") != "", F.concat(F.coalesce("up_role", F.lit("someone")), F.lit(" wrote:\n")))
    text = F.concat(F.coalesce(wrote, F.lit("")), F.coalesce(mark(F.col("up_text"), "> "), F.lit("")), F.coalesce(mark(F.col("up2_text"), "> > "), F.lit("")), "text")
    return quoted.select("conv_id", "turn", "role", text.alias("text"))


#: DuckDB SQL for link_quotes(quoted_mail()) over conversations: the texts come back, each a reply to what it quotes.
ORACLE = rf"""
WITH RECURSIVE c AS (SELECT conv_id, turn, role, coalesce(text, '') AS text, CASE WHEN turn % 3 = 0 AND turn > 1 THEN turn - 2 ELSE turn - 1 END AS up FROM conversations),
m AS (SELECT c.*, CASE WHEN u.text IS NOT NULL AND trim(regexp_replace(u.text, '\s+', ' ', 'g')) <> '' THEN c.up END AS reply_to,
  coalesce(len(regexp_extract_all(trim(regexp_replace(u.text, '\s+', ' ', 'g')), '{LINE}')), 0) + coalesce(len(regexp_extract_all(trim(regexp_replace(v.text, '\s+', ' ', 'g')), '{LINE}')), 0) AS n_quoted
  FROM c LEFT JOIN c u ON u.conv_id = c.conv_id AND u.turn = c.up LEFT JOIN c v ON v.conv_id = c.conv_id AND v.turn = u.up),
r AS (SELECT conv_id, turn, turn AS root_turn, CAST(0 AS BIGINT) AS depth FROM m WHERE reply_to IS NULL
  UNION ALL SELECT m.conv_id, m.turn, r.root_turn, r.depth + 1 FROM r JOIN m ON m.conv_id = r.conv_id AND m.reply_to = r.turn)
SELECT m.conv_id, m.turn, m.role, trim(m.text, E' \n\r\t') AS text, CAST(m.n_quoted AS BIGINT) AS n_quoted, m.reply_to, r.root_turn, r.depth
FROM m JOIN r ON r.conv_id = m.conv_id AND r.turn = m.turn"""
