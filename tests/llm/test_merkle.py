"""The manifest against trees that plain Python builds."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from driftline.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def enc(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(doc_id, text, lang, source, n_chars):
    return sha(*map(enc, (doc_id, source, lang, n_chars, text)))


def climb(nodes, at, fan):
    """The root over nodes, and the siblings before and after the node `at` on its way."""
    way = []
    while len(nodes) > 1:
        run = at // fan * fan
        way.append(("".join(nodes[run:at]), "".join(nodes[at + 1 : run + fan])))
        nodes, at = [sha(*nodes[i : i + fan]) for i in range(0, len(nodes), fan)], at // fan
    return nodes[0], way


def slow_manifest(rows, fan=2):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = lambda r: (r[0] is not None, r[0] or 0, leaf_of(*r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: [leaf_of(*r) for r in sorted(groups[g], key=order)] for g in names}
    subs = [climb(trees[g], 0, fan)[0] for g in names]
    out = []
    for k, g in enumerate(names):
        for i, r in enumerate(sorted(groups[g], key=order)):
            (sub, low), (root, high) = climb(trees[g], i, fan), climb(subs, k, fan)
            hit = r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            node = leaf_of(*r[:4], r[4] + 1) if hit else trees[g][i]
            for a, b in low + high:
                node = sha(a, node, b)
            out.append((r[0], trees[g][i], sub, root, sha(*[a + b for a, b in low + high]), node, node == root))
    return out


def rows_of(n, seed=5):
    rnd = random.Random(seed)
    langs = ["en"] * 6 + ["de", "", "-", None, "é", "zz"]
    rows = [(k, rnd.choice(["", "a b", "Grüße", None, "x" * 5000]), rnd.choice(langs), rnd.choice(["s", None]), rnd.choice([None, k, 12345])) for k in range(n)]
    return rows + [(None, "t", "en", None, 3), (None, None, None, None, None), rows[3], rows[3]]


@pytest.mark.parametrize(("fan", "levels"), [(2, 10), (2, 2), (3, 1)])
def test_small_and_many_blocks_give_the_tree_of_plain_python(spark, fan, levels):
    rows = rows_of(300)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    size = F.col("n_chars").cast("decimal(38,0)")
    hit = F.col("doc_id").isNotNull() & F.col("n_chars").isNotNull() & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0)
    make = lambda n: merkle.leaf(F.col("doc_id"), F.col("source"), F.col("lang"), n, F.col("text"))
    got = merkle.manifest(docs.select("doc_id", "lang", make(size).alias("leaf"), F.when(hit, make(size + 1)).alias("version")), "lang", ["doc_id"], fan, levels)
    got = [tuple(r) for r in got.select("doc_id", "leaf", "subroot", "root", "proof", "folded_root", "verified").collect()]
    want = slow_manifest(rows, fan)
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert 0 < sum(not w[-1] for w in want) < len(want) / 4


def test_document_manifest_with_clashing_columns_one_row_and_none(spark):
    rows = rows_of(60, seed=8)
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS leaf", "2 AS g", "3 AS pos", "4 AS node", "5 AS root")
    got = merkle.document_manifest(docs)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, slow_manifest(rows)))
    one = merkle.document_manifest(docs.filter("doc_id = 1")).first()
    assert one.leaf == one.subroot == one.root == one.folded_root and one.proof_sha256 == sha()
    assert merkle.document_manifest(docs.limit(0)).count() == 0
