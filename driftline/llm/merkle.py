"""Merkle manifest of a dataset: a hash tree a group, a tree over the groups' roots, proofs, and versions of tampered rows.

Nodes are dealt to aligned blocks of BLOCK consecutive ones, which a task hashes on its own: BLOCK is a power of the
tree's fan, so a full block has one node on top, and what stands above blocks is a smaller table of nodes that is treated
in the same way. Going down again, each block gets the steps from its top to the root, as they are the same for all its
rows. A row's version is a copied path: its new leaf, new ancestors within its block and above it, all other nodes (the
siblings on the way) being those of the original tree. No task holds more than a block, however large a group is.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.operators.ranks import positions

from .common import bucket, keep

#: Children of a node.
FAN = 2
#: Levels within a block; a block has FAN ** LEVELS nodes at most.
LEVELS = 10

#: The steps from a node to a root: at each level the digests of the siblings before and after the node, concatenated.
PATH = "array<struct<before:string,after:string>>"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    """A field as part of a leaf's input: `-` if null, else its bytes' number, a colon and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def heights(n: int, fan: int) -> int:
    """Levels above n nodes."""
    level = 0
    while n > 1:
        n, level = -(-n // fan), level + 1
    return level


def grow(nodes: list[str], levels: int, fan: int) -> list[list[str]]:
    """All levels over nodes: each run of `fan` consecutive ones becomes the digest of them, the last run too."""
    out = [nodes]
    for _ in range(levels):
        below = out[-1]
        out.append([digest("".join(below[i : i + fan])) for i in range(0, len(below), fan)])
    return out


def path_of(levels: list[list[str]], at: int, fan: int) -> list[tuple[str, str]]:
    """Siblings before and after the node `at` of the lowest level and its ancestors, up to the top."""
    path = []
    for below in levels[:-1]:
        run = at - at % fan
        path.append(("".join(below[run:at]), "".join(below[at + 1 : run + fan])))
        at //= fan
    return path


def fold(node: str, path: list[tuple[str, str]]) -> str:
    """The root of the version in which `node` stands at the path's foot: its ancestors are new, the siblings shared."""
    for before, after in path:
        node = digest(before + node + after)
    return node


def _tree(rows: pa.Table, fan: int, levels: int) -> tuple[list[int], list[list[str]]]:
    """The rows of a block (pos, n, node) by position, and the block's levels; a group of one block ends where one node is."""
    at, node = rows.column("pos").to_pylist(), rows.column("node").to_pylist()
    turn = sorted(range(len(at)), key=at.__getitem__)
    return turn, grow([node[k] for k in turn], min(levels, heights(rows.column("n")[0].as_py(), fan)), fan)


def _blocks(nodes: DataFrame, block: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"pos div {block}"))


def tops(nodes: DataFrame, fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """(g, pos, n, node): the top nodes of the blocks of nodes (g, pos from 0, n nodes in g, node), which are nodes again."""
    block = fan**levels

    def top(rows: pa.Table) -> pa.Table:
        _, tree = _tree(rows, fan, levels)
        return pa.table({"g": rows.column("g")[:1], "pos": rows.column("block")[:1], "n": pa.array([-(-rows.column("n")[0].as_py() // block)], pa.int64()), "node": tree[-1]})

    return _blocks(nodes.select("g", "pos", "n", "node"), block).groupBy("g", "block").applyInArrow(top, "g string, pos long, n long, node string")


def paths(nodes: DataFrame, fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """(g, pos, path, root) for nodes (g, pos from 0, n nodes in g, node): each node's path to the root of its g.

    A level of blocks at a time: the driver goes through as many as the logarithm of the largest g to the base of a block.
    """
    above = keep(tops(nodes, fan, levels))
    if above.filter("n > 1").isEmpty():
        up = above.select("g", "pos", F.array().cast(PATH).alias("path"), F.col("node").alias("root"))
    else:
        up = paths(above, fan, levels)

    def inner(rows: pa.Table, over: pa.Table) -> pa.Table:
        turn, tree = _tree(rows, fan, levels)
        rest, root = over.column("path")[0].as_py(), over.column("root")[0].as_py()
        steps = [[{"before": b, "after": a} for b, a in path_of(tree, i, fan)] + rest for i in range(len(turn))]
        kind = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
        return pa.table({"g": rows.column("g"), "pos": rows.column("pos").take(pa.array(turn)), "path": pa.array(steps, kind), "root": [root] * len(turn)})

    low = _blocks(nodes.select("g", "pos", "n", "node"), fan**levels).groupBy("g", "block")
    return low.cogroup(up.groupBy("g", "pos")).applyInArrow(inner, f"g string, pos long, path {PATH}, root string")


def manifest(rows: DataFrame, group: str, order: list[str], fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """The columns of rows (which holds leaf: a digest, and version: the leaf after tampering, or null) with subroot, root,
    proof (the digest of all siblings from leaf to root), folded_root (of the version, else of the leaf) and verified.

    Leaves of a group are ascending by `order`, nulls first; groups ascend by their names as text, null first, bytewise.
    Rows equal in group and order are all leaves, ordered by their digests. One row in one group has no siblings, and its
    leaf is the root. An empty table gives an empty result.
    """
    name = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-"))
    named = rows.withColumn("g", name)
    placed = keep(positions(named, [F.col(c).asc_nulls_first() for c in [*order, "leaf"]], ["g"], "pos", "n").withColumn("node", F.col("leaf")))
    in_group = keep(paths(tops(placed, fan, levels), fan, levels))
    subroots = positions(in_group.filter("pos = 0").select(F.col("g").alias("of"), F.col("root").alias("subroot")), [F.col("of")], None, "pos", "n")
    subroots = keep(subroots.select(F.lit("").alias("g"), "of", "pos", "n", "subroot", F.col("subroot").alias("node")))
    over = paths(subroots, fan, levels).select("pos", F.col("path").alias("over"), F.col("root").alias("whole"))
    over = subroots.select("of", "subroot", "pos").join(over, "pos").drop("pos")
    up = in_group.join(over, F.col("g") == F.col("of")).select("g", "pos", "subroot", F.col("whole").alias("root"), F.concat("path", "over").alias("path"))
    names = rows.columns

    def settle(leaves: pa.Table, above: pa.Table) -> pa.Table:
        turn, tree = _tree(leaves, fan, levels)
        leaf, version = leaves.column("leaf").to_pylist(), leaves.column("version").to_pylist()
        rest = [(s["before"], s["after"]) for s in above.column("path")[0].as_py()]
        proof, folded = [""] * len(turn), [""] * len(turn)
        for i, k in enumerate(turn):
            path = path_of(tree, i, fan) + rest
            proof[k] = digest("".join(b + a for b, a in path))
            folded[k] = fold(leaf[k] if version[k] is None else version[k], path)
        new = {c: [above.column(c)[0].as_py()] * len(turn) for c in ("subroot", "root")} | {"proof": proof, "folded_root": folded}
        return pa.table({c: leaves.column(c) for c in names} | new)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    low = _blocks(placed, fan**levels).groupBy("g", "block")
    done = low.cogroup(up.groupBy("g", "pos")).applyInArrow(settle, f"{schema}, subroot string, root string, proof string, folded_root string")
    return done.withColumn("verified", F.col("folded_root") == F.col("root"))


def document_manifest(docs: DataFrame, tampered: int = 7) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) for each row of docs.

    A leaf is the digest of doc_id, source, lang, n_chars and text. Rows whose id's crc32 `tampered` divides count as
    tampered with: n_chars is one more, and a null stays one. Groups are languages; null is one. Null ids come first and
    are not tampered with; repeated rows are a leaf each; whole texts are hashed where they are read and only digests are
    dealt. Other columns are not read. An empty table gives an empty result.
    """
    size = F.col("n_chars").cast("decimal(38,0)")
    of = lambda n: leaf(F.col("doc_id"), F.col("source"), F.col("lang"), n, F.col("text"))
    hit = (bucket(F.col("doc_id"), tampered) == 0) & F.col("n_chars").isNotNull() & F.col("doc_id").isNotNull()
    rows = docs.select("doc_id", "lang", of(size).alias("leaf"), F.when(hit, of(size + 1)).alias("version"))
    out = manifest(rows, "lang", ["doc_id"])
    return out.select("doc_id", "leaf", "subroot", "root", F.col("proof").alias("proof_sha256"), "folded_root", "verified")


def oracle(levels: int = 34, tampered: int = 7) -> str:
    """DuckDB SQL for document_manifest() over documents, for up to two to the `levels` leaves a language."""
    put = lambda v: f"coalesce(concat(strlen(CAST({v} AS VARCHAR)), ':', CAST({v} AS VARCHAR)), '-')"
    row = lambda n: f"sha256(concat({put('doc_id')}, {put('source')}, {put('lang')}, {put(n)}, {put('text')}))"
    crc = "xor(list_reduce(list_prepend(4294967295, [ord(c) for c in string_split(CAST(doc_id AS VARCHAR), '')]), lambda s, b: list_reduce([xor(s, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295)"
    parts = [
        f"d AS (SELECT doc_id, coalesce('=' || lang, '-') AS g, {row('n_chars')} AS leaf, CASE WHEN {crc} % {tampered} = 0 AND n_chars IS NOT NULL THEN {row('n_chars + 1')} END AS version FROM documents)",
        "d0 AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d)",
        "t0 AS (SELECT g, pos AS p, leaf AS node, count(*) OVER (PARTITION BY g) AS n FROM d0)",
        "f0 AS (SELECT doc_id, g, pos, leaf, coalesce(version, leaf) AS fold, '' AS proof FROM d0)",
    ]

    def rise(t: str, f: str) -> None:
        """Levels of trees t, each a table of nodes, and of folds f beside them."""
        for k in range(levels):
            a, b = f"{t}{k}", f"{t}{k + 1}"
            parts.append(f"{b} AS (SELECT g, p // 2 AS p, CASE WHEN any_value(n) = 1 THEN any_value(node) ELSE sha256(string_agg(node, '' ORDER BY p)) END AS node, (any_value(n) + 1) // 2 AS n FROM {a} GROUP BY g, p // 2)")
            parts.append(
                f"{f}{k + 1} AS (SELECT x.* EXCLUDE (pos, fold, proof), x.pos // 2 AS pos, CASE WHEN o.n = 1 THEN x.fold WHEN x.pos % 2 = 0 THEN sha256(concat(x.fold, s.node)) ELSE sha256(concat(s.node, x.fold)) END AS fold, concat(x.proof, s.node) AS proof "
                f"FROM {f}{k} x JOIN {a} o ON o.g = x.g AND o.p = x.pos LEFT JOIN {a} s ON s.g = x.g AND s.p = xor(x.pos, 1))"
            )

    rise("t", "f")
    parts += [
        f"r AS (SELECT g AS name, node AS subroot, row_number() OVER (ORDER BY encode(g)) - 1 AS q FROM t{levels})",
        "u0 AS (SELECT '' AS g, q AS p, subroot AS node, count(*) OVER () AS n FROM r)",
        f"v0 AS (SELECT doc_id, '' AS g, q AS pos, leaf, subroot, fold, proof FROM f{levels} JOIN r ON r.name = f{levels}.g)",
    ]
    rise("u", "v")
    last = f"SELECT doc_id, leaf, subroot, node AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = node AS verified FROM v{levels} JOIN u{levels} ON true"
    return f"WITH {', '.join(parts)} {last}"


#: For up to 4,096 rows a language and as many languages.
ORACLE = oracle(12)
