"""Approximate nearest neighbours by inner product: multi-index hashing of learned rotated binary codes.

Vectors get one more component that brings all of them to the largest length (queries get a zero), so that nearness in
angle is nearness by inner product. Rotations that are learned from a bounded sample turn them before their signs are
taken, so that signs lose little; a code has BITS bits. A code is cut into substrings of SUBSTRING bits, and the rows of a
shard are indexed by each of them. Two codes that differ in r bits or fewer agree to within r // (number of substrings)
bits in one substring at least, so probing each index at all values that near retrieves every code within the radius; the
codes are then compared whole and the vectors of those within the radius by their exact inner products.

The radius is learned as well: a bounded number of queries is compared with all rows, and the radius takes in REACH of the
codes of their true neighbours. Queries meet rows in cells of a block of queries and a shard of rows, both of bounded
size, so no task grows with the data; there is no cap on what a query retrieves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import keep

#: Bits of a code, at least, and of a substring.
BITS, SUBSTRING = 256, 16
#: Rows that the rotations are learned from, rounds of learning, and queries that the radius is learned from.
SAMPLE, ROUNDS, TRIED = 10_000, 20, 256
#: Share of the true neighbours of the queries tried that the radius takes in.
REACH = 0.97
#: Rows of a shard and queries of a block, about.
SHARD, BLOCK = 8192, 4096
#: Differing bits of each pair of substrings, by their exclusive or.
_ONES = np.bitwise_count(np.arange(1 << SUBSTRING, dtype=np.uint32)).astype(np.uint8)


@dataclass
class Coder:
    """Rotations of vectors with one more component; length is the largest one's."""

    rotations: list[np.ndarray]
    length: float

    def code(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        """Codes as rows of substrings (uint16)."""
        rest = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.length**2 - (x * x).sum(axis=1), 0))
        whole = np.column_stack([x, rest])
        signs = np.concatenate([whole @ r > 0 for r in self.rotations], axis=1)
        return np.packbits(signs[:, : signs.shape[1] // SUBSTRING * SUBSTRING], axis=1).view(np.uint16)


def learn(sample: np.ndarray, length: float, bits: int = BITS, rounds: int = ROUNDS, seed: int = 7) -> Coder:
    """Rotations under which the signs of the sample's vectors are near the vectors themselves: each starts at random and
    alternates between the signs and the rotation that is best for them. A sample of no rows leaves them random."""
    rng, width = np.random.default_rng(seed), sample.shape[1] + 1
    x = np.column_stack([sample, np.sqrt(np.maximum(length**2 - (sample * sample).sum(axis=1), 0))])
    rotations = []
    for _ in range(math.ceil(max(bits, SUBSTRING) / width)):
        r = np.linalg.qr(rng.normal(size=(width, width)))[0]
        for _ in range(rounds if len(x) else 0):
            u, _, v = np.linalg.svd(x.T @ np.where(x @ r > 0, 1.0, -1.0))
            r = u @ v
        rotations.append(r)
    return Coder(rotations, length)


def _distances(codes: np.ndarray, code: np.ndarray) -> np.ndarray:
    return _ONES[codes ^ code].sum(axis=1, dtype=np.int32)


class Index:
    """Codes of a shard by each of their substrings: for each, its values, and the rows in their order."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes, self.tables = codes, []
        for column in codes.T:
            order = np.argsort(column, kind="stable")
            values, starts, sizes = np.unique(column[order], return_index=True, return_counts=True)
            self.tables.append((values, starts, sizes, order))

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Numbers of all codes within the radius of code, ascending.

        radius = each * substrings + more: if the first more + 1 substrings all differed in over `each` bits and the others
        in `each` at least, the codes would differ in over the radius; so the others are probed one bit less far.
        """
        each, more = divmod(radius, len(self.tables))
        found = np.zeros(len(self.codes), bool)
        for k, (values, starts, sizes, order) in enumerate(self.tables):
            hit = _ONES[values ^ code[k]] <= (each if k <= more else each - 1)
            start, size = starts[hit], sizes[hit]
            if size.size:
                ends = np.cumsum(size)
                found[order[np.arange(ends[-1]) + np.repeat(start - ends + size, size)]] = True
        at = np.nonzero(found)[0]
        return at[_distances(self.codes[at], code) <= radius]


def best(ids: np.ndarray, vectors: np.ndarray, own: int, query: np.ndarray, k: int) -> list[tuple[float, int]]:
    """The k nearest of the vectors, without the query's own id: (score, id), nearest first. Scores are sums without
    rounding between the terms, so equal vectors have equal ones."""
    other = np.nonzero(ids != own)[0]
    rough = (vectors[other] * query).sum(axis=1)
    if len(other) > k:
        edge = np.partition(rough, len(rough) - k)[len(rough) - k]
        slack = 1e-9 * float(np.abs(query) @ np.abs(vectors[other]).max(axis=0))
        other = other[rough >= edge - slack]
    exact = [(math.fsum((vectors[i] * query).tolist()), int(ids[i])) for i in other]
    return sorted(exact, key=lambda x: (-x[0], x[1]))[:k]


def vectors_of(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) for the rows that take part: with an id, finite components and a length that is not zero; once each."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.col(id_col).isNotNull() & v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return rows.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).filter(fine).distinct()


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def radius_of(rows: DataFrame, coder: Coder, tried: np.ndarray, tried_ids: np.ndarray, k: int, reach: float) -> int:
    """The radius within which a share of `reach` of the true neighbours of the queries tried lie, over all rows.

    Each task keeps the k nearest of its rows for each of them; the driver gets the k nearest of all and their distances.
    """
    shared = rows.sparkSession.sparkContext.broadcast((coder, tried, tried_ids))  # TRIED vectors and the rotations

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, queries, own = shared.value
        codes, top = coder.code(queries, query=True), [[] for _ in own]
        for b in batches:
            ids, x = b.column(0).to_numpy(), _matrix(b.column(1), queries.shape[1])
            scores, mine = queries @ x.T, coder.code(x)
            scores[own[:, None] == ids[None, :]] = -np.inf
            for q in range(len(own)):
                at = np.argpartition(-scores[q], k)[:k] if len(ids) > k else np.arange(len(ids))
                near = zip(scores[q][at].tolist(), _distances(mine[at], codes[q]).tolist(), strict=True)
                top[q] = sorted([*top[q], *(n for n in near if n[0] > -np.inf)], reverse=True)[:k]
        found = [(q, s, d) for q, t in enumerate(top) for s, d in t]
        yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in found], t) for j, t in enumerate((pa.int32(), pa.float64(), pa.int32()))], ["q", "score", "d"])

    near = rows.mapInArrow(run, "q int, score double, d int")
    near = near.withColumn("n", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score")))).filter(F.col("n") <= k)
    return near.agg(F.coalesce(F.expr(f"percentile_disc({reach}) within group (order by d)"), F.lit(0)).cast("int")).first()[0]


def _met(queries: DataFrame, asked: int, rows: DataFrame, n: int, coded: Broadcast, radius: int | None, k: int, shard: int, block: int) -> DataFrame:
    """(query_id, which, rank, vec_id, score): the k nearest to each of `asked` queries among the rows within the radius, or among
    all n rows; which tells queries of one id apart. Every block of queries meets every shard of rows, each pair of them in a cell of its own."""
    shards, blocks = math.ceil(n / shard), math.ceil(asked / block)
    spread = lambda parts: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))
    left = queries.select("id", "v", F.xxhash64("v").alias("which"), F.pmod(F.xxhash64("v", "id"), F.lit(blocks)).alias("b"), spread(shards).alias("s"))
    right = rows.select("id", "v", F.pmod(F.xxhash64("id", "v"), F.lit(shards)).alias("s"), spread(blocks).alias("b"))

    def cell(asked: pa.Table, rows: pa.Table) -> pa.Table:
        own, which, ids, found = asked.column("id").to_numpy(), asked.column("which").to_pylist(), rows.column("id").to_numpy(), []
        if len(own) and len(ids):
            coder = coded.value
            width = coder.rotations[0].shape[0] - 1
            q, x = _matrix(asked.column("v"), width), _matrix(rows.column("v"), width)
            index, codes = Index(coder.code(x)), coder.code(q, query=True)
            for one, its, vector, code in zip(own.tolist(), which, q, codes, strict=True):
                at = slice(None) if radius is None else index.within(code, radius)
                found += [(one, its, i, s) for s, i in best(ids[at], x[at], one, vector, k)]
        kinds = {"query_id": pa.int64(), "which": pa.int64(), "vec_id": pa.int64(), "score": pa.float64()}
        return pa.table({c: pa.array([f[j] for f in found], t) for j, (c, t) in enumerate(kinds.items())})

    near = left.groupBy("b", "s").cogroup(right.groupBy("b", "s")).applyInArrow(cell, "query_id long, which long, vec_id long, score double")
    nearest = Window.partitionBy("query_id", "which").orderBy(F.desc("score"), "vec_id")
    return near.select("query_id", "which", F.row_number().over(nearest).alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)


def search(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 20, k: int = 20, bits: int = BITS, reach: float = REACH, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id `every` divides the k nearest found among the others.

    score: the inner product of the vectors in double precision; nearest first, ties to the smaller id. Rows whose vector
    is null, zero or holds a null or non-finite component, and rows without an id, take no part; vectors of another width
    than the first id's raise a ValueError. Rows that repeat id and vector count once. A row of the query's id is its own;
    rows of one id with other vectors are queries each.
    Where fewer than k lie within the radius, as where there are few rows, the query is compared with all rows. Other
    columns are not read; an empty table gives an empty result.
    """
    schema = "query_id long, rank int, vec_id long, score double"
    spark = rows.sparkSession
    all_rows = keep(vectors_of(rows, id_col, vector_col))
    length2 = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    n, low, high, longest, asked = all_rows.agg(F.count("*"), F.min(F.size("v")), F.max(F.size("v")), F.max(length2), F.count_if(F.col("id") % every == 0)).first()
    if not n or not asked:
        return spark.createDataFrame([], schema)
    if low != high:
        raise ValueError(f"vectors have from {low} to {high} components")
    order = [F.xxhash64("id", "v"), F.col("id")]
    sample = all_rows.orderBy(*order).limit(SAMPLE).select("id", "v").toArrow()
    tried = all_rows.filter(F.col("id") % every == 0).orderBy(*order).limit(TRIED).toArrow()
    coder = learn(_matrix(sample.column("v"), low), math.sqrt(longest), bits)
    radius = radius_of(all_rows, coder, _matrix(tried.column("v"), low), tried.column("id").to_numpy(), k, reach)
    coded = spark.sparkContext.broadcast(coder)
    queries = all_rows.filter(F.col("id") % every == 0)
    near = keep(_met(queries, asked, all_rows, n, coded, radius, k, shard, block))
    enough = near.groupBy("query_id", "which").count().filter(F.col("count") >= k)
    short = keep(queries.select("*", F.col("id").alias("query_id"), F.xxhash64("v").alias("which")).join(enough, ["query_id", "which"], "left_anti"))
    if left := short.count():
        near = near.join(short, ["query_id", "which"], "left_anti").union(_met(short, left, all_rows, n, coded, None, k, shard, block))
    return near.select("query_id", "rank", "vec_id", "score")
