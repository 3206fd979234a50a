"""Language-model scoring: a log-bilinear neural model, trained in numpy by noise-contrastive estimation.

The model predicts a token from the ones before it: each place before it has a diagonal matrix, the weighted vectors add
up to a prediction, and its products with the tokens' vectors, plus biases, are normalised in two steps (class, then
token within the class), so that every batch costs a few matrix products. The most frequent tokens and the end of a text
have vectors of their own. All others, of which there are more the more text there is, share vectors by how they end; a
token's share of such a bucket is that of its count, so the probability of every token depends on what is before it.

Counts cover all training tokens. Training covers all training texts, once: they are dealt to rounds by hash and to trainers in
turn, with about equal numbers of tokens, whatever files they come from. The trainers of a round start from the mean, by tokens, of
what those of the round before reached, parameters and step lengths alike.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bucket, keep

#: Most frequent tokens with vectors of their own, and buckets that the others share; fixed bounds on what is broadcast.
KNOWN, BUCKETS = 4094, 1024
#: Bytes at a token's end, punctuation left out, that tell its bucket.
ENDING = 3
#: Frequent tokens whose counts are broadcast for the base score; all others are joined.
FREQUENT = 65_536
#: Tokens before the predicted one, and the length of vectors.
PLACES, DIM = 3, 16
#: Noise samples for each batch, tokens in a batch, parts that the training texts are dealt to one after the other, first step.
NOISE, BATCH, ROUNDS, STEP = 64, 2048, 3, 0.1
#: Tokens that are mixed before they go into batches, so that a long text does not fill them alone.
MIXED = 1 << 18
#: Tokens whose products with a class of tokens are made at once.
AT_ONCE = 2048
#: Tokens of a round for each of its trainers, about.
SHARE = 1 << 20
#: Distinct tokens whose buckets a task remembers before it begins anew.
HELD = 200_000
#: Bytes of text whose tokens a task counts, and looks up, at once.
COUNTED, LOOKED_UP = 1 << 24, 1 << 22
#: Parameters in a row of a trainer's results.
WIDTH = 64
PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())


def parts_of(batch: pa.RecordBatch, at: int, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in parts of at most `most` bytes in column `at`, or of one row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy().astype(np.int64))
    a = 0
    while a < batch.num_rows:
        z = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + most, side="right")))
        yield batch.slice(a, z - a)
        a = z


def tokens(bodies: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Number of words of each UTF-8 text, and the words of all one after the other, with A-Z lower-cased. Only ASCII white
    space parts words; the ends are not among them. Arrow's functions go by bytes, so nothing is decoded."""
    bodies = pc.fill_null(bodies.cast(pa.binary()), b"")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pa.Array.from_buffers(pa.string(), len(bodies), bodies.buffers(), 0, bodies.offset)))
    words, text = lists.flatten(), np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    real = pc.binary_length(words).to_numpy() > 0  # white space at either end of a text leaves an empty one
    if not real.all():
        words, text = words.filter(pa.array(real)), text[real]
    return np.bincount(text, minlength=len(lists)), words.cast(pa.binary())


def count_tokens(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(token, n): token is binary, null for the end of texts."""
    schema = T.StructType([T.StructField("token", T.BinaryType()), T.StructField("n", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends = 0
        for b in batches:
            for part in parts_of(b, 0, COUNTED):
                found = pc.value_counts(tokens(part.column(0))[1])
                yield pa.RecordBatch.from_arrays([found.field(0), found.field(1)], schema.names)
            ends += b.num_rows
        if ends:
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.binary()), pa.array([ends], pa.int64())], schema.names)

    return docs.select(F.col(text_col).cast("binary").alias("body")).mapInArrow(run, schema).groupBy("token").agg(F.sum("n").alias("n"))


def most_frequent(counts: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """At most `most` (token, n) by falling n, then token: all tokens from the least count on that leaves no more.

    Counts are cut by a histogram in steps of a 64th of a doubling, so that the driver gets `most` rows at the most, from
    all tasks together, and no task sorts or sends a list of its own. Tokens of a step that does not fit stay out.
    """
    words = counts.filter("token is not null").withColumn("step", F.floor(F.log2("n") * 64))
    left, least = most, None
    for r in sorted(words.groupBy("step").count().collect(), key=lambda r: -r.step):
        left -= r["count"]
        if left < 0:
            break
        least = r.step
    rows = words.filter(F.col("step") >= least).collect() if least is not None else []
    return sorted(((bytes(r.token), r.n) for r in rows), key=lambda x: (-x[1], x[0]))


def bucket_of(token: bytes, buckets: int) -> int:
    return zlib.crc32((token.rstrip(PUNCTUATION) or token)[-ENDING:]) % buckets


class Buckets(dict):
    """The buckets of tokens, remembered up to HELD of them."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, token: bytes) -> int:
        if len(self) >= HELD:
            self.clear()
        self[token] = found = bucket_of(token, self.buckets)
        return found


def bucket_sums(counts: DataFrame, known: list[tuple[bytes, int]], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """For each bucket, the training tokens that are not known: how many, and how many distinct ones."""
    shared = counts.sparkSession.sparkContext.broadcast(frozenset(w for w, _ in known))
    schema = T.StructType([T.StructField(x, T.LongType()) for x in ("bucket", "n", "v")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, v = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for b in batches:
            pairs = [(bucket_of(w, buckets), c) for w, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) if w not in shared.value]
            if pairs:
                at, c = np.array(pairs, np.int64).T
                np.add.at(n, at, c)
                np.add.at(v, at, 1)
        at = np.nonzero(v)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at]), pa.array(v[at])], schema.names)

    found = counts.filter("token is not null").select("token", "n").mapInArrow(run, schema).groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).toPandas()
    n, v = np.zeros(buckets), np.zeros(buckets)
    n[found["bucket"].to_numpy(np.int64)], v[found["bucket"].to_numpy(np.int64)] = found["n"], found["v"]
    return n, v


@dataclass
class Model:
    """Token ids: 0 the end (also what stands before a text), then the buckets, then known tokens by falling count. classes:
    for each id; a class holds ids that follow each other."""

    noise: np.ndarray  # each id's share of the training tokens
    vectors: np.ndarray  # of tokens before
    places: np.ndarray  # a diagonal for each place
    targets: np.ndarray  # of predicted tokens
    bias: np.ndarray
    class_of: np.ndarray
    class_at: np.ndarray  # where each class begins in order, and the end
    class_vectors: np.ndarray
    class_bias: np.ndarray


def start(counts: np.ndarray, dim: int = DIM, places: int = PLACES, seed: int = 0) -> Model:
    """An untrained model that already predicts the ids' shares: small random vectors before, none after, biases from counts."""
    rng, n = np.random.default_rng(seed), len(counts)
    share = np.maximum(counts.astype(float), 0.5)
    share /= share.sum()
    size = max(1, round(n**0.5))
    class_of = (np.arange(n) // size).astype(np.int32)
    class_at = np.append(np.arange(0, n, size), n)
    mass = np.add.reduceat(share, class_at[:-1])
    none = lambda k: np.zeros((k, dim), np.float32)
    return Model(share, rng.normal(0, 0.1, (n, dim)).astype(np.float32), np.ones((places, dim), np.float32) / places, none(n), np.log(share).astype(np.float32), class_of, class_at, none(len(mass)), np.log(mass).astype(np.float32))


def contexts(ids: np.ndarray, places: int) -> np.ndarray:
    """(tokens, places) ids before each token of one text; before the text stands its end token, 0."""
    padded = np.concatenate([np.zeros(places, ids.dtype), ids])
    return np.lib.stride_tricks.sliding_window_view(padded, places)[: len(ids)]


def predictions(m: Model, before: np.ndarray) -> np.ndarray:
    return sum(m.vectors.take(before[:, p], axis=0) * d for p, d in enumerate(m.places))


def log_probabilities(m: Model, before: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Natural log-probabilities of the target ids, which over all ids sum to one."""
    hidden = predictions(m, before)
    cls = m.class_of[target]
    out = _log_softmax(m.class_vectors, m.class_bias, hidden, cls)
    order = _order(cls, len(m.class_at))
    cuts, hidden, target = np.searchsorted(cls[order], np.arange(len(m.class_at))), hidden.take(order, axis=0), target[order]
    within = np.empty_like(out)
    for c in np.nonzero(cuts[1:] > cuts[:-1])[0]:
        at, a, b = slice(cuts[c], cuts[c + 1]), m.class_at[c], m.class_at[c + 1]
        within[at] = _log_softmax(m.targets[a:b], m.bias[a:b], hidden[at], target[at] - a)
    out[order] += within
    return out


def _log_softmax(vectors: np.ndarray, bias: np.ndarray, hidden: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Log-probability of the chosen row of vectors for each row of hidden. Choices run down the columns, so that maxima
    and sums go along memory for many tokens at once, AT_ONCE of them, whose products stay in the processor's cache."""
    out = np.empty(len(chosen), np.float32)
    for a in range(0, len(chosen), AT_ONCE):
        own, part = chosen[a : a + AT_ONCE], out[a : a + AT_ONCE]
        logits = vectors @ hidden[a : a + AT_ONCE].T
        logits += bias[:, None]
        logits -= logits.max(axis=0)
        part[:] = logits[own, np.arange(len(own))]
        part -= np.log(np.exp(logits, out=logits).sum(axis=0))
    return out


def _order(at: np.ndarray, size: int) -> np.ndarray:
    """Stable order of numbers below size; short ones are sorted by radix."""
    return np.argsort(at.astype(np.int16) if size <= 1 << 15 else at, kind="stable")


def _sums(at: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The different numbers (below size) in at, and for each the sum of its rows, by runs of the sorted numbers."""
    order = _order(at, size)
    at = at[order]
    first = np.nonzero(np.concatenate(([True], at[1:] != at[:-1])))[0]
    return at[first], np.add.reduceat(rows.take(order, axis=0), first, axis=0)


def levels(m: Model, noise_n: int = NOISE) -> list[tuple[np.ndarray, np.ndarray]]:
    """For tokens and for classes what all batches share: the distribution that noise is drawn from, and the logarithms of
    each one's expected noise samples."""
    shares = m.noise, np.add.reduceat(m.noise, m.class_at[:-1])
    return [(np.cumsum(share) / share.sum(), np.log(share * noise_n).astype(np.float32)) for share in shares]


def _nce(hidden: np.ndarray, vectors: np.ndarray, bias: np.ndarray, expected: np.ndarray, target: np.ndarray, noise: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the noise-contrastive objective for a batch whose tokens share the noise samples: rows that have one,
    and those of their vectors with that of the bias after them; that of the hidden vectors is added to whole. hidden has
    a column of ones at its end, so that products take biases along."""
    noise, times = np.unique(noise, return_counts=True)  # samples that repeat have one gradient, taken so many times
    lift, own, other = bias - expected, vectors.take(target, axis=0), vectors[noise]
    g_own = 1 / (1 + np.exp(np.einsum("td,td->t", hidden[:, :-1], own) + lift[target]))
    g_noise = np.negative(np.column_stack([other, lift[noise]])) @ hidden.T  # a row for each different noise sample; worked on in place
    np.exp(g_noise, out=g_noise)
    g_noise += 1
    np.divide(-times[:, None].astype(np.float32), g_noise, out=g_noise)
    own *= g_own[:, None]
    whole += own
    whole += g_noise.T @ other
    return _sums(np.concatenate([target, noise]), np.concatenate([g_own[:, None] * hidden, g_noise @ hidden]), len(bias))


def _step(x: np.ndarray, squares: np.ndarray, at: np.ndarray | slice, g: np.ndarray, step: float) -> None:
    """A step of the rows at, its length set by coordinate; others have no gradient and stay as they are."""
    s = squares[at] + g * g
    squares[at] = s
    x[at] += np.float32(step) * g / np.sqrt(s)


def train_batch(m: Model, rng: np.random.Generator, squares: dict, before: np.ndarray, target: np.ndarray, step: float = STEP, noise_n: int = NOISE, shared: list | None = None) -> None:
    """One noise-contrastive step for classes and for tokens, in place, of the rows that the batch touches. shared:
    levels(m, noise_n), if they are there already."""
    shared = shared or levels(m, noise_n)
    n, dim = len(target), m.vectors.shape[1]
    seen = [m.vectors.take(before[:, p], axis=0) for p in range(len(m.places))]
    hidden = np.ones((n, dim + 1), np.float32)
    hidden[:, :-1] = sum(v * d for v, d in zip(seen, m.places, strict=True))
    whole, grads = np.zeros((n, dim), np.float32), []
    for vec, bia, (drawn, expected), tgt in (("targets", "bias", shared[0], target), ("class_vectors", "class_bias", shared[1], m.class_of[target])):
        noise = np.minimum(drawn.searchsorted(rng.random(noise_n), side="right"), len(drawn) - 1).astype(tgt.dtype)
        at, g = _nce(hidden, getattr(m, vec), getattr(m, bia), expected, tgt, noise, whole)
        grads += [(vec, at, g[:, :-1]), (bia, at, g[:, -1])]
    at, g = _sums(before.T.ravel(), np.concatenate([whole * d for d in m.places]), len(m.vectors))
    grads += [("vectors", at, g), ("places", slice(None), np.stack([np.einsum("td,td->d", whole, v) for v in seen]))]
    for x, at, g in grads:
        if x not in squares:
            squares[x] = np.full_like(getattr(m, x), SQUARES)
        _step(getattr(m, x), squares[x], at, g / np.float32(n), step)


LEARNED = ("vectors", "places", "targets", "bias", "class_vectors", "class_bias")
SQUARES = np.float32(1e-6)


def _flat(m: Model, squares: dict) -> np.ndarray:
    """All that training changes, as one vector."""
    return np.concatenate([np.broadcast_to(x, getattr(m, k).shape).ravel() for k in LEARNED for x in (getattr(m, k), squares.get(k, SQUARES))]).astype(np.float32)


def _unflat(m: Model, values: np.ndarray) -> tuple[Model, dict]:
    new, squares, at = {}, {}, 0
    for k in LEARNED:
        old = getattr(m, k)
        for into in (new, squares):
            into[k] = values[at : at + old.size].reshape(old.shape).astype(np.float32)
            at += old.size
    return replace(m, **new), squares


def train_round(texts: DataFrame, m: Model, squares: dict, step: float = STEP) -> tuple[Model, dict]:
    """The mean, by tokens, of what each task reaches from m over its rows (ids: bytes of int16). Means are taken in Spark
    over rows of WIDTH parameters, so the driver gets one model."""
    shared = texts.sparkSession.sparkContext.broadcast((m, squares))
    schema = T.StructType([T.StructField("row", T.IntegerType()), T.StructField("values", T.ArrayType(T.FloatType())), T.StructField("n", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given, before_squares = shared.value
        own = replace(given, **{x: getattr(given, x).copy() for x in LEARNED})
        own_squares = {x: a.copy() for x, a in before_squares.items()}
        shares = levels(own)
        rng, seen, befores, targets, n = np.random.default_rng(1), 0, [], [], 0

        def learn() -> None:
            before, target, order = np.concatenate(befores), np.concatenate(targets), rng.permutation(n)
            for a in range(0, n, BATCH):
                train_batch(own, rng, own_squares, before[order[a : a + BATCH]], target[order[a : a + BATCH]], step, shared=shares)

        for b in batches:
            for ids in b.column(0).to_pylist():
                targets.append(np.frombuffer(ids, np.int16).astype(np.int32))
                befores.append(contexts(targets[-1], len(own.places)))
                n += len(targets[-1])
                if n >= MIXED:
                    learn()
                    seen, befores, targets, n = seen + n, [], [], 0
        if n:
            learn()
        if seen := seen + n:
            flat = _flat(own, own_squares)
            rows = np.pad(flat, (0, -len(flat) % WIDTH)).reshape(-1, WIDTH)
            values = pa.ListArray.from_arrays(np.arange(0, rows.size + 1, WIDTH, np.int32), pa.array(rows.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(rows), dtype=np.int32)), values, pa.array(np.full(len(rows), float(seen)))], schema.names)

    parts = texts.select("ids").mapInArrow(run, schema).groupBy("row").agg(F.sum("n").alias("n"), *[F.sum(F.get("values", F.lit(i)) * F.col("n")).alias(f"c{i}") for i in range(WIDTH)])
    means = parts.orderBy("row").toPandas()
    if means.empty:
        return m, squares
    return _unflat(m, (means[[f"c{i}" for i in range(WIDTH)]].to_numpy() / means[["n"]].to_numpy()).ravel())


def train(texts: DataFrame, m: Model, tokens_n: int, rounds: int = ROUNDS, share: int = SHARE, step: float = STEP) -> Model:
    """m trained on texts (rid, id, ids) with tokens_n tokens: each text in one round, which a hash tells, by one of its trainers, to which they are dealt in turn. There
    are fewer rounds where they would have fewer than `share` tokens."""
    squares: dict = {}
    rounds = max(1, min(rounds, tokens_n // share))
    deal = texts.select("ids", F.xxhash64("id", "rid").alias("h"))
    for r in range(rounds):
        part = deal.filter(F.pmod(F.col("h"), F.lit(rounds)) == r)
        m, squares = train_round(part.repartition(max(1, round(tokens_n / rounds / share))), m, squares, step)
    return m


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", known: int = KNOWN, buckets: int = BUCKETS, frequent: int = FREQUENT, rounds: int = ROUNDS, share: int = SHARE) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row of docs.

    Learns from rows whose crc32(id as text) mod 5 is not 1. A text's tokens are its words and one end. base_score: sum of
    log10((c + 0.5) / (N + 0.5 (V + 1))), with c the token's count in training, N all, V distinct ones. n_known: tokens
    with c > 0. score: log10 probability of the text by the model; a token without a vector has its bucket's probability
    times (c + 0.5) / (N + 0.5 (V + 1)) of the bucket. Null text counts as empty: its end is scored. Rows that repeat an id
    are scored each; other columns are not read; an empty table gives an empty result. known + buckets is below 32,767.
    """
    if known + buckets >= 32_767:
        raise ValueError("known and buckets are too many for two bytes")
    counts = keep(count_tokens(docs.filter(bucket(F.col(id_col), 5) != 1), text_col))
    total, distinct, ends = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.coalesce(F.sum(F.when(F.col("token").isNull(), F.col("n"))), F.lit(0))).first()
    top = most_frequent(counts, frequent)
    rest_n, rest_v = bucket_sums(counts, top[:known], buckets)
    model = start(np.array([ends, *rest_n, *(c for _, c in top[:known])]))
    id_of = np.array([*(1 + buckets + i for i in range(len(top[:known]))), *(1 + bucket_of(w, buckets) for w, _ in top[known:]), 0], np.int32)
    shared = docs.sparkSession.sparkContext.broadcast(([w for w, _ in top], id_of, np.log10(np.array([*(c for _, c in top), 0.5]) + 0.5), np.log10(ends + 0.5), np.log10(rest_n + 0.5 * (rest_v + 1))))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("body"), F.monotonically_increasing_id().alias("rid"))
    fields = [("rid", T.LongType()), ("id", rows.schema["id"].dataType), ("token", T.BinaryType()), ("times", T.LongType()), ("n_tokens", T.LongType()), ("n_known", T.LongType()), ("logs", T.DoubleType()), ("rest_logs", T.DoubleType()), ("ids", T.BinaryType())]
    schema = T.StructType([T.StructField(*f) for f in fields])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each text, with its ids, and for each of its tokens that is not frequent."""
        frequent_words, id_of, logs, end_log, rest_log = shared.value  # id_of and logs end with a nought for words without a place
        of, frequent_words = Buckets(buckets), pa.array(frequent_words, pa.binary())
        for b in batches:
            for part in parts_of(b, 1, LOOKED_UP):
                n, rids = part.num_rows, part.column(2)
                words_n, words = tokens(part.column(1))
                place = pc.fill_null(pc.index_in(words, value_set=frequent_words), -1).to_numpy()
                lengths = words_n + 1
                begins = np.concatenate(([0], np.cumsum(lengths)[:-1]))
                is_word = np.ones(lengths.sum(), bool)
                is_word[begins + lengths - 1] = False
                others = np.nonzero(place < 0)[0]
                left = words.take(pa.array(others)).dictionary_encode()
                different, code = left.dictionary, left.indices.to_numpy()
                word_id = id_of[place]
                word_id[others] = np.fromiter(map(of.__getitem__, different.to_pylist()), np.int32, len(different))[code] + 1
                flat, log = np.zeros(len(is_word), np.int32), np.full(len(is_word), end_log)
                flat[is_word], log[is_word] = word_id, logs[place]
                in_bucket = (flat > 0) & (flat <= buckets)
                rest = np.where(in_bucket, log - rest_log[np.where(in_bucket, flat - 1, 0)], 0.0)
                placed = np.full(len(is_word), end_log > -0.3)  # an end that training has seen counts as known
                placed[is_word] = place >= 0
                known_n, logs_sum, rest_sum = (np.add.reduceat(x, begins) for x in (placed.astype(np.int64), log, rest))
                pairs, times = np.unique(np.repeat(np.arange(n), words_n)[others] * len(different) + code, return_counts=True)
                own, word = np.divmod(pairs, max(1, len(different)))
                z, short = len(pairs), flat.astype(np.int16)
                coded = [short[x : x + y].tobytes() for x, y in zip(begins.tolist(), lengths.tolist(), strict=True)]
                ids = part.column(0)
                null = lambda kind, size: pa.nulls(size, kind)
                yield pa.RecordBatch.from_arrays([rids, ids, null(pa.binary(), n), null(pa.int64(), n), pa.array(lengths), pa.array(known_n, pa.int64()), pa.array(logs_sum, pa.float64()), pa.array(rest_sum, pa.float64()), pa.array(coded, pa.binary())], schema.names)
                if z:
                    yield pa.RecordBatch.from_arrays([rids.take(pa.array(own)), null(ids.type, z), different.take(pa.array(word)), pa.array(times, pa.int64()), *(null(pa.int64(), z) for _ in range(2)), *(null(pa.float64(), z) for _ in range(2)), null(pa.binary(), z)], schema.names)

    passed = keep(rows.mapInArrow(read, schema))
    texts = passed.filter("token is null")
    if total:
        model = train(texts.filter(bucket(F.col("id"), 5) != 1), model, total, rounds, share)
    trained = docs.sparkSession.sparkContext.broadcast(model)

    def add_model(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = trained.value
        for b in batches:
            coded, sums = b.column(b.num_columns - 1).to_pylist(), []
            for a in range(0, len(coded), 256):
                lists = [np.frombuffer(x, np.int16).astype(np.int32) for x in coded[a : a + 256]]
                flat = np.concatenate(lists)
                before = np.concatenate([contexts(x, len(m.places)) for x in lists])
                lp = np.concatenate([log_probabilities(m, before[s : s + 32768], flat[s : s + 32768]) for s in range(0, len(flat), 32768)])
                sums.append(np.add.reduceat(lp.astype(float), np.cumsum([0, *map(len, lists[:-1])])) / np.log(10))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(np.concatenate(sums) if sums else [], pa.float64())], [*b.schema.names[:-1], "model_log"])

    found = passed.filter("token is not null").select("rid", "token", "times").join(counts.filter("token is not null"), "token", "left")
    c = F.coalesce("n", F.lit(0))
    joined = found.groupBy("rid").agg(F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("n2"), F.sum(F.log10(c + 0.5) * F.col("times")).alias("logs2"))
    carried = texts.select("rid", "id", "n_tokens", "n_known", "logs", "rest_logs", "ids")
    scored = carried.mapInArrow(add_model, T.StructType([*carried.schema.fields[:-1], T.StructField("model_log", T.DoubleType())]))
    per = scored.join(joined, "rid", "left")
    logs2 = F.coalesce("logs2", F.lit(0.0))
    base = F.col("logs") + logs2 - F.col("n_tokens") * F.lit(float(np.log10(total + 0.5 * (distinct + 1))))
    return per.select(F.col("id").alias(id_col), (bucket(F.col("id"), 5) == 1).alias("held_out"), "n_tokens", (F.col("n_known") + F.coalesce("n2", F.lit(0))).alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"), base.alias("base_score"), (F.col("model_log") + F.col("rest_logs") + logs2).alias("score"))
