import copy
import math
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from driftline.llm import lmscore


def test_probabilities_sum_to_one():
    m = lmscore.start(np.array([30, *[3] * 11, *range(100, 60, -1)]))
    rng = np.random.default_rng(2)
    for x in lmscore.LEARNED:
        getattr(m, x).__iadd__(rng.normal(0, 0.5, getattr(m, x).shape).astype(np.float32))
    before = np.array([[0, 0, 0], [3, 1, 40]], np.int32)
    for row in before:
        p = np.exp(lmscore.log_probabilities(m, np.repeat(row[None], 52, 0), np.arange(52)))
        assert abs(p.sum() - 1) < 1e-4


def full_softmax(m, before):
    """Brute force: probabilities of all ids after each row of ids, class times token within it, without shortcuts."""
    out = []
    for row in before:
        h = sum(m.vectors[i].astype(float) * m.places[p] for p, i in enumerate(row))
        cls = np.exp(m.class_vectors @ h + m.class_bias)
        p = np.exp(m.targets @ h + m.bias)
        out.append([cls[c] / cls.sum() * p[i] / p[m.class_of == c].sum() for i, c in enumerate(m.class_of)])
    return np.array(out)


def test_trained_model_beats_shares_by_brute_force(spark):
    """Texts in which the token before tells the next: the model learns it, and its scores are those of the full softmax."""
    rng = np.random.default_rng(6)
    step = rng.integers(1, 30, 30)
    texts = []
    for _ in range(400):
        ids = [int(rng.integers(1, 30))]
        while len(ids) < 60:
            ids.append(int(step[ids[-1]]) if rng.random() < 0.8 else int(rng.integers(1, 30)))
        texts.append(np.array([*ids, 0], np.int16))
    counts = np.bincount(np.concatenate(texts), minlength=30)
    first = lmscore.start(counts)
    df = spark.createDataFrame([(i, i, bytearray(t.tobytes())) for i, t in enumerate(texts)], "rid long, id long, ids binary")
    m = lmscore.train(df, first, int(counts.sum()))
    before, target = np.concatenate([lmscore.contexts(t.astype(np.int32), 3) for t in texts[:40]]), np.concatenate(texts[:40]).astype(np.int32)
    slow = np.log(full_softmax(m, before)[np.arange(len(target)), target])
    assert np.allclose(lmscore.log_probabilities(m, before, target), slow, atol=1e-4)
    shares = np.log(counts / counts.sum())[target]
    assert slow.mean() > shares.mean() + 0.3


def test_scores_hold_however_the_table_is_split(spark):
    """Held-out scores beat the base at any number of partitions and rounds, and are much the same."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", F.lit(1).alias("token"), F.lit(2).alias("ids"), F.lit("x").alias("n"))
    means = {}
    for parts, rounds in ((1, 3), (8, 3), (64, 3), (8, 1), (8, 5)):
        r = lmscore.score(docs.repartition(parts), rounds=rounds, share=60_000 if rounds == 5 else lmscore.SHARE).filter("held_out").agg(F.sum("score") / F.sum("n_tokens"), F.sum("base_score") / F.sum("n_tokens")).first()
        means[parts, rounds] = r[0]
        assert r[0] > r[1] + 0.1
    assert max(means.values()) - min(means.values()) < 0.06


def test_base_score_and_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").union(spark.createDataFrame([(5000, None), (5001, ""), (5002, "THE the"), (5002, "THE the")], "doc_id long, text string"))
    rows = [(r.doc_id, (r.text or "").encode().lower().split()) for r in docs.collect()]
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    c = Counter()
    for i, ws in rows:
        if not held(i):
            c.update([*ws, None])
    n, v = sum(c.values()), len(c)
    want = sorted((i, len(ws) + 1, sum(c[w] > 0 for w in [*ws, None]), round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in [*ws, None]), 5)) for i, ws in rows)
    got = lmscore.score(docs, frequent=3000).collect()
    assert sorted((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 5)) for r in got) == want
    assert all(r.train_tokens == n and r.held_out == held(r.doc_id) for r in got)
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
    assert lmscore.score(docs.limit(0)).count() == 0


def plain_batch(m, rng, squares, before, target, step, noise_n):
    """A noise-contrastive step in double precision, sample by sample over whole tables, as the objective says."""
    hidden = sum(m.vectors[before[:, p]].astype(float) * m.places[p] for p in range(3))
    grads = {x: np.zeros(getattr(m, x).shape) for x in lmscore.LEARNED}
    whole = np.zeros_like(hidden)
    for vec, bia, share, tgt in (("targets", "bias", m.noise, target), ("class_vectors", "class_bias", np.add.reduceat(m.noise, m.class_at[:-1]), m.class_of[target])):
        noise, vectors, bias = rng.choice(len(share), noise_n, p=share / share.sum()), getattr(m, vec).astype(float), getattr(m, bia).astype(float)
        true = lambda t, i: 1 / (1 + np.exp(np.log(share[i] * noise_n) - hidden[t] @ vectors[i] - bias[i]))  # noqa: B023, E731
        for t in range(len(tgt)):
            for i, g in [(tgt[t], 1 - true(t, tgt[t])), *((i, -true(t, i)) for i in noise)]:
                grads[vec][i] += g * hidden[t]
                grads[bia][i] += g
                whole[t] += g * vectors[i]
    for p in range(3):
        np.add.at(grads["vectors"], before[:, p], whole * m.places[p])
        grads["places"][p] = (whole * m.vectors[before[:, p]]).sum(axis=0)
    for x, g in grads.items():
        squares[x] = squares.get(x, 1e-6) + (g / len(target)) ** 2
        setattr(m, x, getattr(m, x) + step * g / len(target) / np.sqrt(squares[x]))


def test_a_batch_takes_the_step_of_the_objective():
    rng = np.random.default_rng(3)
    fast = lmscore.start(np.array([30, *[3] * 11, *range(100, 60, -1)]))
    for x in lmscore.LEARNED:
        getattr(fast, x).__iadd__(rng.normal(0, 0.3, getattr(fast, x).shape).astype(np.float32))
    slow, fast_squares, slow_squares = copy.deepcopy(fast), {}, {}
    first, second = np.random.default_rng(4), np.random.default_rng(4)
    for _ in range(3):
        before, target = rng.integers(0, 52, (40, 3)).astype(np.int32), rng.integers(0, 30, 40).astype(np.int32)
        lmscore.train_batch(fast, first, fast_squares, before, target, 0.1, 64)
        plain_batch(slow, second, slow_squares, before, target, 0.1, 64)
    for x in lmscore.LEARNED:
        assert np.allclose(getattr(fast, x), getattr(slow, x), atol=2e-3), x


def test_a_batch_costs_by_its_tokens_and_not_by_the_tables():
    """A small batch on a table of 600,000 ids costs little more than on a small one: rows that it does not touch are left alone."""
    used = []
    for ids in (600, 600_000):
        m, rng, squares = lmscore.start(np.full(ids, 5)), np.random.default_rng(1), {}
        before, target = rng.integers(0, 500, (512, 3)).astype(np.int32), rng.integers(0, 500, 512).astype(np.int32)
        shared = {"shared": lmscore.levels(m)} if hasattr(lmscore, "levels") else {}
        lmscore.train_batch(m, rng, squares, before, target, **shared)
        begun = time.process_time()
        for _ in range(10):
            lmscore.train_batch(m, rng, squares, before, target, **shared)
        used.append(time.process_time() - begun)
    assert used[1] < used[0] + 0.4


def test_tokens_are_those_of_bytes_with_any_white_space():
    """Parts of a column that does not begin at its first row, nulls, white space at the ends, bytes that are no UTF-8."""
    bodies = [b"skip me", b" THE\x0bthe\x0c ", None, b"", b" \t\n", "\u0130\u00c4 a\u00a0b\x1cc\x85d\u2003e".encode(), b"\xff\xfeA \x80\r\nz\x00Z", b"x" * 100 + b" Y"]
    batch = pa.RecordBatch.from_arrays([pa.array(bodies, pa.binary())], ["body"]).slice(1)
    for most in (1, 10, 1 << 20):
        got = []
        for part in lmscore.parts_of(batch, 0, most):
            n, words = lmscore.tokens(part.column(0))
            ends = np.cumsum(n)
            got += [words.to_pylist()[e - k : e] for k, e in zip(n, ends, strict=True)]
        assert got == [(t or b"").lower().split() for t in bodies[1:]]
