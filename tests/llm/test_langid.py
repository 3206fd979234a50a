import math

import numpy as np
import pytest

from driftline.llm import langid


def slow(word, model, ids):
    """Brute force: the sum over all segmentations of the marked word, by exact shares of each place."""
    w = "▁" + word
    longest = max(map(len, ids))
    out = []
    for lang in range(len(model.languages)):
        total, shift = [1.0], 0.0
        for j in range(1, len(w) + 1):
            s = 0.0
            for k in range(1, min(j, longest) + 1):
                x = w[j - k : j]
                if x in ids:
                    s += math.exp(model.log_p[ids[x], lang]) * total[-k]
                elif k == 1:
                    s += math.exp(model.unknown[lang]) * total[-k]
            total.append(s)
            if s < 1e-200:
                total, shift = [t * 1e200 for t in total[-longest:]], shift - 200 * math.log(10)
        out.append(math.log(total[-1]) + shift)
    return out


def test_forward_sums_all_segmentations():
    pieces = langid.vocabulary()
    rng = np.random.default_rng(3)
    log_p = np.log(rng.dirichlet(np.ones(len(pieces)), 2).T)
    model = langid.Model(["a", "b"], np.ones(2) / 2, log_p, np.array([-20.0, -21.0]), langid.VOCABULARY)
    scorer = langid.Scorer(model)
    some = [p.replace("▁", "") for p in pieces[1000:6000]]
    long = lambda n: "".join(rng.choice(some, n))[:n]
    words = ["the", "house", "über", "ǅ漢x", "a", "thanedble", "", *(long(n) for n in (47, 48, 49, 50, 95, 97, 300, 5000))]
    words += [long(n) for n in rng.integers(60, 70, 40)] + ["漢字" * 100, "x" * 49]
    scorer.fill(words)
    ids = {p: i for i, p in enumerate(pieces) if p}
    for w in words:
        assert np.allclose(scorer.scores[scorer.memo[w]], slow(w, model, ids), rtol=1e-9), len(w)


def test_long_words_by_blocks(monkeypatch):
    """A word's score does not depend on the blocks in which it is read."""
    pieces = langid.vocabulary()
    rng = np.random.default_rng(4)
    model = langid.Model(["a", "b"], np.ones(2) / 2, np.log(rng.dirichlet(np.ones(len(pieces)), 2).T), np.array([-20.0, -21.0]), langid.VOCABULARY)
    scorer, word = langid.Scorer(model), "".join(rng.choice([p for p in pieces[500:4000] if p], 300))
    whole = scorer._alone(word)
    for size in (1, 17, 100):
        monkeypatch.setattr(langid, "BLOCK", size)
        assert np.allclose(scorer._alone(word), whole)
    assert np.allclose(scorer._forward([word])[0], whole)


def test_training_counts(spark):
    """Piece counts of the training rows are those of the tokenizer, word by word."""
    import sentencepiece

    rows = [(1, "The the cat", "en"), (2, "das Haus das", "de"), (3, None, "en"), (4, "la casa", None), (5, "a" * 100 + " cat", "en"), (2, "das Haus das", "de")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, piece int")
    m = langid.train(df, smoothing=0.5)
    sp = sentencepiece.SentencePieceProcessor(model_file=langid.VOCABULARY)
    pieces = langid.vocabulary()
    real = [bool(p) for p in pieces]
    assert m.languages == ["de", "en"]
    for k, lang in enumerate(m.languages):
        n = np.zeros(len(pieces))
        for _, text, of in rows:
            if text and of == lang:
                for w in text.lower().split():
                    np.add.at(n, sp.encode(w), 1)
        n[~np.array(real)] = 0
        want = np.log((n + 0.5) / (n.sum() + 0.5 * (sum(real) + 1)))
        assert np.allclose(m.log_p[real, k], want[real])
    with pytest.raises(ValueError):
        langid.train(df, most=1)


def test_held_out_accuracy_and_edges(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.98 * len(got)
    model = langid.train(langid.training_rows(docs))
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 34 !!"), (4, "the " * 50000), (4, "x" * 5000), (None, "und der die das")], "doc_id long, text string")
    rows = {(r.doc_id, r.lang_pred): r.score for r in langid.predict(odd, model).collect()}
    assert all(rows[i, "und"] == 0 for i in (1, 2, 3)) and rows[4, "en"] > 0.9 and (None, "de") in rows and len(rows) == 6
    assert all(0 <= s <= 1 and not math.isnan(s) for s in rows.values())
    assert langid.train(docs.limit(0)).languages == []
