"""Language identification: unigrams over the pieces of a fixed public vocabulary, summed over all segmentations.

Each language has a probability for every piece of a public tokenizer's vocabulary. A word's probability is the sum over
all ways to write it as pieces (forward algorithm); a text's, the product over its words. Words repeat, so tasks keep the
words that they have scored in a bounded memo.
"""

from __future__ import annotations

import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bucket

#: The public vocabulary; a parameter of every function.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: Entries of a task's memo of words before it is emptied.
MEMO = 300_000
#: Texts that are scored together, so that their new words are scored together.
TOGETHER = 512
#: Languages that a model may have by default; more are an error, since labels of a free-text column would make it boundless.
LANGUAGES = 1024
#: Words of up to so many characters are scored with those of the same length, longer ones with those of about their length;
#: those that are longer still, or have few like them, one by one.
SAME, ALIKE, FEW = 48, 2048, 16
#: Characters of such a word for which pieces are looked up at once.
BLOCK = 1 << 16
MARK = "▁"  # begins a word in the vocabulary


def vocabulary(path: str = VOCABULARY) -> list[str]:
    """The vocabulary's text pieces by id; control and byte pieces are empty."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    odd = lambda i: sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)
    return ["" if odd(i) else sp.id_to_piece(i) for i in range(sp.get_piece_size())]


def words_of(text: str) -> list[str]:
    return text.lower().split()


@dataclass
class Model:
    """log_p[piece id, language]: natural logarithms; unknown: those of a character outside the vocabulary."""

    languages: list[str]
    prior: np.ndarray
    log_p: np.ndarray
    unknown: np.ndarray
    path: str


BASE, MIX, SLOTS = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), 20


class Pieces:
    """The vocabulary by length and hash of its pieces (64 bits, polynomial in the characters)."""

    def __init__(self, pieces: list[str]):
        lengths = np.array([len(p) for p in pieces])
        self.longest = int(lengths.max(initial=1))
        self.powers = np.array([pow(int(BASE), k, 1 << 64) for k in range(self.longest + 1)], np.uint64)
        self.filter, self.hashes, self.ids = np.zeros(1 << SLOTS, bool), {}, {}
        for n in range(1, self.longest + 1):
            ids = np.nonzero(lengths == n)[0]
            h = np.zeros(len(ids), np.uint64)
            for k in range(n):
                h = h * BASE + np.array([ord(pieces[i][k]) + 1 for i in ids], np.uint64)
            order = np.argsort(h)
            self.hashes[n], self.ids[n] = h[order], ids[order]
            if len(np.unique(h)) < len(h):
                raise ValueError("two pieces of one hash")
            self.filter[self._slot(h)] = True

    @staticmethod
    def _slot(h: np.ndarray) -> np.ndarray:
        return (h * MIX >> np.uint64(64 - SLOTS)).astype(np.int64)

    def find(self, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Where h are hashes of pieces of n characters, and which; most others fail at a small table already."""
        at = np.nonzero(self.filter[self._slot(h)])[0]
        if not len(at) or not len(self.hashes[n]):
            return at[:0], at[:0]
        place = np.minimum(np.searchsorted(self.hashes[n], h[at]), len(self.hashes[n]) - 1)
        same = self.hashes[n][place] == h[at]
        return at[same], self.ids[n][place[same]]


class Scorer:
    """Log-probabilities of words under each language, by the forward algorithm, memoised."""

    def __init__(self, model: Model):
        self.model, self.memo = model, {}
        self.scores = np.zeros((0, len(model.languages)))
        self.pieces = Pieces(vocabulary(model.path))
        self.table = np.vstack([model.log_p, model.unknown])  # the last row is a character outside the vocabulary

    def fill(self, words: list[str]) -> None:
        """Score words that are not in the memo; those of one length, or nearly, go through the algorithm at once."""
        new = np.zeros((len(words), len(self.model.languages)))
        order = sorted(range(len(words)), key=lambda k: len(words[k]))
        at = 0
        while at < len(order):
            n = len(words[order[at]]) + 1
            most, end = n if n <= SAME else n * 5 // 4, at
            while end < len(order) and end < at + 50_000 and len(words[order[end]]) < most:
                end += 1
            some = order[at:end]
            if n > ALIKE or (n > SAME and len(some) < FEW):
                for k in some:
                    new[k] = self._alone(MARK + words[k])
            else:
                new[some] = self._forward([MARK + words[k] for k in some])
            at = end
        begin = len(self.scores)
        self.scores = np.concatenate([self.scores, new])
        self.memo.update((w, begin + k) for k, w in enumerate(words))

    def _forward(self, ws: list[str]) -> np.ndarray:
        """The algorithm for words in order of length, all at once. Substrings are looked up by a rolling hash. Only what
        the longest piece may need of earlier columns is held."""
        lengths, far = np.array([len(w) for w in ws]), self.pieces.longest + 1
        n = int(lengths[-1])
        codes = np.array(ws, f"<U{n}").view(np.uint32).reshape(len(ws), n).T.astype(np.uint64)
        run, alpha = [np.zeros(len(ws), np.uint64)] * far, [np.zeros((len(ws), self.table.shape[1]))] * far
        out = np.zeros_like(alpha[0])
        ended = np.searchsorted(lengths, np.arange(n + 2))  # words before ended[j] are shorter than j
        for j in range(1, n + 1):
            before = run[(j - 1) % far]
            run[j % far] = now = before * BASE + codes[j - 1] + np.uint64(1)
            at, ids = self.pieces.find(now - before * BASE, 1)
            one = np.full(len(ws), len(self.table) - 1)
            one[at] = ids
            ends = alpha[(j - 1) % far] + self.table[one]
            for i in range(max(0, j - self.pieces.longest), j - 1):
                at, ids = self.pieces.find(now - run[i % far] * self.pieces.powers[j - i], j - i)
                if len(at):
                    ends[at] = np.logaddexp(ends[at], alpha[i % far][at] + self.table[ids])
            alpha[j % far] = ends
            out[ended[j] : ended[j + 1]] = ends[ended[j] : ended[j + 1]]
        return out

    def _alone(self, word: str) -> np.ndarray:
        """The algorithm for one long word: pieces are looked up for a block of places at once, and each place passes its
        sum on to where its pieces end; the columns that reach into the next block are carried over."""
        codes = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
        n, longest = len(codes), self.pieces.longest
        alpha = np.full((BLOCK + longest, self.table.shape[1]), -np.inf)
        alpha[0] = 0
        for a in range(0, n, BLOCK):
            b = min(a + BLOCK, n)
            h, starts, sizes, pieces = np.zeros(b - a, np.uint64), [np.arange(b - a)], [np.ones(b - a, np.int64)], [np.full(b - a, len(self.table) - 1)]
            for k in range(1, min(longest, n - a) + 1):
                h = h[: min(b, n - k + 1) - a] * BASE + codes[a + k - 1 : a + k - 1 + min(b, n - k + 1) - a]
                at, ids = self.pieces.find(h, k)
                if k == 1:
                    pieces[0][at] = ids
                else:
                    starts.append(at), sizes.append(np.full(len(at), k)), pieces.append(ids)
            start = np.concatenate(starts)
            order = np.argsort(start, kind="stable")
            size, piece = np.concatenate(sizes)[order], np.concatenate(pieces)[order]
            cuts = np.searchsorted(start[order], np.arange(b - a + 1)).tolist()
            for i in range(b - a):
                to, of = i + size[cuts[i] : cuts[i + 1]], piece[cuts[i] : cuts[i + 1]]
                alpha[to] = np.logaddexp(alpha[to], alpha[i] + self.table[of])
            rest = alpha[b - a : b - a + longest].copy()
            alpha.fill(-np.inf)
            alpha[: len(rest)] = rest
        return alpha[0]

    def texts(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, its share by the mean word) for each text; ("und", 0.0) for null or without letters."""
        counts = [Counter(words_of(t)) if t else {} for t in texts]
        if len(self.memo) > MEMO:
            self.memo, self.scores = {}, self.scores[:0]
        memo, prior, out = self.memo, np.log(self.model.prior), []
        self.fill([w for w in dict.fromkeys(w for c in counts for w in c) if w not in memo])
        for c in counts:
            if not self.model.languages or not any(x.isalpha() for w in c for x in w):
                out.append(("und", 0.0))
                continue
            score = prior + np.fromiter(c.values(), float, len(c)) @ self.scores[[memo[w] for w in c]]
            p = np.exp((score - score.max()) / sum(c.values()))
            best = int(p.argmax())
            out.append((self.model.languages[best], float(p[best] / p.sum())))
        return out


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", path: str = VOCABULARY, smoothing: float = 0.1, most: int = LANGUAGES) -> Model:
    """Piece probabilities from every row of docs that has text and language.

    Tasks segment words with the vocabulary's own tokenizer, each distinct word of a batch once, and add up pieces by
    language; the driver gets sums for languages times pieces, whatever the size of docs. Smoothed by additive counts,
    so every piece has some probability in every language. The model is broadcast, pieces times languages, so more than
    `most` languages raise a ValueError.
    """
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("piece", T.IntegerType()), T.StructField("n", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        sp, memo, seen = sentencepiece.SentencePieceProcessor(model_file=path), {}, defaultdict(Counter)
        sums: dict[str, np.ndarray] = {}

        def flush() -> None:
            for lang, counts in seen.items():
                new = [w for w in counts if w not in memo]
                for w, ids in zip(new, sp.encode(new, num_threads=1), strict=True):
                    memo[w] = ids
                total = sums.setdefault(lang, np.zeros(sp.get_piece_size(), np.int64))
                lengths = [len(memo[w]) for w in counts]
                np.add.at(total, np.array([i for w in counts for i in memo[w]], np.int64), np.repeat(np.array(list(counts.values()), np.int64), lengths))
            seen.clear()
            if len(memo) > MEMO:
                memo.clear()

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                seen[lang].update(words_of(text))
                if len(seen[lang]) > MEMO:
                    flush()
            flush()
        for lang, total in sums.items():
            at = np.nonzero(total)[0]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(total[at])], ["lang", "piece", "n"])

    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).dropna()
    languages = sorted(r.lang for r in rows.select("lang").distinct().limit(most + 1).collect())
    if len(languages) > most:
        raise ValueError(f"more than {most} languages")
    counts = rows.mapInArrow(run, schema).groupBy("lang", "piece").agg(F.sum("n").alias("n")).toPandas()
    pieces = vocabulary(path)
    real = np.array([bool(p) for p in pieces])
    n = np.zeros((len(pieces), len(languages)))
    where = {lang: k for k, lang in enumerate(languages)}
    n[counts["piece"].to_numpy(np.int64), counts["lang"].map(where).to_numpy(np.int64)] = counts["n"]
    n[~real] = 0
    total = n.sum(axis=0) + smoothing * (real.sum() + 1)
    log_p = np.where(real[:, None], np.log((n + smoothing) / total), -np.inf)
    prior = (n.sum(axis=0) + 1) / (n.sum() + max(1, len(languages)))
    return Model(languages, prior, log_p, np.log(smoothing / total) - np.log(2.0) * 8, path)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) for each row of docs: the likeliest language, and its share when languages are weighed by
    the geometric mean of their probabilities for a word. So the score does not grow with the length of a text; one between
    two languages has about a half, however long.

    Null text and text without letters are "und" with score 0. Whole texts are scored. Repeated rows are scored each; other
    columns are not read; an empty table gives an empty result; a model of no languages calls everything "und". Ties go
    to the language first in code-point order.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # vocabulary times languages: bounded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for b in batches:
            texts = b.column(1).to_pylist()
            found = [x for a in range(0, len(texts), TOGETHER) for x in scorer.texts(texts[a : a + TOGETHER])]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x for x, _ in found], pa.string()), pa.array([p for _, p in found], pa.float64())], [id_col, "lang_pred", "score"])

    rows = docs.select(F.col(id_col), F.col(text_col).alias("__body"))
    return rows.mapInArrow(run, T.StructType([rows.schema[0], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))


def training_rows(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows to learn from: two thirds by crc32 of the id."""
    return docs.filter(bucket(F.col(id_col), 3) != 1)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", path: str = VOCABULARY) -> DataFrame:
    """(id, held_out, lang_pred, score): predict() by a model of training_rows(); held_out tells the others."""
    found = predict(docs, train(training_rows(docs, id_col), text_col, lang_col, path), id_col, text_col)
    return found.select(id_col, (bucket(F.col(id_col), 3) == 1).alias("held_out"), "lang_pred", "score")
