"""Toxicity by subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word's vector is the mean of the vectors of its hashed character n-grams and of the word itself. A text is read in all windows of
``WINDOW`` words, or in one if it is shorter; a window's vector is the mean over its distinct words (missing ones count as zero), a two-class softmax reads
it, and the text's score is that of its worst window, so that a long text doesn't dilute what one passage says. Misspelt words share n-grams with the words that
were trained.

Embeddings and softmax are trained together by Adam on a bounded sample of the labelled rows: of those of
``TRAIN_BYTES`` bytes or fewer, at most ``SAMPLE`` of each class by seeded hash. First on whole texts, then on the window of each text that the model of the
round before holds to be the worst. Scoring reads every whole text.

All of it is linear before the softmax, so a bucket acts on the logit by one number: what goes to the executors is ``BUCKETS``
floats, whatever the corpus.

Texts without words (null, empty) are scored by the bias, as a text of no evidence. Repeated rows get the same score. Labels
that are null, or without a row in the documents, are not used; without both classes every text scores the share of class 1.
"""

from __future__ import annotations

import zlib
from collections import Counter
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fringeline.llm.common import ascii_words, give_back

BUCKETS = 1 << 16
DIM = 4
NGRAMS = (3, 4, 5)
WINDOW = 24
SAMPLE = 1_200
TRAIN_BYTES = 16_000
SUPPORT = 3
#: Steps on whole texts, then on the worst windows: one of a text of class 1, HARD of a text of class 0.
ROUNDS = (40, 40, 40, 40, 120)
HARD = 4
RATE = 0.05
DECAY = 3e-5
SEED = 11
FOLDS = 5
#: Words whose sums a worker keeps; about 160 bytes each.
_KEPT_WORDS = 200_000
_SCALE = 20.0  # means over many words are small; this keeps the steps of Adam in range


def subwords(word: bytes) -> list[int]:
    """Buckets of a word and of its character n-grams, with borders."""
    w, crc = b"<" + word + b">", zlib.crc32
    out = [crc(w) % BUCKETS]
    for n in NGRAMS:
        out += [crc(w[i : i + n]) % BUCKETS for i in range(len(w) - n + 1)]
    return out


class Bags:
    """Rows of weighted members, as sorted arrays: products with a matrix and with its transpose."""

    def __init__(self, rows: np.ndarray, cols: np.ndarray, weights: np.ndarray, n_rows: int, n_cols: int):
        order = np.argsort(rows, kind="stable")
        self.rows, self.cols, self.weights = rows[order], cols[order], weights[order].astype(np.float32)[:, None]
        self.n_rows, self.n_cols = n_rows, n_cols
        self.row_at = np.flatnonzero(np.diff(self.rows, prepend=-1))
        self.by_col = np.argsort(self.cols, kind="stable")
        self.col_at = np.flatnonzero(np.diff(self.cols[self.by_col], prepend=-1))

    def dot(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros((self.n_rows, x.shape[1]), np.float32)
        if len(self.rows):
            out[self.rows[self.row_at]] = np.add.reduceat(x[self.cols] * self.weights, self.row_at)
        return out

    def dot_t(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros((self.n_cols, x.shape[1]), np.float32)
        if len(self.rows):
            out[self.cols[self.by_col][self.col_at]] = np.add.reduceat(x[self.rows[self.by_col]] * self.weights[self.by_col], self.col_at)
        return out

    def only(self, keep: np.ndarray) -> "Bags":
        """The given rows, renumbered in their order."""
        place = np.full(self.n_rows, -1)
        place[keep] = np.arange(len(keep))
        own = place[self.rows] >= 0
        return Bags(place[self.rows[own]], self.cols[own], self.weights[own, 0], len(keep), self.n_cols)


def _adam(par: list[np.ndarray], words: Bags, bags: Bags, y: np.ndarray, steps: int) -> None:
    """Train embeddings, softmax weights and bias in place; classes weigh the same."""
    first, second = [np.zeros_like(p) for p in par], [np.zeros_like(p) for p in par]
    target = np.stack([1 - y, y], axis=1)
    weight = (target / target.sum(axis=0)).sum(axis=1, keepdims=True) / 2
    for step in range(1, steps + 1):
        h = bags.dot(words.dot(par[0])) * _SCALE
        z = h @ par[1] + par[2]
        p = np.exp(z - z.max(axis=1, keepdims=True))
        d = ((p / p.sum(axis=1, keepdims=True) - target) * weight).astype(np.float32)
        back = words.dot_t(bags.dot_t(d @ par[1].T)) * _SCALE
        for i, g in enumerate((back + DECAY * par[0], h.T @ d + DECAY * par[1], d.sum(axis=0))):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            par[i] -= (RATE * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-9)).astype(np.float32)


def train(texts: list[bytes], labels: list[int]) -> tuple[np.ndarray, float]:
    """(logit of each bucket, bias) after joint training of embeddings and softmax."""
    y = np.array(labels, dtype=np.float32)
    share = float(y.mean()) if len(y) else 0.0
    if not 0 < share < 1:
        return np.zeros(BUCKETS, np.float32), float(np.log((share + 1e-3) / (1 - share + 1e-3)))
    split = [ascii_words(t) for t in texts]
    shared = Counter(w for words in split for w in set(words))
    vocabulary = {w: i for i, w in enumerate(sorted(w for w, n in shared.items() if n >= SUPPORT))}
    # a rare word has no vector of its own in training, but counts among the words that are averaged
    ids = [[vocabulary.get(w, -1) for w in words] for words in split]
    own = [subwords(w) for w in vocabulary]
    size = np.array([len(s) for s in own] or [0])
    used, cols = np.unique(np.concatenate([np.array(s, np.int64) for s in own]) if own else np.zeros(0, np.int64), return_inverse=True)
    words = Bags(np.repeat(np.arange(len(own)), size[: len(own)]), cols, np.repeat(1 / np.maximum(size, 1), size)[: len(cols)], len(own), len(used))

    flat = np.array([i for doc in ids for i in doc], np.int64)
    lengths = np.array([len(doc) for doc in ids])
    doc = np.repeat(np.arange(len(ids)), lengths)
    known = flat >= 0
    whole = Bags(doc[known], flat[known], 1 / lengths[doc[known]], len(ids), len(own))
    place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    begin = np.cumsum(lengths) - lengths
    first_at, spot = np.repeat(begin, lengths), np.arange(len(flat))
    place = spot - first_at
    opens = place <= np.maximum(lengths - WINDOW, 0)[doc]
    # a word counts in the windows that begin behind its last occurrence in the text
    order = np.lexsort((spot, flat, doc))
    before = np.full(len(flat), -1)
    same = (doc[order][1:] == doc[order][:-1]) & (flat[order][1:] == flat[order][:-1])
    before[order[1:][same]] = order[:-1][same]
    low = np.maximum(np.maximum(first_at, spot - WINDOW + 1), before + 1)
    half = np.unique(doc * (1 << 32) + place // (WINDOW // 2), return_inverse=True)[1]

    def worst(value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first place, text) of the worst window of each text; HARD of a text of class 0, begun in different halves of a window."""
        v = np.where(known, np.append(value, 0.0)[flat], 0.0)
        step = np.bincount(low, v, len(flat) + 1) - np.bincount(spot + 1, v, len(flat) + 1)
        z = np.cumsum(step)[:-1] / np.minimum(WINDOW, lengths)[doc]
        start = spot[opens][np.lexsort((-z[opens], half[opens]))]
        start = start[np.diff(half[start], prepend=-1) != 0]
        start = start[np.lexsort((-z[start], doc[start]))]
        rank = np.arange(len(start)) - np.maximum.accumulate(np.where(np.diff(doc[start], prepend=-1) != 0, np.arange(len(start)), 0))
        start = start[rank < np.where(y[doc[start]] == 1, 1, HARD)]
        return start, doc[start]

    def bags_of(start: np.ndarray) -> Bags:
        """A window is its distinct words over WINDOW places, or over the places of a shorter text."""
        size = np.minimum(WINDOW, lengths[doc[start]])
        row = np.repeat(np.arange(len(start)), size)
        at = np.repeat(start, size) + np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        pairs = np.unique(row[known[at]] * max(1, len(own)) + flat[at[known[at]]])
        row = pairs // max(1, len(own))
        return Bags(row, pairs % max(1, len(own)), 1 / size[row], len(start), len(own))

    rng = np.random.default_rng(SEED)
    par = [rng.normal(0, 0.1, (len(used), DIM)).astype(np.float32), rng.normal(0, 0.1, (DIM, 2)).astype(np.float32), np.zeros(2, np.float32)]
    _adam(par, words, whole, y, ROUNDS[0])
    for steps in ROUNDS[1:]:
        start, text = worst((words.dot(par[0]) @ (par[1][:, 1] - par[1][:, 0])).astype(np.float64))
        _adam(par, words, bags_of(start), y[text], steps)
    logit = np.zeros(BUCKETS, np.float32)
    logit[used] = _SCALE * (par[0] @ (par[1][:, 1] - par[1][:, 0]))
    return logit, float(par[2][1] - par[2][0])


def held_out(doc_id: Column) -> Column:
    """Rows that are never learnt from."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS)) == 0


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float]:
    """Train on the bounded sample, outside the held-out fold."""
    known = labels.filter("toxic in (0, 1)").filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    short = docs.filter(F.octet_length(F.coalesce("text", F.lit(""))) <= TRAIN_BYTES)
    known = known.join(short.select("doc_id"), "doc_id", "left_semi")
    order = F.xxhash64(F.col("doc_id").cast("string"), F.lit(SEED))
    parts = [known.filter(F.col("toxic") == t).orderBy(order, "doc_id").limit(SAMPLE) for t in (0, 1)]
    chosen = F.broadcast(parts[0].unionByName(parts[1]))  # SAMPLE rows of each class at most
    rows = short.select("doc_id", "text").join(chosen, "doc_id")
    got = rows.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "toxic").dropDuplicates(["doc_id"]).collect()
    got.sort(key=lambda r: r.doc_id)
    return train([r.text.encode() for r in got], [r.toxic for r in got])


class Scorer:
    """Sums of bucket logits by word, kept per worker."""

    def __init__(self, logit: np.ndarray, bias: float):
        self.logit, self.bias, self.kept = logit.tolist(), bias, {}

    def score(self, text: bytes) -> float:
        words, kept, logit = ascii_words(text), self.kept, self.logit
        for word in set(words).difference(kept):
            own = subwords(word)
            kept[word] = sum(logit[b] for b in own) / len(own)
        z = self.bias
        if words:
            # a word counts in the windows that begin behind its last occurrence; sums of windows as running differences
            n, last, step = len(words), {}, [0.0] * (len(words) + 1)
            for j, w in enumerate(words):
                v = kept[w]
                step[max(last.get(w, -1) + 1, j - WINDOW + 1)] += v
                step[j + 1] -= v
                last[w] = j
            z += max(accumulate(step[: max(1, n - WINDOW + 1)])) / min(WINDOW, n)
        if len(kept) > _KEPT_WORDS:
            kept.clear()
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def scorer(docs: DataFrame, model: tuple[np.ndarray, float]):
    """A function from a text column to its score."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS floats
    made: list[Scorer] = []

    @F.pandas_udf("double")
    def scored(text: pd.Series) -> pd.Series:
        if not made:
            made.append(Scorer(*sent.value))
        found = pd.Series([made[0].score((t or "").encode()) for t in text], dtype="float64")
        give_back()
        return found

    return scored


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    score = scorer(docs, fit(docs, labels))
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(F.col("text")).alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows that are predicted toxic."""
    score = scorer(docs, fit(docs, labels))
    return docs.filter(score(F.col("text")) < 0.5)
