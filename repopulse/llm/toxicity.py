"""Toxicity by a convolutional text classifier, trained in numpy.

A word is a run of letters and digits, lower-case in A-Z. Its vector is the sum of two hashed embeddings, one
for the word and one for its first bytes, so unseen forms of a word still have a vector. Filters of several
widths run over the word vectors of the whole text, each filter's largest value is kept (max pooling),
and a linear layer gives a logit. Texts are padded with zero vectors at the end.

Thresholds are calibrated by language on rows that were not fitted on: the score is the logistic function of
the logit less its language's threshold, so 0.5 is the threshold everywhere. The language is read from
function words in the text, never from a column.

The fit sees a bounded sample (``PER_CLASS`` rows of each label, ``MAX_CHARS`` characters each), the
calibration another of the same bound. Scoring sees every word of every text.

Results: a missing text is empty; an empty text has a score too (that of the bias); without both labels in the
sample every score is 0. Extra columns don't matter.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repopulse.llm.sampling import fold, labelled_sample
from repopulse.llm.ship import ship
from repopulse.llm.words import LOWER, NON_WORD, hash_spans, slices, spans, words_of

PREFIX = 5
BUCKET_BITS, WIDTH = 15, 16
FILTERS = {1: 16, 2: 8, 3: 8}
PER_CLASS, MAX_CHARS = 3000, 20_000
EPOCHS, BATCH, RATE = 6, 64, 0.1
#: Rows of a language below which the common threshold holds.
MIN_ROWS = 40

#: Frequent function words by language.
FUNCTION_WORDS = {
    "en": "the of and to is that it for was with as this from are be not have they you which",
    "de": "der die das und ist nicht mit sich auf ein eine dem den zu von auch wird wie im für",
    "fr": "le les des et est une dans qui pour pas sur avec par au ce sont il elle du plus",
    "es": "el los las y del que una por con para se no lo como su al es más pero sus",
}
LANGUAGES = [*FUNCTION_WORDS, "other"]


def _word_hashes(words: list[str]) -> np.ndarray:
    data = LOWER[np.frombuffer(" ".join(words).encode(), np.uint8)]
    return hash_spans(data, *spans(data, np.array([0, len(data)]), NON_WORD))


_FUNCTION = np.concatenate([_word_hashes(w.split()) for w in FUNCTION_WORDS.values()])
_OF = np.repeat(np.arange(len(FUNCTION_WORDS)), [len(w.split()) for w in FUNCTION_WORDS.values()])
_ORDER = np.argsort(_FUNCTION)


def tokens(column):
    """(buckets of word and prefix, bounds of each text, language number of each text)."""
    words = words_of(column, lower=True, separators=NON_WORD, prefix=PREFIX)
    shift = np.uint64(64 - BUCKET_BITS)
    buckets = np.stack([words.hash >> shift, (1 << BUCKET_BITS) + (words.prefix >> shift).astype(np.int64)], axis=1).astype(np.int32)
    known = _FUNCTION[_ORDER]
    place = np.minimum(np.searchsorted(known, words.hash), len(known) - 1)
    hit = np.flatnonzero(known[place] == words.hash)
    n = len(words.first) - 1
    text = np.searchsorted(words.first[1:], hit, "right")
    votes = np.zeros((n, len(FUNCTION_WORDS)), np.int64)
    np.add.at(votes, (text, _OF[_ORDER][place[hit]]), 1)
    language = np.where(votes.max(axis=1, initial=0) > 0, votes.argmax(axis=1), len(FUNCTION_WORDS)) if n else np.zeros(0, int)
    return buckets, words.first, language


@dataclass
class ConvNet:
    """Embeddings, filters by width, output layer, and a threshold for each language."""

    seed: int = 2
    trained: bool = False
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(len(LANGUAGES), np.float32))

    def __post_init__(self):
        rng = np.random.default_rng(self.seed)
        self.embed = rng.normal(0, 0.1, (2 << BUCKET_BITS, WIDTH)).astype(np.float32)
        self.filters = {w: rng.normal(0, 0.3, (w, WIDTH, n)).astype(np.float32) for w, n in FILTERS.items()}
        self.out = rng.normal(0, 0.3, sum(FILTERS.values())).astype(np.float32)
        self.bias = np.zeros(sum(FILTERS.values()), np.float32)
        self.base = np.float32(0)

    def _pool(self, vectors: np.ndarray, first: np.ndarray, where: bool = False):
        """Largest value of every filter in every text, and optionally the first place that has it."""
        n = len(first) - 1
        full = np.flatnonzero(np.diff(first))
        pooled = np.zeros((n, len(self.out)), np.float32)
        places = np.zeros((n, len(self.out)), np.int64)
        low = 0
        ends = np.zeros(len(vectors), bool)
        ends[first[1:][full] - 1] = True
        for width, weights in self.filters.items():
            value = vectors @ weights[0]
            for k in range(1, width):  # beyond a text's end there are zero vectors
                ahead = vectors[k:] @ weights[k]
                crossing = ends[:-1].copy() if k == 1 else crossing[:-1] | ends[k - 1 : -1]
                ahead[crossing] = 0
                value[:-k] += ahead
            high = low + weights.shape[2]
            if len(full):
                best = np.maximum.reduceat(value, first[:-1][full], axis=0)
                pooled[full, low:high] = best
                if where:
                    text = np.repeat(np.arange(len(full)), np.diff(first)[full])
                    for c in range(high - low):
                        at = np.flatnonzero(value[:, c] == best[text, c])
                        places[full[text[at[::-1]]], low + c] = at[::-1]
            low = high
        return pooled, places

    def logits(self, buckets: np.ndarray, first: np.ndarray) -> np.ndarray:
        vectors = self.embed[buckets[:, 0]] + self.embed[buckets[:, 1]]
        pooled, _ = self._pool(vectors, first)
        return np.maximum(pooled + self.bias, 0) @ self.out + self.base

    def scores(self, buckets: np.ndarray, first: np.ndarray, language: np.ndarray) -> np.ndarray:
        if not self.trained:
            return np.zeros(len(first) - 1)
        margin = self.logits(buckets, first).astype(float) - self.thresholds[language]
        return 1 / (1 + np.exp(-np.clip(margin, -60, 60)))

    def fit(self, texts: list[np.ndarray], labels: np.ndarray) -> ConvNet:
        """Adagrad on the log loss; only the pooled places of a text get a gradient."""
        rng = np.random.default_rng(self.seed + 1)
        total = {k: np.full_like(v, 1e-6) for k, v in {"out": self.out, "bias": self.bias, **self.filters}.items()}
        seen = np.full(len(self.embed), 1e-6, np.float32)
        base_seen = 1e-6
        offset = np.concatenate([[0], np.cumsum(list(FILTERS.values()))])
        for _ in range(EPOCHS):
            for rows in np.array_split(rng.permutation(len(texts)), max(1, len(texts) // BATCH)):
                buckets = np.concatenate([texts[i] for i in rows])
                first = np.concatenate([[0], np.cumsum([len(texts[i]) for i in rows])])
                vectors = self.embed[buckets[:, 0]] + self.embed[buckets[:, 1]]
                pooled, places = self._pool(vectors, first, where=True)
                hidden = np.maximum(pooled + self.bias, 0)
                gap = (1 / (1 + np.exp(-np.clip(hidden @ self.out + self.base, -30, 30))) - labels[rows]) / len(rows)
                into = gap[:, None] * self.out * (hidden > 0)
                grads = {"out": gap @ hidden, "bias": into.sum(axis=0)}
                touched, pushes = [], []
                for w, (low, high) in zip(self.filters, zip(offset, offset[1:], strict=False), strict=True):
                    weights = self.filters[w]
                    grad = np.zeros_like(weights)
                    for k in range(w):
                        at = places[:, low:high] + k
                        ok = (at < first[1:, None]) & (np.diff(first) > 0)[:, None]
                        at = np.where(ok, at, 0)
                        push = into[:, low:high] * ok
                        if len(vectors):
                            grad[k] = np.einsum("tcw,tc->wc", vectors[at], push)
                            touched.append(at[ok])
                            pushes.append((push[..., None] * weights[k].T[None])[ok])
                    grads[w] = grad
                for k, g in grads.items():
                    p = self.filters.get(k) if k in self.filters else getattr(self, k)
                    total[k] += g * g
                    p -= RATE * g / np.sqrt(total[k])
                base_seen += gap.sum() ** 2
                self.base -= np.float32(RATE * gap.sum() / np.sqrt(base_seen))
                if touched:
                    at, push = np.concatenate(touched), np.concatenate(pushes)
                    own, inverse = np.unique(buckets[at].ravel(), return_inverse=True)
                    grad = np.zeros((len(own), WIDTH), np.float32)
                    np.add.at(grad, inverse, np.repeat(push, 2, axis=0))
                    seen[own] += (grad * grad).mean(axis=1)
                    self.embed[own] -= RATE * grad / np.sqrt(seen[own])[:, None]
        self.trained = True
        return self

    def calibrate(self, logits: np.ndarray, labels: np.ndarray, language: np.ndarray) -> ConvNet:
        """For every language the threshold of the best F1, half-way to the next value below."""

        def best(x, y):
            order = np.argsort(-x, kind="stable")
            x, y = x[order], y[order]
            hits = np.cumsum(y)
            f1 = 2 * hits / (np.arange(len(y)) + 1 + y.sum())
            i = int(f1.argmax())
            return (x[i] + x[i + 1]) / 2 if i + 1 < len(x) else x[i] - 1.0

        common = best(logits, labels) if 0 < labels.sum() < len(labels) else 0.0
        for k in range(len(LANGUAGES)):
            own = language == k
            enough = own.sum() >= MIN_ROWS and 0 < labels[own].sum() < own.sum()
            self.thresholds[k] = best(logits[own], labels[own]) if enough else common
        return self


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, max_chars: int = MAX_CHARS) -> ConvNet:
    """Fit and calibrate on a bounded sample of the rows of ``labels``; half of it calibrates."""

    def run(batches):
        for batch in slices(batches):
            buckets, first, language = tokens(batch.column(0))
            rows = [buckets[first[i] : first[i + 1]].tobytes() for i in range(batch.num_rows)]
            yield pa.record_batch([pa.array(rows, pa.binary()), batch.column(1), pa.array(language, pa.int32())], names=["words", "y", "language"])

    ship(docs.sparkSession)
    sample = labelled_sample(docs, labels, "toxic", 2 * per_class, max_chars).orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id")
    rows = sample.select("text", "y").mapInArrow(run, "words binary, y int, language int").collect()
    texts = [np.frombuffer(r["words"], np.int32).reshape(-1, 2) for r in rows]
    y, language = np.array([r["y"] for r in rows], float), np.array([r["language"] for r in rows], int)
    net, half = ConvNet(), len(rows) // 2
    if len(set(y[:half])) < 2:
        return net
    net.fit(texts[:half], y[:half])
    rest = texts[half:]
    first = np.concatenate([[0], np.cumsum([len(t) for t in rest])])
    return net.calibrate(net.logits(np.concatenate(rest), first), y[half:], language[half:])


def score(docs: DataFrame, net: ConvNet) -> DataFrame:
    """(doc_id, language, score, predicted) of every row."""
    model = docs.sparkSession.sparkContext.broadcast(net)  # a few megabytes, fixed by BUCKET_BITS

    def run(batches):
        for batch in slices(batches, 2 << 20):
            buckets, first, language = tokens(batch.column(1))
            scores = model.value.scores(buckets, first, language)
            yield pa.record_batch([batch.column(0), pa.array(np.array(LANGUAGES)[language]), pa.array(scores, pa.float64()),
                                   pa.array((scores >= 0.5).astype(np.int32))], names=["doc_id", "language", "score", "predicted"])

    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, language string, score double, predicted int")


def score_documents(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0) -> DataFrame:
    """Train without the rows whose crc32(doc_id) mod ``folds`` is ``held_out``, then score all rows."""
    net = train(docs, labels.where(fold(folds) != held_out))
    return score(docs, net).withColumn("held_out", fold(folds) == held_out)
