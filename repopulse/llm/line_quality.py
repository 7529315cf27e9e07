"""Quality rules by line sequence labelling.

A linear-chain conditional random field marks every line of a text as content or boilerplate; Viterbi
decoding finds the best marks of the whole sequence, and the share of word bytes in content lines decides
whether the text stays. The field is fitted in numpy by exact gradients (forward-backward) on a bounded
sample of labelled documents, whose quality label stands for each of their lines.

Features of a line are shares and counts cut into steps: symbols, bars, capitals, digits, exclamation marks,
length, sentence end, sameness with an earlier line, and words in three-word runs that the text repeats.

Results: a missing or empty text has zero counts, one empty line, and fails the base rule of 50 words.
Every row of docs is judged by its own text; extra columns don't matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repopulse.llm.sampling import labelled_sample
from repopulse.llm.ship import ship
from repopulse.llm.words import WHITE, hash_spans, ngram_rows, slices, text_buffer, words_in

SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
CONTENT_SHARE = 0.5
#: Bound of the fit: so many documents of each label, so many characters and lines each.
FIT_DOCS, FIT_CHARS, FIT_LINES = 1500, 20_000, 200
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
SLICE = 1 << 20  # bytes of text described at once, with a dozen running sums over them

#: Steps of the shares a line is described by.
_SHARE = np.array([1e-9, 0.02, 0.05, 0.1, 0.2, 0.4, 0.7])
_COUNT = np.array([1, 2, 4, 8, 16, 32, 64])
_COLUMNS = 7
STEPS = len(_SHARE) + 1
FEATURES = 2 + _COLUMNS * STEPS + 2


def _sums(flags: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])


def _repeated(words) -> np.ndarray:
    """Words in a three-word run that their text has twice or more."""
    grams, first = ngram_rows(words, 3)
    out = np.zeros(len(words.hash), bool)
    if not len(grams):
        return out
    runs = np.diff(first)
    row = np.repeat(np.arange(len(runs)), runs)
    order = np.lexsort((grams, row))
    same = (grams[order][1:] == grams[order][:-1]) & (row[order][1:] == row[order][:-1])
    twice = np.zeros(len(grams), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    at = np.flatnonzero(twice)
    word = at + np.repeat(words.first[:-1] - first[:-1], runs)[at]
    for i in range(3):
        out[word + i] = True
    return out


def describe(data: np.ndarray, offsets: np.ndarray):
    """Base counts of every text, and lines: bounds of each text's lines, feature columns, word bytes."""
    words = words_in(data, offsets)
    n = len(offsets) - 1
    inside = ~WHITE[data]
    points = _sums(inside & ((data & 0xC0) != 0x80))
    symbols = _sums(SYMBOLS[data])
    repeated = _sums(_repeated(words))

    newline = np.flatnonzero(data == 10)
    bounds = np.concatenate([[0], np.cumsum(np.bincount(np.searchsorted(offsets[1:], newline, "right"), minlength=n) + 1)])
    text = np.repeat(np.arange(n), np.diff(bounds))
    start, stop = np.empty(bounds[-1], np.int64), np.empty(bounds[-1], np.int64)
    opens, closes = np.zeros(bounds[-1], bool), np.zeros(bounds[-1], bool)
    opens[bounds[:-1]] = closes[bounds[1:] - 1] = True
    start[opens], start[~opens] = offsets[:-1], newline + 1
    stop[closes], stop[~closes] = offsets[1:], newline

    low, high = np.searchsorted(words.start, start), np.searchsorted(words.start, stop)
    n_words = high - low
    wordy = np.flatnonzero(n_words)
    value = hash_spans(data, start[wordy], stop[wordy])
    order = np.lexsort((np.arange(len(wordy)), value, text[wordy]))
    again = np.zeros(len(stop), bool)
    same = (value[order][1:] == value[order][:-1]) & (text[wordy][order][1:] == text[wordy][order][:-1])
    again[wordy[order[1:][same]]] = True

    counts = {
        "n_words": np.diff(words.first),
        "word_chars": points[offsets[1:]] - points[offsets[:-1]],
        "n_symbols": symbols[offsets[1:]] - symbols[offsets[:-1]],
        "n_dup_lines": np.bincount(text[again], minlength=n),
        "n_repeat_words": repeated[words.first[1:]] - repeated[words.first[:-1]],
    }

    bytes_in = _sums(inside)
    size = bytes_in[stop] - bytes_in[start]
    each = np.maximum(size, 1)

    def share(flags):
        total = _sums(flags)
        return np.searchsorted(_SHARE, (total[stop] - total[start]) / each, "right")

    ending = np.zeros(len(stop), np.int64)
    ending[wordy] = np.isin(data[words.end[high[wordy] - 1] - 1], [ord(c) for c in ".!?:"])
    columns = np.stack([
        share(SYMBOLS[data]), share(data == ord("|")), share((data >= ord("A")) & (data <= ord("Z"))),
        share((data >= ord("0")) & (data <= ord("9"))), share(data == ord("!")),
        np.searchsorted(_COUNT, n_words, "right"),
        np.searchsorted(_SHARE, (repeated[high] - repeated[low]) / np.maximum(n_words, 1), "right")], axis=1)
    columns = np.concatenate([2 + np.arange(_COLUMNS) * STEPS + columns, ending[:, None], FEATURES - 2 + again[:, None]], axis=1)
    return counts, bounds, columns.astype(np.int16), size


class LineField:
    """Two marks (0 boilerplate, 1 content), one weight a feature and mark, transitions and first mark."""

    def __init__(self):
        self.weights = np.zeros((FEATURES, 2))
        self.moves = np.array([[0.5, -0.5], [-0.5, 0.5]])
        self.first = np.zeros(2)
        self.weights[2, 1] = 0.1  # without a fit, lines free of symbols are content

    def emissions(self, columns: np.ndarray) -> np.ndarray:
        return self.weights[columns].sum(axis=1)

    def decode(self, columns: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The best marks of every text's lines (Viterbi), all texts side by side, line after line."""
        score = self.emissions(columns)
        lengths = np.diff(bounds)
        by_length = np.argsort(-lengths, kind="stable")
        first = bounds[:-1][by_length]
        lengths = lengths[by_length]
        back = np.zeros((len(score), 2), np.int8)
        best = score[first] + self.first if len(first) else np.zeros((0, 2))
        last = best.copy()
        for t in range(1, int(lengths.max(initial=0))):
            active = int(np.searchsorted(-lengths, -t, "left"))
            step = last[:active, :, None] + self.moves[None]
            choice = step.argmax(axis=1)
            at = first[:active] + t
            back[at] = choice
            last[:active] = np.take_along_axis(step, choice[:, None, :], 1)[:, 0] + score[at]
        marks = np.zeros(len(score), np.int8)
        mark = last.argmax(axis=1)
        for t in range(int(lengths.max(initial=0)) - 1, -1, -1):
            active = int(np.searchsorted(-lengths, -t, "left"))
            at = first[:active] + t
            marks[at] = mark[:active]
            mark[:active] = back[at, mark[:active]]
        return marks

    def fit(self, columns: np.ndarray, bounds: np.ndarray, marks: np.ndarray, rounds: int = 60, rate: float = 0.15, decay: float = 1e-3, smooth: float = 0.3):
        """Maximum likelihood by Adam on the exact gradient; marks has one mark for each line.

        ``smooth`` holds the transitions near 0: a document's label stands for each of its lines, so the sample
        shows no change of mark inside a text, and without it one odd line would turn all others.
        """
        lengths = np.diff(bounds)
        texts, longest = len(lengths), int(lengths.max(initial=0))
        if not texts:
            return self
        inside = np.arange(longest)[None] < lengths[:, None]
        place = np.where(inside, bounds[:-1, None] + np.arange(longest)[None], 0)
        y = marks[place]
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in (self.weights, self.moves, self.first)]
        for r in range(1, rounds + 1):
            score = self.emissions(columns)[place]
            forward, backward = np.zeros((texts, longest, 2)), np.zeros((texts, longest, 2))
            forward[:, 0] = score[:, 0] + self.first
            for t in range(1, longest):
                forward[:, t] = np.where(inside[:, t, None], np.logaddexp(*np.moveaxis(forward[:, t - 1, :, None] + self.moves, 1, 0)) + score[:, t], forward[:, t - 1])
            for t in range(longest - 2, -1, -1):
                ahead = np.logaddexp(*np.moveaxis(self.moves[None] + (score[:, t + 1] + backward[:, t + 1])[:, None], 2, 0))
                backward[:, t] = np.where(inside[:, t + 1, None], ahead, 0)
            total = np.logaddexp(*forward[:, -1].T)
            chance = np.exp(forward + backward - total[:, None, None]) * inside[..., None]
            pair = np.exp(forward[:, :-1, :, None] + self.moves + (score[:, 1:] + backward[:, 1:])[:, :, None] - total[:, None, None, None]) * inside[:, 1:, None, None]
            gap = np.eye(2)[y] * inside[..., None] - chance
            flat = np.zeros((len(columns), 2))
            flat[place[inside]] = gap[inside]
            grad_w = np.stack([np.bincount(columns.ravel(), np.repeat(flat[:, k], columns.shape[1]), FEATURES) for k in range(2)], axis=1)
            seen = np.zeros((2, 2))
            np.add.at(seen, (y[:, :-1][inside[:, 1:]], y[:, 1:][inside[:, 1:]]), 1)
            grads = (grad_w / texts - decay * self.weights, (seen - pair.sum(axis=(0, 1))) / texts - smooth * self.moves, gap[:, 0].sum(axis=0) / texts)
            for p, g, (m, v) in zip((self.weights, self.moves, self.first), grads, moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p += rate * (m / (1 - 0.9**r)) / (np.sqrt(v / (1 - 0.99**r)) + 1e-8)
        return self


def fit_field(docs: DataFrame, labels: DataFrame, per_class: int = FIT_DOCS, max_chars: int = FIT_CHARS) -> LineField:
    """The field, fitted on a bounded sample of the rows with a quality label."""

    def run(batches):
        for batch in slices(batches, SLICE):
            _, bounds, columns, _ = describe(*text_buffer(batch.column(0)))
            rows = [columns[bounds[i] : bounds[i + 1]].tobytes() for i in range(batch.num_rows)]
            yield pa.record_batch([pa.array(rows, pa.binary()), batch.column(1)], names=["columns", "y"])

    ship(docs.sparkSession)
    sample = labelled_sample(docs, labels, "quality", per_class, max_chars)
    rows = sample.orderBy("doc_id").select("text", "y").mapInArrow(run, "columns binary, y int").collect()
    rows = [r for r in rows if len(r["columns"]) <= FIT_LINES * 2 * (_COLUMNS + 2)]
    texts = [np.frombuffer(r["columns"], np.int16).reshape(-1, _COLUMNS + 2) for r in rows]
    if len({r["y"] for r in rows}) < 2:
        return LineField()
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    return LineField().fit(np.concatenate(texts), bounds, np.repeat([r["y"] for r in rows], np.diff(bounds)))


def _judged(docs: DataFrame, field: LineField, keep: list[int], share: float) -> DataFrame:
    """The columns of docs at the places ``keep`` as _0, _1, ..., then counts, content share and verdict."""

    def run(batches):
        for batch in slices(batches, SLICE, text="_text"):
            counts, bounds, columns, size = describe(*text_buffer(batch.column(batch.num_columns - 1)))
            marks = field.decode(columns, bounds)
            total = np.add.reduceat(size, bounds[:-1])
            content = np.add.reduceat(np.where(marks == 1, size, 0), bounds[:-1]) / np.maximum(total, 1)
            failed = (counts["n_words"] < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * counts["n_words"])
            made = [pa.array(c, pa.int64()) for c in counts.values()]
            made += [pa.array(failed), pa.array(content, pa.float64()), pa.array(~failed & (content >= share))]
            names = [*(f"_{i}" for i in range(batch.num_columns - 1)), *counts, "base_failed", "content_share", "kept"]
            yield pa.record_batch([*batch.columns[:-1], *made], names=names)

    ship(docs.sparkSession)
    numbered = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    text = F.col(f"c{docs.columns.index('text')}").cast("string").alias("_text")
    given = numbered.select(*(F.col(f"c{k}").alias(f"_{i}") for i, k in enumerate(keep)), text)
    schema = T.StructType([*given.schema.fields[:-1], *T._parse_datatype_string(
        "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, content_share double, kept boolean").fields])
    return given.mapInArrow(run, schema)


def judge(docs: DataFrame, field: LineField, share: float = CONTENT_SHARE) -> DataFrame:
    """(doc_id, base counts, base_failed, content_share, kept) of every row."""
    return _judged(docs, field, [docs.columns.index("doc_id")], share).withColumnRenamed("_0", "doc_id")


def drop_boilerplate(docs: DataFrame, field: LineField, share: float = CONTENT_SHARE) -> DataFrame:
    """The rows of docs that the rules keep, with docs' own columns."""
    n = len(docs.columns)
    kept = _judged(docs, field, list(range(n)), share).where("kept")
    return kept.select(*(f"_{i}" for i in range(n))).toDF(*docs.columns)
