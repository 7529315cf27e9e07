"""Substring dedup by seed and extend over winnowed anchors.

Passages of at least ``window`` words that an earlier document (smaller doc_id) also holds are found
exactly. Every run of ``window`` words picks its smallest ``seed``-word hash as its anchor, so equal
runs have equal anchors at equal places, and about two of ten positions are anchors.

1. Seed: each block of documents asks once for each of its different anchors whether another block has
   it too. Anchors that one document alone holds end here, which is nearly all of the corpus.
2. Extend: only the runs around a shared anchor are looked up whole, to the left and to the right of it
   as far as ``window`` words reach, with the smallest doc_id that starts them.
3. Runs that an earlier document starts are joined into maximal repeats and cut.

A passage that very many documents share costs one record a block, never pairs of documents.
Runs are compared by 96 bits of hash.

Results: a missing text is empty; with a missing doc_id a document counts as the earliest; rows with
the same doc_id are one document's parts, never a repeat of one another; texts shorter than the window
stay whole. Extra columns don't matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from repopulse.llm import blocks as B
from repopulse.llm.words import Words, mix, ngram_rows, words_in
from repopulse.session import cut_lineage

WINDOW, SEED = 13, 6


def _anchors(words: Words, window: int, seed: int):
    """Of every run of ``window`` words: its text, first word, and its anchor's word and hash."""
    grams, first = ngram_rows(words, seed)
    width = window - seed + 1
    per_text = np.maximum(np.diff(first) - width + 1, 0)
    total = int(per_text.sum())
    if not total:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, np.zeros(0, np.uint64)
    text = np.repeat(np.arange(len(per_text)), per_text)
    begun = np.concatenate([[0], np.cumsum(per_text)])[:-1]
    gram = np.arange(total) + np.repeat(first[:-1] - begun, per_text)
    best, place = grams[gram], gram.copy()
    for i in range(1, width):  # the leftmost smallest
        other = grams[gram + i]
        less = other < best
        best = np.where(less, other, best)
        place[less] = gram[less] + i
    shift = words.first[:-1] - first[:-1]
    return text, gram + shift[text], place + shift[text], best


def _seeds(words: Words, ids: np.ndarray, window: int, seed: int):
    """Runs with their anchors; the block's different anchors; which of them two of its documents hold."""
    text, run, place, value = _anchors(words, window, seed)
    keys, inverse = np.unique(value, return_inverse=True)
    one = np.full(len(keys), B.NO_ID)
    one[inverse] = ids[text]
    local = np.zeros(len(keys), bool)
    local[inverse[one[inverse] != ids[text]]] = True
    return text, run, keys, inverse, local


def _seeking(ids, data, offsets, window, seed):
    return [_seeds(words_in(data, offsets), ids, window, seed)[2]]


def _shared(keys):
    """1 where another block has the anchor too."""
    same = np.zeros(len(keys), np.uint8)
    equal = keys[1:] == keys[:-1]
    same[1:] |= equal
    same[:-1] |= equal
    return [same], []


def _runs(ids, data, offsets, found, window, seed, buckets):
    """Runs around shared anchors: text, first word, hash, check."""
    words = words_in(data, offsets)
    text, run, keys, inverse, local = _seeds(words, ids, window, seed)
    shared = local
    if found is not None:
        shared = local | B.placed(keys, found, buckets)[0].astype(bool)
    chosen = shared[inverse]
    text, run = text[chosen], run[chosen]
    whole = _at(words.hash, run, window)
    return words, text, run, whole, (_at(mix(words.hash, 5), run, window) >> np.uint64(32)).astype(np.uint32)


def _at(hashes: np.ndarray, run: np.ndarray, window: int) -> np.ndarray:
    out = np.zeros(len(run), np.uint64)
    for i in range(window):
        out = out * np.uint64(0xD6E8FEB86659FD93) + hashes[run + i]
    return mix(out, window)


def _first_ids(ids, text, whole, check):
    """Different runs, the place of each run among them, check and smallest id of each."""
    keys, inverse = np.unique(whole, return_inverse=True)
    least = np.full(len(keys), np.iinfo(np.int64).max)
    np.minimum.at(least, inverse, ids[text])
    checks = np.zeros(len(keys), np.uint32)
    checks[inverse] = check
    return keys, inverse, checks, least


def _extending(ids, data, offsets, found, window, seed, buckets):
    _, text, _, whole, check = _runs(ids, data, offsets, found, window, seed, buckets)
    keys, _, checks, least = _first_ids(ids, text, whole, check)
    return [keys, checks, least]


def _earlier(keys, checks, least):
    """1 where another block has the run in a document with a smaller id."""
    if not len(keys):
        return [np.zeros(0, np.uint8)], []
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (checks[1:] != checks[:-1])
    group = np.cumsum(new) - 1
    return [(np.minimum.reduceat(least, np.flatnonzero(new))[group] < least).astype(np.uint8)], []


def _covered(ids, data, offsets, found, known, window, seed, buckets):
    """Which words go, and the words."""
    words, text, run, whole, check = _runs(ids, data, offsets, found, window, seed, buckets)
    keys, inverse, _, least = _first_ids(ids, text, whole, check)
    earlier = np.zeros(len(keys), bool)
    if known is not None:
        earlier = B.placed(keys, known, buckets)[0].astype(bool)
    gone = run[earlier[inverse] | (ids[text] > least[inverse])]
    step = np.zeros(len(words.hash) + 1, np.int64)
    np.add.at(step, gone, 1)
    np.add.at(step, gone + window, -1)
    return words, np.cumsum(step[:-1]) > 0


def _cut(ids, data, offsets, found, known, window, seed, buckets):
    words, covered = _covered(ids, data, offsets, found, known, window, seed, buckets)
    total = np.concatenate([[0], np.cumsum(covered)])
    removed = total[words.first[1:]] - total[words.first[:-1]]
    raw, kept, spans = data.tobytes(), [], []
    for i in range(len(ids)):
        low, high = words.first[i], words.first[i + 1]
        own = raw[offsets[i] : offsets[i + 1]].split()
        if removed[i]:
            gone = covered[low:high]
            own = [w for w, g in zip(own, gone.tolist(), strict=True) if not g]
            edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
            spans.append([{"first": int(a), "n": int(b - a)} for a, b in edge.reshape(-1, 2)])
        else:
            spans.append([])
        kept.append(b" ".join(own))
    return pa.record_batch([
        pa.array(ids, pa.int64(), mask=ids == B.NO_ID), pa.array(np.diff(words.first), pa.int64()),
        pa.array(removed, pa.int64()), pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("n", pa.int64())]))),
        pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "repeats", "kept_text"])


def cut_repeats(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_removed, repeats, kept_text): every row of docs without its maximal repeats.

    ``repeats`` lists the cut spans (first word, number of words); kept words are joined by one space.
    Blocks and answers are written to the shared folder.
    """
    if not 0 < seed <= window:
        raise ValueError("seed must be between 1 and window")
    buckets = B.buckets_of(docs)
    packed = cut_lineage(B.pack(docs), "repeats-blocks")
    asked = B.mail(packed, lambda *x: _seeking(*x, window, seed), buckets)
    found = cut_lineage(B.answer(asked, _shared, buckets), "repeats-seeds")
    asked = B.mail(B.deliver(packed, found), lambda *x: _extending(*x, window, seed, buckets), buckets)
    known = cut_lineage(B.answer(asked, _earlier, buckets), "repeats-runs")
    return B.finish(B.deliver(packed, found, known), lambda *x: _cut(*x, window, seed, buckets),
                    "doc_id long, n_words long, n_removed long, repeats array<struct<first:long,n:long>>, kept_text string")
