"""Runs: stretches of words that repeat with one period, found by internal pattern matching.

A text's words are a sequence. For every power of two m, blocks of m words begin at each multiple of m / 2. A
stretch with smallest period q, m / 2 < q <= m, that is four periods long holds a block that has its next occurrence q
words further on: the block is at least a period long, so it can't occur in between, and there is always a place
of the grid with room behind it. So each block asks one question: where is its next occurrence in the window
of m words to its right? All occurrences of a block are one interval of the suffix array; the next one is the
smallest place above its own in that interval, which a wavelet tree over the suffix array answers in as many
steps as a place has bits. Neighbouring blocks with the same distance are one progression; its distance is a
candidate period, which is extended word by word and kept if it is long enough.

A slice of documents is one suffix array, ordered by document first; it is sorted only as deep as two suffixes of a
document are equal, by doubling, and the interval of a block is known when its length is reached.

Results: a missing or empty text has no words and no runs; missing doc_ids stay; rows that repeat a doc_id are
documents each; ties are told apart by start and period; no documents give no rows. Extra columns don't matter.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repopulse.llm.ship import ship
from repopulse.llm.words import slices, text_buffer, words_in

LEAST_LENGTH, LEAST_PERIODS = 6, 4
_FOUND = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


class WaveletTree:
    """Smallest value from x on in a range of a sequence, for many ranges at once."""

    def __init__(self, values: np.ndarray):
        self.bits, self.levels = int(values.max(initial=0)).bit_length(), []
        for bit in reversed(range(self.bits)):
            ones = (values >> bit & 1).astype(bool)
            packed = np.packbits(ones, bitorder="little")
            words = np.concatenate([packed, np.zeros(-len(packed) % 8 + 8, np.uint8)]).view("<u8")
            ahead = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
            self.levels.append((words, ahead, len(values) - int(ones.sum())))
            values = np.concatenate([values[~ones], values[ones]])

    @staticmethod
    def _zeros(words: np.ndarray, ahead: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Zeros before each place."""
        word = at >> 6
        below = words[word] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
        return at - ahead[word] - np.bitwise_count(below)

    def successor(self, low: np.ndarray, high: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Smallest value >= ``least`` of each range, -1 where there is none."""
        smaller, a, b = np.zeros(len(low), np.int64), low, high
        for depth, (words, ahead, zeros) in enumerate(self.levels):
            up = (least >> (self.bits - 1 - depth) & 1).astype(bool)
            a0, b0 = self._zeros(words, ahead, a), self._zeros(words, ahead, b)
            smaller += np.where(up, b0 - a0, 0)
            a, b = np.where(up, zeros + a - a0, a0), np.where(up, zeros + b - b0, b0)
        there = (smaller < high - low) & (least < 1 << self.bits)
        out, a, b, rank = np.full(len(low), -1, np.int64), low[there], high[there], smaller[there]
        value = np.zeros(len(a), np.int64)
        for words, ahead, zeros in self.levels:
            a0, b0 = self._zeros(words, ahead, a), self._zeros(words, ahead, b)
            up = rank >= b0 - a0
            rank = rank - np.where(up, b0 - a0, 0)
            value = value << 1 | up
            a, b = np.where(up, zeros + a - a0, a0), np.where(up, zeros + b - b0, b0)
        out[there] = value
        return out


def block_intervals(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]]:
    """Suffix array of the words that a document repeats, and for each m (m, place, low, high) of the grid's blocks."""
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    end = first[doc + 1]
    suffix = np.lexsort((words, doc))
    new = np.ones(len(words), bool)
    new[1:] = (np.diff(doc[suffix]) != 0) | (words[suffix][1:] != words[suffix][:-1])
    rank, asked, m = np.empty(len(words), np.int64), [], 1
    at = np.arange(len(words))  # places of the suffix array that are still in question
    while len(at):
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(at)))
        rank[suffix[at]] = np.repeat(at[starts], sizes)
        low, high = np.repeat(at[starts], sizes), np.repeat(at[starts] + sizes, sizes)
        keep = high - low > 1
        at, low, high = at[keep], low[keep], high[keep]
        place = suffix[at]
        grid = (place - first[doc[place]]) % max(m // 2, 1) == 0
        asked.append((m, place[grid], low[grid], high[grid]))
        second = np.where(place + m < end[place], rank[np.minimum(place + m, len(words) - 1)], -1)
        order = np.lexsort((second, low))
        suffix[at] = place[order]
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(low) != 0) | (np.diff(second[order]) != 0)
        m *= 2
    return suffix, asked


def find_runs(words: np.ndarray, first: np.ndarray, least_length: int = LEAST_LENGTH, least_periods: int = LEAST_PERIODS) -> np.ndarray:
    """Rows (document, start, length, period) of all runs, in that order; ``words`` are the documents' word hashes."""
    if least_periods < LEAST_PERIODS:
        raise ValueError(f"the grid of blocks finds runs of {LEAST_PERIODS} periods and more")
    none = np.zeros((0, 4), np.int64)
    if not len(words):
        return none
    suffix, asked = block_intervals(words, first)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    begin = first[doc]
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, np.unique(asked[0][2]), 1)
    np.add.at(edge, np.unique(asked[0][3]), -1)
    repeated = np.cumsum(edge[:-1]) > 0
    number = np.concatenate([[0], np.cumsum(repeated)])
    tree = WaveletTree((suffix - begin[suffix])[repeated])
    found = []
    for m, place, low, high in asked:
        local = place - begin[place]
        period = tree.successor(number[low], number[high], local + 1) - local
        near = (period > m // 2) & (period <= m)
        found.append(np.stack([doc[place[near]], period[near], place[near], np.full(near.sum(), m)], 1))
    found = np.concatenate(found)
    if not len(found):
        return none
    found = found[np.lexsort(found.T[2::-1])]
    # Blocks at most m apart with one distance: their repeated parts overlap by a period or more.
    link = (np.diff(found[:, 0]) == 0) & (np.diff(found[:, 1]) == 0) & (np.diff(found[:, 2]) <= found[1:, 3])
    head = np.flatnonzero(np.concatenate([[True], ~link]))
    tail = np.append(head[1:], len(found)) - 1
    runs = []
    for (d, q, low, m), last in zip(found[head].tolist(), found[tail, 2].tolist(), strict=True):
        floor, top = int(first[d]), int(first[d + 1])
        high = last + q + m
        # The next block of the grid is not in the stretch, so the first word that differs is near.
        while low > floor:
            back = max(floor, low - m)
            differs = np.flatnonzero(words[back:low] != words[back + q : low + q])
            low = back + int(differs[-1]) + 1 if len(differs) else back
            if len(differs):
                break
        while high < top:
            ahead = min(top, high + m)
            differs = np.flatnonzero(words[high:ahead] != words[high - q : ahead - q])
            high = high + int(differs[0]) if len(differs) else ahead
            if len(differs):
                break
        if high - low >= max(least_length, least_periods * q):
            runs.append((d, low - floor, high - low, q))
    return np.unique(np.array(runs, np.int64).reshape(-1, 4), axis=0)


def periodic_runs(docs: DataFrame, least_length: int = LEAST_LENGTH, least_periods: int = LEAST_PERIODS) -> DataFrame:
    """Runs of every text, and the text with only the first period of each run, words joined by one space."""

    def run(batches):
        for batch in slices(batches):
            data, offsets = text_buffer(batch.column(1))
            words = words_in(data, offsets)
            rows = find_runs(words.hash, words.first, least_length, least_periods)
            bounds = np.searchsorted(rows[:, 0], np.arange(batch.num_rows + 1))
            raw, at, collapsed = data.tobytes(), offsets.tolist(), []
            for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
                parts = raw[at[i] : at[i + 1]].split()
                if a < b:
                    edge = np.zeros(len(parts) + 1, np.int64)
                    np.add.at(edge, rows[a:b, 1] + rows[a:b, 3], 1)
                    np.add.at(edge, rows[a:b, 1] + rows[a:b, 2], -1)
                    parts = compress(parts, (np.cumsum(edge[:-1]) == 0).tolist())
                collapsed.append(b" ".join(parts))
            struct = pa.StructArray.from_arrays([pa.array(rows[:, c]) for c in (1, 2, 3)], ["start", "length", "period"])
            yield pa.record_batch([batch.column(0), pa.array(np.diff(words.first)), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), struct),
                                   pa.array(collapsed, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])

    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text")).mapInArrow(run, _FOUND)
