"""Benchmark decontamination by edit distance: CGK embedding, bit-sampling LSH, exact verification.

A document is contaminated by a benchmark item of n words if some part of it is within ``RATE`` * n word edits
(insert, delete, replace) of the item; words are ``[^\\x20\\x09-\\x0D]+`` in lower case (A-Z).

For every item length n, windows of n words are taken at every word of every document that has n - k words of its text
after it; a window that reaches the text's end is cut there and counts as padded.

1. Screen. k edits change at most 2k of an item's word pairs, so a window must have n - 1 - 2k pairs that the
   benchmark has, too; a running count tells. This drops no match.
2. CGK walk. A random walk reads the window: at step j it writes the word under its pointer and moves on if a random bit of
   (step, word) says so. Windows at a small edit distance give writings at a small Hamming distance.
3. Bit sampling. A few written places, drawn at random, are a key. Keys of several samples of several independent
   walks are looked up among the items' keys; each item length has its own number of walks, raised until simulated
   edits of its items at the largest distance are found with probability ``RECALL`` for each kind of edit, where text
   goes on and where it ends.
4. Lengths that ``MOST_WALKS`` walks are too few for, and those over ``LONGEST`` words, are not sampled at all: the
   runs of screened windows go to every item of which they have n - 1 - 2k pairs. That drops no match either.
5. Candidates are decided by the exact edit distance between the item and the best part of the region.

The benchmark is the stated query set: it is taken in blocks of at most ``BLOCK_WORDS`` words, each block against
all documents. Documents are never shuffled.

Results: missing and empty items match nothing, missing and empty texts hold nothing; items of fewer than seven words
must occur exactly. Rows that repeat an item or a document are all reported. Extra columns don't matter.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repopulse.llm.ship import ship
from repopulse.llm.words import mix, ngrams, slices, words_of

RATE, RECALL = 0.15, 0.98
SAMPLED, SAMPLES, MOST_WALKS = 3, 8, 6
#: Words of the longest items that are walked over, and simulated edits of each kind and length.
LONGEST, TRIALS = 120, 50
KINDS = ("replace", "insert", "delete", "mixed")
BLOCK_WORDS = 500_000
_PAD = np.uint64(0x5851F42D4C957F2D)


def edits(n: int, rate: float = RATE) -> int:
    return int(rate * n)


def edit_match(item: np.ndarray, region: np.ndarray) -> tuple[int, int, int]:
    """Distance of the item to the nearest part of the region, that part's first word and length; the leftmost end wins."""

    def ends(a, b, free):
        steps = np.arange(len(b) + 1)
        row = np.zeros(len(b) + 1, np.int64) if free else steps.copy()
        for i, word in enumerate(a.tolist()):
            new = np.empty_like(row)
            new[0] = i + 1
            new[1:] = np.minimum(row[:-1] + (b != word), row[1:] + 1)
            row = np.minimum.accumulate(new - steps) + steps
        return row

    last = ends(item, region, True)
    end = int(last.argmin())
    back = ends(item[::-1], region[:end][::-1], False)
    length = int(np.flatnonzero(back == last[end])[0])
    return int(last[end]), end - length, length


def edited(rng: np.random.Generator, words: list[int], kind: str, k: int) -> list[int]:
    """The words after k edits with new words at random places."""
    words = list(words)
    for _ in range(k):
        one = KINDS[rng.integers(0, 3)] if kind == "mixed" else kind
        at = int(rng.integers(0, len(words)))
        if one == "delete":
            del words[at]
        else:
            words[at : at + (one == "replace")] = [int(rng.integers(1, 1 << 62))]
    return words


class ItemBlock:
    """The look-up tables of some items: their ids and words."""

    def __init__(self, ids: list, texts: list[np.ndarray], rate: float = RATE, recall: float = RECALL):
        self.ids, self.items, self.rate = ids, texts, rate
        self.by_length = defaultdict(list)
        for i, t in enumerate(texts):
            self.by_length[len(t)].append(i)
        pairs = [ngrams(t, 2) for t in texts if len(t) > 1]
        self.pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.uint64)
        self.singles = np.unique(np.concatenate([t for t in texts if len(t) == 1] or [np.zeros(0, np.uint64)]))
        self.common = np.zeros(1 << 20, bool)
        self.common[(self.pairs >> np.uint64(44)).astype(np.int64)] = True
        self.tables, self.exact = {}, {}
        self.walks = {n: self._walks(n, [texts[i] for i in own], recall) for n, own in self.by_length.items()}
        for n, own in self.by_length.items():
            data = np.concatenate([texts[i] for i in own])
            if self.walks[n]:
                keys = self.keys(data, np.arange(len(own)) * n, n)
            else:
                keys = ngrams(data, 2)[(np.arange(len(own)) * n)[:, None] + np.arange(n - 1)]
            flat, number = keys.ravel(), np.repeat(np.array(own), keys.shape[1])
            order = np.lexsort((number, flat))
            flat, number = flat[order], number[order]
            if self.walks[n]:
                self.tables[n] = flat, number
            else:
                new = np.ones(len(flat), bool)
                new[1:] = (flat[1:] != flat[:-1]) | (number[1:] != number[:-1])
                self.exact[n] = flat[new], number[new]

    def keys(self, words: np.ndarray, starts: np.ndarray, n: int, bits: dict | None = None, room: np.ndarray | None = None,
             walks: range | None = None) -> np.ndarray:
        """Keys of the n-word windows at ``starts``: one row a window, one column for each sample of each walk.

        ``bits`` keeps the random bits of ``words`` between calls; they don't depend on n. ``room``: the words of each window,
        fewer than n where its text ends.
        """
        room = n if room is None else room
        out, bits = [], {} if bits is None else bits
        for walk in range(self.walks[n]) if walks is None else walks:
            rng = np.random.default_rng([n, walk])
            chosen = rng.integers(0, 2 * n, (SAMPLES, SAMPLED))
            written = {}
            wanted, pointer = set(chosen.ravel().tolist()), np.zeros(len(starts), np.int64)
            for j in range(int(chosen.max()) + 1):
                part = (walk, j // 64)
                if part not in bits:
                    bits[part] = mix(words, 7000 + 64 * walk + j // 64)
                inside = pointer < room
                at = np.where(inside, starts + pointer, 0)
                if j in wanted:
                    written[j] = np.where(inside, words[at], _PAD)
                pointer += (((bits[part][at] >> np.uint64(j % 64)) & np.uint64(1)) == 1) & inside
            for s in range(SAMPLES):
                key = np.full(len(starts), np.uint64(walk * SAMPLES + s + 1))
                for j in chosen[s].tolist():
                    key = key * np.uint64(0xD6E8FEB86659FD93) + written[j]
                out.append(mix(key, 31))
        return np.stack(out, axis=1) if out else np.zeros((len(starts), 0), np.uint64)

    def _walks(self, n: int, items: list[np.ndarray], recall: float) -> int:
        """Walks that find items of n words, edited as far as allowed, of each kind of edit; 0 if the exact way must."""
        k = edits(n, self.rate)
        if not k:
            return 1
        if n > LONGEST:
            return 0
        rng, near, room = np.random.default_rng([5, n]), [], []
        of, group = [], []
        for kind in range(len(KINDS)):
            for trial in range(TRIALS):
                item = int(rng.integers(0, len(items)))
                other = edited(rng, items[item].tolist(), KINDS[kind], k)
                row = (other + rng.integers(1, 1 << 62, n).tolist())[:n]
                for ends in (False, True):
                    near.append(row)
                    room.append(min(len(other), n) if ends else n)
                    of.append(item)
                    group.append(2 * kind + ends)
        given, own = np.array(near, np.uint64).ravel(), np.concatenate(items)
        found, group, starts = np.zeros(len(near), bool), np.array(group), np.arange(len(near)) * n
        for walk in range(MOST_WALKS):
            one = range(walk, walk + 1)
            key = self.keys(own, np.arange(len(items)) * n, n, walks=one)[of]
            found |= (self.keys(given, starts, n, room=np.array(room), walks=one) == key).any(axis=1)
            if np.bincount(group, found).min() >= recall * TRIALS:
                return walk + 1
        return 0

    def _sharing(self, n: int, pair: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(item, from, to) for runs of the windows from:to and the n-word items of which a run has enough pairs."""
        pairs, number = self.exact[n]
        need = n - 1 - 2 * edits(n, self.rate)
        cut = np.flatnonzero(starts[1:] >= ends[:-1]) + 1
        for low, high in zip(np.concatenate([[0], cut]).tolist(), np.concatenate([cut, [len(starts)]]).tolist(), strict=True):
            run = pair[starts[low] : ends[high - 1] - 1]
            a, b = np.searchsorted(pairs, run, "left"), np.searchsorted(pairs, run, "right")
            each = b - a
            at = np.arange(each.sum()) + np.repeat(a - (np.cumsum(each) - each), each)
            items, times = np.unique(number[at], return_counts=True)
            for item in items[times >= need].tolist() if need > 0 else self.by_length[n]:
                yield item, low, high

    def screened(self, hashes: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For every item length the first words of windows that can match, and where each window ends."""
        n_words = len(hashes)
        if n_words == 0:
            return
        after = np.repeat(first[1:], np.diff(first))  # where each word's text ends
        pair = ngrams(hashes, 2)
        hit = self.common[(pair >> np.uint64(44)).astype(np.int64)]
        maybe = np.flatnonzero(hit)
        if len(maybe):
            place = np.minimum(np.searchsorted(self.pairs, pair[maybe]), max(len(self.pairs) - 1, 0))
            hit[maybe] = self.pairs[place] == pair[maybe]
        total = np.concatenate([[0], np.cumsum(hit)])
        word = np.arange(n_words)
        for n in self.by_length:
            k = edits(n, self.rate)
            if n - k > n_words:
                continue
            if n == 1:
                start = np.flatnonzero(np.isin(hashes, self.singles))
                yield n, start, start + 1
                continue
            start = word[: n_words - max(n - k, 1) + 1]
            end = np.minimum(start + n, after[: len(start)])
            fits = (end - start >= n - k) & (total[end - 1] - total[start] >= n - 1 - 2 * k)
            yield n, start[fits], end[fits]

    def matches(self, hashes: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(text, item, first word, words, distance) of all matches: of each region the best part, and others beside it."""
        regions, left = defaultdict(list), list(self.screened(hashes, first))
        edge = np.zeros(len(hashes) + 1, np.int64)
        pair = ngrams(hashes, 2) if self.exact else None
        for n, starts, ends in left:
            if n in self.exact:
                for item, low, high in self._sharing(n, pair, starts, ends) if len(starts) else ():
                    regions[item].extend(starts[low:high].tolist())
                continue
            np.add.at(edge, starts, 1)
            np.add.at(edge, ends, -1)
        covered = np.cumsum(edge[:-1]) > 0  # only the words of these windows are walked over
        near, rank, bits = hashes[covered], np.cumsum(covered) - 1, {}
        for n, starts, ends in left:
            if n in self.exact:
                continue
            table, number = self.tables[n]
            for low in range(0, len(starts), 50_000):
                part = starts[low : low + 50_000]
                keys = self.keys(near, rank[part], n, bits, ends[low : low + 50_000] - part)
                a, b = np.searchsorted(table, keys, "left"), np.searchsorted(table, keys, "right")
                row, column = np.nonzero(b > a)
                for r, c in zip(row.tolist(), column.tolist(), strict=True):
                    for item in number[a[r, c] : b[r, c]].tolist():
                        regions[item].append(int(part[r]))
        out = []
        for item, starts in regions.items():
            n, k = len(self.items[item]), edits(len(self.items[item]), self.rate)
            starts = np.unique(starts)
            text = np.searchsorted(first, starts, "right") - 1
            cut = np.flatnonzero((np.diff(starts) > n) | (np.diff(text) > 0)) + 1
            for part, own in zip(np.split(starts, cut), np.split(text, cut), strict=True):
                low, high = max(int(part[0]) - k, int(first[own[0]])), min(int(part[-1]) + n + k, int(first[own[0] + 1]))
                out += [(int(own[0]), item, at - int(first[own[0]]), length, distance) for at, length, distance in self._parts(item, k, hashes, low, high)]
        return sorted(out)

    def _parts(self, item: int, k: int, hashes: np.ndarray, low: int, high: int) -> Iterator[tuple[int, int, int]]:
        """(first word, words, distance) of the best part of a stretch within k edits of the item, then of what is left of it
        and right of it."""
        rest = [(low, high)]
        while rest:
            low, high = rest.pop()
            if high - low < max(len(self.items[item]) - k, 1):
                continue
            distance, at, length = edit_match(self.items[item], hashes[low:high])
            if distance <= k:
                yield low + at, length, distance
                if length:
                    rest += [(low, low + at), (low + at + length, high)]


def item_blocks(benchmark: DataFrame, rate: float = RATE, recall: float = RECALL, block_words: int = BLOCK_WORDS) -> Iterator[ItemBlock]:
    """The benchmark in blocks; one block at a time is on the driver."""
    ids, texts, size = [], [], 0
    ordered = benchmark.select("item_id", F.col("text").cast("string").alias("text")).where("text IS NOT NULL").distinct().orderBy("item_id", "text")
    for row in ordered.toLocalIterator():
        words = words_of(pa.array([row["text"]]), lower=True).hash
        if not len(words):
            continue
        ids.append(row["item_id"])
        texts.append(words)
        size += len(words)
        if size >= block_words:
            yield ItemBlock(ids, texts, rate, recall)
            ids, texts, size = [], [], 0
    if ids:
        yield ItemBlock(ids, texts, rate, recall)


def leaks(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, recall: float = RECALL, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, item_id, first_word, n_words, distance) of every part of a document that matches an item."""
    spark = ship(docs.sparkSession)
    item_type = dict(benchmark.dtypes)["item_id"]
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, number long, first_word long, n_words long, distance long"
    parts = []
    for block in item_blocks(benchmark, rate, recall, block_words):
        held = spark.sparkContext.broadcast(block)

        def run(batches, held=held):
            for batch in slices(batches):
                words = words_of(batch.column(1), lower=True)
                found = held.value.matches(words.hash, words.first)
                columns = list(zip(*found, strict=True)) or [()] * 5
                yield pa.record_batch([batch.column(0).take(pa.array(columns[0], pa.int64())), *(pa.array(c, pa.int64()) for c in columns[1:])],
                                      names=["doc_id", "number", "first_word", "n_words", "distance"])

        names = spark.createDataFrame([(i, x) for i, x in enumerate(block.ids)], f"number long, item_id {item_type}")
        found = given.mapInArrow(run, schema).join(F.broadcast(names), "number")  # a block's items are bounded
        parts.append(found.select("doc_id", "item_id", "first_word", "n_words", "distance"))
    if not parts:
        return spark.createDataFrame([], f"doc_id long, item_id {item_type}, first_word long, n_words long, distance long")
    return reduce(DataFrame.unionByName, parts)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, recall: float = RECALL) -> DataFrame:
    """The rows of docs that hold no item."""
    spark = ship(docs.sparkSession)
    rows = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    text = docs.columns.index("text")
    for block in item_blocks(benchmark, rate, recall):
        held = spark.sparkContext.broadcast(block)

        def run(batches, held=held):
            for batch in slices(batches, text=f"c{text}"):
                words = words_of(batch.column(text), lower=True)
                clean = np.ones(batch.num_rows, bool)
                clean[[m[0] for m in held.value.matches(words.hash, words.first)]] = False
                yield batch.filter(pa.array(clean))

        rows = rows.mapInArrow(run, rows.schema)
    return rows.toDF(*docs.columns)
