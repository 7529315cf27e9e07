"""Whole-column word arithmetic on Arrow text buffers.

A text column is handled as one byte array: words are found with table look-ups and hashed with
prefix sums, so no Python string is made per word. A word is a run of bytes that are no separator;
the separators of the contract, ``\\x20 \\x09-\\x0D``, are single bytes in UTF-8, so cutting bytes
equals cutting code points.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SEGMENT = 1 << 20  # bytes hashed at once
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
#: Everything in ASCII but letters and digits separates; bytes of other letters don't.
NON_WORD = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_BYTES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    done = 1
    while done < n:  # doubling: out[done:2*done] = out[:done] * base**done
        take = min(done, n - done)
        out[done : done + take] = out[:take] * np.uint64(pow(base, done, 1 << 64))
        done += take
    return out


_POWER = _powers(_BASE, SEGMENT + 1)
_INVERSE = _powers(pow(_BASE, -1, 1 << 64), SEGMENT + 1)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply), a bijection for every seed."""
    x = x ^ np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & _MASK)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


@dataclass
class Words:
    """Words of a batch of texts: ``hash``, byte span, and ``first[i]:first[i+1]`` are text i's words."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    prefix: np.ndarray | None = None

    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def spans(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word; a word never crosses two texts."""
    inside = ~separators[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    after = np.ones(len(data), bool)
    after[1:] = ~inside[:-1]
    start = np.flatnonzero(inside & (after | edge[:-1]))
    after[-1:] = True
    after[:-1] = ~inside[1:]
    end = np.flatnonzero(inside & (after | edge[1:])) + 1
    return start, end


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of data[start:end] for sorted spans that are disjoint."""
    out = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):
        low = int(start[i])
        j = int(np.searchsorted(end, low + SEGMENT, "right"))
        if j <= i:  # one word longer than a segment
            digest = hashlib.blake2b(data[low : int(end[i])].tobytes(), digest_size=8).digest()
            out[i] = int.from_bytes(digest, "little")
            i += 1
            continue
        part = data[low : int(end[j - 1])]
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTES[part] * _POWER[: len(part)], out=total[1:])
        a, b = start[i:j] - low, end[i:j] - low
        out[i:j] = mix((total[b] - total[a]) * _INVERSE[a] + (b - a).astype(np.uint64))
        i = j
    return out


def words_of(column, lower: bool = False, separators: np.ndarray = WHITE, prefix: int = 0) -> Words:
    """Words of every text of an Arrow column; ``lower`` folds A-Z only.

    ``prefix`` also hashes the first so many bytes of every word.
    """
    data, offsets = text_buffer(column)
    if lower:
        data = LOWER[data]
    return words_in(data, offsets, separators, prefix)


def words_in(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = WHITE, prefix: int = 0) -> Words:
    start, end = spans(data, offsets, separators)
    first = np.searchsorted(start, offsets)
    heads = hash_spans(data, start, np.minimum(end, start + prefix)) if prefix else None
    return Words(hash_spans(data, start, end), start, end, first, heads)


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n neighbours; order counts. Runs over text borders are the caller's to drop."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    for i in range(n):
        out = out * np.uint64(0xD6E8FEB86659FD93) + hashes[i : len(hashes) - n + 1 + i]
    return mix(out, n)


def ngram_rows(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-word runs inside each text, and the bounds of each text's runs."""
    counts = np.diff(words.first)
    runs = np.maximum(counts - n + 1, 0)
    first = np.concatenate([[0], np.cumsum(runs)])
    if not first[-1]:
        return np.zeros(0, np.uint64), first
    every = ngrams(words.hash, n)
    position = np.arange(first[-1]) + np.repeat(words.first[:-1] - first[:-1], runs)
    return every[position], first


def slices(batches: Iterator[pa.RecordBatch], max_bytes: int = 4 << 20, text: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about so much text; a longer text stays whole, alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        offsets = text_buffer(batch.column(batch.schema.get_field_index(text)))[1]
        low = 0
        while low < batch.num_rows:
            high = int(np.searchsorted(offsets, offsets[low] + max_bytes, "right")) - 1
            high = min(max(high, low + 1), batch.num_rows)
            yield batch.slice(low, high - low)
            low = high
        del batch
        pa.default_memory_pool().release_unused()  # a worker keeps no more than it needs
