"""Subword ids of whole slices of texts, each different segment encoded once.

Both kinds of vocabulary have places that no token crosses, so a text's ids are the ids of its segments one
after the other. A slice of texts is cut at those places in one pass over its bytes, equal segments are found by
hash, the different ones are joined and given to the library in a few calls, and ids are gathered back.
Nothing is kept between slices, so memory does not grow with the vocabulary of the corpus.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa

from repopulse.llm.words import WHITE, hash_spans

#: Fixed value: the pattern of byte-level pre-tokenizing.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space of Unicode outside ASCII.
FAR_WHITE = [0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
SPACE = 0x20
CHUNK = 1 << 15


def default_vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def with_leading_space(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every text with one space before it."""
    return np.insert(data, offsets[:-1], SPACE), offsets + np.arange(len(offsets))


def gather(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """data[start:start + size] of every span, joined."""
    ends = np.cumsum(size)
    return data[np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)]


class _Segmented:
    """What both vocabularies share: distinct segments, joined calls, ids gathered back."""

    #: Bytes of every id, and how many they are.
    token_bytes: list[bytes]
    token_sizes: np.ndarray

    def _first_bytes(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        first = np.zeros(len(data), bool)
        first[offsets[:-1][np.diff(offsets) > 0]] = True
        return first

    def _marks(self, data: np.ndarray) -> np.ndarray:
        """Places that only the library itself knows how to cut at."""
        return np.zeros(0, np.int64)

    def _starts(self, data: np.ndarray, offsets: np.ndarray, marks: np.ndarray) -> np.ndarray:
        raise NotImplementedError

    def _distinct(self, data: np.ndarray, sizes: np.ndarray, marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the segments that follow one another in ``data``, joined, and the number of ids of each;
        -1 for one that does not round-trip."""
        raise NotImplementedError

    def _split(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Number of ids of each of the segments that were encoded in one call."""
        ends = np.concatenate([[0], np.cumsum(self.token_sizes[ids])])
        at = np.searchsorted(ends, np.concatenate([[0], np.cumsum(sizes)]))
        if at[-1] != len(ids) or (ends[at] != np.concatenate([[0], np.cumsum(sizes)])).any():
            raise ValueError("a token crosses a place where segments are cut")
        return np.diff(at)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other; ids of each text; which texts round-trip.

        A text that does not round-trip has no ids.
        """
        texts = len(offsets) - 1
        marks = self._marks(data)
        start = self._starts(data, offsets, marks)
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(texts, np.int64), np.ones(texts, bool)
        end = np.append(start[1:], len(data))
        text = np.searchsorted(offsets, start, "right") - 1
        _, place, inverse = np.unique(hash_spans(data, start, end), return_index=True, return_inverse=True)
        begin, sizes = start[place], (end - start)[place]
        marked = np.searchsorted(marks, begin) < np.searchsorted(marks, begin + sizes)
        flat, counts = self._distinct(gather(data, begin, sizes), sizes, marked)
        good = np.ones(texts, bool)
        good[text[(counts < 0)[inverse]]] = False
        counts = np.maximum(counts, 0)
        begin = (np.cumsum(counts) - counts)[inverse]
        each = counts[inverse] * good[text]
        per_text = np.bincount(text, weights=each, minlength=texts).astype(np.int64)
        return gather(flat, begin, each), per_text, good


def arrange(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Parts (segments, their joined ids, ids of each) in the order of the segments."""
    counts, begin, base = np.zeros(n, np.int64), np.zeros(n, np.int64), 0
    for which, ids, sizes in parts:
        counts[which] = sizes
        begin[which] = base + np.cumsum(np.maximum(sizes, 0)) - np.maximum(sizes, 0)
        base += len(ids)
    flat = np.concatenate([np.zeros(0, np.uint32), *[p[1] for p in parts]])
    return gather(flat, begin, np.maximum(counts, 0)), counts


class ByteBpe(_Segmented):
    """A byte-level vocabulary of the tokenizers library. Special tokens in a text are plain text if ``plain_specials``.

    Segments in Latin letters are merged by the same ranks in tiktoken, which gives the same ids in a quarter of the time;
    all others by the tokenizers library itself. A text with white space outside ASCII or with a special token's
    string, where a special token is meant, is one segment.
    """

    _loaded: dict[tuple[str, bool], ByteBpe] = {}

    def __init__(self, path: str, plain_specials: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        cut, model = rules["pre_tokenizer"], rules["model"]
        if (rules["normalizer"] or cut["type"] != "ByteLevel" or cut["add_prefix_space"] or not cut["use_regex"]
                or model["type"] != "BPE" or model.get("ignore_merges")):
            raise ValueError(f"{path} is no plain byte-level vocabulary")
        letters = byte_letters()
        ranks = {bytes(letters[c] for c in token): number for token, number in model["vocab"].items() if all(c in letters for c in token)}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [model["vocab"][a + b] for a, b in merges]
        if made != sorted(made) or made and made[0] < 256:
            raise ValueError(f"{path} merges in another order than its ids")
        far = [chr(c).encode() for c in FAR_WHITE]
        self.far = np.array([int.from_bytes(c) for c in far], np.uint32)
        self.leads = np.isin(np.arange(256), [c[0] for c in far])
        # Beyond ASCII only letters up to U+027F are joined: their classes are the same in every version of Unicode.
        self.strange = (np.arange(256) >= 0xCA) | (np.arange(256) == 0xC2)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_specials
        self.specials = [] if plain_specials else [t["content"].encode() for t in rules["added_tokens"]]
        self.size = self.tokenizer.get_vocab_size()
        self.fast = tiktoken.Encoding("plain", pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.token_bytes = [b""] * self.size
        for token, number in ranks.items():
            self.token_bytes[number] = token
        for token in rules["added_tokens"]:
            self.token_bytes[token["id"]] = token["content"].encode()
        self.token_sizes = np.array([len(t) for t in self.token_bytes], np.int64)

    @classmethod
    def load(cls, path: str, plain_specials: bool = False) -> ByteBpe:
        key = (path, plain_specials)
        if key not in cls._loaded:
            cls._loaded[key] = cls(*key)
        return cls._loaded[key]

    def _marks(self, data):
        at = [np.zeros(0, np.int64)]
        lead = np.flatnonzero(self.leads[data])
        if len(lead):
            padded = np.concatenate([data, np.zeros(2, np.uint8)]).astype(np.uint32)
            two = padded[lead] << 8 | padded[lead + 1]
            at.append(lead[np.isin(two, self.far) | np.isin(two << 8 | padded[lead + 2], self.far)])
        for special in self.specials:
            at.append(np.array([m.start() for m in re.finditer(re.escape(special), data.tobytes())], np.int64))
        return np.sort(np.concatenate(at))

    def _starts(self, data, offsets, marks):
        first, white = self._first_bytes(data, offsets), WHITE[data]
        before = np.zeros(len(data), bool)
        before[1:] = white[:-1]
        word_next = np.zeros(len(data), bool)
        word_next[:-1] = ~white[1:] & ~first[1:]
        start = first | white & (~before | word_next)
        for t in np.unique(np.searchsorted(offsets, marks, "right") - 1).tolist():
            start[offsets[t] + 1 : offsets[t + 1]] = False  # the whole text is one segment
        return np.flatnonzero(start)

    def _distinct(self, data, sizes, marked):
        end = np.cumsum(sizes)
        start = end - sizes
        strange = np.logical_or.reduceat(self.strange[data], start)
        joined = ~strange & ~marked & WHITE[data[start]] & ~WHITE[data[end - 1]]
        which, parts = np.flatnonzero(joined), []
        if len(which):
            text = gather(data, start[which], sizes[which]).tobytes().decode()
            ids = np.asarray(self.fast.encode_ordinary(text), np.uint32)
            parts.append((which, ids, self._split(ids, sizes[which])))
        rest = np.flatnonzero(~joined)
        if len(rest):
            texts = [data[a:b].tobytes().decode() for a, b in zip(start[rest].tolist(), end[rest].tolist(), strict=True)]
            made = [x.ids for x in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
            ids = np.array([i for m in made for i in m], np.uint32)
            parts.append((rest, ids, np.array([len(m) for m in made], np.int64)))
        return arrange(parts, len(start))


class PieceBpe(_Segmented):
    """A sentencepiece vocabulary with byte fallback, given texts that have the space which it adds itself."""

    _loaded: dict[str, PieceBpe] = {}

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(self.size)]
        longer = [p for p in pieces if len(p) > 1 and not p.startswith("<0x")]
        #: White space that no piece joins with what is next to it; a carriage return may be part of a piece.
        self.breaks = WHITE.copy()
        self.breaks[[SPACE, *{ord(c) for p in longer for c in p if c in "\t\n\v\f\r"}]] = False
        if not self.breaks[ord("\n")] or any(re.search("[^▁]▁", p) for p in longer):
            raise ValueError(f"{path} has pieces across white space")

        def raw(i: int) -> bytes:
            if self.model.is_byte(i):
                return bytes([int(pieces[i][3:-1], 16)])
            return b"" if self.model.is_control(i) or self.model.is_unknown(i) else pieces[i].replace("▁", " ").encode()

        self.token_bytes = [raw(i) for i in range(self.size)]
        self.token_sizes = np.array([len(t) for t in self.token_bytes], np.int64)
        probe = "  a\n  b "
        if b"".join(self.token_bytes[i] for i in self.model.encode(probe)) != f" {probe}".encode():
            raise ValueError(f"{path} changes white space")

    @classmethod
    def load(cls, path: str) -> PieceBpe:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def _starts(self, data, offsets, marks):
        space = data == SPACE
        before = np.zeros(len(data), bool)
        before[1:] = space[:-1]
        return np.flatnonzero(self._first_bytes(data, offsets) | self.breaks[data] | space & ~before)

    def _encode(self, texts: list[bytes]) -> list[list[int]]:
        """Ids of strings that start with white space; a line feed in front takes the space that the model adds."""
        return [ids[2:] for ids in self.model.encode(["\n" + t.decode() for t in texts], num_threads=1)]

    def _distinct(self, data, sizes, marked):
        end = np.cumsum(sizes)
        start = end - sizes
        joined = data[end - 1] != SPACE  # runs of spaces would merge with a next segment
        which, parts = np.flatnonzero(joined), []
        if len(which):
            at = np.concatenate([[0], np.cumsum(sizes[which])])
            borders = np.flatnonzero(np.diff(at[1:] // CHUNK, prepend=0)).tolist()
            edges = sorted({0, *borders, len(which)})
            text = gather(data, start[which], sizes[which]).tobytes()
            calls = [text[at[a] : at[b]] for a, b in zip(edges[:-1], edges[1:], strict=True)]
            for a, b, call, ids in zip(edges[:-1], edges[1:], calls, self._encode(calls), strict=True):
                if b"".join([self.token_bytes[i] for i in ids]) == call:
                    ids = np.asarray(ids, np.uint32)
                    parts.append((which[a:b], ids, self._split(ids, sizes[which[a:b]])))
                else:
                    joined[which[a:b]] = False
        rest = np.flatnonzero(~joined)
        if len(rest):
            texts = [data[a:b].tobytes() for a, b in zip(start[rest].tolist(), end[rest].tolist(), strict=True)]
            made = self._encode(texts)
            same = [b"".join([self.token_bytes[i] for i in m]) == t for m, t in zip(made, texts, strict=True)]
            ids = np.array([i for m, s in zip(made, same, strict=True) if s for i in m], np.uint32)
            parts.append((rest, ids, np.array([len(m) if s else -1 for m, s in zip(made, same, strict=True)], np.int64)))
        return arrange(parts, len(start))


def as_lists(ids: np.ndarray, counts: np.ndarray) -> pa.LargeListArray:
    """Ids of every text as an Arrow list column."""
    return pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int64()), pa.array(ids.astype(np.int32)))
