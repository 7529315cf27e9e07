"""Token ids in flat binary files, with a minimal perfect hash index to every document.

A shard is a range of doc_ids in ascending order. Its payload file is a 16-byte header (magic, item size) and the raw
little-endian ids of its documents, one after the other, each document closed by the end id. Ids are two
bytes wide if the vocabulary allows, else four. Its index file maps a doc_id to a slot without
storing the keys in the hash: levels of bit arrays hold the keys that are alone at their hashed place, the rank of a key's bit is
its slot, and the slot has a 32-bit fingerprint of the key, its first record and its number of records.
A look-up costs a constant number of probes; a key that is not there fails its fingerprint (but for one
in four billion). Record offsets and doc_ids in order follow, so a shard can also be read through.

Texts are encoded word by word: the vocabulary never joins across white space, so a word's ids are the same in
every text, and each different word of a slice is encoded once. Texts are encoded where they are read; only packed
ids are sorted and written.

Files are written straight to the shared folder under a name of their own for each attempt; the manifest
names those of the attempts that finished, so a lost executor or a repeated task leaves no wrong file in use.

Results: a missing text is empty and has the end id only; missing doc_ids come first; rows that repeat a
doc_id are records one after the other under one key. Extra columns don't matter.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from repopulse.llm.blocks import NO_ID
from repopulse.llm.ship import ship
from repopulse.llm.subwords import arrange, byte_letters, gather
from repopulse.llm.words import mix, slices, text_buffer, words_in
from repopulse.session import cut_lineage, shared_path

END = 1
MAGIC = b"RPIDS\x00\x00\x01"
#: Bytes of text that a shard's ids stand for on average, above which there are more shards.
SHARD_BYTES = 128 << 20
#: Fixed value: the only pre-tokenizing pattern whose words may be cut here before the merges.
WORD_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_PIECES = re.compile(f"\r|'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u017f]+|[0-9]|[^a-z\u00df-\u00f6\u00f8-\u017f0-9\r]+")


class WordEncoder:
    """Ids of different words of a vocabulary with word ends; loaded once in a process.

    Words of Latin letters, digits and ASCII marks are cut into pieces here and merged by the same ranks in tiktoken,
    a line feed standing for the end of a piece; all others are encoded by the tokenizers library.
    """

    _loaded: dict[str, WordEncoder] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        rules = json.loads(self.tokenizer.to_str())
        model, letters = rules["model"], byte_letters()
        vocab = model["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [vocab[a + b] for a, b in merges]
        cut = json.dumps(rules["pre_tokenizer"], ensure_ascii=False).replace("\\\\", "\\")
        self.fast = None
        if (WORD_PATTERN in cut and model["end_of_word_suffix"] == "</w>" and not model["ignore_merges"] and made == sorted(made)
                and sorted(vocab[c] for c in letters) + sorted(vocab[c + "</w>"] for c in letters) == list(range(512)) and min(made) > 511):
            ranks = {bytes(letters[c] for c in t.removesuffix("</w>")) + b"\n" * t.endswith("</w>"): n for t, n in vocab.items()}
            self.fast = tiktoken.Encoding("words", pat_str=r"[^\n]*\n", mergeable_ranks=ranks, special_tokens={})
            self.stop = ranks[b"\r\n"]
        known = np.arange(256)
        #: Bytes that lead elsewhere than to U+00C0 .. U+017F.
        self.strange = (known >= 0xC6) | (known == 0xC2)

    @classmethod
    def load(cls, path: str) -> WordEncoder:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def distinct(self, data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words that follow one another in ``data``, joined, and the number of ids of each."""
        end = np.cumsum(sizes)
        start = end - sizes
        after = np.append(data[1:], 0)
        # the capital I with a dot becomes two letters, and "<|" may begin a special token
        odd = self.strange[data] | (data == 0xC4) & (after == 0xB0) | (data == ord("<")) & (after == ord("|"))
        plain = ~np.logical_or.reduceat(odd, start) if self.fast else np.zeros(len(sizes), bool)
        which, parts = np.flatnonzero(plain), []
        if len(which):
            n = sizes[which]
            joined = np.full(int(n.sum()) + len(n), ord("\r"), np.uint8)
            keep = np.ones(len(joined), bool)
            keep[np.cumsum(n + 1) - 1] = False
            joined[keep] = gather(data, start[which], n)
            pieces = _PIECES.findall(joined.tobytes().decode().lower())
            ids = np.asarray(self.fast.encode_ordinary("\n".join(pieces) + "\n"), np.uint32)
            stops = np.flatnonzero(ids == self.stop)
            parts.append((which, ids[ids != self.stop], np.diff(stops, prepend=-1) - 1))
        rest = np.flatnonzero(~plain)
        if len(rest):
            words = [data[a:b].tobytes().decode() for a, b in zip(start[rest].tolist(), end[rest].tolist(), strict=True)]
            made = [x.ids for x in self.tokenizer.encode_batch(words, add_special_tokens=False)]
            parts.append((rest, np.array([i for m in made for i in m], np.uint32), np.array([len(m) for m in made], np.int64)))
        return arrange(parts, len(sizes))


def encode_texts(column, encoder: WordEncoder, end: int = END) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, one after the other, each with the end id; and the number of ids of each text."""
    data, offsets = text_buffer(column)
    words = words_in(data, offsets)
    if not len(words.hash):
        return np.full(len(offsets) - 1, end, np.uint32), np.ones(len(offsets) - 1, np.int64)
    _, place, inverse = np.unique(words.hash, return_index=True, return_inverse=True)
    sizes = (words.end - words.start)[place]
    flat, counts = encoder.distinct(gather(data, words.start[place], sizes), sizes)
    each = counts[inverse]
    ahead = np.concatenate([[0], np.cumsum(each)])
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(words.first))
    out = np.full(int(ahead[-1]) + len(offsets) - 1, end, np.uint32)
    out[np.arange(ahead[-1]) + np.repeat(text, each)] = gather(flat, (np.cumsum(counts) - counts)[inverse], each)
    return out, ahead[words.first[1:]] - ahead[words.first[:-1]] + 1


class PerfectHash:
    """Different int64 keys to 0 .. n-1, by levels of bit arrays."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray, ranks: np.ndarray):
        self.sizes, self.words, self.ranks = sizes, words, ranks

    @classmethod
    def build(cls, keys: np.ndarray, spread: int = 2) -> PerfectHash:
        left, sizes, levels = keys.astype(np.int64).view(np.uint64), [], []
        while len(left):
            if len(sizes) > 200:
                raise ValueError("keys must differ")
            size = max(64, -(-spread * len(left) // 64) * 64)
            place = mix(left, 100 + len(sizes)) % np.uint64(size)
            alone = np.bincount(place.astype(np.int64), minlength=size) == 1
            sizes.append(size)
            levels.append(np.packbits(alone, bitorder="little"))
            left = left[~alone[place.astype(np.int64)]]
        words = np.concatenate([np.zeros(0, np.uint8), *levels]).view("<u8")
        counts = np.bitwise_count(words).astype(np.uint32)
        return cls(np.array(sizes, np.int64), words, (np.cumsum(counts) - counts).astype(np.uint32))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; of a strange key any slot, or -1."""
        keys = keys.astype(np.int64).view(np.uint64)
        out, left, base = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes.tolist()):
            place = (mix(keys[left], 100 + level) % np.uint64(size)).astype(np.int64) + base
            word, bit = self.words[place >> 6], (place & 63).astype(np.uint64)
            there = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            out[left[there]] = self.ranks[place[there] >> 6].astype(np.int64) + below[there]
            left, base = left[~there], base + size
            if not len(left):
                break
        return out


class ShardIndex:
    """Key to records of one shard's payload file."""

    FIELDS = ("sizes", "words", "ranks", "prints", "first", "records", "offsets", "ids")

    def __init__(self, **arrays):
        self.__dict__.update(arrays)
        self.hash = PerfectHash(self.sizes, self.words, self.ranks)

    @classmethod
    def build(cls, ids: np.ndarray, lengths: np.ndarray) -> ShardIndex:
        keys, first, records = np.unique(ids, return_index=True, return_counts=True)
        made = PerfectHash.build(keys)
        order = np.argsort(made.slots(keys))
        return cls(sizes=made.sizes, words=made.words, ranks=made.ranks, prints=cls.fingerprint(keys)[order],
                   first=first[order].astype(np.int64), records=records[order].astype(np.int64),
                   offsets=np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64), ids=ids.astype(np.int64))

    @staticmethod
    def fingerprint(keys: np.ndarray) -> np.ndarray:
        return (mix(keys.astype(np.int64).view(np.uint64), 99) >> np.uint64(32)).astype(np.uint32)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First record and number of records of each key; 0 records for a key that is not in the shard."""
        slot = self.hash.slots(keys)
        if not len(self.prints):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        there = (slot >= 0) & (self.prints[slot] == self.fingerprint(keys))
        return np.where(there, self.first[slot], 0), np.where(there, self.records[slot], 0)

    def dump(self) -> bytes:
        arrays = [np.ascontiguousarray(getattr(self, n)) for n in self.FIELDS]
        head = json.dumps([[n, a.dtype.str, len(a)] for n, a in zip(self.FIELDS, arrays, strict=True)]).encode()
        return len(head).to_bytes(8, "little") + head + b"".join(a.tobytes() for a in arrays)

    @classmethod
    def parse(cls, data: bytes) -> ShardIndex:
        at = 8 + int.from_bytes(data[:8], "little")
        arrays = {}
        for name, kind, n in json.loads(data[8:at]):
            arrays[name] = np.frombuffer(data, kind, n, at)
            at += arrays[name].nbytes
        return cls(**arrays)


def _write(uri: str):
    where, path = pafs.FileSystem.from_uri(uri)
    where.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return where.open_output_stream(path)


def read_bytes(uri: str, offset: int = 0, length: int | None = None) -> bytes:
    where, path = pafs.FileSystem.from_uri(uri)
    with where.open_input_file(path) as file:
        file.seek(offset)
        return file.read(length)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


_MANIFEST = "shard long, payload string, index string, low long, high long, n_docs long, n_ids long, width int"


def shard_starts(keys: DataFrame, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """The first (doc_id, row) of every shard but the first one; one row a shard comes to the driver."""
    ranged = keys.repartitionByRange(shards, "doc_id", "row").groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct("doc_id", "row")).alias("k"))
    found = sorted((r.k.doc_id, r.k.row) for r in ranged.collect())[1:]
    return np.array([f[0] for f in found], np.int64), np.array([f[1] for f in found], np.int64)


def shard_of(starts: tuple[np.ndarray, np.ndarray], ids: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The shard of each (doc_id, row); rows of one doc_id may be spread over several."""
    shard, same = np.searchsorted(starts[0], ids, "left"), np.searchsorted(starts[0], ids, "right")
    for key in np.unique(ids[same > shard]).tolist():  # doc_ids at which a shard begins
        own = ids == key
        low, high = np.searchsorted(starts[0], key, "left"), np.searchsorted(starts[0], key, "right")
        shard[own] = low + np.searchsorted(starts[1][low:high], rows[own], "right")
    return shard


def encode_documents(docs: DataFrame, vocabulary: str, starts: tuple[np.ndarray, np.ndarray], end: int = END) -> DataFrame:
    """(shard, doc_id, row, n, ids): the packed ids of every document, made where its text is read."""

    def run(batches):
        encoder = WordEncoder.load(vocabulary)
        width = np.dtype(f"<u{id_width(encoder, end)}")
        for batch in slices(batches):
            ids, sizes = encode_texts(batch.column(1), encoder, end)
            shard = shard_of(starts, np.asarray(batch.column(0)), np.asarray(batch.column(2)))
            bounds = np.concatenate([[0], np.cumsum(sizes)]) * width.itemsize
            packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(bounds), pa.py_buffer(ids.astype(width))])
            yield pa.record_batch([pa.array(shard.astype(np.int32)), batch.column(0), batch.column(2), pa.array(sizes), packed.cast(pa.binary())],
                                  names=["shard", "doc_id", "row", "n", "ids"])

    return docs.select("doc_id", "text", "row").mapInArrow(run, "shard int, doc_id long, row long, n long, ids binary")


def id_width(encoder: WordEncoder, end: int) -> int:
    return 2 if max(encoder.size, end + 1) <= 1 << 16 else 4


def write_shards(docs: DataFrame, vocabulary: str | None = None, folder: str | None = None, shards: int | None = None, end: int = END) -> DataFrame:
    """Encode and write all documents; gives the manifest: one row a shard, with ``start``, the ids before it.

    There are as many shards as shuffle partitions, or more so that one holds about ``SHARD_BYTES``.
    """
    spark = ship(docs.sparkSession)
    vocabulary = vocabulary or default_vocabulary()
    folder = folder or shared_path(spark, "token-files")
    ids = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id")
    # the row number spreads a doc_id that very many rows repeat over several shards
    given = docs.select(ids, F.col("text").cast("string").alias("text"), F.monotonically_increasing_id().alias("row"))
    if shards is None:
        size = given.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
        shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_BYTES))
    # found by the keys alone, so that ids are made once and moved once
    starts = shard_starts(given.select("doc_id", "row"), shards)

    def run(batches):
        from pyspark import TaskContext

        shard, name = TaskContext.get().partitionId(), uuid.uuid4().hex
        width = id_width(WordEncoder.load(vocabulary), end)
        payload, index = f"{folder}/{shard:06d}-{name}.ids", f"{folder}/{shard:06d}-{name}.idx"
        ids, lengths, out = [], [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                out = _write(payload)
                out.write(MAGIC + width.to_bytes(8, "little"))
            out.write(text_buffer(batch.column(2))[0].tobytes())
            ids.append(np.asarray(batch.column(0)))
            lengths.append(np.asarray(batch.column(1)))
        if out is None:
            return
        out.close()
        ids, lengths = np.concatenate(ids), np.concatenate(lengths)
        with _write(index) as file:
            file.write(ShardIndex.build(ids, lengths).dump())
        row = (shard, payload, index, int(ids[0]), int(ids[-1]), len(ids), int(lengths.sum()), width)
        yield pa.record_batch([pa.array([x]) if i < 7 else pa.array([x], pa.int32()) for i, x in enumerate(row)],
                              names=[f.split()[0] for f in _MANIFEST.split(", ")])

    encoded = encode_documents(given, vocabulary, starts, end)
    ordered = encoded.repartitionById(len(starts[0]) + 1, "shard").sortWithinPartitions("doc_id", "row")
    made = cut_lineage(ordered.select("doc_id", "n", "ids").mapInArrow(run, _MANIFEST), "token-manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return made.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))  # one row a shard


def read_shards(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every record, read back from the files through their index."""

    def run(batches):
        for batch in batches:
            for payload, index, width, start in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                raw = read_bytes(payload)
                if raw[:8] != MAGIC or int.from_bytes(raw[8:16], "little") != width:
                    raise ValueError(f"{payload} is no id file of width {width}")
                tokens = np.frombuffer(raw, f"<u{width}", offset=16)
                shard = ShardIndex.parse(read_bytes(index))
                keys, place = np.unique(shard.ids, return_index=True)
                first, records = shard.find(keys)
                if (first != place).any() or records.sum() != len(shard.ids):
                    raise ValueError(f"{index} doesn't fit its documents")
                record = np.arange(len(shard.ids))
                low, high = shard.offsets[record], shard.offsets[record + 1]
                sums = [zlib.crc32(tokens[a:b].astype("<u4").tobytes()) for a, b in zip(low.tolist(), high.tolist(), strict=True)]
                yield pa.record_batch([pa.array(shard.ids, mask=shard.ids == NO_ID), pa.array(start + low), pa.array(high - low),
                                       pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    spark: SparkSession = ship(manifest.sparkSession)
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (manifest.select("payload", "index", "width", "start").repartition(shards, "index")
            .mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def fetch(manifest: DataFrame, keys: DataFrame) -> DataFrame:
    """(doc_id, ids) of wanted doc_ids: each is looked up in the shards whose range holds it, and only its bytes are read."""
    spark = ship(manifest.sparkSession)
    files = sorted(tuple(r) for r in manifest.select("shard", "low", "high", "payload", "index", "width").collect())  # one row a shard
    low, high = np.array([f[1] for f in files], np.int64), np.array([f[2] for f in files], np.int64)
    places = spark.sparkContext.broadcast(files)

    def place(batches):
        for batch in batches:
            key = np.asarray(batch.column(0))
            a, b = np.searchsorted(high, key, "left"), np.searchsorted(low, key, "right")
            n = np.maximum(b - a, 0)
            shard = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(a, n)
            yield pa.record_batch([pa.array(shard, pa.int64()), pa.array(np.repeat(key, n), pa.int64())], names=["shard", "doc_id"])

    def run(batches):
        now, index = None, None
        for batch in batches:
            out = []
            for number, key in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                _, _, _, payload, path, width = places.value[number]
                if number != now:
                    now, index = number, ShardIndex.parse(read_bytes(path))
                first, records = index.find(np.array([key]))
                for r in range(int(first[0]), int(first[0] + records[0])):
                    a, b = int(index.offsets[r]), int(index.offsets[r + 1])
                    out.append((key, np.frombuffer(read_bytes(payload, 16 + width * a, width * (b - a)), f"<u{width}").tolist()))
            yield pa.record_batch([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.list_(pa.int64()))], names=["doc_id", "ids"])

    wanted = keys.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct()
    placed = wanted.mapInArrow(place, "shard long, doc_id long").repartition("shard").sortWithinPartitions("shard", "doc_id")
    return placed.mapInArrow(run, "doc_id long, ids array<long>")
