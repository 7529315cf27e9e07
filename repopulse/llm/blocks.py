"""Documents as blocks, and look-ups that a block makes of all others.

Several operators ask, for each of a document's words or passages, something about the whole corpus.
Sending every token through a shuffle would move many times the text. Instead the documents are
packed into compressed blocks of a few megabytes, each block asks once for each of its different
keys, a bucket of keys answers all blocks, and blocks meet their answers by block number. A key
that a third of all documents hold costs one record a block, never one a document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repopulse.llm.ship import ship
from repopulse.llm.words import text_buffer

BLOCK_BYTES = 4 << 20
#: Sorts before every id; stands for a missing one inside an operator.
NO_ID = -(1 << 63)

_BLOCK = "block long, payload binary"
MAIL = "bucket int, block long, payload binary"


def encode(arrays: list[np.ndarray], level: int = 1) -> bytes:
    """Arrays as one compressed payload."""
    batch = pa.record_batch([pa.array([a.tobytes()], pa.large_binary()) for a in arrays]
                            + [pa.array([a.dtype.str]) for a in arrays],
                            names=[f"c{i}" for i in range(2 * len(arrays))])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return zstandard.ZstdCompressor(level=level).compress(sink.getvalue())


def decode(payload: bytes) -> list[np.ndarray]:
    batch = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(payload)).read_next_batch()
    half = batch.num_columns // 2
    return [np.frombuffer(batch.column(i)[0].as_buffer(), batch.column(half + i)[0].as_py()) for i in range(half)]


def pack(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows (block, payload): doc ids and texts of about ``block_bytes``; a longer text is a block of its own.

    Block numbers come from partition and position; write the result before it is used twice.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def flush():
            ids = np.concatenate([h[0] for h in held])
            lengths = np.concatenate([np.diff(h[2]) for h in held])
            data = np.concatenate([h[1] for h in held])
            return pa.record_batch([pa.array([number], pa.int64()),
                                    pa.array([encode([ids, lengths, data], 3)], pa.binary())], names=["block", "payload"])

        for batch in batches:
            ids = np.asarray(batch.column(0).fill_null(NO_ID))
            data, offsets = text_buffer(batch.column(1))
            low = 0
            while low < len(ids):
                room = max(block_bytes - size, 0)
                high = int(np.searchsorted(offsets, offsets[low] + room, "right")) - 1
                high = min(high, len(ids))
                if high <= low and not held:
                    high = low + 1
                if high > low:
                    held.append((ids[low:high], data[offsets[low] : offsets[high]], offsets[low : high + 1]))
                    size += int(offsets[high] - offsets[low])
                if high < len(ids):  # the next text does not fit
                    yield flush()
                    held, size, number = [], 0, number + 1
                low = max(high, low)
        if held:
            yield flush()

    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, _BLOCK)


def unpack(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, bytes and offsets of a block."""
    ids, lengths, data = decode(payload)
    return ids, data, np.concatenate([[0], np.cumsum(lengths)])


def buckets_of(docs: DataFrame) -> int:
    """As many key buckets as the session has shuffle partitions."""
    return int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def bucket_order(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the keys by bucket and key, and the bounds of each bucket in it."""
    which = (keys >> np.uint64(40)) % np.uint64(buckets)
    order = np.lexsort((keys, which))
    return order, np.searchsorted(which[order], np.arange(buckets + 1))


def mail(blocks: DataFrame, ask: Callable[..., list[np.ndarray]], buckets: int) -> DataFrame:
    """Every block's questions: (bucket, block, payload).

    ``ask(ids, data, offsets, *answers)`` gives parallel arrays, the first of them different uint64
    keys; the order of the keys must be the same each time it is called.
    """

    def send(block, payload, answers):
        columns = ask(*unpack(payload), *answers)
        order, bounds = bucket_order(columns[0], buckets)
        columns = [c[order] for c in columns]
        for b in np.flatnonzero(np.diff(bounds)):
            yield int(b), block, encode([c[bounds[b] : bounds[b + 1]] for c in columns])

    return _per_block(blocks, send, MAIL)


def _rows(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


_SCHEMA = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("payload", pa.binary())])


def row(bucket: int, block: int, payload: bytes) -> pa.RecordBatch:
    """One record of ``MAIL``."""
    return _rows(_SCHEMA, [(bucket, block, payload)])


def _answers(cell) -> list:
    return [decode(x.as_buffer()) if x.is_valid else None for x in cell]


def _per_block(blocks: DataFrame, send, schema: str) -> DataFrame:
    """``send(block, payload, answers)`` for every block; blocks has (block, payload, answers array)."""
    has_answers = "answers" in blocks.columns

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                answers = _answers(batch.column(2)[i]) if has_answers else []
                for row in send(batch.column(0)[i].as_py(), batch.column(1)[i].as_buffer(), answers):
                    yield _rows(_SCHEMA, [row])

    return blocks.mapInArrow(run, schema)


def answer(letters: DataFrame, reply: Callable[..., tuple[list[np.ndarray], list[np.ndarray]]], buckets: int) -> DataFrame:
    """Answer all questions of a bucket together: (bucket, block, payload).

    ``reply(*columns)`` sees the bucket's records of all blocks, sorted by key, and gives parallel
    arrays to send back and totals; totals go out with block -1, one record a bucket.
    """

    def run(batches):
        bucket, block, sizes, parts = [], [], [], []
        for batch in batches:
            for i in range(batch.num_rows):
                columns = decode(batch.column(2)[i].as_buffer())
                bucket.append(batch.column(0)[i].as_py())
                block.append(batch.column(1)[i].as_py())
                sizes.append(len(columns[0]))
                parts.append(columns)
        if not parts:
            return
        columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
        del parts
        order = np.argsort(columns[0], kind="stable")
        back, totals = reply(*[c[order] for c in columns])
        out = []
        for c in back:
            placed = np.empty_like(c)
            placed[order] = c
            out.append(placed)
        ends = np.cumsum(sizes)
        for b, k, size, end in zip(bucket, block, sizes, ends, strict=True):
            yield _rows(_SCHEMA, [(b, k, encode([c[end - size : end] for c in out]))])
        if totals:
            yield _rows(_SCHEMA, [(bucket[0], -1, encode(totals))])

    return letters.repartitionById(buckets, "bucket").mapInArrow(run, MAIL)


def deliver(blocks: DataFrame, *replies: DataFrame) -> DataFrame:
    """Blocks with their answers: (block, payload, answers), one merged answer for each of ``replies``.

    One exchange by block; a block and its answers are a few megabytes however large the corpus is.
    """
    every = blocks.select("block", F.lit(-1).alias("kind"), F.lit(-1).alias("bucket"), "payload")
    for kind, reply in enumerate(replies):
        every = every.unionByName(reply.where("block >= 0").select("block", F.lit(kind).alias("kind"), "bucket", "payload"))
    every = every.repartition("block").sortWithinPartitions("block", "kind", "bucket")
    kinds = len(replies)

    def merge(parts):
        """Answers of all buckets in bucket order, which is the order the keys were sent in."""
        if not parts:
            return None
        columns = [np.concatenate(c) for c in zip(*[decode(p) for p in parts], strict=True)]
        return encode(columns)

    def run(batches):
        schema = pa.schema([("block", pa.int64()), ("payload", pa.binary()), ("answers", pa.list_(pa.binary()))])
        now, payload, answers = None, None, [[] for _ in range(kinds)]

        def row():
            return pa.record_batch([pa.array([now], pa.int64()), pa.array([payload], pa.binary()),
                                    pa.array([[merge(a) for a in answers]], pa.list_(pa.binary()))], schema=schema)

        for batch in batches:
            for i in range(batch.num_rows):
                block, kind = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                if block != now:
                    if payload is not None:
                        yield row()
                    now, payload, answers = block, None, [[] for _ in range(kinds)]
                if kind < 0:
                    payload = batch.column(3)[i].as_py()
                else:
                    answers[kind].append(batch.column(3)[i].as_py())
        if payload is not None:
            yield row()

    return every.mapInArrow(run, T.StructType([T.StructField("block", T.LongType()), T.StructField("payload", T.BinaryType()),
                                               T.StructField("answers", T.ArrayType(T.BinaryType()))]))


def placed(keys: np.ndarray, columns: list[np.ndarray], buckets: int) -> list[np.ndarray]:
    """Answers back in the order in which the block made its keys."""
    order, _ = bucket_order(keys, buckets)
    out = []
    for c in columns:
        a = np.empty_like(c)
        a[order] = c
        out.append(a)
    return out


def finish(blocks: DataFrame, make: Callable[..., pa.RecordBatch], schema: T.StructType) -> DataFrame:
    """``make(ids, data, offsets, *answers)`` gives each block's rows."""
    kinds = "answers" in blocks.columns

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                answers = _answers(batch.column(2)[i]) if kinds else []
                yield make(*unpack(batch.column(1)[i].as_buffer()), *answers)

    return blocks.mapInArrow(run, schema)
