"""Training sequences of one length, every one filled to the sources' target proportions.

All documents of a source are one queue of tokens. A deficit round-robin serves the queues: at every sequence a
source's deficit grows by its share of the sequence, the largest deficits are served first, and what a source was
served too little or too much stays on its account for the next sequence. Small sources thus wait until they may
add a piece worth cutting for, and proportions hold over a few sequences instead of being forced on each one.

The queues are cut into chunks at places that the targets alone decide (``Schedule``), so a chunk knows its
tokens, its first position in the packed stream and the deficits that the chunk before leaves, without
waiting for it. Chunks are packed side by side; a sequence that a chunk leaves unfinished is finished by the next.
One chunk holds about a million tokens however the documents lie: a source with a third of all rows is a
third of each chunk, a very long document is spread over many.

Results: every id of every document is in one piece and sequences have no gaps. A missing text is empty and has the end
id only; a missing source is a source of its own; rows that repeat a doc_id are packed each; no documents
give no pieces. Extra columns don't matter. Only the last tokens, fewer than a sequence, have shorter
sequences, one for each power of two in their number.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repopulse.llm.ship import ship
from repopulse.llm.subwords import ByteBpe, default_vocabulary
from repopulse.llm.words import slices, text_buffer
from repopulse.session import cut_lineage

WINDOW = 2048
END = 1
CHUNK_TOKENS = 1 << 20
#: A source waits until it may add so many tokens, unless a document or a queue ends before.
LEAST_PIECE = 128
#: The table of the sources is in memory everywhere: 24 bytes and the name of each.
MOST_SOURCES = 1_000_000

_ENCODED = "doc_id long, source string, task long, at long, n long, ids binary"
_PARTS = "chunk long, queue int, at long, doc_id long, start long, doc_tokens long, ids binary"
_PIECES = "doc_id long, start long, length long, doc_tokens long, source string, sequence_id long, offset long, ids binary"


class Schedule:
    """How far every queue has been served when a chunk begins.

    Queue s is served ``weights[s]`` tokens a unit of time until it is empty; chunks are equal shares of all tokens.
    """

    def __init__(self, totals: np.ndarray, weights: np.ndarray, chunks: int):
        self.totals, self.weights, self.chunks = totals.astype(np.float64), weights.astype(np.float64), chunks
        self.times = np.concatenate([[0.0], np.unique(self.totals / self.weights)])
        self.sums = np.array([np.minimum(self.totals, self.weights * t).sum() for t in self.times])

    def _time(self, chunk: np.ndarray) -> np.ndarray:
        return np.interp(self.sums[-1] * (chunk / self.chunks), self.sums, self.times)

    def served(self, queue: np.ndarray, chunk: np.ndarray) -> np.ndarray:
        """Tokens that the queue has given before the chunk."""
        due = np.floor(np.minimum(self.totals[queue], self.weights[queue] * self._time(chunk)))
        return np.where(chunk >= self.chunks, self.totals[queue], due).astype(np.int64)

    def chunk_of(self, queue: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The chunk that takes the token at each place of a queue."""
        done = np.interp(at / self.weights[queue], self.times, self.sums)
        chunk = np.clip((done / self.sums[-1] * self.chunks).astype(np.int64), 0, self.chunks - 1)
        while (late := self.served(queue, chunk) > at).any():
            chunk = chunk - late
        while (early := self.served(queue, chunk + 1) <= at).any():
            chunk = chunk + early
        return chunk

    def chunk(self, number: int) -> tuple[int, np.ndarray, np.ndarray]:
        """First position of a chunk, its tokens of each queue, and the deficits at its start."""
        every = np.arange(len(self.totals))
        begin = self.served(every, np.full(len(every), number))
        due = np.minimum(self.totals, self.weights * self._time(np.array(number)))
        return int(begin.sum()), self.served(every, np.full(len(every), number + 1)) - begin, due - begin


def sequence_borders(total: int, window: int, low: int, high: int) -> np.ndarray:
    """Ends of the sequences that cross ``low`` to ``high``; the last tokens have one for each power of two."""
    whole = total // window * window
    ends = np.arange(low // window + 1, min(high, whole) // window + 1) * window
    if high <= whole:
        return ends if len(ends) and ends[-1] >= high else np.append(ends, (high + window - 1) // window * window)
    rest = [1 << b for b in range(window.bit_length(), -1, -1) if (total - whole) >> b & 1]
    tail = whole + np.cumsum(rest)
    return np.concatenate([ends, tail[tail > low]]).astype(np.int64)


def sequence_of(total: int, window: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and place in it of each position of the packed stream."""
    whole = total // window * window
    tail = sequence_borders(total, window, whole, total) if total > whole else np.zeros(0, np.int64)
    starts = np.concatenate([[whole], tail[:-1]]) if len(tail) else np.array([whole])
    late = np.searchsorted(starts, at, "right") - 1
    inside = at < whole
    return (np.where(inside, at // window, whole // window + late), np.where(inside, at % window, at - starts[np.maximum(late, 0)]))


def round_robin(position: int, tokens: np.ndarray, deficits: np.ndarray, borders: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Serve all of a chunk's tokens: (queue, tokens, position) in the order of the stream."""
    left, owed = tokens.astype(np.int64).copy(), deficits.astype(np.float64).copy()
    served, end = [], position + int(left.sum())
    share = left / max(left.sum(), 1)
    for border in borders.tolist():
        room = min(border, end) - position
        if room <= 0:
            continue
        owed += room * share
        order = np.argsort(-owed, kind="stable").tolist()
        for last in (False, True):  # first what is due in pieces worth cutting for, then whatever fills the sequence
            for q in order:
                if not room:
                    break
                due = min(int(owed[q]) if not last else room, int(left[q]), room)
                if due <= 0 or not last and due < least and due < left[q]:
                    continue
                served.append((q, due, position))
                position, room = position + due, room - due
                left[q] -= due
                owed[q] -= due
    return served


def encode(docs: DataFrame, vocabulary: str | None = None, end: int = END, source: str = "source") -> DataFrame:
    """Ids of every document with its end id, and the tokens of its source before it in its task's share of the table."""
    spark = ship(docs.sparkSession)
    vocabulary = vocabulary or default_vocabulary("byte_bpe_50k.json")

    def run(batches):
        from pyspark import TaskContext

        task, encoder, before = TaskContext.get().partitionId(), ByteBpe.load(vocabulary), {}
        width = np.dtype("<u2") if max(encoder.size, end + 1) <= 1 << 16 else np.dtype("<u4")
        for batch in slices(batches):
            ids, counts, _ = encoder.encode(*text_buffer(batch.column(1)))
            n = counts + 1
            ends = np.cumsum(n)
            flat = np.full(int(ends[-1]), end, width)
            keep = np.ones(len(flat), bool)
            keep[ends - 1] = False
            flat[keep] = ids
            names = batch.column(2).dictionary_encode()
            code = np.asarray(names.indices.fill_null(len(names.dictionary)))
            labels = [*names.dictionary.to_pylist(), None]
            at = np.zeros(len(n), np.int64)
            for c in np.unique(code).tolist():
                own = code == c
                at[own] = before.get(labels[c], 0) + np.cumsum(n[own]) - n[own]
                before[labels[c]] = before.get(labels[c], 0) + int(n[own].sum())
            lists = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(n), [
                None, pa.py_buffer(np.concatenate([[0], ends]) * width.itemsize), pa.py_buffer(flat)])
            yield pa.record_batch([batch.column(0), batch.column(2), pa.array(np.full(len(n), task)), pa.array(at), pa.array(n),
                                   lists.cast(pa.binary())], names=["doc_id", "source", "task", "at", "n", "ids"])

    label = F.col(source) if source in docs.columns else F.lit(None)
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                        label.cast("string").alias("source"))
    return given.mapInArrow(run, _ENCODED)


def pack(docs: DataFrame, weights: dict[str | None, float] | None = None, vocabulary: str | None = None, window: int = WINDOW,
         end: int = END, chunk_tokens: int = CHUNK_TOKENS, least_piece: int = LEAST_PIECE, source: str = "source") -> DataFrame:
    """Pieces of all documents in sequences of ``window`` tokens, ``ids`` as little-endian unsigned 32-bit integers.

    ``weights`` are the target proportions of the sources (1 where a source isn't named) until a source is used
    up; without them every sequence gets the proportions of the whole corpus, so all sources last to the end.
    """
    spark = docs.sparkSession
    encoded = cut_lineage(encode(docs, vocabulary, end, source), "encoded")
    per_task = cut_lineage(encoded.groupBy("source", "task").agg(F.sum("n").alias("n")), "task-tokens")
    per_source = per_task.groupBy("source").agg(F.sum("n").alias("n")).limit(MOST_SOURCES + 1).collect()
    if len(per_source) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources; pack by a coarser column")
    if not per_source:
        return spark.createDataFrame([], _PIECES)
    rows = sorted(((r.source, r.n) for r in per_source), key=lambda r: (r[0] is None, r[0] or ""))
    names = [r[0] for r in rows]
    totals = np.array([r[1] for r in rows], np.int64)
    total = int(totals.sum())
    rates = np.array([1.0 if weights is None else weights.get(s, 1.0) for s in names])
    if not (np.isfinite(rates) & (rates > 0)).all():
        raise ValueError("weights must be above 0")
    plan = spark.sparkContext.broadcast(
        (Schedule(totals, totals if weights is None else rates, -(-total // chunk_tokens)), names, {s: i for i, s in enumerate(names)}))

    earlier = Window.partitionBy("source").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = per_task.select(F.col("source").alias("_source"), F.col("task").alias("_task"),
                           F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    placed = encoded.join(base, encoded.source.eqNullSafe(base._source) & (encoded.task == base._task)).select(
        "doc_id", "source", (F.col("at") + F.col("base")).alias("at"), "n", "ids")

    def cut(batches):
        """Documents cut where chunks begin."""
        schedule, _, number = plan.value
        for batch in batches:
            if not batch.num_rows:
                continue
            queue = np.array([number[s] for s in batch.column(1).to_pylist()], np.int64)
            at, n = np.asarray(batch.column(2)), np.asarray(batch.column(3))
            first, last = schedule.chunk_of(queue, at), schedule.chunk_of(queue, at + n - 1)
            parts = last - first + 1
            doc = np.repeat(np.arange(len(n)), parts)
            chunk = first[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
            low = np.maximum(schedule.served(queue[doc], chunk), at[doc])
            high = np.minimum(schedule.served(queue[doc], chunk + 1), (at + n)[doc])
            keep = high > low
            doc, chunk, low, high = doc[keep], chunk[keep], low[keep], high[keep]
            data, offsets = text_buffer(batch.column(4))
            width = (offsets[-1] - offsets[0]) // max(int(n.sum()), 1)
            bounds = np.concatenate([[0], np.cumsum(high - low)]) * width
            ids = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(doc), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
            yield pa.record_batch([
                pa.array(chunk), pa.array(queue[doc].astype(np.int32)), pa.array(low), batch.column(0).take(pa.array(doc)),
                pa.array(low - at[doc]), pa.array(n[doc]), ids.cast(pa.binary())],
                names=["chunk", "queue", "at", "doc_id", "start", "doc_tokens", "ids"])

    def fill(batches):
        """The pieces of each chunk; a chunk's parts are neighbours, by queue and place in it."""
        schedule, names, _ = plan.value
        now, held = None, []

        def pieces():
            table = pa.Table.from_batches(held).combine_chunks()
            position, tokens, deficits = schedule.chunk(now)
            queue, starts, doc_tokens = (np.asarray(table[c]) for c in ("queue", "start", "doc_tokens"))
            data, offsets = text_buffer(table["ids"])
            width = 2 if len(data) == 2 * tokens.sum() else 4
            ends = offsets[1:] // width
            sums = np.bincount(queue, weights=np.diff(offsets) // width, minlength=len(tokens)).astype(np.int64)
            if (sums != tokens).any():
                raise ValueError(f"chunk {now} doesn't hold its share of the queues")
            served = np.array(round_robin(position, tokens, deficits,
                                          sequence_borders(total, window, position, position + int(tokens.sum())), least_piece), np.int64)
            served = served[np.lexsort((served[:, 2], served[:, 0]))]  # by queue, as the parts lie
            serve_ends = np.cumsum(served[:, 1])
            cuts = np.union1d(ends, serve_ends)
            begin = np.concatenate([[0], cuts[:-1]])
            part, serve = np.searchsorted(ends, begin, "right"), np.searchsorted(serve_ends, begin, "right")
            at = served[serve, 2] + begin - (serve_ends - served[:, 1])[serve]
            sequence, offset = sequence_of(total, window, at)
            flat = data.view(f"<u{width}").astype("<u4")
            bounds = np.concatenate([[0], cuts]).astype(np.int32) * 4
            return pa.record_batch([
                table["doc_id"].combine_chunks().take(pa.array(part)), pa.array(starts[part] + begin - (ends - np.diff(offsets) // width)[part]),
                pa.array(cuts - begin), pa.array(doc_tokens[part]), pa.array(names, pa.string()).take(pa.array(queue[part])),
                pa.array(sequence), pa.array(offset),
                pa.BinaryArray.from_buffers(pa.binary(), len(cuts), [None, pa.py_buffer(bounds), pa.py_buffer(flat)])],
                names=["doc_id", "start", "length", "doc_tokens", "source", "sequence_id", "offset", "ids"])

        for batch in batches:
            chunk = np.asarray(batch.column(0))
            edges = np.flatnonzero(np.diff(chunk, prepend=-1, append=-1)) if len(chunk) else []
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                if chunk[low] != now and held:
                    yield pieces()
                    held = []
                now = int(chunk[low])
                held.append(batch.slice(low, high - low))
        if held:
            yield pieces()

    parts = placed.mapInArrow(cut, _PARTS).repartition("chunk").sortWithinPartitions("chunk", "queue", "at")
    return parts.mapInArrow(fill, _PIECES)


def assemble(pieces: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, ids): the pieces of each sequence joined; a sequence is never longer than the window."""
    rows = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    return pieces.groupBy("sequence_id").agg(rows.alias("rows"), F.sum("length").alias("n_tokens")).select(
        "sequence_id", "n_tokens", F.aggregate("rows", F.lit(b""), lambda a, r: F.concat(a, r["ids"])).alias("ids"))
