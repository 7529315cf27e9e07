"""Two tokenizers laid side by side over the same bytes, and how often each pair of their ids meets.

A text is encoded by both vocabularies. Where a token of each ends at the same byte the text is cut into groups;
tokens whose byte ranges overlap are linked. All of it is Arrow columns of a slice of documents: ids are lists,
flattened with the parent index of each; byte offsets are segmented cumulative sums; a hash join on
(document, end) finds the shared ends, and its outer rows in order of ends are the links themselves, since
between two neighbouring ends lies exactly one token of each side. ``Table.group_by`` counts in how many of a
slice's documents a pair of ids is linked; Spark adds these counts up over the corpus. Each slice then gets back
the count of each of its different pairs, one row a slice and pair however often it occurs there.

Results: a text that is missing, empty or not given back byte for byte by both vocabularies has no tokens: zeros and ''.
Missing doc_ids stay missing; rows that repeat a doc_id are documents each. No documents give no rows;
extra columns don't matter.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repopulse.llm.blocks import NO_ID, decode, encode
from repopulse.llm.ship import ship
from repopulse.llm.subwords import ByteBpe, PieceBpe, as_lists, default_vocabulary, with_leading_space
from repopulse.llm.words import slices, text_buffer
from repopulse.session import cut_lineage

#: Text of a block. Its joins take some hundred times that in memory.
SLICE_BYTES = 3 << 19
_BLOCK = "block long, payload binary, a array<int>, b array<int>, docs array<long>"
RESULT = T.StructType([T.StructField(n, T.LongType()) for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
                      + [T.StructField("groups", T.StringType())])
DIGEST = T.StructType([*RESULT.fields[:-1], T.StructField("groups_sha256", T.StringType())])


def tokens(ids: pa.LargeListArray, sizes: pa.Array) -> pa.Table:
    """One row a token: (doc, end, id), ``end`` being its last byte in its document; rows in order."""
    flat, doc = pc.list_flatten(ids), pc.list_parent_indices(ids)
    running = pc.cumulative_sum(sizes.take(flat))
    # What the documents before have: the sum at the last token before a document's first.
    before = pc.fill_null(pa.concat_arrays([pa.array([0], running.type), running]).take(ids.offsets.slice(0, len(ids))), 0)
    return pa.table({"doc": doc, "end": pc.subtract(running, before.take(doc)), "id": flat})


def links(a: pa.Table, b: pa.Table) -> pa.Table:
    """One row a link: (doc, end, at_a, at_b, shared): places of its tokens, and whether both end there."""
    left = a.select(["doc", "end"]).append_column("at_a", pa.array(np.arange(len(a))))
    right = b.select(["doc", "end"]).append_column("at_b", pa.array(np.arange(len(b))))
    both = left.join(right, ["doc", "end"], join_type="full outer", coalesce_keys=True, use_threads=False)
    both = both.take(pc.sort_indices(both, [("doc", "ascending"), ("end", "ascending")]))
    shared = pc.and_(pc.is_valid(both["at_a"]), pc.is_valid(both["at_b"]))
    return pa.table({"doc": both["doc"], "end": both["end"], "at_a": pc.fill_null_backward(both["at_a"]),
                     "at_b": pc.fill_null_backward(both["at_b"]), "shared": shared})


def _bounds(last: np.ndarray) -> pa.Array:
    """Offsets of the runs that end where ``last`` is true."""
    return pa.array(np.concatenate([[0], np.flatnonzero(last) + 1]), pa.int64())


def _text(mark: str) -> pa.Scalar:
    return pa.scalar(mark, pa.large_string())


def group_texts(a: pa.Table, b: pa.Table, link: pa.Table, docs: int) -> pa.Array:
    """Each document's groups as ``a1,a2|b1;a3|b2``."""
    shared = link.filter(link["shared"])
    sides = []
    for table, at in ((a, "at_a"), (b, "at_b")):
        last = np.zeros(len(table), bool)
        last[np.asarray(shared[at])] = True
        names = table["id"].cast(pa.string()).combine_chunks().cast(pa.large_string())
        sides.append(pc.binary_join(pa.LargeListArray.from_arrays(_bounds(last), names), _text(",")))
    groups = pc.binary_join_element_wise(*sides, _text("|"))
    per_doc = np.bincount(np.asarray(shared["doc"]), minlength=docs)
    return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per_doc)]), pa.int64()), groups), _text(";"))


def pair_counts(doc: pa.ChunkedArray, pair: pa.ChunkedArray) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """Different pairs, in how many documents each is, and the place of each link's pair among them."""
    coded = pair.combine_chunks().dictionary_encode()
    held = pa.table({"doc": doc, "code": coded.indices}).group_by(["doc", "code"], use_threads=False).aggregate([])
    counted = held.group_by("code", use_threads=False).aggregate([("doc", "count")])
    counts = np.zeros(len(coded.dictionary), np.int64)
    counts[np.asarray(counted["code"])] = np.asarray(counted["doc_count"])
    return coded.dictionary, pa.array(counts), np.asarray(coded.indices).astype(np.int32)


def align_blocks(docs: DataFrame, vocabulary_a: str, vocabulary_b: str, keep_text: bool) -> DataFrame:
    """Blocks of aligned documents, with the id pairs that each block links and in how many of its documents."""

    def run(batches):
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        a_side, b_side = ByteBpe.load(vocabulary_a, plain_specials=True), PieceBpe.load(vocabulary_b)
        sizes = [pa.array(side.token_sizes) for side in (a_side, b_side)]
        for batch in slices(batches, SLICE_BYTES):
            given, offsets = text_buffer(batch.column(1))
            data, ends = with_leading_space(given, offsets)
            coded = [side.encode(data, ends) for side in (a_side, b_side)]
            good = coded[0][2] & coded[1][2] & (np.diff(offsets) > 0)
            lists = [as_lists(ids[np.repeat(good, counts)], counts * good) for ids, counts, _ in coded]
            a, b = [tokens(ids, size) for ids, size in zip(lists, sizes, strict=True)]
            link = links(a, b)
            texts = group_texts(a, b, link, len(good))
            if not keep_text:
                texts = pa.array([hashlib.sha256(t.as_buffer()).hexdigest() if g else "" for t, g in zip(texts, good.tolist(), strict=True)])
            pair = pc.add(pc.multiply(a["id"].take(link["at_a"]).cast(pa.int64()), 1 << 32), b["id"].take(link["at_b"]).cast(pa.int64()))
            pairs, counts, codes = pair_counts(link["doc"], pair)
            text_data, text_offsets = text_buffer(texts)
            per_doc = [np.diff(np.asarray(ids.offsets)) for ids in lists]
            groups = np.bincount(np.asarray(link["doc"]), weights=np.asarray(link["shared"]), minlength=len(good)).astype(np.int64)
            linked = np.bincount(np.asarray(link["doc"]), minlength=len(good))
            payload = encode([np.asarray(batch.column(0).fill_null(NO_ID)), *per_doc, groups, linked, codes,
                              np.diff(text_offsets), text_data])
            pairs = np.asarray(pairs)
            row = [[block], [payload], [(pairs >> 32).astype(np.int32)], [(pairs & 0xFFFFFFFF).astype(np.int32)], [counts]]
            del coded, lists, a, b, link, pair, texts, codes
            yield pa.record_batch([pa.array(row[0], pa.int64()), pa.array(row[1], pa.binary()), *[pa.array(r, pa.list_(pa.int32())) for r in row[2:4]],
                                   pa.array(row[4], pa.list_(pa.int64()))], names=["block", "payload", "a", "b", "docs"])
            block += 1

    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text")).mapInArrow(run, _BLOCK)


def crosswalk(blocks: DataFrame) -> DataFrame:
    """(a, b, docs, best): in how many documents each pair of ids is linked, and whether no id is linked to ``a`` in more."""
    per_block = blocks.select(F.explode(F.arrays_zip("a", "b", "docs")).alias("p")).select("p.*")
    totals = cut_lineage(per_block.groupBy("a", "b").agg(F.sum("docs").alias("docs")), "id-pairs")
    most = totals.groupBy("a").agg(F.max("docs").alias("most"))
    # one row an id of the first vocabulary, so its size is bounded by the vocabulary
    return totals.join(F.broadcast(most), "a").select("a", "b", "docs", (F.col("docs") == F.col("most")).alias("best"))


def aligned(docs: DataFrame, vocabulary_a: str | None = None, vocabulary_b: str | None = None, keep_text: bool = True) -> DataFrame:
    """Counts of every document and its groups as text, or their SHA-256 if the text isn't kept."""
    blocks = cut_lineage(align_blocks(docs, vocabulary_a or default_vocabulary("byte_bpe_50k.json"),
                                      vocabulary_b or default_vocabulary("piece_bpe_32k.model"), keep_text), "aligned")
    asked = blocks.select("block", F.posexplode(F.arrays_zip("a", "b"))).select("block", "pos", "col.a", "col.b")
    told = asked.join(crosswalk(blocks), ["a", "b"]).groupBy("block").agg(F.collect_list(F.struct("pos", "docs", "best")).alias("told"))
    met = blocks.select("block", "payload").join(told, "block", "left").select(
        "payload", F.col("told.pos").alias("pos"), F.col("told.docs").alias("docs"), F.col("told.best").alias("best"))

    def finish(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                ids, n_a, n_b, groups, linked, codes, sizes, data = decode(batch.column(0)[i].as_buffer())
                pos, docs, best = (np.asarray(batch.column(c)[i].values) if batch.column(c)[i].is_valid else np.zeros(0, np.int64) for c in (1, 2, 3))
                count, is_best = np.zeros(len(pos), np.int64), np.zeros(len(pos), np.int64)
                count[pos], is_best[pos] = docs, best
                doc = np.repeat(np.arange(len(ids)), linked)
                sums = [np.zeros(len(ids), np.int64) for _ in range(2)]
                for out, values in zip(sums, (is_best, count), strict=True):
                    np.add.at(out, doc, values[codes])
                text = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [
                    None, pa.py_buffer(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)), pa.py_buffer(data)])
                yield pa.record_batch([pa.array(ids, mask=ids == NO_ID), *[pa.array(x) for x in (n_a, n_b, groups, linked, *sums)],
                                       text.cast(pa.large_string()).cast(pa.string())], names=schema.fieldNames())

    schema = RESULT if keep_text else DIGEST
    return met.mapInArrow(finish, schema)
