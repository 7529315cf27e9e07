"""MinHash near-dedup with sequential Bayesian verification.

Documents are linked when the Jaccard similarity of their sets of distinct five-word shingles is at
least 85 %; a document's group is its connected component.

1. Every text becomes a set size, a 128-bit set key and a MinHash signature. Equal keys are equal sets:
   they form one class at once, so thousands of exact copies are one node from here on.
2. Signature bands name candidates. In each band bucket the nodes are compared with its smallest and its
   largest node only, so a bucket of any size gives two pairs a node.
3. Candidates are verified batch by batch of their signatures: after m compared values with c equal, a pair
   goes on while the posterior probability that its similarity reaches the threshold (uniform prior,
   a Beta(c + 1, m - c + 1)) is at least ``miss``. Survivors are decided on the full shingle sets.
4. Buckets whose nodes are still in different components are compared across components, in blocks of
   bounded size, by the same test; survivors are decided on full sets in the same task, and only links come
   out. So no link is left out for want of a partner, and no list of pairs is made.
5. Components by alternating large-star and small-star steps over node numbers.

With 25 bands of 5 values a pair at 85 % meets in no band with probability 4e-7; ``miss`` adds 1e-6 a
verified pair. Nodes are told apart by 64 bits, sets by 128.

Results: a text without words has an empty set and is linked with nothing; with fewer than five words the whole
sequence is one shingle; a missing doc_id sorts first and comes back as a missing id; rows that repeat a
doc_id are judged by their own text. Extra columns don't matter. Intermediate tables go to the shared folder.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repopulse.llm.blocks import NO_ID
from repopulse.llm.ship import ship
from repopulse.llm.words import Words, mix, ngram_rows, ngrams, slices, words_of
from repopulse.session import cut_lineage

SHINGLE, PERCENT = 5, 85
BANDS, ROWS = 25, 5
HASHES = BANDS * ROWS
BATCH = 25  # signature values compared before each look at the posterior
MISS = 1e-6
MEMBERS, BLOCK_SHINGLES = 256, 500_000  # nodes and shingles of a bucket in one block

_RANDOM = np.random.default_rng(85)
_FACTOR = _RANDOM.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSET = _RANDOM.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def shingles(words: Words, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, and the bounds of each text's."""
    grams, first = ngram_rows(words, n)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    counts = np.diff(words.first)
    for k in range(1, n):  # short texts: the whole sequence
        rows = np.flatnonzero(counts == k)
        if len(rows):
            run = ngrams(words.hash, k)
            grams = np.concatenate([grams, run[words.first[rows]]])
            row = np.concatenate([row, rows])
    order = np.lexsort((grams, row))
    grams, row = grams[order], row[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (row[1:] != row[:-1])
    grams, row = grams[new], row[new]
    return grams, np.searchsorted(row, np.arange(len(first)))


def _per_text(reduce, values: np.ndarray, first: np.ndarray, full: np.ndarray) -> np.ndarray:
    return reduce.reduceat(values, first[:-1][full])


def _describe(column):
    """Set size, set key and signature of every text of a column."""
    grams, first = shingles(words_of(column, lower=True))
    sizes = np.diff(first)
    full = np.flatnonzero(sizes)
    keys = np.zeros((len(full), 2), np.uint64)
    signature = np.zeros((len(full), HASHES), np.uint32)
    if len(full):
        for k in range(2):
            keys[:, k] = _per_text(np.add, mix(grams, k + 1), first, full)
        for k in range(HASHES):
            values = ((grams * _FACTOR[k] + _OFFSET[k]) >> np.uint64(32)).astype(np.uint32)
            signature[:, k] = _per_text(np.minimum, values, first, full)
    return sizes, full, keys, signature


def _binary(rows: np.ndarray, full: np.ndarray, n: int) -> pa.Array:
    out = [None] * n
    for i, row in zip(full.tolist(), rows, strict=True):
        out[i] = row.tobytes()
    return pa.array(out, pa.binary())


def text_mark() -> Column:
    """Tells apart the texts of rows that share a doc_id."""
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def profile(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, n_shingles, set_key, signature) of every row; key and signature are null for an empty set."""

    def run(batches):
        for batch in slices(batches, 2 << 20):
            sizes, full, keys, signature = _describe(batch.column(2))
            n = batch.num_rows
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), _binary(keys, full, n),
                                   _binary(signature, full, n)], names=["doc_id", "mark", "n_shingles", "set_key", "signature"])

    ship(docs.sparkSession)
    ids = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    return (docs.select(ids.alias("doc_id"), text_mark().alias("mark"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, mark long, n_shingles long, set_key binary, signature binary"))


def _matrix(column, dtype=np.uint32) -> np.ndarray:
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, dtype).reshape(len(column), -1)


def band_rows(nodes: DataFrame) -> DataFrame:
    """(band, node, n_shingles): one row for each of a node's bands."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                signature = _matrix(batch.column(1)).astype(np.uint64)
                bands = np.zeros((len(signature), BANDS), np.uint64)
                for k in range(ROWS):
                    bands = bands * np.uint64(0xD6E8FEB86659FD93) + signature[:, k::ROWS]
                bands = mix(bands + np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), 3)
                node = np.repeat(np.asarray(batch.column(0)), BANDS)
                size = np.repeat(np.asarray(batch.column(2)), BANDS)
                yield pa.record_batch([pa.array(bands.ravel().view(np.int64)), pa.array(node), pa.array(size)],
                                      names=["band", "node", "n_shingles"])

    return nodes.select("node", "signature", "n_shingles").mapInArrow(run, "band long, node long, n_shingles long")


def least_matches(compared: int, miss: float = MISS, percent: int = PERCENT) -> int:
    """Fewest equal values of ``compared`` that leave the posterior chance of a link at ``miss`` or more.

    P(Beta(c + 1, m - c + 1) >= t) is P(Binomial(m + 1, t) <= c).
    """
    t, total = percent / 100, 0.0
    for c in range(compared + 2):
        total += math.comb(compared + 1, c) * t**c * (1 - t) ** (compared + 1 - c)
        if total >= miss:
            return c
    return compared + 1


def _survives(left: np.ndarray, right: np.ndarray, miss: float) -> np.ndarray:
    """Sequential test of signature rows against each other."""
    alive, equal = np.arange(len(left)), np.zeros(len(left), np.int64)
    for low in range(0, HASHES, BATCH):
        equal[alive] += (left[alive, low : low + BATCH] == right[alive, low : low + BATCH]).sum(axis=1)
        alive = alive[equal[alive] >= least_matches(low + BATCH, miss)]
    out = np.zeros(len(left), bool)
    out[alive] = True
    return out


def likely_pairs(pairs: DataFrame, nodes: DataFrame, miss: float = MISS) -> DataFrame:
    """Pairs (a, b) that set sizes and the sequential test leave."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                keep = _survives(_matrix(batch.column(2)), _matrix(batch.column(3)), miss)
                yield pa.record_batch([batch.column(0).filter(pa.array(keep)), batch.column(1).filter(pa.array(keep))], names=["a", "b"])

    side = nodes.select("node", "n_shingles", "signature")
    a = side.select(F.col("node").alias("a"), F.col("n_shingles").alias("na"), F.col("signature").alias("sa"))
    b = side.select(F.col("node").alias("b"), F.col("n_shingles").alias("nb"), F.col("signature").alias("sb"))
    joined = pairs.join(a, "a").join(b, "b").where(100 * F.least("na", "nb") >= PERCENT * F.greatest("na", "nb"))
    return joined.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def candidate_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, grams): full shingle sets of the wanted (node, rep, mark) only."""

    def run(batches):
        for batch in slices(batches, 2 << 20):
            grams, first = shingles(words_of(batch.column(1), lower=True))
            sets = [grams[first[i] : first[i + 1]].tobytes() for i in range(batch.num_rows)]
            yield pa.record_batch([batch.column(0), pa.array(sets, pa.binary())], names=["node", "grams"])

    ids = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    texts = docs.select(ids.alias("rep"), text_mark().alias("mark"), F.col("text").cast("string").alias("text"))
    found = texts.join(wanted, ["rep", "mark"]).select("node", "text").mapInArrow(run, "node long, grams binary")
    return found.dropDuplicates(["node"])


def true_links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) whose full sets reach the threshold."""

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= PERCENT * (len(x) + len(y) - both))
            keep = pa.array(keep, pa.bool_())
            yield pa.record_batch([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    a = sets.select(F.col("node").alias("a"), F.col("grams").alias("ga"))
    b = sets.select(F.col("node").alias("b"), F.col("grams").alias("gb"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "ga", "gb").mapInArrow(run, "a long, b long")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that links reach, for every node that has a link.

    Large-star and small-star steps in turn until nothing changes; every step joins a node's links with
    their minimum, which is aggregated map-side first, so a hub with very many links is no single task's.
    """
    edges = cut_lineage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "star")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        after = cut_lineage(small, "star")
        changed = after.exceptAll(edges).unionByName(edges.exceptAll(after))
        if changed.isEmpty():
            break
        edges = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _links_in_block(own, component, size, signature, grams, miss):
    """Links between nodes of different components: each node of the left block against the right.

    Nodes that links of this block already join are not compared again, so at most one link a node comes out.
    """
    left, right = np.flatnonzero(own == own.min()), np.flatnonzero(own == own.max())
    _, label = np.unique(component, return_inverse=True)
    sets = [np.frombuffer(g, np.uint64) for g in grams]
    lengths = np.array([len(x) for x in sets])
    first = np.concatenate([[0], np.cumsum(lengths)])
    names, number = np.unique(np.concatenate(sets), return_inverse=True)
    held = np.zeros(len(names), bool)
    out = []
    for x in left.tolist():
        y = right[(right > x) | (own[right] != own[x])]
        y = y[label[y] != label[x]]
        y = y[100 * np.minimum(size[y], size[x]) >= PERCENT * np.maximum(size[y], size[x])]
        if len(y):
            y = y[_survives(np.broadcast_to(signature[x], (len(y), HASHES)), signature[y], miss)]
        if not len(y):
            continue
        held[number[first[x] : first[x + 1]]] = True
        bounds = np.cumsum(lengths[y]) - lengths[y]
        both = np.add.reduceat(held[np.concatenate([number[first[i] : first[i + 1]] for i in y.tolist()])].astype(np.int64), bounds)
        held[number[first[x] : first[x + 1]]] = False
        for i in y[100 * both >= PERCENT * (lengths[x] + lengths[y] - both)].tolist():
            if label[i] != label[x]:
                out.append((x, i))
                label[label == label[i]] = label[x]
    return out


def cross_links(members: DataFrame, nodes: DataFrame, sets: DataFrame, miss: float = MISS) -> DataFrame:
    """Links (a, b) between nodes that share a bucket and are in different components.

    members: (band, node, n_shingles, component) of buckets with several components. Buckets with the same nodes
    are compared once. A large bucket is cut into blocks of about MEMBERS nodes and BLOCK_SHINGLES shingles, and
    each pair of blocks is a key of its own; signatures and full sets meet there, and links alone come out.
    """
    shape = members.groupBy("band").agg(F.count("*").alias("size"), F.sum("n_shingles").alias("shingles"),
                                        F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("s1"),
                                        F.sum(F.xxhash64("node", F.lit(1)).cast("decimal(38,0)")).alias("s2"))
    chosen = shape.groupBy("size", "shingles", "s1", "s2").agg(F.min("band").alias("band"))
    blocks = F.greatest(F.ceil(F.col("size") / MEMBERS), F.least(F.col("size"), F.ceil(F.col("shingles") / BLOCK_SHINGLES))).cast("int")
    own = F.pmod(F.xxhash64("node", F.lit(2)), F.col("blocks")).cast("int")
    dealt = (members.join(chosen.select("band", blocks.alias("blocks")), "band").withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("band", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "component"))
    side = nodes.select("node", "n_shingles", "signature").join(sets, "node")
    dealt = dealt.join(side, "node").repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")

    def run(batches):
        now, held = None, []

        def flush():
            own, node, component, size, signature, grams = zip(*held, strict=True)
            found = []
            if len(set(component)) > 1:
                found = _links_in_block(np.array(own), np.array(component), np.array(size),
                                        np.frombuffer(b"".join(signature), np.uint32).reshape(len(held), HASHES), grams, miss)
            return pa.record_batch([pa.array([node[x] for x, _ in found], pa.int64()), pa.array([node[y] for _, y in found], pa.int64())],
                                   names=["a", "b"])

        for batch in batches:
            for band, i, j, *row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if (band, i, j) != now:
                    if held:
                        yield flush()
                    now, held = (band, i, j), []
                held.append(row)
        if held:
            yield flush()

    return dealt.select("band", "i", "j", "own", "node", "component", "n_shingles", "signature", "grams").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, miss: float = MISS) -> DataFrame:
    """(doc_id, mark, n_shingles, set_key, component_id, kept) of every row of docs.

    ``component_id`` is the smallest doc_id that links reach; ``kept`` marks the rows that have it.
    """
    described = cut_lineage(profile(docs), "near-profile")
    nodes = cut_lineage(
        described.where("set_key IS NOT NULL").groupBy("set_key")
        .agg(F.min(F.struct("doc_id", "mark")).alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature"))
        .select(F.xxhash64("set_key").alias("node"), "set_key", F.col("rep.doc_id").alias("rep"), F.col("rep.mark").alias("mark"),
                "n_shingles", "signature"), "near-nodes")
    bands = band_rows(nodes)
    shared = (bands.groupBy("band").agg(F.min("node").alias("low"), F.max("node").alias("high"))
              .where("low <> high"))
    members = cut_lineage(bands.join(shared, "band"), "near-members")
    stars = _ordered(members.select(F.col("node").alias("a"), F.explode(F.array("low", "high")).alias("b")))
    wanted = nodes.join(members.select("node").distinct(), "node").select("node", "rep", "mark")
    sets = cut_lineage(candidate_sets(docs, wanted), "near-sets")
    links = cut_lineage(true_links(likely_pairs(stars, nodes, miss), sets), "near-links")
    first = cut_lineage(components(links), "near-first")

    placed = members.select("band", "node", "n_shingles").join(first, "node", "left").withColumn("component", F.coalesce("component", "node"))
    open_bands = placed.groupBy("band").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("band")
    more = cut_lineage(cross_links(cut_lineage(placed.join(open_bands, "band"), "near-open"), nodes, sets, miss), "near-more")
    final = first if more.isEmpty() else components(links.unionByName(more))

    whole = nodes.select("node", "set_key", "rep").join(final, "node", "left").withColumn("component", F.coalesce("component", "node"))
    whole = cut_lineage(whole, "near-whole")
    smallest = whole.groupBy("component").agg(F.min("rep").alias("component_id"))
    labels = whole.join(smallest, "component").select("set_key", "component_id")
    ids = F.when(F.col("doc_id") != NO_ID, F.col("doc_id"))
    result = described.select("doc_id", "mark", "n_shingles", "set_key").join(labels, "set_key", "left")
    result = result.withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return result.select(ids.alias("doc_id"), "mark", "n_shingles", "set_key",
                         F.when(F.col("component_id") != NO_ID, F.col("component_id")).alias("component_id"),
                         (F.col("doc_id") == F.col("component_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, miss: float = MISS) -> DataFrame:
    """docs with one document of each group: the one with the smallest doc_id; a repeated row stays once."""
    judged = near_duplicates(docs, miss)
    kept = (judged.where("kept").groupBy(F.coalesce("doc_id", F.lit(NO_ID)).alias("_id"), F.coalesce("set_key", F.lit(b"")).alias("_set"))
            .agg(F.min("mark").alias("_mark")).select("_id", "_mark").distinct())
    marked = docs.select("*", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_id"), text_mark().alias("_mark"))
    return marked.dropDuplicates(["_id", "_mark"]).join(kept, ["_id", "_mark"], "left_semi").select(*docs.columns)
