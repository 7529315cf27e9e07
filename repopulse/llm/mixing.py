"""Mixing sources to target weights by pivotal dependent rounding.

Every document gets a fractional number of copies, its source's target over its source's size. Whole copies
are taken as they are; the fractions are rounded in pairs: one document's fraction rises and the other's
falls by as many words, at random in such a way that expectations stay, until one of the two is whole. So the
words of a pair, hence of a source, never change. The longer of the two is mostly the one that stays open, so a few
documents of each length are held back, and at the source's end the last open document and those are rounded
together, long ones first, each to what the shorter ones can still make good: a source's taken words differ from
its target by about half of its shortest documents, where its lengths allow that.

Pairs are met along a reduction tree. Rows are dealt by hash into buckets of about ``BUCKET_ROWS`` rows of one source;
each bucket leaves one open row and ``HELD_BACK`` for each power of two of lengths; those of ``FAN_IN`` buckets meet in
the next level, and so on to the source's end. Random numbers are hashes of the rows, so reruns agree.

Results: sources in code point order, null last, have the weights in turn; a missing text has size 0; a document of
size 0 takes 0 words (its copies are rounded by themselves); repeated rows are rounded each; no documents, no rows.
Extra columns don't matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repopulse.llm.ship import ship
from repopulse.session import cut_lineage

WEIGHTS, SHARE, MOST_COPIES = (5, 2, 1), 1.5, 2
BUCKET_ROWS, FAN_IN, HELD_BACK = 2_000, 1_024, 2
#: Sources up to this number are broadcast; more are joined by shuffle.
FEW_SOURCES = 10_000


def word_count(text: Column) -> Column:
    words = F.array_remove(F.split(F.coalesce(text.cast("string"), F.lit("")), "[\\x20\\x09-\\x0D]+"), "")
    return F.size(words).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST_COPIES) -> DataFrame:
    """(source, source_size, target) from (source, source_size, rows), one row a source.

    What is above ``most`` times a source's size goes to the others by weight, until none is above.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    table = cut_lineage(sizes.withColumn("weight", weight), "mix-sources")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, None
    cap = F.col("source_size") * most
    while True:
        above = F.col("weight") * F.lit(level) >= cap
        full = table.agg(F.sum(F.when(above, cap).otherwise(0)), F.sum(F.when(above, 0).otherwise(F.col("weight"))), F.sum(above.cast("int"))).first()
        if full[2] == capped or not full[1]:
            break
        capped, level = full[2], (share * total - full[0]) / full[1]
    return table.withColumn("target", F.least(F.col("weight") * F.lit(float(level)), cap.cast("double")))


def _unit(key: int) -> float:
    """A number in [0, 1) that depends on the key only."""
    key = (key ^ (key >> 30)) * 0xBF58476D1CE4E5B9 & 0xFFFFFFFFFFFFFFFF
    key = (key ^ (key >> 27)) * 0x94D049BB133111EB & 0xFFFFFFFFFFFFFFFF
    return ((key ^ (key >> 31)) >> 11) / (1 << 53)


def pivot(chances: list[float], sizes: list[int], keys: list[int], close: float = 1e-9) -> tuple[list[float], int | None]:
    """Round chances in pairs. Gives the chances, all 0 or 1 but one at most, and the place of that one."""
    chances, left = list(chances), None
    for j, p in enumerate(chances):
        if sizes[j] == 0:
            chances[j] = float(_unit(keys[j]) < p)
            continue
        if p <= close or p >= 1 - close:
            chances[j] = float(round(p))
            continue
        if left is None:
            left = j
            continue
        i, a, b, q = left, sizes[left], sizes[j], chances[left]
        up, down = min(a * (1 - q), b * p), min(a * q, b * (1 - p))
        if _unit(keys[i] * 3 + keys[j]) * (up + down) < down:
            q, p = q + up / a, p - up / b
        else:
            q, p = q - down / a, p + down / b
        for k, x in ((i, q), (j, p)):
            chances[k] = float(round(x)) if x <= close or x >= 1 - close else x
        left = next((k for k in (i, j) if 0 < chances[k] < 1), None)
    return chances, left


def held_back(chances: list[float], sizes: list[int], keys: list[int]) -> list[int]:
    """Places of open rows to be rounded last: the first ``HELD_BACK`` by key of each power of two of sizes."""
    classes: dict[int, list[tuple[int, int]]] = {}
    for j, p in enumerate(chances):
        if sizes[j] and 0 < p < 1:
            classes.setdefault(sizes[j].bit_length(), []).append((keys[j], j))
    return sorted(j for own in classes.values() for _, j in sorted(own)[:HELD_BACK])


def settle(chances: list[float], sizes: list[int], places: list[int]) -> list[float]:
    """Round the rows at ``places`` so that their words come near what they sum to: long ones first, a row being taken if its
    words are still due, or if the shorter ones can't make them good as nearly."""
    chances, order = list(chances), sorted(places, key=lambda j: -sizes[j])
    due, rest = sum(chances[j] * sizes[j] for j in order), sum(sizes[j] for j in order)
    for j in order:
        rest -= sizes[j]
        take = due >= sizes[j] or due > rest and sizes[j] - due < due - rest
        chances[j] = float(take)
        due -= sizes[j] * take
    return chances


def round_group(chances: list[float], sizes: list[int], keys: list[int], last: bool) -> list[float]:
    """Pairs of a group rounded; what is held back and the last open row stay as they are, or are closed if ``last``."""
    held = held_back(chances, sizes, keys)
    kept = set(held)
    others = [j for j in range(len(chances)) if j not in kept]
    made, left = pivot([chances[j] for j in others], [sizes[j] for j in others], [keys[j] for j in others])
    out = list(chances)
    for j, x in zip(others, made, strict=True):
        out[j] = x
    return settle(out, sizes, held if left is None else [*held, others[left]]) if last else out


def _level(rows: DataFrame, group: list[str], last: bool) -> DataFrame:
    """Round the fractions of each group (``round_group``) and number its rows in ``_slot`` where they have no number yet.

    rows has group, _order, _size, _slot, chance; a group's rows are bounded by how they were dealt.
    """
    schema = rows.schema
    names = [f.name for f in schema]
    places = [names.index(g) for g in group]

    def run(batches):
        now, held = None, []

        def flush():
            batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            keys = [k & 0xFFFFFFFFFFFFFFFF for k in batch.column(names.index("_order")).to_pylist()]
            chances = round_group(batch.column(names.index("chance")).to_pylist(), batch.column(names.index("_size")).to_pylist(), keys, last)
            batch = batch.set_column(names.index("chance"), "chance", pa.array(chances, pa.float64()))
            if batch.column(names.index("_slot"))[0].as_py() < 0:
                batch = batch.set_column(names.index("_slot"), "_slot", pa.array(np.arange(batch.num_rows)))
            return batch

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = list(zip(*[batch.column(p).to_pylist() for p in places], strict=True))
            edges = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            for a, b in zip(edges, edges[1:], strict=False):
                if held and keys[a] != now:
                    yield flush()
                    held = []
                now = keys[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield flush()

    ship(rows.sparkSession)
    return rows.repartition(*group).sortWithinPartitions(*group, F.col("_size").desc(), "_order").mapInArrow(run, schema)


def _mixed(docs: DataFrame, keep: list[int], weights, share, most) -> DataFrame:
    """The columns of docs at the places ``keep`` as _0, _1, ..., then _size, _source_size, _target, _copies."""
    at = {c: f"c{docs.columns.index(c)}" for c in ("doc_id", "text", "source")}
    numbered = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    given = numbered.select(*(F.col(f"c{k}").alias(f"_{i}") for i, k in enumerate(keep)), F.col(at["source"]).cast("string").alias("_source"),
                            F.xxhash64(F.lit(17), at["doc_id"], F.coalesce(at["text"], F.lit(""))).alias("_order"), word_count(F.col(at["text"])).alias("_size"))
    per_source = numbered.groupBy(F.col(at["source"]).cast("string").alias("source")).agg(
        F.sum(word_count(F.col(at["text"]))).alias("source_size"), F.count("*").alias("rows"))
    table = targets(per_source, weights, share, most)
    facts = table.agg(F.count("*"), F.max("rows")).first()
    side = table.select(F.col("source").alias("_of"), F.col("source_size").alias("_source_size"), F.col("target").alias("_target"),
                        F.ceil(F.col("rows") / BUCKET_ROWS).cast("long").alias("_buckets"))
    side = F.broadcast(side) if facts[0] <= FEW_SOURCES else side
    wanted = F.when(F.col("_source_size") > 0, F.col("_target") / F.col("_source_size")).otherwise(F.lit(share))
    rows = given.join(side, F.col("_source").eqNullSafe(F.col("_of"))).drop("_of")
    rows = (rows.withColumn("_wanted", F.least(wanted, F.lit(float(most)))).withColumn("_whole", F.floor("_wanted").cast("int"))
            .withColumn("_bucket", F.pmod(F.xxhash64("_order", F.lit(3)), F.col("_buckets")))
            .withColumn("_slot", F.lit(-1).cast("long")).withColumn("chance", F.col("_wanted") - F.col("_whole")).drop("_wanted", "_buckets"))
    first = cut_lineage(_level(rows, ["_source", "_bucket"], last=False), "mix-rows")
    open_ = (F.col("chance") > 0) & (F.col("chance") < 1)
    left = first.where(open_).select("_source", "_bucket", F.col("_bucket").alias("_group"), "_order", "_size", "_slot", "chance")
    done, span = None, -(-(facts[1] or 0) // BUCKET_ROWS)
    while True:
        span = -(-span // FAN_IN)
        top = span <= 1
        level = cut_lineage(_level(left.withColumn("_group", F.floor(F.col("_group") / FAN_IN).cast("long")), ["_source", "_group"], last=top), "mix-level")
        whole = level.where(~open_).select("_source", "_bucket", "_slot", "chance")
        done = whole if done is None else done.unionByName(whole)
        if top:
            break
        left = level.where(open_)
    done = done.select(F.col("_source").alias("_s"), F.col("_bucket").alias("_b"), F.col("_slot").alias("_n"), F.col("chance").alias("_last"))
    joined = first.join(done, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_bucket") == F.col("_b")) & (F.col("_slot") == F.col("_n")), "left")
    copies = F.col("_whole") + F.when(open_, F.coalesce("_last", F.lit(0.0))).otherwise(F.col("chance")).cast("int")
    return joined.select(*(f"_{i}" for i in range(len(keep))), "_size", "_source_size", "_target", copies.alias("_copies"))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST_COPIES) -> DataFrame:
    """(doc_id, size, source_size, target, copies, taken) of every row."""
    made = _mixed(docs, [docs.columns.index("doc_id")], weights, share, most)
    return made.toDF("doc_id", "size", "source_size", "target", "copies").withColumn("taken", F.col("size") * F.col("copies"))


def mixed_documents(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST_COPIES) -> DataFrame:
    """The rows of docs, each as often as the mix takes it."""
    n = len(docs.columns)
    made = _mixed(docs, list(range(n)), weights, share, most).where("_copies > 0")
    repeated = made.withColumn("_again", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return repeated.select(*(f"_{i}" for i in range(n))).toDF(*docs.columns)
