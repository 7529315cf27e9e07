"""Bounded samples for fitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(n: int) -> Column:
    """crc32 of the doc_id as text, modulo n; a missing id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(n))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, max_chars: int) -> DataFrame:
    """(doc_id, text, y): for each label 0 and 1 the ``per_class`` rows that come first by a hash of doc_id.

    A doc_id labelled twice has its larger label. Texts over ``max_chars`` characters are not fitted on, so
    the sample has a proven size: 2 * per_class rows of at most max_chars characters.
    """
    marks = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col(label).cast("int")).alias("y")))
    marks = marks.join(docs.where(F.length("text").between(1, max_chars)).select(F.col("doc_id").cast("long").alias("doc_id")).distinct(), "doc_id", "left_semi")
    order = F.xxhash64("doc_id"), F.col("doc_id")
    first = [marks.where(F.col("y") == y).orderBy(*order).limit(per_class) for y in (0, 1)]
    chosen = F.broadcast(first[0].unionByName(first[1]))
    texts = docs.where(F.length("text").between(1, max_chars)).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.join(chosen, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("y").alias("y"))
