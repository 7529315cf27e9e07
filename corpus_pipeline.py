"""From documents to token files: quality rules, near-dedup, decontamination, mixing, token ids.

Each stage takes (spark, docs, sf_dir), docs being what the stage before it left, and returns a DataFrame; all but
the last return the columns of documents, so rows that a stage rejects are gone and the mix repeats the
rows that it takes twice. ``run`` writes each stage's result to the shared folder and reads it again.

Results: a missing or empty text fails the base rules of quality; of rows that repeat text and id one stays in near-dedup;
rows without an id are documents like others, their records come first in the token files; a missing source is a
source of its own. Extra columns stay as they are up to the mix. No documents give no rows in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from repopulse.llm import decontamination, line_quality, mixing, near_dedup, token_files
from repopulse.session import cut_lineage


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and have mostly content lines."""
    return line_quality.drop_boilerplate(docs, line_quality.fit_field(docs, _table(spark, sf_dir, "labels")))


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return near_dedup.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontamination.drop_leaks(docs, _table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target wants it."""
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: one row for each copy of a document."""
    return token_files.read_shards(token_files.write_shards(docs))


STAGES = [("quality rules", quality), ("near-dedup", dedup), ("decontamination", decontaminate), ("mixing", mix), ("token ids", tokens)]
#: SQL has neither the line field nor the vocabulary.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, from the documents table."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
