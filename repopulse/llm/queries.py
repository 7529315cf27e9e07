"""One query for each operator over its whole table, and DuckDB SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repopulse.llm import (crosswalk, decontamination, line_quality, lm_scoring, mixing, near_dedup, packing, periodic_runs, preferences,
                           substring_dedup, token_files, toxicity, url_filter)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words cut from every document because an earlier one holds them in a 13-word run."""
    cut = substring_dedup.cut_repeats(_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix takes."""
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


@query
def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part of a document within the edit distance of a benchmark item; only contaminated documents have rows."""
    return decontamination.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@query
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids as the written files hold them."""
    return token_files.read_shards(token_files.write_shards(_table(spark, sf_dir, "documents")))


@query
def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate group of every document."""
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


@query
def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram base and attention-model score of every document; one fold is held out of both."""
    scored = lm_scoring.score_texts(_table(spark, sf_dir, "documents"))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score for every document; one fold of the labels is never learned from."""
    scored = toxicity.score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted", "language")


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of every document and the verdict of the line field."""
    docs = _table(spark, sf_dir, "documents")
    return line_quality.judge(docs, line_quality.fit_field(docs, _table(spark, sf_dir, "labels")))


@query
def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompt and masked completions of every conversation, against itself with another one's last reply."""
    rows = preferences.rows_of_pairs(preferences.segments(preferences.swapped_replies(_table(spark, sf_dir, "conversations"))))
    spans = [F.array_join(F.transform(c, lambda m: F.concat_ws(":", m["start"], m["end"])), " ").alias(c) for c in ("chosen_mask", "rejected_mask")]
    return rows.select("pair_id", "stretch", "prompt", "chosen", "rejected", *spans)


@query
def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page."""
    return url_filter.judge_urls(_table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "score")


@query
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two vocabularies' tokens in every document, with corpus-wide counts of the linked ids."""
    return crosswalk.aligned(_table(spark, sf_dir, "documents"), keep_text=False)


@query
def op12_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document in the packed sequences."""
    pieces = packing.pack(_table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "source")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Documents (doc_id, text) in which a tenth, chosen by the checksum of the id, repeat a stretch to their end.

    From word a on, the p words there come again and again. A missing id plants nothing.
    """
    # an explode pins the words as a column; as an expression they would be split again for each use
    words = F.filter(F.split(F.col("text").cast("string"), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    checksum = F.crc32(F.col("doc_id").cast("string"))
    chosen = docs.select("doc_id", "text", checksum.alias("h")).withColumn(
        "words", F.when(F.col("h") % 10 == 0, words)).select("doc_id", "text", "h", F.explode_outer(F.array("words")).alias("words"))
    n, g = F.size("words"), F.floor(F.col("h") / 10)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    again = F.flatten(F.array_repeat(F.slice("words", a + 1, p), F.ceil((n - a) / p).cast("int")))
    planted = F.array_join(F.concat(F.slice("words", F.lit(1), a), F.slice(again, F.lit(1), n - a)), " ")
    return chosen.select("doc_id", F.when(F.size("words") > 0, planted).otherwise(F.col("text")).alias("text"))


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, its longest run, and a checksum of the text without their repetitions."""
    found = periodic_runs.periodic_runs(with_planted_runs(_table(spark, sf_dir, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("less"))))
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))))
    best = found.withColumn("best", longest)
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.before")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.less")).alias("period"), F.expr("(1000 * best.length) div (-best.less)").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
