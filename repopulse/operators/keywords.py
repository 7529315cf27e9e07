"""Relational TF-IDF over whole posts and the top words of each post."""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repopulse.functions import text as tx
from repopulse.functions.stopwords import ENGLISH
from repopulse.operators import skew
from repopulse.session import cut_lineage

DOC = ["source", "doc_id"]
#: The same for windows: rows are sorted by the number before the few sources.
_BY_DOC = ["doc_id", "source"]
# --- Fixed values ---------------------------------------------------------------------------
TOP_WORDS = 10
HASH_BUCKETS = 200_000
# -------------------------------------------------------------------------------------------


def term_counts(docs: DataFrame, split: Column, stop_words: Iterable[str] = ENGLISH) -> DataFrame:
    """Kept terms of each document with their counts; ``split`` is the array of raw tokens.

    ``docs`` has one row per document, so this is a map over rows. ``inline_outer`` keeps Spark
    from evaluating the clean-up a second time in an inferred not-empty filter.
    """
    return docs.select(*DOC, F.inline_outer(tx.word_counts(split))).filter(
        tx.kept_word(F.col("term"), list(stop_words)))


def _with_frequencies(docs: DataFrame, counts: DataFrame, rows_per_split: int) -> DataFrame:
    """Term counts with the documents holding the term and all documents of the source.

    A frequent term is in a large share of the documents, so its rows are spread by document; the
    document frequencies themselves say which terms those are. A task holds its part of the vocabulary,
    so the counts meet it unsorted.
    """
    counts = cut_lineage(counts, "term_counts")
    # written, as the hot terms and the join both use it
    frequency = cut_lineage(counts.groupBy("source", "term").agg(F.count("*").alias("df")), "term_frequencies")
    hot = skew.hottest(frequency.withColumnRenamed("df", "_n"), ["source", "term"], rows_per_split)
    # One row a source; broadcast, as a join on a handful of keys would put a vocabulary into one task.
    n_docs = F.broadcast(docs.groupBy("source").agg(F.count("*").alias("n")))
    return skew.split_join(counts, frequency.join(n_docs, "source"), ["source", "term"],
                           ["doc_id"], hot, strategy="shuffle_hash")


def tfidf_plain(docs: DataFrame, counts: DataFrame,
                rows_per_split: int = skew.ROWS_PER_SPLIT) -> DataFrame:
    """tf * ln((n + 1) / (df + 1)), the term kept next to its score."""
    idf = F.log((F.col("n") + 1) / (F.col("df") + 1))
    return _with_frequencies(docs, counts, rows_per_split).select(
        *DOC, "term", "tf", (F.col("tf") * idf).alias("tfidf"))


def tfidf(docs: DataFrame, counts: DataFrame,
          rows_per_split: int = skew.ROWS_PER_SPLIT) -> DataFrame:
    """tf * (ln((1 + n) / (1 + df)) + 1), each document scaled to length 1."""
    weight = F.col("tf") * (F.log((F.col("n") + 1) / (F.col("df") + 1)) + 1)
    norm = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy(*_BY_DOC)))
    return (_with_frequencies(docs, counts, rows_per_split).withColumn("weight", weight)
            .select(*DOC, "term", "tf", "weight", (F.col("weight") / norm).alias("tfidf")))


def top_terms(scored: DataFrame, order: str = "weight", n: int = TOP_WORDS) -> DataFrame:
    """Terms among the ``n`` largest scores of their document, ties at the border kept.

    ``weight`` is the score before scaling: same order, and equal terms tie exactly.
    """
    by_doc = Window.partitionBy(*_BY_DOC).orderBy(F.desc(order))
    return (scored.filter(F.col(order) > 0).withColumn("rank", F.rank().over(by_doc))
            .filter(F.col("rank") <= n))


def top_terms_strict(scored: DataFrame, order: str = "tfidf", n: int = TOP_WORDS) -> DataFrame:
    """Exactly ``n`` terms per document at most; equal scores in term order."""
    by_doc = Window.partitionBy(*_BY_DOC).orderBy(F.desc(order), "term")
    return scored.withColumn("rank", F.row_number().over(by_doc)).filter(F.col("rank") <= n)


def keep_lexicon_words(terms: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Terms that are in the caller's noun table (column ``term``)."""
    return terms.join(lexicon.select("term").distinct(), "term", "left_semi")


def clean_top_terms(terms: DataFrame, lexicon: DataFrame) -> DataFrame:
    return keep_lexicon_words(terms.filter(~tx.has_unwanted_fragment(F.col("term"))), lexicon)


def collect_top_words(posts: DataFrame, terms: DataFrame) -> DataFrame:
    """Each post with its top words in term order; posts without any keep an empty list."""
    lists = terms.groupBy(*DOC).agg(F.array_sort(F.collect_list("term")).alias("top_words"))
    return posts.join(lists, DOC, "left").select(
        *DOC, "date_published", "title", "link",
        F.coalesce("top_words", F.array().cast("array<string>")).alias("top_words"))


def term_bucket(term: Column, buckets: int = HASH_BUCKETS) -> Column:
    """The checksum of a term modulo the number of buckets."""
    return F.pmod(F.crc32(term), F.lit(buckets)).cast("int")


def hashed_counts(docs: DataFrame, split: Column, buckets: int = HASH_BUCKETS, stop_words: Iterable[str] = ENGLISH) -> DataFrame:
    """(source, doc_id, n_words, counts): the buckets of each document's kept terms with their counts, made in its row."""
    kept = F.filter(split, lambda w: tx.kept_word(w, list(stop_words)))
    numbers = F.transform(kept, lambda w: term_bucket(w, buckets))
    # a one-element array binds the numbers, else the clean-up would run for each use of them
    return docs.select(*DOC, F.transform(F.array(numbers), lambda n: F.struct(
        F.size(n).cast("long").alias("n_words"), tx.word_counts(n).alias("counts")))[0].alias("row")).select(*DOC, "row.*")


def tfidf_hashed(docs: DataFrame, split: Column, buckets: int = HASH_BUCKETS, stop_words: Iterable[str] = ENGLISH,
                 rows_per_split: int = skew.ROWS_PER_SPLIT) -> DataFrame:
    """Sparse hashed TF-IDF vectors of all sources: (source, doc_id, n_words, indices, tf, tfidf), indices ascending.

    tf * ln((n + 1) / (df + 1)) by bucket, within each source. Texts are read once and counted in their rows; only
    buckets and counts are shuffled. A document without kept terms has an empty vector. ``docs`` has one
    row per document.
    """
    rows = cut_lineage(hashed_counts(docs, split, buckets, stop_words), "hashed_counts")
    entries = rows.select(*DOC, "n_words", F.inline_outer("counts")).withColumnRenamed("term", "bucket")
    frequency = rows.select("source", F.explode("counts.term").alias("bucket")).groupBy("source", "bucket").agg(F.count("*").alias("df"))
    frequency = cut_lineage(frequency, "bucket_frequencies")
    # One row a source; broadcast, as a join on a handful of keys would put a vocabulary into one task.
    n_docs = F.broadcast(rows.groupBy("source").agg(F.count("*").alias("n")))
    idf = frequency.join(n_docs, "source").select("source", "bucket", F.log((F.col("n") + 1) / (F.col("df") + 1)).alias("idf"))
    hot = skew.hottest(frequency.withColumnRenamed("df", "_n"), ["source", "bucket"], rows_per_split)
    weighed = skew.split_join(entries, idf, ["source", "bucket"], ["doc_id"], hot, how="left", strategy="shuffle_hash")
    entry = F.when(F.col("bucket").isNotNull(), F.struct("bucket", "tf", (F.col("tf") * F.col("idf")).alias("tfidf")))
    vector = F.array_sort(F.collect_list(entry)).alias("entries")
    return weighed.groupBy(*DOC, "n_words").agg(vector).select(
        *DOC, "n_words", F.col("entries.bucket").alias("indices"), F.col("entries.tf").alias("tf"), F.col("entries.tfidf").alias("tfidf"))


def stop_word_set(lines: DataFrame) -> DataFrame:
    """Distinct words of a stop-word file (column ``value``): quotes and brackets are removed,
    tabs, slashes and dots separate words like spaces."""
    bare = F.translate("value", "\t/.'[]", "   ")
    return (lines.select(F.explode(F.split(bare, " ")).alias("word"))
            .filter(F.col("word") != "").distinct())


def recency_frequency(page: DataFrame) -> DataFrame:
    """Latest date and number of rows per source and word."""
    return page.groupBy("source", "top_words").agg(
        F.max("date_published").alias("date_published"), F.count("*").alias("frequency"))
