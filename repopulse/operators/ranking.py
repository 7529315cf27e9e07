"""Word rankings over time: trailing scores, first-seen ranks, co-occurrence."""

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repopulse.functions import text as tx
from repopulse.functions.dates import first_day_not_before, inverse_age
from repopulse.operators import skew
from repopulse.session import cut_lineage

# --- Fixed values ---------------------------------------------------------------------------
TRAILING_DAYS = 30
WINDOW_MONTHS = 6
SCORE_DAYS = 180
DATE_FLOORS = {"dzone": dt.date(2014, 1, 1)}
# -------------------------------------------------------------------------------------------

#: Lists up to so many words make their pairs in the row.
SHORT_LIST = 100


def dated(posts: DataFrame) -> DataFrame:
    return posts.filter(F.col("date_published").isNotNull())


def post_words(posts: DataFrame) -> DataFrame:
    """One row per dated post and top word."""
    return dated(posts).select(
        "source", "doc_id", "date_published", "title", "link",
        F.explode("top_words").alias("top_words"))


def trailing_scores(words: DataFrame, as_of: dt.date) -> DataFrame:
    """Score and link count of each word at each of the last 30 days.

    A post counts when it lies in the six months up to the benchmark day and adds
    (180 - age in days) / 180. Only the day a post first counts matters, so rows are summed per
    word and day before they meet the 30 benchmark days.
    """
    per_day = (words.withColumn("counts_from", first_day_not_before(F.col("date_published")))
               .groupBy("source", "top_words", "counts_from").agg(F.count("*").alias("links")))
    # Benchmark day i days before the newest: a post counts while counts_from <= newest - i and
    # counts_from > newest - 6 months - i, which is a range of i, so the days are a plain sequence.
    newest = F.date_sub(F.lit(as_of.isoformat()).cast("date"), 1)
    low = F.greatest(F.lit(0), F.date_diff(F.add_months(newest, -WINDOW_MONTHS), "counts_from") + 1)
    high = F.least(F.lit(TRAILING_DAYS - 1), F.date_diff(newest, "counts_from"))
    days = (per_day.filter(low <= high)
            .select("*", F.explode(F.sequence(low, high)).alias("i"))
            .withColumn("benchmark_date", F.date_sub(newest, F.col("i"))))
    age = F.date_diff("benchmark_date", "counts_from")
    return (
        days.groupBy("source", "top_words", "benchmark_date")
        .agg((F.sum(F.col("links") * (SCORE_DAYS - age)) / SCORE_DAYS).alias("score"),
             F.sum("links").alias("no_of_links"))
    )


def first_seen(words: DataFrame, as_of: dt.datetime, rows_per_split: int = skew.ROWS_PER_SPLIT) -> DataFrame:
    """Rank (ties share the smallest) of each post date within its word, and the inverse age.

    The rank is 1 + rows of the word on earlier days + rows earlier on the same day. Both come
    from counts per day and per time, so a word used in a third of all posts is never sorted in
    one task.
    """
    key = ["source", "top_words"]
    per_time = (words.groupBy(*key, "date_published").agg(F.count("*").alias("rows"))
                .withColumn("day", F.to_date("date_published")))
    earlier_days = Window.partitionBy(*key).orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    earlier_times = (Window.partitionBy(*key, "day").orderBy("date_published")
                     .rowsBetween(Window.unboundedPreceding, -1))
    days = (per_time.groupBy(*key, "day").agg(F.sum("rows").alias("rows"))
            .select(*key, "day", F.coalesce(F.sum("rows").over(earlier_days), F.lit(0)).alias("before_day")))
    ranks = per_time.withColumn(
        "before_time", F.coalesce(F.sum("rows").over(earlier_times), F.lit(0))).join(days, [*key, "day"])
    ranks = ranks.select(*key, "date_published", "rows",
                         (F.col("before_day") + F.col("before_time") + 1).alias("rank_first_seen"))
    at = [*key, "date_published"]
    hot = skew.hot_keys(ranks, at, rows_per_split, rows=F.col("rows"))
    now = F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    return skew.split_join(words, ranks.drop("rows"), at, ["doc_id"], hot).select(
        "source", "doc_id", "date_published", "title", "link", "top_words", "rank_first_seen",
        inverse_age(F.col("date_published"), now).alias("score"))


def on_or_after(floors: dict[str, dt.date]) -> Column:
    """Per-source earliest date; sources without one keep everything."""
    ok = F.lit(True)
    for source, day in floors.items():
        late = F.col("date_published") >= F.lit(day.isoformat()).cast("timestamp_ntz")
        ok = ok & ((F.col("source") != source) | late)
    return ok


def cooccurrence(posts: DataFrame, floors: dict[str, dt.date] | None = None,
                 rows_per_split: int = skew.ROWS_PER_SPLIT) -> DataFrame:
    """How often other top words appear with a word, repeated for each date of the word.

    Pairs are counted before dates join them; both sides of a common word are cut into blocks, as many dates meet
    many partners there.
    """
    kept = dated(posts).filter(on_or_after(DATE_FLOORS if floors is None else floors))
    # written, as it feeds the pairs, the dates and the counts that both are split by
    kept = cut_lineage(kept.select("source", "date_published", "top_words"), "dated_words")
    key = ["source", "top_words"]
    pairs = cut_lineage(list_pairs(kept.select("source", "top_words"), "top_words", rows_per_split).groupBy(
        "source", F.col("word").alias("top_words"), F.col("other").alias("search_results")).agg(F.count("*").alias("frequency")), "pairs")
    dates = kept.select("source", F.explode("top_words").alias("top_words"), "date_published").distinct()
    return skew.grid_join(dates, pairs, key, ["date_published"], ["search_results"], rows_per_split).select(
        *key, "date_published", "search_results", "frequency")


def list_pairs(rows: DataFrame, column: str, rows_per_split: int = skew.ROWS_PER_SPLIT, short_list: int = SHORT_LIST) -> DataFrame:
    """Ordered pairs (word, other) of different words of each row's list, with the row's other columns.

    A list of up to ``short_list`` words makes its pairs inside the row, without a shuffle. The words of a longer one,
    say of a post with very many tied words, become rows which meet through a grid, so no row and no
    task holds the square of its length.
    """
    rest = [c for c in rows.columns if c != column]
    inside = rows.filter(F.size(column) <= short_list).select(*rest, F.explode(tx.word_pairs(F.col(column))).alias("pair"))
    inside = inside.select(*rest, "pair.word", "pair.other")
    long = rows.filter(F.size(column) > short_list)
    if long.isEmpty():
        return inside
    words = cut_lineage(long.withColumn("_row", F.monotonically_increasing_id()).select("_row", *rest, F.explode(column).alias("word")), "long_lists")
    others = words.select("_row", F.col("word").alias("other"))
    counts = skew.row_counts(others, ["_row"])
    met = skew.grid_join(words, others, ["_row"], ["word"], ["other"], rows_per_split, counts, counts)
    return inside.unionByName(met.filter(F.col("word") != F.col("other")).select(*rest, "word", "other"))


def sorted_cooccurrence(pairs: DataFrame, rows_per_split: int = skew.ROWS_PER_SPLIT) -> DataFrame:
    """Newest dates first, then words with many rows first; ``word_rows`` is the second sort key.

    The words complete the sort key, so rows that tie on the first two still spread over tasks.
    """
    key = ["source", "top_words"]
    counts = pairs.groupBy(*key).agg(F.count("*").alias("word_rows"))
    hot = skew.hot_keys(counts, key, rows_per_split, rows=F.col("word_rows"))
    counted = skew.split_join(pairs, counts, key, ["date_published", "search_results"], hot)
    return counted.orderBy(F.desc("date_published"), F.desc("word_rows"), "top_words", "search_results")
