"""Blog posts -> top words per post -> ranking tables, all sources in one job."""

import dataclasses
import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repopulse.functions import text as tx
from repopulse.operators import keywords, ranking
from repopulse.session import cut_lineage
from repopulse.sources import files


def post_terms(posts: DataFrame, max_tokens: int | None = None) -> DataFrame:
    clean = tx.clean_text(F.col("title"), F.col("content"), max_tokens)
    return keywords.term_counts(posts, tx.words(clean))


def post_keywords(posts: DataFrame, lexicon: DataFrame, max_tokens: int | None = None) -> DataFrame:
    """Posts with their top words: TF-IDF per source, top ten, nouns of the lexicon only."""
    scored = keywords.tfidf(posts, post_terms(posts, max_tokens))
    terms = keywords.clean_top_terms(keywords.top_terms(scored), lexicon)
    return keywords.collect_top_words(posts, terms)


def post_keywords_strict(posts: DataFrame, lexicon: DataFrame, max_tokens: int | None = None) -> DataFrame:
    """The other clean-up (unit words cut) with unscaled TF-IDF and exactly ten candidates."""
    clean = tx.clean_text_units(F.col("title"), F.col("content"), max_tokens)
    counts = keywords.term_counts(posts, tx.spaced_words(clean))
    terms = keywords.top_terms_strict(keywords.tfidf_plain(posts, counts))
    return keywords.collect_top_words(posts, keywords.keep_lexicon_words(terms, lexicon))


@dataclasses.dataclass(frozen=True)
class Rankings:
    trailing: DataFrame
    first_seen: DataFrame
    cooccurrence: DataFrame
    recency: DataFrame


def rank_words(tagged: DataFrame, as_of: dt.datetime, floors: dict[str, dt.date] | None = None) -> Rankings:
    words = ranking.post_words(tagged)
    page = ranking.first_seen(words, as_of)
    return Rankings(ranking.trailing_scores(words, as_of.date()), page,
                    ranking.cooccurrence(tagged, floors), keywords.recency_frequency(page))


def write_results(tagged: DataFrame, rankings: Rankings, out: str) -> None:
    """One headered CSV result per table, a folder per source inside it."""
    for name, df in {"tfidf_result": tagged, "trailing_scores": rankings.trailing,
                     "first_seen": rankings.first_seen, "cooccurrence": rankings.cooccurrence,
                     "recency_frequency": rankings.recency}.items():
        files.write_csv(df, f"{out}/{name}.csv", ["source"])


def run_posts(posts: DataFrame, lexicon: DataFrame, as_of: dt.datetime,
              floors: dict[str, dt.date] | None = None) -> tuple[DataFrame, Rankings]:
    """Key words are written once; the four ranking tables start from the written rows."""
    tagged = cut_lineage(post_keywords(posts, lexicon), "post_keywords")
    return tagged, rank_words(tagged, as_of, floors)
