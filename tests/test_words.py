import datetime as dt
import math
import random

from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from repopulse.functions import text as tx
from repopulse.operators import keywords, ranking, skew
from repopulse.plans import posts_job

T = dt.datetime
POST = "source string, doc_id long, date_published timestamp_ntz, title string, content string, link string"


def posts(frame, contents, source="s"):
    return frame(POST, [(source, i, T(2016, 1, 1) + dt.timedelta(days=i), "", c, f"l{i}") for i, c in enumerate(contents)])


def rounded(df):
    return df.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def test_tfidf_values(frame):
    docs = posts(frame, ["apple apple pear", "pear plum", "plum"])
    got = {(r.doc_id, r.term): r for r in keywords.tfidf(docs, posts_job.post_terms(docs)).collect()}
    apple, pear = 2 * (math.log(4 / 2) + 1), math.log(4 / 3) + 1
    assert math.isclose(got[0, "apple"].weight, apple)
    assert math.isclose(got[0, "apple"].tfidf, apple / math.hypot(apple, pear))
    plain = {(r.doc_id, r.term): r.tfidf for r in keywords.tfidf_plain(docs, posts_job.post_terms(docs)).collect()}
    assert math.isclose(plain[0, "apple"], 2 * math.log(2))


def test_hot_term_split_changes_nothing(frame):
    pick = random.Random(1)
    docs = posts(frame, ["common " + " ".join(f"w{pick.randrange(30)}" for _ in range(20)) for _ in range(60)])
    tokens = posts_job.post_terms(docs)
    assert rows(rounded(keywords.tfidf(docs, tokens))) == rows(rounded(keywords.tfidf(docs, tokens, rows_per_split=5)))


def test_ties_at_rank_ten_are_kept(frame):
    docs = posts(frame, ["one1 " * 3 + " ".join(f"t{i}x" for i in range(14)), "other"])
    scored = keywords.tfidf(docs, posts_job.post_terms(docs)).filter("doc_id = 0")
    assert keywords.top_terms(scored).count() == 15
    assert keywords.top_terms_strict(scored, "weight").count() == 10


def test_fragments_and_lexicon(frame):
    terms = frame("source string, doc_id long, term string", [("s", 1, t) for t in ("cloud", "scaling", "quality", "bingo", "sky")])
    lexicon = frame("term string", [("cloud",), ("scaling",), ("bingo",), ("cloud",)])
    assert rows(keywords.clean_top_terms(terms, lexicon).select("term")) == [("cloud",)]


def test_posts_without_words_keep_an_empty_list(frame):
    docs = posts(frame, ["cloud cloud", "the"])
    out = posts_job.post_keywords(docs, frame("term string", [("cloud",)]))
    assert {r.doc_id: r.top_words for r in out.collect()} == {0: ["cloud"], 1: []}


def test_stop_word_set(frame):
    lines = frame("value string", [("'a' [b]\tc/d.e  a",)])
    assert rows(keywords.stop_word_set(lines)) == [("a",), ("b",), ("c",), ("d",), ("e",)]


def tagged(frame, data):
    return frame("source string, doc_id long, date_published timestamp_ntz, title string, link string, top_words array<string>",
                 [("s", i, d, "t", "l", w) for i, (d, w) in enumerate(data)])


def test_trailing_window_bounds(frame):
    newest, oldest = T(2016, 6, 4), T(2015, 12, 4)
    data = [(newest, ["in"]), (newest + dt.timedelta(seconds=1), ["late"]), (oldest, ["out"]),
            (oldest + dt.timedelta(seconds=1), ["in"]), (T(2016, 6, 3, 12), ["half"]), (None, ["none"])]
    scores = ranking.trailing_scores(ranking.post_words(tagged(frame, data)), dt.date(2016, 6, 5))
    at = {r.top_words: (r.no_of_links, r.score) for r in scores.filter("benchmark_date = '2016-06-04'").collect()}
    # 2015-12-04 00:00:01 is 182 whole days before the newest day.
    assert set(at) == {"in", "half"} and at["in"][0] == 2 and math.isclose(at["in"][1], 1 + (180 - 182) / 180)
    assert at["half"] == (1, 1.0)


def test_trailing_month_arithmetic_goes_month_first(frame):
    data = [(T(2016, 2, 28, 12), ["w"])]
    scores = ranking.trailing_scores(ranking.post_words(tagged(frame, data)), dt.date(2016, 9, 1))
    # 31 August back six months is 29 February; one day earlier is 28 February, so i=1 holds the post.
    dates = {str(r.benchmark_date) for r in scores.collect()}
    assert "2016-08-31" not in dates and "2016-08-30" in dates


def test_first_seen_equals_rank_window(frame):
    pick = random.Random(2)
    data = [(T(2016, 1, 1) + dt.timedelta(hours=6 * pick.randrange(60)), [f"w{pick.randrange(3)}", "common"]) for _ in range(80)]
    words = ranking.post_words(tagged(frame, data))
    window = Window.partitionBy("source", "top_words").orderBy("date_published")
    want = words.select("doc_id", "top_words", F.rank().over(window).cast("long"))
    for limit in (10**6, 3):
        got = ranking.first_seen(words, T(2016, 6, 5), limit).select("doc_id", "top_words", "rank_first_seen")
        assert rows(got) == rows(want)


def test_cooccurrence(frame):
    data = [(T(2016, 1, 1), ["a", "b"]), (T(2016, 1, 2), ["a", "b", "c"]), (None, ["a", "z"]), (T(2016, 1, 3), [])]
    want = []
    dates = {"a": (1, 2), "b": (1, 2), "c": (2,)}
    freq = {("a", "b"): 2, ("b", "a"): 2, ("a", "c"): 1, ("c", "a"): 1, ("b", "c"): 1, ("c", "b"): 1}
    for (w, o), n in freq.items():
        want += [("s", w, T(2016, 1, d), o, n) for d in dates[w]]
    for limit in (10**6, 1):
        assert rows(ranking.cooccurrence(tagged(frame, data), rows_per_split=limit)) == sorted(want, key=str)
    floored = ranking.cooccurrence(tagged(frame, data), {"s": dt.date(2016, 1, 2)})
    assert {r.date_published for r in floored.collect()} == {T(2016, 1, 2)}


def test_recency_frequency(frame):
    words = ranking.post_words(tagged(frame, [(T(2016, 1, 1), ["a"]), (T(2016, 1, 5), ["a", "b"])]))
    assert rows(keywords.recency_frequency(words)) == [("s", "a", T(2016, 1, 5), 2), ("s", "b", T(2016, 1, 5), 1)]


def test_counts_meet_their_frequencies_unsorted(frame):
    docs = frame("source string, doc_id long, title string, content string", [("a", i, "x", "apple pear") for i in range(3)])
    plan = keywords.tfidf_plain(docs, posts_job.post_terms(docs))._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def test_the_list_of_frequent_terms_is_not_grouped_again(frame):
    df = frame("k string, _n long", [("a", 7), ("b", 5), ("c", 6)])
    hot = skew.hottest(df, ["k"], 5)
    assert sorted((r.k, r._splits) for r in hot.collect()) == [("a", 2), ("c", 2)]
    assert "hashpartitioning" not in hot._jdf.queryExecution().executedPlan().toString()


def test_marks_at_the_ends_of_a_text(frame):
    texts = ["-_a-_", "_-a_-", "--a", "a__", "-", "_", "a-b_c", "", "x_\u0085", "x-\u2028", "_", "a b"]
    plain = F.col("text")
    for edge in ("^-", "^_", "-$", "_$"):
        plain = F.regexp_replace(plain, edge, "")
    got = frame("text string", [(t,) for t in texts]).select(tx._without_edges(F.col("text")).alias("a"), plain.alias("b")).collect()
    assert [r.a for r in got] == [r.b for r in got] and got[0].a == "a-"
