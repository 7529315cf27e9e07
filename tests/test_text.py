from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from repopulse.functions import text as tx
from repopulse.functions.stopwords import ENGLISH


def one(frame, expression, *values):
    df = frame("a string, b string", [tuple(values) + (None,) * (2 - len(values))])
    return df.select(expression).first()[0]


def test_stop_words_are_the_default_list(spark):
    assert sorted(ENGLISH) == sorted(StopWordsRemover.loadDefaultStopWords("english"))


def test_clean_text(frame):
    clean = tx.clean_text(F.col("a"), F.col("b"))
    assert one(frame, clean, "-A Title", "see http://www.site.com/page-one, café\n_x_") == \
        "a title see http: site page one, caf _x"
    assert one(frame, clean, "x", "") == ""
    assert one(frame, clean, None, None) == ""


def test_leading_tokens_is_only_on_request(frame):
    long = " ".join(f"w{i}" for i in range(300))
    assert len(one(frame, tx.clean_text(F.col("a"), F.col("b")), "t", long).split()) == 301
    assert len(one(frame, tx.clean_text(F.col("a"), F.col("b"), 100), "t", long).split()) == 100


def test_clean_text_units_cuts_inside_words(frame):
    out = one(frame, tx.clean_text_units(F.col("a"), F.col("b")), "Systems", "took 20ms and 30 minutes (v2) [ok] it's 42")
    assert out.split() == ["syste", "took", "and", "ok", "it", "s"]


def test_words(frame):
    assert one(frame, tx.words(F.col("a")), "the cat's tail, 9_lives!") == ["the", "cat", "s", "tail", "9_lives", ""]


def test_word_pairs(frame):
    df = frame("w array<string>", [(["a", "b", "c"],)])
    pairs = df.select(F.explode(tx.word_pairs(F.col("w"))).alias("p")).collect()
    assert sorted((r.p.word, r.p.other) for r in pairs) == [
        ("a", "b"), ("a", "c"), ("b", "a"), ("b", "c"), ("c", "a"), ("c", "b")]


def test_page_text(frame):
    html = "<p>A &amp; B</p><script>var x='</p>'</script><!-- c --><style>p{}</style><b>C&lt;D</b>"
    assert one(frame, tx.page_text(F.col("a")), html) == "A & BC<D"


def test_repository_key(frame):
    assert one(frame, tx.repository_key(F.col("a")), "Own/Näme.JS") == "nme.js"


def test_word_counts(frame):
    df = frame("w array<string>", [(["b", "a", "b", "", "c", "b"],), ([""],), (["x"],)])
    got = [[(r.term, r.tf) for r in row[0]] for row in df.select(tx.word_counts(F.col("w"))).collect()]
    assert got == [[("", 1), ("a", 1), ("b", 3), ("c", 1)], [("", 1)], [("x", 1)]]
