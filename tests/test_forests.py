"""Forests as tables of nodes, hashed vectors, posts with their pages, and results for SQL text."""

import datetime as dt
import math
import random
import zlib
from collections import Counter

import pytest
from conftest import rows
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from repopulse.operators import keywords, scoring, skew
from repopulse.plans import feeds_job, sql_job
from repopulse.sources import feeds

T = dt.datetime
VECTORS = "repo_owner string, repo_name string, user_type string, repo_created_at timestamp_ntz, max_month int, features array<double>"


def test_the_walk_is_the_model(spark, frame):
    rng = random.Random(3)
    data = [("o", f"r{i}", rng.choice(["User", "Organization"]), T(2014, 1, 1), rng.choice([2, 3]), [rng.random(), rng.random() * 9, float(i % 4)], int(rng.random() < 0.4))
            for i in range(120)]
    vectors = frame(VECTORS + ", label int", data)
    models = scoring.fit_cohort_models(vectors, trees=4, depth=4)
    assert len(models) == 4
    got = {r.repo_name: r.model_score for r in scoring.score_repositories(vectors, models).collect()}
    for (user_type, month), model in models.items():
        own = vectors.filter((F.col("user_type") == user_type) & (F.col("max_month") == month)).withColumn("vector", array_to_vector("features"))
        for r in model.transform(own).select("repo_name", vector_to_array("probability")[1].alias("p")).collect():
            assert got[r.repo_name] == pytest.approx(r.p, abs=1e-12)
    assert len(got) == 120


def random_tree(rng, tree):
    """Nodes of one tree, children after their parents."""
    nodes, queue, n = [], [0], 1
    while queue:
        node = queue.pop(0)
        if rng.random() < 0.3 or n > 20:
            nodes.append((tree, node, None, None, None, None, rng.random()))
        else:
            nodes.append((tree, node, rng.randrange(4), rng.random(), n, n + 1, None))
            queue += [n, n + 1]
            n += 2
    return nodes


def test_walks_of_random_trees(spark, frame):
    rng = random.Random(8)
    forest = {(u, m): [random_tree(rng, t) for t in range(rng.randrange(1, 5))] for u in ("User", "Organization") for m in (1, 2)}
    nodes = [(u, m, *n) for (u, m), trees in forest.items() for tree in trees for n in tree]
    rng.shuffle(nodes)
    data = [("o", f"r{i}", rng.choice(["User", "Organization", None, "Bot"]), T(2014, 1, 1), rng.choice([1, 2, 3, None]),
             None if i == 7 else [rng.choice([rng.random(), None, 0.5]) for _ in range(rng.choice([0, 2, 4]))]) for i in range(80)]

    def score(user_type, month, features):
        trees = forest.get((user_type, month))
        if trees is None:
            return None
        total = 0
        for tree in trees:
            by_node, node = {n[1]: n for n in tree}, 0
            while by_node[node][2] is not None:
                _, _, f, limit, low, high, _ = by_node[node]
                x = features[f] if features and f < len(features) else None
                node = low if x is not None and x <= limit else high
            total += by_node[node][6]
        return total / len(trees)

    got = {r.repo_name: r.model_score for r in scoring.score_by_nodes(frame(VECTORS, data), frame(scoring.NODES, nodes)).collect()}
    for r in data:
        want = score(r[2], r[4], r[5])
        assert got[r[1]] == (None if want is None else pytest.approx(want)), r
    steps = {(r.user_type, r.month): r.steps for r in scoring.forests(frame(scoring.NODES, nodes)).collect()}
    assert set(steps) == set(forest) and all(0 <= s <= 10 for s in steps.values())


def test_hashed_vectors_of_any_source(frame, monkeypatch):
    rng = random.Random(1)
    pool = [f"term{i}" for i in range(30)] + ["the", "a", ""]
    data = [(rng.choice(["x", "y", "never seen"]), i, " ".join(rng.choice(pool) for _ in range(rng.choice([0, 1, 40])))) for i in range(40)]
    docs = frame("source string, doc_id long, text string", data).withColumn("words", F.split("text", " "))
    bucket = lambda w: zlib.crc32(w.encode()) % 17
    counts = {(s, i): Counter(bucket(w) for w in t.split() if len(w) > 1 and w != "the") for s, i, t in data}
    n = Counter(s for s, _, _ in data)
    df = Counter((s, b) for (s, _), c in counts.items() for b in c)
    for limit in (10**6, 2):
        got = {(r.source, r.doc_id): r for r in keywords.tfidf_hashed(docs, F.col("words"), 17, rows_per_split=limit).collect()}
        assert set(got) == set(counts)
        for (s, i), c in counts.items():
            r = got[s, i]
            assert (r.n_words, r.indices, r.tf) == (c.total(), sorted(c), [c[b] for b in sorted(c)])
            assert r.tfidf == pytest.approx([c[b] * math.log((n[s] + 1) / (df[s, b] + 1)) for b in sorted(c)])
    empty = docs.filter("doc_id < 0")
    assert keywords.tfidf_hashed(empty, F.col("words")).collect() == []


def test_link_keys(frame):
    links = ["http://Blog.Example/A/b/", "https://blog.example/A/b#part", "blog.example/A/b", " HTTP://BLOG.example/A/b ", "blog.example/a/b",
             "blog.example/A/b?q=1", "", "#x", None, "///", "http://x"]
    got = [r.k for r in frame("i int, link string", list(enumerate(links))).sort("i").select(feeds.link_key(F.col("link")).alias("k")).collect()]
    assert got == ["blog.example/A/b"] * 4 + ["blog.example/a/b", "blog.example/A/b?q=1", None, None, None, None, "x"]


def test_page_text_follows_the_summary(frame):
    posts = frame("source string, content string, link string, bucket string",
                  [("s", "sum ", "http://b/1", "k"), ("s", None, "b/1/", "k"), ("s", "other", "b/2", "k"), ("s", "none", None, "k"), ("s", "same", "b/1", "k")])
    pages = frame("url string, html string", [("B/1", "<p>page &amp; one</p>"), ("b/1", "<p>second</p>"), ("b/9", "not asked"), (None, "x"), ("b/2", None)])
    for limit in (10**6, 1):
        got = rows(feeds.with_page_text(posts, pages, limit).select("content", "link"))
        assert got == sorted([("sum page & one", "http://b/1"), ("page & one", "b/1/"), ("other", "b/2"), ("none", None), ("samepage & one", "b/1")], key=str)


def test_loaded_posts_have_their_pages(spark, frame, tmp_path):
    lake = str(tmp_path / "lake")
    items = frame("source string, title string, description string, link string, pubDate string",
                  [("s", "t", "<b>sum</b>, it's", "http://b/1,2", "2016-01-01T10:00:00Z"), ("s", "t", "alone", "b/3", "2016-01-02T10:00:00Z")])
    pages = frame("url string, html string", [("b/1,2", "<p>one,\ntwo</p>")])
    feeds_job.load_items(items, lake, {"s": "sum.*its"}, pages)
    stored = spark.read.parquet(f"{lake}/posts").select("content", "link")
    assert rows(stored) == [("alone", "b/3"), ("one two", "http://b/1COMMA2")]  # cut and cleaned after both are joined
    again = feeds_job.load_items(items, lake, None, pages)
    assert again == 2 and spark.read.parquet(f"{lake}/posts").count() == 2


def test_sql_text_over_results(spark, frame):
    df = frame("k string, n long", [("a", 1), ("b", 2)])
    assert sql_job.offer(spark, {"first_result": df}, {"second_result": df}) == ["first_result", "second_result"]
    got = sql_job.ask(spark, "SELECT a.k, get_index(TIMESTAMP_NTZ '2014-05-01 00:00:00') AS i FROM first_result a JOIN second_result b ON a.n = b.n WHERE b.n > 1",
                      {"first_result": df}, {"second_result": df})
    assert rows(got) == [("b", "2")]
    with pytest.raises(ValueError, match="named"):
        sql_job.offer(spark, {"x": df}, {"x": df})


def test_a_list_without_hot_keys_leaves_the_join_plain(frame):
    df = frame("k long", [(k,) for k in range(9)])
    assert skew.settled(skew.hot_keys(df, ["k"], 5)) is None
    plan = skew.split_join(df, df, ["k"], ["k"], skew.hot_keys(df, ["k"], 5))._jdf.queryExecution().optimizedPlan().toString()
    assert "_split" not in plan
