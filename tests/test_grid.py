"""Grid joins, pairs of long lists, classes of contributors and their lists in parts."""

import random
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from repopulse.operators import contributors as co
from repopulse.operators import ranking, skew


def sides(frame, left, right):
    make = lambda keys, name: frame(f"k string, {name} long", [(k, i) for i, k in enumerate(k for k, n in keys.items() for _ in range(n))])
    return make(left, "x"), make(right, "y")


@pytest.mark.parametrize(("left", "right", "limit"), [
    ({"a": 1}, {"a": 100}, 10), ({"a": 100}, {"a": 1}, 10), ({"a": 50, "b": 3}, {"a": 40, "b": 2, "c": 9}, 10),
    ({"a": 30, "b": 30}, {"a": 30, "b": 1}, 1), ({"a": 5}, {"b": 5}, 1), ({"a": 2, "b": 2}, {"a": 2, "b": 2}, 1000)])
def test_grid_join_is_the_join(frame, left, right, limit):
    x, y = sides(frame, left, right)
    want = rows(x.join(y, "k"))
    assert rows(skew.grid_join(x, y, ["k"], ["x"], ["y"], limit)) == want
    grid = {r.k: (r._across, r._down) for r in skew.hot_products(skew.row_counts(x, ["k"]), skew.row_counts(y, ["k"]), ["k"], limit).collect()}
    share = sum(left[k] * right.get(k, 0) for k in left) / skew.MAX_SPLIT_KEYS
    assert set(grid) == {k for k in left if left[k] * right.get(k, 0) > max(limit, share)}
    for k, (across, down) in grid.items():
        assert 1 <= across <= left[k] and 1 <= down <= right[k] and across * down >= left[k] * right[k] / max(limit, share)
    if grid:
        frame_of = skew.settled(skew.hot_products(skew.row_counts(x, ["k"]), skew.row_counts(y, ["k"]), ["k"], limit))
        cut = Counter(r.k for r in skew.cut_side(x, frame_of, ["k"], ["x"], "_across", "_down").collect())
        assert cut == {k: n * grid.get(k, (1, 1))[1] for k, n in left.items()}  # rows times blocks of the other side
        cut = Counter(r.k for r in skew.cut_side(y, frame_of, ["k"], ["y"], "_down", "_across").collect())
        assert cut == {k: n * grid.get(k, (1, 1))[0] for k, n in right.items()}


def test_one_row_against_many_is_not_copied_like_a_product(frame):
    x, y = sides(frame, {"a": 1}, {"a": 100})
    grid = skew.settled(skew.hot_products(skew.row_counts(x, ["k"]), skew.row_counts(y, ["k"]), ["k"], 10))
    assert skew.cut_side(x, grid, ["k"], ["x"], "_across", "_down").count() == 10
    assert skew.cut_side(y, grid, ["k"], ["y"], "_down", "_across").count() == 100


def test_cells_share_the_work(frame):
    x, y = sides(frame, {"a": 400, "b": 5}, {"a": 300, "b": 5})
    grid = skew.settled(skew.hot_products(skew.row_counts(x, ["k"]), skew.row_counts(y, ["k"]), ["k"], 3000))
    cells = ["_across_block", "_down_block"]
    made = (skew.cut_side(x, grid, ["k"], ["x"], "_across", "_down").join(skew.cut_side(y, grid, ["k"], ["y"], "_down", "_across"), ["k", *cells])
            .groupBy("k", *cells).count().collect())
    assert sum(r["count"] for r in made) == 120_025 and max(r["count"] for r in made) < 9000


def test_missing_keys_never_meet(frame):
    x, y = sides(frame, {None: 9, "a": 2}, {None: 9, "a": 2})
    assert skew.grid_join(x, y, ["k"], ["x"], ["y"], 1).count() == 4


def test_pairs_of_long_lists(frame):
    rng = random.Random(2)
    data = [(i, rng.sample([f"w{k}" for k in range(40)], n)) for i, n in enumerate([0, 1, 2, 5, 30, 40, 40])] + [(3, ["x", "x", None, "y"]), (9, None)]
    df = frame("doc_id long, top_words array<string>", data)
    want = rows(df.select("doc_id", F.explode("top_words").alias("word"), "top_words")
                .select("doc_id", "word", F.explode("top_words").alias("other")).filter("word <> other"))
    for short, limit in ((100, 10**6), (4, 10**6), (4, 50), (0, 1)):
        assert rows(ranking.list_pairs(df, "top_words", limit, short)) == want


def test_twenty_thousand_tied_words(frame):
    df = frame("doc_id long, n int", [(1, 3000)]).select("doc_id", F.transform(F.sequence(F.lit(1), "n"), lambda i: i.cast("string")).alias("top_words"))
    pairs = ranking.list_pairs(df, "top_words", rows_per_split=100_000)
    assert pairs.groupBy("word").count().agg(F.sum("count"), F.min("count"), F.count("*")).first()[:] == (3000 * 2999, 2999, 3000)


def contributions(seed=4):
    pick = random.Random(seed)
    data = [(f"o/r{i}", "bot") for i in range(40)] + [(f"o/r{i}", "twin") for i in range(40)]
    data += [(f"o/r{pick.randrange(40)}", f"u{pick.randrange(15)}") for _ in range(150)]
    data += [(r, f"crew{i}") for r in ("o/r3", "o/r5", "o/r8") for i in range(30)] + [("o/r1", f"single{i}") for i in range(5)]
    data += [("o/r1", None), ("o/r2", ""), data[0]]
    return [(r, u, f"2016-01-{int(r[3:]) % 28 + 1:02d}") for r, u in data]


SCHEMA = "full_name string, author_login string, created_at string"


def shared(data):
    known = {(r, u) for r, u, _ in data if u}
    return sorted({(a, b, u) for a, u in known for b, v in known if u == v and a < b}, key=str)


def test_classes_hold_equal_sets(frame):
    data = contributions()
    known = co.known_contributions(frame(SCHEMA, data))
    sets = {}
    for r, u, _ in data:
        if u:
            sets.setdefault(u, set()).add(r)
    want = sorted((u, min(v for v in sets if sets[v] == s), len(s)) for u, s in sets.items() if len(s) > 1)
    assert sorted(map(tuple, co.login_classes(known).collect())) == want
    pairs = co.class_pairs(known, co.login_classes(known), 7)
    assert pairs.filter("class LIKE 'crew%'").count() == 3 and pairs.filter("class IN ('bot', 'twin')").count() == 40 * 39 / 2


def test_expanded_classes_are_the_pairs(frame):
    data = contributions()
    for limit in (10**6, 5):
        assert rows(co.shared_contributor_pairs(frame(SCHEMA, data), 7, limit)) == shared(data)


def test_parts_in_order_are_the_list(frame):
    data = contributions()
    want = {}
    for a, b, u in shared(data):
        want.setdefault((a, b), []).append(u)
    for size, limit in ((8192, 10**6), (8, 10**6), (2, 20), (1, 1)):
        got = {}
        for r in sorted(co.contributor_parts(frame(SCHEMA, data), 7, size, limit).collect(), key=lambda r: (r.repo1, r.repo2, r.part)):
            own = got.setdefault((r.repo1, r.repo2), [])
            assert len(r.logins) <= size and r.first == len(own)
            own += r.logins
        assert got == {k: sorted(v) for k, v in want.items()}


def test_graph_of_classes(frame):
    data = contributions()
    want = {}
    for a, b, u in shared(data):
        for pair in ((a, b), (b, a)):
            want.setdefault(pair, []).append(u)
    dates = {r: d for r, _, d in data}
    expected = sorted(((a, b, ",".join(sorted(us)), len(us), dates[a]) for (a, b), us in want.items()), key=str)
    for size, limit in ((8192, 10**6), (4, 3)):
        assert rows(co.contributor_graph(frame(SCHEMA, data), 7, size, limit)) == expected


def test_no_contributions(frame):
    empty = frame(SCHEMA, [])
    assert co.contributor_graph(empty).collect() == [] and co.shared_contributor_pairs(empty).collect() == []


def test_a_class_moves_as_lists(frame):
    """What is shuffled for a class is its lists, not a row for each pair; every ordered pair of blocks is one row."""
    data = contributions()
    known = co.known_contributions(frame(SCHEMA, data))
    lists = co.class_lists(known, co.login_classes(known), 2000)
    assert lists.filter("class = 'bot'").select(F.size("xs"), F.size("ys")).collect() == [(40, 40)]
    assert lists.count() == lists.select("class").distinct().count()
    assert co.class_lists(known, co.login_classes(known), 7).filter("class = 'bot'").count() == 36


def test_repositories_without_a_name_make_no_pair(frame):
    data = [(r, "bot", "2016-01-01") for r in ("o/a", "o/b", "o/c", None)]
    for block in (2000, 1):
        assert rows(co.shared_contributor_pairs(frame(SCHEMA, data), block)) == [("o/a", "o/b", "bot"), ("o/a", "o/c", "bot"), ("o/b", "o/c", "bot")]
