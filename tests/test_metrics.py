import datetime as dt
import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from repopulse import schemas
from repopulse.operators import features, metrics, normalize, repositories, skew
from repopulse.schemas import COUNT_METRICS, MEAN_METRICS, METRICS, REPO, SCORED_METRICS, TIMELINE

T = dt.datetime
EVENTS = ["WatchEvent", "ForkEvent", "PullRequestEvent", "IssuesEvent", "PushEvent", "GistEvent"]


@pytest.fixture(scope="module")
def timeline(spark):
    pick = random.Random(3)
    out = []
    for i in range(3000):
        repo = "hot" if i % 3 == 0 else f"r{pick.randrange(8)}"
        at = T(2014, 6, 1) + dt.timedelta(hours=pick.randrange(24 * 300))
        closed = at if pick.random() < .5 else None
        out.append(("o", repo, f"u{pick.randrange(40)}", at, pick.choice(EVENTS), "closed" if closed else "opened",
                    str(i), at - dt.timedelta(hours=pick.randrange(50)), closed, None))
    return spark.createDataFrame(out, TIMELINE)


@pytest.fixture(scope="module")
def repo(spark):
    names = ["hot", *[f"r{i}" for i in range(8)], "idle"]
    return spark.createDataFrame(
        [("o", n, T(2014, 5 + i % 3, 1), "User" if i % 2 else "Organization") for i, n in enumerate(names)], REPO)


def rounded(df):
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def test_splitting_a_hot_repository_changes_nothing(timeline, repo):
    whole = metrics.monthly_metrics(timeline, repo)
    split = metrics.monthly_metrics(timeline, repo, rows_per_split=100)
    assert rows(rounded(whole)) == rows(rounded(split))
    assert rows(metrics.join_repository(timeline, repo)) == rows(metrics.join_repository(timeline, repo, rows_per_split=50))


def test_months_shuffle_once_without_a_hot_repository(timeline, repo):
    monthly = metrics.monthly_metrics(timeline, F.broadcast(repo))
    assert monthly._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_repositories_sort_by_name_once(frame):
    monthly = frame("repo_owner string, repo_name string, user_type string, month long, repo_index string, repo_created_at timestamp_ntz, "
                    + ", ".join(f"{m} {'double' if m in metrics.MEAN_METRICS else 'long'}" for m in metrics.METRICS), [])
    plan = metrics.cumulative_metrics(metrics.project_month_metrics(monthly))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("+- Sort [repo_name") == plan.count("+- Sort [") == 1


def test_monthly_counts_against_plain_python(timeline, repo):
    created = {r.repository_name: r.repo_created_at for r in repo.collect()}
    want = {}
    for e in timeline.collect():
        s = (e.created_at - created[e.repository_name]).total_seconds() / 2592000
        month = int(np.ceil(s)) if s > 0 else int(np.floor(s))
        if month > 0:
            group = want.setdefault((e.repository_name, month, f"{e.created_at:%Y_%m}"), [0, 0, set()])
            group[0] += e.event == "PullRequestEvent"
            group[1] += e.event == "IssuesEvent" and e.event_action == "closed"
            if e.event in metrics.CONTRIBUTION_EVENTS:
                group[2].add(e.actor_login)
    got = {(r.repo_name, r.month, r.calendar_month): (r.pulls_opened, r.issues_closed, r.contributors)
           for r in metrics.monthly_metrics(timeline, repo).collect()}
    assert got == {k: (a, b, len(c)) for k, (a, b, c) in want.items()}


def test_running_window_equals_theta_self_join(timeline, repo):
    months = metrics.project_month_metrics(metrics.monthly_metrics(timeline, repo), [metrics.AgeBand(1, None, 0, 0)])
    a, b = months.alias("a"), months.alias("b")
    theta = (a.join(b, (F.col("a.repo_name") == F.col("b.repo_name")) & (F.col("a.month") >= F.col("b.month")))
             .groupBy("a.repo_owner", "a.repo_name", "a.user_type", "a.month")
             .agg(F.min("b.repo_index").alias("repo_index"), F.max("b.repo_created_at").alias("repo_created_at"),
                  *[F.sum(f"b.{m}").alias(m) for m in COUNT_METRICS], *[F.avg(f"b.{m}").alias(m) for m in MEAN_METRICS],
                  F.sum("b.contributors").alias("contributors")))
    assert rows(rounded(metrics.cumulative_metrics(months))) == rows(rounded(theta))


def test_survivor_bands_are_numeric_and_strict(frame):
    def months(name, last, watchers, forks):
        return [("o", name, m, watchers if m == last else 0, forks if m == last else 0) for m in {1, 9, last} if m <= last]
    df = frame("repo_owner string, repo_name string, month long, watchers long, forks long",
               months("old", 13, 16, 16) + months("old_low", 13, 15, 16) + months("mid", 12, 11, 11)
               + months("mid_low", 12, 11, 10) + months("new", 1, 6, 6) + months("new_low", 1, 5, 6))
    assert {r.repo_name for r in metrics.active_repositories(df).collect()} == {"old", "mid", "new"}


def test_exact_percentiles_match_numpy(frame):
    pick = random.Random(5)
    data = {"few": [3.0], "two": [1.0, 5.0], "zeros": [0.0] * 300 + [7.0],
            "ties": [float(pick.randrange(4)) for _ in range(501)],
            "wide": [pick.random() * 10 ** pick.randrange(-3, 9) for _ in range(2000)],
            "signs": [pick.uniform(-50, 50) for _ in range(777)]}
    df = frame("k string, x double, y double", [(k, v, -v) for k, vs in data.items() for v in vs] + [("few", None, None)])
    for q in (0.95, 0.5, 0.0, 1.0):
        got = {r.k: (r.x_p, r.y_p) for r in normalize.exact_percentiles(df, ["k"], ["x", "y"], q).collect()}
        for k, vs in data.items():
            assert got[k] == pytest.approx((np.percentile(vs, q * 100), np.percentile([-v for v in vs], q * 100)), rel=1e-9)


def test_capped_ratio(frame):
    df = frame("v double, p double", [(5.0, 0.0), (5.0, 4.0), (1.0, 4.0), (0.0, 0.0)])
    assert [r[0] for r in df.select(normalize.capped_ratio(F.col("v"), F.col("p"))).collect()] == [5.0, 1.0, 0.25, 0.0]


def _metric_rows(frame, months):
    schema = "repo_owner string, repo_name string, user_type string, repo_index string, repo_created_at timestamp_ntz, month long, " + \
        ", ".join(f"{m} double" for m in METRICS)
    return frame(schema, [("o", "r", "User", None, T(2014, 1, 1), m, *[v] * len(METRICS)) for m, v in months])


def test_forward_fill_is_numeric_month_order(frame):
    filled = normalize.forward_fill(_metric_rows(frame, [(10, None), (9, 4.0), (1, None), (2, 2.0), (3, None)]))
    assert {r.month: r.watchers for r in filled.collect()} == {1: 0.0, 2: 2.0, 3: 2.0, 9: 4.0, 10: 4.0}
    assert {r.repo_index for r in filled.collect()} == {"0"}


def test_month_spine_fills_gaps(frame):
    spine = features.month_spine(_metric_rows(frame, [(3, 1.0), (6, None), (7, 5.0)]))
    assert {r.month: r.watchers for r in spine.collect()} == {1: 0.0, 2: 0.0, 3: 1.0, 4: 1.0, 5: 1.0, 6: 1.0, 7: 5.0}


def test_feature_vector_layout(frame):
    vector = features.feature_vectors(_metric_rows(frame, [(2, 0.5), (18, 1.0), (19, 9.0)])).first()
    n = len(SCORED_METRICS)
    assert vector.max_month == 18 and len(vector.features) == 18 * n
    assert vector.features == [0.0] * n + [0.5] * (16 * n) + [1.0] * n


def test_project_details(frame):
    df = frame("repo_owner string, repo_name string, month long, repo_created_at timestamp_ntz, watchers long, year int",
               [("o", "r", 1, T(2016, 1, 10), 1, 2015), ("o", "r", 1, T(2016, 1, 10), 2, 2016),
                ("o", "r", 5, T(2016, 1, 10), 3, 2016), ("o", "r", 6, T(2016, 1, 10), 4, 2016)])
    kept = repositories.project_details(df, T(2016, 5, 10), [-F.col("year")])
    assert sorted((r.month, r.watchers) for r in kept.collect()) == [(1, 2), (5, 3)]


def test_age_split_boundary_is_old(frame):
    df = frame("created_at string", [("2015-01-01",), ("2015-01-02",), (None,)])
    assert [r.is_young for r in repositories.age_split(df, dt.date(2016, 6, 5)).collect()] == [False, True, False]


def test_one_actor_holding_a_repository_is_spread(spark):
    raw = [("o", "r", "bot" if i % 10 else f"u{i}", T(2014, 7, 1, i % 24, i % 60), "IssuesEvent", "opened", str(i), None, None, None) for i in range(300)]
    timeline = spark.createDataFrame(raw, schemas.TIMELINE)
    keys = ["repository_owner", "repository_name"]
    hot = skew.hot_keys(timeline, keys, 10)
    sizes = [r["count"] for r in skew.split_hot(timeline, hot, keys, ["actor_login", "created_at", "event", "event_number"]).groupBy("_split").count().collect()]
    assert len(sizes) > 20 and max(sizes) < 40
    repo = spark.createDataFrame([("o", "r", T(2014, 6, 20), "User")], schemas.REPO)
    got = metrics.monthly_metrics(timeline, repo, rows_per_split=10).first()
    assert (got.issues_opened, got.contributors) == (300, 31)


def test_every_key_above_the_limit_is_split(frame):
    df = frame("k long", [(k,) for k in range(50) for _ in range(20)])
    assert skew.hot_keys(df, ["k"], 5).count() == 50
