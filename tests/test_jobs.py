import datetime as dt

from conftest import rows
from test_events import PULL, event
from pyspark.sql import functions as F

from repopulse import schemas
from repopulse.operators import scoring
from repopulse.plans import graphs_job, lake_job, metrics_job, posts_job
from repopulse.schemas import SCORED_METRICS

T, D = dt.datetime, dt.date


def at(day, type_="WatchEvent", payload="{}", repo="o/r"):
    return event(type_, payload, repo, f"2016-01-{day:02d} 10:00:00.000000")


def test_days_load_once_and_reruns_change_nothing(spark, tmp_path):
    lake = str(tmp_path / "lake")
    data = [at(2, "PublicEvent"), at(3, "PublicEvent"), at(3), at(9), at(17), at(20, "PullRequestEvent", PULL),
            at(21, "PublicEvent", repo="o/s"), at(25)]
    raw = spark.createDataFrame(data, schemas.ARCHIVE)
    first = D(2015, 12, 31)
    assert lake_job.load_days(raw, lake, D(2016, 1, 10), first) == D(2016, 1, 9)
    assert spark.read.parquet(f"{lake}/timeline").count() == 2
    for _ in range(2):
        assert lake_job.load_days(raw, lake, D(2016, 1, 22), first) == D(2016, 1, 21)
        assert spark.read.parquet(f"{lake}/timeline").count() == 4
        repos = spark.read.parquet(f"{lake}/repositories").select("repository_name", "repo_created_at")
        assert rows(repos) == [("r", T(2016, 1, 2, 10)), ("s", T(2016, 1, 21, 10))]
    run = lake_job.run_metrics(spark, lake, T(2016, 1, 31), 1)
    assert [(r.repo_name, r.month, r.watchers, r.pulls_closed) for r in run.monthly.collect()] == [("r", 1, 3, 1)]


def test_new_days_alone_keep_the_old_ones(spark, tmp_path):
    lake, first = str(tmp_path / "lake"), D(2015, 12, 31)
    load = lambda data, day: lake_job.load_days(spark.createDataFrame(data, schemas.ARCHIVE), lake, day, first)
    load([at(2), at(3, "WatchEvent", "{")], D(2016, 1, 4))  # no new repository, one broken row
    load([at(4, "PublicEvent"), at(5), event("WatchEvent", "{}", "o/r", None)], D(2016, 1, 6))
    load([at(6, "PublicEvent"), at(17)], D(2016, 1, 18))
    assert sorted(r.created_at.day for r in spark.read.parquet(f"{lake}/timeline").collect()) == [2, 5, 17]
    assert rows(spark.read.parquet(f"{lake}/repositories").select("repository_name", "repo_created_at")) == [("r", T(2016, 1, 4, 10))]
    assert rows(spark.read.parquet(f"{lake}/rejects").select("created", "reason")) == [
        ("2016-01-03 10:00:00.000000", "bad_json"), (None, "blank_field")]


def test_repositories_without_a_model_stay(spark, frame):
    data = [("o", f"r{i}", "User" if i < 3 else None, T(2014, 1, 1), 2 + i, [0.5]) for i in range(4)]
    vectors = frame("repo_owner string, repo_name string, user_type string, repo_created_at timestamp_ntz, "
                    "max_month int, features array<double>", data)
    assert rows(scoring.score_repositories(vectors, {}).select("repo_name", "model_score", "age_of_project")) == [
        ("r0", None, 2), ("r1", None, 3), ("r2", None, 4), ("r3", None, 5)]


def test_month_names():
    assert lake_job.months_of(T(2016, 1, 31), 2) == ["2015_Nov", "2015_Dec", "2016_Jan"]


def test_models_survive_saving(spark, frame, tmp_path):
    n = 2 * len(SCORED_METRICS)
    data = [("o", f"r{i}", "User", T(2014, 1, 1), 2, [float(i % 2)] * n, i % 2) for i in range(20)]
    vectors = frame("repo_owner string, repo_name string, user_type string, repo_created_at timestamp_ntz, "
                    "max_month int, features array<double>, label int", data)
    models = scoring.fit_cohort_models(vectors)
    scoring.save_models(models, str(tmp_path / "models"))
    again = scoring.load_models(str(tmp_path / "models"), scoring.cohorts(vectors))
    scores = {r.repo_name: r.model_score for r in scoring.score_repositories(vectors, again).collect()}
    assert len(scores) == 20 and scores["r1"] > 0.5 > scores["r0"]
    assert rows(scoring.score_repositories(vectors, models)) == rows(scoring.score_repositories(vectors, again))


def test_posts_and_graph_results_are_written(spark, frame, tmp_path):
    posts = frame("source string, doc_id long, date_published timestamp_ntz, title string, content string, link string",
                  [("s", i, T(2016, 5, 1 + i), "t", f"cloud word{i} spark", "l") for i in range(5)])
    tagged, rankings = posts_job.run_posts(posts, frame("term string", [("cloud",), ("spark",)]), T(2016, 6, 5))
    posts_job.write_results(tagged, rankings, str(tmp_path / "posts"))
    assert spark.read.option("header", True).csv(str(tmp_path / "posts" / "recency_frequency.csv")).count() == 2
    info = frame("repository_owner string, repository_name string, full_name string, owner_type string, description string, "
                 "created_at string, watchers_count long, doc_id long",
                 [("o", "alpha", "o/alpha", "User", "Beta", "2016-01-01", 1, 1), ("o", "beta", "o/beta", None, None, None, 2, 2),
                  ("o", "alpha", "o/alpha", "User", "old", "2016-01-01", 1, 3)])
    out = graphs_job.consolidated_outputs(info, [F.col("doc_id")], D(2016, 6, 5))
    assert out["younger"].count() == 1 and out["older"].count() == 1 and out["recency"].count() == 1
    assert [(r.repo1, r.repo2) for r in out["mentions"].collect()] == [("o/beta", "o/alpha")]
    graphs_job.write_results(out, str(tmp_path / "graphs"))
    fresh = spark.read.option("header", True).csv(str(tmp_path / "graphs" / "last_updated_at.csv"))
    assert {r.file_name for r in fresh.collect()} == {"younger.csv", "older.csv", "recency.csv", "mentions.csv"}


def test_metric_results_are_written(spark, frame, tmp_path):
    raw = [("o", "r", f"u{i}", T(2014, 7, 1 + i), "WatchEvent" if i % 2 else "ForkEvent", "", "", None, None, None) for i in range(20)]
    timeline = spark.createDataFrame(raw, schemas.TIMELINE)
    repo = spark.createDataFrame([("o", "r", T(2014, 6, 20), "User")], schemas.REPO)
    run = metrics_job.run_metrics(timeline, repo)
    metrics_job.write_results(run, str(tmp_path / "out"))
    back = spark.read.option("header", True).csv(str(tmp_path / "out" / "derived_metrics.csv"))
    assert {(r.user_type, r.watchers) for r in back.collect()} == {("User", "10")}
