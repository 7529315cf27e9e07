import datetime as dt
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from repopulse import schemas
from repopulse.operators import events as ev

T = dt.datetime
OK = "2016-01-02 03:04:05.000000"


def event(type_, payload="{}", repo="o/r", created=OK, org_id=None, org=None):
    return (type_, payload if isinstance(payload, str) else json.dumps(payload), repo, "me", created, org_id, org)


def classified(spark, *events):
    return ev.classify_events(spark.createDataFrame(list(events), schemas.ARCHIVE))


def outcome(spark, *args, **kw):
    row = classified(spark, event(*args, **kw)).first()
    return row.reason if row.outcome == "rejected" else row.outcome


PULL = {"action": "closed", "number": 7, "pull_request": {"created_at": "2016-01-01T00:00:00Z", "closed_at": None}}


def test_outcomes(spark):
    assert outcome(spark, "WatchEvent") == "timeline"
    assert outcome(spark, "GollumEvent") == "skipped"
    assert outcome(spark, "PublicEvent") == "new_repo"
    assert outcome(spark, "CreateEvent", {"ref_type": "repository"}) == "new_repo"
    assert outcome(spark, "CreateEvent", {"ref_type": "branch"}) == "skipped"
    assert outcome(spark, "PullRequestEvent", PULL | {"action": "labeled"}) == "skipped"
    assert outcome(spark, "CommitCommentEvent", {"comment": {}}) == "timeline"
    assert outcome(spark, "CreateEvent", {}) == "missing_field"
    assert outcome(spark, "IssuesEvent", {"action": "opened"}) == "missing_field"
    assert outcome(spark, "WatchEvent", '{"act') == "bad_json"
    assert outcome(spark, "WatchEvent", created="2016-01-02 03:04:05") == "bad_time"
    assert outcome(spark, "WatchEvent", created=None) == "blank_field"
    assert outcome(spark, "WatchEvent", repo="o/r/x") == "bad_repo_name"
    assert outcome(spark, "WatchEvent", repo=None) == "bad_repo_name"


def test_closed_pull_request_without_time(spark):
    row = ev.timeline_events(classified(spark, event("PullRequestEvent", PULL, org="acme"))).first()
    assert (row.event_action, row.event_number, row.user_type) == ("closed", "7", "Organization")
    assert row.event_created_at == T(2016, 1, 1) and row.event_closed_at is None
    assert row.created_at == T(2016, 1, 2, 3, 4, 5)


def test_reopened_is_opened(spark):
    issue = {"action": "reopened", "issue": {"number": 3, "created_at": "2016-01-01T00:00:00Z"}}
    row = ev.timeline_events(classified(spark, event("IssuesEvent", issue))).first()
    assert (row.event_action, row.event_number, row.event_closed_at) == ("opened", "3", None)


def test_keep_first_takes_the_earliest(frame):
    df = frame("repository_owner string, repository_name string, repo_created_at timestamp_ntz, user_type string",
               [("o", "r", T(2016, 2, 1), "User"), ("o", "r", T(2016, 1, 1), "Organization"), ("o", "r", None, "User"),
                ("o", "s", None, "User")])
    assert rows(ev.dedupe_repositories(df)) == rows(df.filter("(repository_name = 'r' AND user_type = 'Organization') OR repository_name = 's'"))


def test_slices_and_days(frame):
    df = frame("ts timestamp_ntz", [(T(2016, 1, 1, h),) for h in (0, 2, 3, 23)])
    assert [r["slice"] for r in ev.day_slices(df, "ts", 3).collect()] == [0, 0, 1, 7]
    with pytest.raises(ValueError):
        ev.day_slices(df, "ts", 5)
    days = frame("ts timestamp_ntz", [(T(2016, 1, d),) for d in (1, 2, 3, 4)])
    assert rows(ev.days_to_load(days, "ts", dt.date(2016, 1, 1), dt.date(2016, 1, 4))) == [(T(2016, 1, 2),), (T(2016, 1, 3),)]


def test_the_time_of_a_row_is_read_once(frame):
    raw = frame(schemas.ARCHIVE, [event("WatchEvent", "{}")]).withColumn("created", F.concat("created", F.lit("")))
    for classified in (ev.classify_events(raw), ev.classify_events(ev.timed(raw).filter("_time > '2000-01-01' OR _time IS NULL"))):
        used = classified.select("outcome", "reason", "created_at", *[c for c in classified.columns if c == "_time"])
        assert used._jdf.queryExecution().optimizedPlan().toString().count("gettimestamp(CASE WHEN") == 1
        assert [r.outcome for r in used.collect()] == ["timeline"]
