"""Column names and types of every dataset the jobs read or write."""

from pyspark.sql import types as T


def _struct(**fields):
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


_S, _L, _D, _TS = T.StringType(), T.LongType(), T.DoubleType(), T.TimestampNTZType()

# --- Fixed values: metric and column names of the published result files -------------------
COUNT_METRICS = [
    "watchers", "forks", "pulls_opened", "pulls_closed", "pulls_review_comments",
    "issues_opened", "issues_closed", "issues_comments", "commits_comments", "downloads",
    "gists", "pushes", "releases",
]
MEAN_METRICS = ["pulls_avg_response_time", "issues_avg_response_time"]
METRICS = COUNT_METRICS + MEAN_METRICS + ["contributors"]
SCORED_METRICS = [
    "watchers", "forks", "commits_comments", "issues_opened", "issues_comments",
    "issues_avg_response_time", "pulls_opened", "pulls_avg_response_time",
    "pulls_review_comments", "pushes", "contributors",
]
REPOSITORY_INFO_COLUMNS = [
    "repository_owner", "repository_name", "full_name", "owner_type", "description",
    "created_at", "size", "language", "watchers_count", "forks_count", "open_issues_count",
    "default_branch", "score",
]
# -------------------------------------------------------------------------------------------

REPO_KEY = ["repo_owner", "repo_name"]

ARCHIVE = _struct(type=_S, payload=_S, repo_name=_S, actor_login=_S, created=_S,
                  org_id=_S, org_login=_S)

TIMELINE = _struct(repository_owner=_S, repository_name=_S, actor_login=_S, created_at=_TS,
                   event=_S, event_action=_S, event_number=_S, event_created_at=_TS,
                   event_closed_at=_TS, user_type=_S)

REPO = _struct(repository_owner=_S, repository_name=_S, repo_created_at=_TS, user_type=_S)

POST = _struct(date_published=_TS, title=_S, content=_S, link=_S)

CONTRIBUTOR = _struct(full_name=_S, author_login=_S, contributions=_L, created_at=_S)

# The parts of an event payload the normaliser looks at. Everything is read as text, so a number
# or a commit id can land in the same ``event_number`` column.
PAYLOAD = T.StructType([
    T.StructField("action", _S),
    T.StructField("number", _S),
    T.StructField("ref_type", _S),
    T.StructField("pull_request", _struct(created_at=_S, closed_at=_S)),
    T.StructField("issue", _struct(number=_S, created_at=_S, closed_at=_S)),
    T.StructField("comment", _struct(commit_id=_S)),
    T.StructField("_corrupt", _S),
])

REPO_DETAILS = T.StructType([
    T.StructField("name", _S),
    T.StructField("owner", _struct(login=_S, type=_S)),
    T.StructField("description", _S),
    T.StructField("size", _S),
    T.StructField("language", _S),
    T.StructField("watchers_count", _S),
    T.StructField("forks_count", _S),
    T.StructField("open_issues_count", _S),
    T.StructField("default_branch", _S),
    T.StructField("_corrupt", _S),
])

CONTRIBUTOR_STATS = T.ArrayType(T.StructType([
    T.StructField("author", _struct(login=_S)),
    T.StructField("total", _S),
]))
