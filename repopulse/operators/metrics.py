"""Events -> monthly metrics -> surviving repositories -> cumulative metrics."""

import dataclasses

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repopulse.functions.dates import cohort_index, elapsed_units
from repopulse.operators import skew
from repopulse.schemas import COUNT_METRICS, MEAN_METRICS, METRICS, REPO_KEY

# --- Fixed values: which events make up which metric ----------------------------------------
EVENT_OF_METRIC = {
    "watchers": ("WatchEvent", None),
    "forks": ("ForkEvent", None),
    "pulls_opened": ("PullRequestEvent", None),
    "pulls_closed": ("PullRequestEvent", "closed"),
    "pulls_review_comments": ("PullRequestReviewCommentEvent", None),
    "issues_opened": ("IssuesEvent", None),
    "issues_closed": ("IssuesEvent", "closed"),
    "issues_comments": ("IssueCommentEvent", None),
    "commits_comments": ("CommitCommentEvent", None),
    "downloads": ("DownloadEvent", None),
    "gists": ("GistEvent", None),
    "pushes": ("PushEvent", None),
    "releases": ("ReleaseEvent", None),
}
RESPONSE_EVENT = {
    "pulls_avg_response_time": "PullRequestEvent",
    "issues_avg_response_time": "IssuesEvent",
}
CONTRIBUTION_EVENTS = [
    "PullRequestEvent", "IssueCommentEvent", "PullRequestReviewCommentEvent", "IssuesEvent",
    "CommitCommentEvent", "PushEvent",
]
# -------------------------------------------------------------------------------------------


@dataclasses.dataclass(frozen=True)
class AgeBand:
    """Repositories whose latest month is in [first, last] need more than these totals."""
    first: int
    last: int | None
    watchers: int
    forks: int


# --- Fixed values: survivor thresholds by age -----------------------------------------------
AGE_BANDS = [AgeBand(13, None, 15, 15), AgeBand(2, 12, 10, 10), AgeBand(1, 1, 5, 5)]
# -------------------------------------------------------------------------------------------


def join_repository(timeline: DataFrame, repo: DataFrame, base_year: int = 2014, years: int = 3,
                    rows_per_split: int = skew.ROWS_PER_SPLIT) -> DataFrame:
    """Timeline rows with project month, cohort and response hours.

    Rows of a very active repository are spread one by one, so no join task holds all of them, not even
    when a single actor made them.
    """
    return _joined(timeline, repo, base_year, years, skew.hot_keys(timeline, _TIMELINE_KEY, rows_per_split))


_TIMELINE_KEY = ["repository_owner", "repository_name"]


def _joined(timeline: DataFrame, repo: DataFrame, base_year: int, years: int, hot: DataFrame | None) -> DataFrame:
    dims = repo.select(*_TIMELINE_KEY, "repo_created_at", "user_type")
    joined = skew.split_join(
        timeline.drop("user_type"), dims, _TIMELINE_KEY, ["actor_login", "created_at", "event", "event_number"], hot)
    columns = [
        F.col("repository_owner").alias("repo_owner"),
        F.col("repository_name").alias("repo_name"),
        cohort_index(F.col("repo_created_at"), base_year, years).alias("repo_index"),
        elapsed_units(F.col("created_at"), F.col("repo_created_at"), "Month").alias("month"),
        "actor_login", "created_at", "event", "event_action", "event_number",
        "event_created_at", "event_closed_at",
        elapsed_units(F.col("event_closed_at"), F.col("event_created_at"), "Hour").alias("response_time"),
        "repo_created_at", "user_type",
    ]
    return joined.select(*columns)


def contributor() -> Column:
    return F.when(F.col("event").isin(CONTRIBUTION_EVENTS), F.col("actor_login"))


_MONTH_KEY = [*REPO_KEY, "user_type", "month", "first_day"]
_EVENTS = sorted({event for event, _ in EVENT_OF_METRIC.values()})


def _narrow(rows: DataFrame) -> DataFrame:
    """What the metrics need of each row: numbers for the event and its action, hours only of an answer."""
    closed = F.col("event_action") == "closed"
    return rows.filter(F.col("month") > 0).select(
        *REPO_KEY, "user_type", "month", F.trunc("created_at", "MM").alias("first_day"), contributor().alias("who"), "repo_created_at",
        F.array_position(F.array(*map(F.lit, _EVENTS)), F.col("event")).cast("byte").alias("event"), closed.alias("closed"),
        F.when(closed & (F.col("response_time") > 0), F.col("response_time")).alias("hours"))


def _is_event(event: str) -> Column:
    return F.col("event") == _EVENTS.index(event) + 1


def _event_count(metric: str) -> Column:
    event, action = EVENT_OF_METRIC[metric]
    return F.count_if(_is_event(event) if action is None else _is_event(event) & F.col("closed"))


def _answered(metric: str) -> Column:
    return F.when(_is_event(RESPONSE_EVENT[metric]), F.col("hours"))


def _months_of_contributors(rows: DataFrame) -> DataFrame:
    """Aggregated per contributor first and then over contributors, so distinct contributors are counted by plain sums.

    Rows that lie by month already are not shuffled again; else both steps combine before they shuffle: one
    actor's million events are one row a task.
    """
    # Only numbers and dates are aggregated (the cohort text is derived afterwards), which keeps
    # every step a hash aggregate.
    partial = rows.groupBy(*_MONTH_KEY, "who").agg(
        F.min("repo_created_at").alias("repo_created_at"),
        *[_event_count(m).alias(m) for m in COUNT_METRICS],
        *[F.sum(_answered(m)).alias(f"{m}_sum") for m in MEAN_METRICS],
        *[F.count(_answered(m)).alias(f"{m}_n") for m in MEAN_METRICS])
    return partial.groupBy(*_MONTH_KEY).agg(
        F.min("repo_created_at").alias("repo_created_at"),
        *[F.sum(m).alias(m) for m in COUNT_METRICS],
        *[F.try_divide(F.sum(f"{m}_sum").cast("double"), F.sum(f"{m}_n")).alias(m)
          for m in MEAN_METRICS],
        F.count("who").alias("contributors"))


def monthly_metrics(timeline: DataFrame, repo: DataFrame, base_year: int = 2014, years: int = 3,
                    rows_per_split: int = skew.ROWS_PER_SPLIT) -> DataFrame:
    """16 metrics per repository, project month and calendar month of the events.

    Repositories with more than ``rows_per_split`` rows combine per contributor before they shuffle. All others have few
    rows a contributor and month, so their rows are shuffled once, narrow, and not combined before.
    """
    hot = skew.settled(skew.hot_keys(timeline, _TIMELINE_KEY, rows_per_split))
    others = timeline if hot is None else timeline.join(F.broadcast(hot), _TIMELINE_KEY, "left_anti")
    merged = _months_of_contributors(_narrow(_joined(others, repo, base_year, years, None)).repartition(*_MONTH_KEY))
    if hot is not None:
        most = timeline.join(F.broadcast(hot), _TIMELINE_KEY, "left_semi")
        merged = merged.unionByName(_months_of_contributors(_narrow(_joined(most, repo, base_year, years, hot))))
    return merged.select(
        *REPO_KEY, "user_type", "month", F.date_format("first_day", "yyyy_MM").alias("calendar_month"),
        cohort_index(F.col("repo_created_at"), base_year, years).alias("repo_index"),
        "repo_created_at", *METRICS)


#: The key in the order of a sort: owners have many repositories.
_BY_REPO = REPO_KEY[::-1]


def _passes(bands: list[AgeBand]) -> Column:
    ok = F.lit(False)
    for band in bands:
        age = F.col("max_month") >= band.first
        if band.last is not None:
            age = age & (F.col("max_month") <= band.last)
        ok = ok | (age & (F.col("total_watchers") > band.watchers) & (F.col("total_forks") > band.forks))
    return ok


_TOTALS = [("max_month", F.max, "month"), ("total_watchers", F.sum, "watchers"),
           ("total_forks", F.sum, "forks")]


def active_repositories(monthly: DataFrame, bands: list[AgeBand] | None = None) -> DataFrame:
    """Repositories with enough watchers and forks for their age."""
    return (monthly.groupBy(*REPO_KEY)
            .agg(*[fn(col).alias(name) for name, fn, col in _TOTALS])
            .filter(_passes(bands or AGE_BANDS)))


def project_month_metrics(monthly: DataFrame, bands: list[AgeBand] | None = None) -> DataFrame:
    """Calendar-month pieces of the surviving repositories, re-aggregated by project month.

    One shuffle by repository serves the survivor totals, the aggregate and later windows. A
    repository has at most a few rows per month of its life here, so no group is large. The order is that of the
    aggregate and the later windows, so rows are sorted once.
    """
    by_repo = (Window.partitionBy(*_BY_REPO).orderBy("user_type", "month")
               .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    totals = monthly.repartition(*REPO_KEY).select(
        "*", *[fn(col).over(by_repo).alias(name) for name, fn, col in _TOTALS])
    return (
        totals.filter(_passes(bands or AGE_BANDS))
        .groupBy(*_BY_REPO, "user_type", "month")
        .agg(F.min("repo_index").alias("repo_index"),
             F.max("repo_created_at").alias("repo_created_at"),
             *[F.sum(m).alias(m) for m in COUNT_METRICS],
             *[F.avg(m).alias(m) for m in MEAN_METRICS],
             F.sum("contributors").alias("contributors"))
    )


def cumulative_metrics(project_months: DataFrame) -> DataFrame:
    """Running sums, and running means of the monthly means, over the months of a repository."""
    upto = (Window.partitionBy(*_BY_REPO, "user_type").orderBy("month")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return project_months.select(
        *REPO_KEY, "user_type", "month",
        F.min("repo_index").over(upto).alias("repo_index"),
        F.max("repo_created_at").over(upto).alias("repo_created_at"),
        *[F.sum(m).over(upto).alias(m) for m in COUNT_METRICS],
        *[F.avg(m).over(upto).alias(m) for m in MEAN_METRICS],
        F.sum("contributors").over(upto).alias("contributors"))
