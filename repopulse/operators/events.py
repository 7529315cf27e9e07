"""Raw archive rows -> typed timeline, new repositories and rejected rows."""

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repopulse import schemas

# --- Fixed values: event names and time formats ---------------------------------------------
UNTRACKED_EVENTS = [
    "DeleteEvent", "DeploymentEvent", "DeploymentStatusEvent", "FollowEvent", "ForkApplyEvent",
    "GollumEvent", "MemberEvent", "MembershipEvent", "PageBuildEvent", "StatusEvent",
    "TeamAddEvent",
]
CREATED_PATTERN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\.000000$"
# -------------------------------------------------------------------------------------------


def blank(col: Column) -> Column:
    """Missing, empty or spaces only."""
    return F.coalesce(F.trim(col), F.lit("")) == ""


def drop_untracked(events: DataFrame, column: str = "type") -> DataFrame:
    return events.filter(~F.coalesce(F.col(column), F.lit("")).isin(UNTRACKED_EVENTS))


def require_fields(events: DataFrame, columns=("repo_name", "type", "created")) -> DataFrame:
    for column in columns:
        events = events.filter(~blank(F.col(column)))
    return events


def split_repository(events: DataFrame, column: str = "repo_name") -> DataFrame:
    """Owner and name; rows whose text does not have exactly two parts are dropped."""
    parts = F.split(F.col(column), "/")
    return events.filter(F.size(parts) == 2).select(
        "*", parts[0].alias("repository_owner"), parts[1].alias("repository_name"))


def user_type(org_id: Column, org_login: Column) -> Column:
    empty = (F.coalesce(org_id, F.lit("")) == "") & (F.coalesce(org_login, F.lit("")) == "")
    return F.when(empty, F.lit("User")).otherwise(F.lit("Organization"))


def canonical_action(event: Column, action: Column) -> Column:
    """opened / closed for pull requests and issues, '' for other events, NULL = not wanted."""
    with_action = event.isin("PullRequestEvent", "IssuesEvent")
    return (F.when(~with_action, F.lit(""))
            .when(action.isin("opened", "reopened"), F.lit("opened"))
            .when(action == "closed", F.lit("closed")))


def _iso_time(text: Column) -> Column:
    return F.try_to_timestamp(
        F.replace(F.replace(text, F.lit("T"), F.lit(" ")), F.lit("Z")),
        F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")


def created_time(text: Column) -> Column:
    """The time of a row of the archive; NULL if it is not of the fixed form or no such time exists."""
    seconds = F.when(text.rlike(CREATED_PATTERN), F.substring(text, 1, 19))
    return F.try_to_timestamp(seconds, F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")


def timed(raw: DataFrame) -> DataFrame:
    """The archive with the time of each row, read once, as ``_time``.

    Exploding a one-element list pins it as a column; as a plain expression it would be copied into every later filter
    and condition and read again in each.
    """
    return raw.select("*", F.explode_outer(F.array(created_time(F.col("created")))).alias("_time"))


def classify_events(raw: DataFrame) -> DataFrame:
    """One pass over the archive: every row with its ``outcome`` and its parsed columns.

    ``outcome`` is ``timeline``, ``new_repo``, ``skipped`` (not wanted) or ``rejected`` (broken,
    with ``reason``). The expression is stateless, so it serves batches and streams alike.
    Rows that are ``timed`` already keep their ``_time``.
    """
    # the parsed payload is pinned like the time
    parsed = F.from_json("payload", schemas.PAYLOAD, {"columnNameOfCorruptRecord": "_corrupt"})
    own_time = [] if "_time" in raw.columns else ["_time"]
    rows = (timed(raw) if own_time else raw).select("*", F.split(F.col("repo_name"), "/").alias("_parts"),
                                                    F.explode_outer(F.array(parsed)).alias("_json"))
    event, body, created = F.col("type"), F.col("_json"), F.col("_time")
    is_pull, is_issue = event == "PullRequestEvent", event == "IssuesEvent"
    is_comment, is_create = event == "CommitCommentEvent", event == "CreateEvent"
    action = canonical_action(event, body["action"])

    missing = (
        (is_create & body["ref_type"].isNull())
        | (is_pull & (body["number"].isNull() | body["pull_request"].isNull() | body["action"].isNull()))
        | (is_issue & (body["issue"].isNull() | body["issue"]["number"].isNull() | body["action"].isNull()))
        | (is_comment & body["comment"].isNull())
    )
    reason = (
        F.when(F.coalesce(F.size("_parts"), F.lit(0)) != 2, F.lit("bad_repo_name"))
        .when(blank(event) | blank(F.col("created")), F.lit("blank_field"))
        .when(event.isin(UNTRACKED_EVENTS), F.lit(None))
        .when(created.isNull(), F.lit("bad_time"))
        .when(body.isNull() | body["_corrupt"].isNotNull(), F.lit("bad_json"))
        .when(missing, F.lit("missing_field"))
    )
    outcome = (
        F.when(F.col("reason").isNotNull(), F.lit("rejected"))
        .when(event.isin(UNTRACKED_EVENTS), F.lit("skipped"))
        .when((event == "PublicEvent") | (is_create & (body["ref_type"] == "repository")), F.lit("new_repo"))
        .when(is_create | action.isNull(), F.lit("skipped"))
        .otherwise(F.lit("timeline"))
    )
    number = (F.when(is_pull, body["number"]).when(is_issue, body["issue"]["number"])
              .when(is_comment, body["comment"]["commit_id"]))
    subject_created = F.when(is_pull, body["pull_request"]["created_at"]).when(
        is_issue, body["issue"]["created_at"])
    subject_closed = F.when(is_pull, body["pull_request"]["closed_at"]).when(
        is_issue, body["issue"]["closed_at"])
    return rows.withColumn("reason", reason).select(
        "*",
        outcome.alias("outcome"),
        F.get("_parts", F.lit(0)).alias("repository_owner"),
        F.get("_parts", F.lit(1)).alias("repository_name"),
        created.alias("created_at"),
        event.alias("event"),
        F.coalesce(action, F.lit("")).alias("event_action"),
        F.coalesce(number, F.lit("")).alias("event_number"),
        _iso_time(subject_created).alias("event_created_at"),
        F.when(action == "closed", _iso_time(subject_closed)).alias("event_closed_at"),
        user_type(F.col("org_id"), F.col("org_login")).alias("user_type"),
    ).drop("_parts", "_json", *own_time)


def timeline_events(classified: DataFrame) -> DataFrame:
    return classified.filter("outcome = 'timeline'").select(*schemas.TIMELINE.fieldNames())


def new_repositories(classified: DataFrame) -> DataFrame:
    return classified.filter("outcome = 'new_repo'").select(
        "repository_owner", "repository_name", F.col("created_at").alias("repo_created_at"),
        "user_type")


def rejected_events(classified: DataFrame, raw_columns: list[str]) -> DataFrame:
    return classified.filter("outcome = 'rejected'").select(*raw_columns, "reason")


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the smallest by ``order`` and then by the remaining columns.

    A ``min`` over structs combines map-side, so a key with very many copies never has to fit
    into one task the way a row_number window would need.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(order)], *rest)
    return df.groupBy(*keys).agg(F.min(ranked).alias("_first")).select(
        *keys, *[F.col(f"_first.{c}").alias(c) for c in rest]).select(*df.columns)


def dedupe_repositories(repos: DataFrame) -> DataFrame:
    """The earliest creation of each repository."""
    return keep_first(repos, ["repository_owner", "repository_name"],
                      [F.col("repo_created_at").isNull(), F.col("repo_created_at")])


def day_slices(events: DataFrame, column: str, step_hours: int = 3) -> DataFrame:
    """Equal half-open slices of each day, numbered from 0; ``step_hours`` must divide 24."""
    if 24 % step_hours:
        raise ValueError("step_hours must divide 24")
    return events.withColumn("day", F.to_date(column)).withColumn(
        "slice", F.floor(F.hour(column) / F.lit(step_hours)).cast("int"))


def time_range(events: DataFrame, column: str, start: dt.datetime, end: dt.datetime) -> DataFrame:
    """Half-open range; a plain comparison, so it is pushed into the scan."""
    bounds = [F.lit(t.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz") for t in (start, end)]
    return events.filter((F.col(column) >= bounds[0]) & (F.col(column) < bounds[1]))


def days_to_load(events: DataFrame, column: str, last_run: dt.date, as_of: dt.date) -> DataFrame:
    """Whole days after the last loaded one and before ``as_of``."""
    start = dt.datetime.combine(last_run, dt.time()) + dt.timedelta(days=1)
    return time_range(events, column, start, dt.datetime.combine(as_of, dt.time()))
