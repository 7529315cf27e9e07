"""Landed service responses (JSON text per repository) -> rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repopulse import schemas

# --- Fixed values ---------------------------------------------------------------------------
MARKER = "___delematar___"
# -------------------------------------------------------------------------------------------


def _or_blank(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


def repository_details(responses: DataFrame) -> DataFrame:
    """13 repository columns. Broken responses keep their key, date and score with blanks."""
    body = F.col("_json")
    parsed = responses.withColumn("_json", F.from_json(
        "response", schemas.REPO_DETAILS, {"columnNameOfCorruptRecord": "_corrupt"}))
    usable = (body.isNotNull() & body["_corrupt"].isNull() & body["name"].isNotNull()
              & body["owner"]["login"].isNotNull() & body["owner"]["type"].isNotNull())

    def field(col: Column) -> Column:
        return F.when(usable, _or_blank(col)).otherwise(F.lit(""))

    return parsed.select(
        field(body["owner"]["login"]).alias("repository_owner"),
        field(body["name"]).alias("repository_name"),
        "full_name",
        field(body["owner"]["type"]).alias("owner_type"),
        field(F.translate(body["description"], ",'\"", "   ")).alias("description"),
        "created_at",
        *[field(body[c]).alias(c) for c in ("size", "language", "watchers_count", "forks_count",
                                            "open_issues_count", "default_branch")],
        "score")


def contributor_rows(responses: DataFrame) -> DataFrame:
    """One row per contributor; an empty or broken response gives one row with blanks."""
    item = F.col("item")
    return responses.select(
        "full_name", "created_at",
        F.explode_outer(F.from_json("response", schemas.CONTRIBUTOR_STATS)).alias("item"),
    ).select(
        "full_name",
        _or_blank(item["author"]["login"]).alias("author_login"),
        _or_blank(item["total"]).alias("contributions"),
        "created_at")


def pack(columns: list[Column]) -> Column:
    """One record as text, fields joined by the marker."""
    return F.concat_ws(MARKER, *[_or_blank(c) for c in columns])


def unpack(df: DataFrame, packed: str, names: list[str]) -> DataFrame:
    """Comma-separated packed records -> one row per record with the named columns."""
    records = df.select("*", F.explode(F.split(packed, ",")).alias("_record")).drop(packed)
    return records.select(
        *[c for c in records.columns if c != "_record"],
        *[F.split_part("_record", F.lit(MARKER), F.lit(i + 1)).alias(n) for i, n in enumerate(names)])
