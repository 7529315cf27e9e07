"""Complete month spines and fixed-order feature vectors."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repopulse.schemas import REPO_KEY, SCORED_METRICS

LAST_SCORED_MONTH = 18
_REPO = [*REPO_KEY, "user_type"]


def month_spine(df: DataFrame, columns: Sequence[str] = SCORED_METRICS,
                carried: Sequence[str] = ()) -> DataFrame:
    """Every month 1..max of each repository; gaps carry the last known value, 0 before the first.

    Each row stands for the months up to the next one, so a gap needs no join: one window by
    repository, then an explode. ``carried`` columns have their largest value in every row.
    """
    months = Window.partitionBy(*_REPO).orderBy("month")
    until = F.coalesce(F.lead("month").over(months) - 1, F.col("month"))
    upto = months.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = df.select(
        *_REPO, "month", until.alias("until"),
        (F.row_number().over(months) == 1).alias("is_first"),
        *[F.max(c).over(Window.partitionBy(*_REPO)).alias(c) for c in carried],
        *[F.coalesce(F.last(c, ignorenulls=True).over(upto), F.lit(0)).cast("double").alias(c)
          for c in columns])
    spread = known.withColumnRenamed("month", "known_month").select(
        "*", F.explode(F.sequence(
            F.when(F.col("is_first"), F.lit(1).cast("long")).otherwise(F.col("known_month").cast("long")),
            F.col("until").cast("long"))).alias("month"))
    return spread.select(
        *_REPO, "month", *carried,
        *[F.when(F.col("month") >= F.col("known_month"), F.col(c)).otherwise(F.lit(0.0)).alias(c)
          for c in columns])


def feature_vectors(normalized: DataFrame, last_month: int = LAST_SCORED_MONTH) -> DataFrame:
    """11 metrics per month, month-major, over months 1..max(month) of each repository."""
    scored = normalized.filter(F.col("month") <= last_month)
    rows = F.array_sort(F.collect_list(F.struct("month", F.array(*SCORED_METRICS).alias("values"))))
    # A repository has at most ``last_month`` rows, which bounds the collected list.
    vectors = month_spine(scored, carried=["repo_created_at"]).groupBy(*_REPO).agg(
        F.max("repo_created_at").alias("repo_created_at"), F.max("month").alias("max_month"), rows.alias("rows"))
    return vectors.select(
        *_REPO, "repo_created_at", "max_month",
        F.flatten(F.transform("rows", lambda r: r["values"])).alias("features"))
