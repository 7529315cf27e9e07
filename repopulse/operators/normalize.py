"""Forward fill, exact cohort quantiles and capped ratios."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repopulse.schemas import METRICS, REPO_KEY

COHORT = ["user_type", "month", "repo_index"]
NO_COHORT = "0"
_BUCKETS_PER_DOUBLING = 1024


def forward_fill(df: DataFrame, columns: Sequence[str] = METRICS) -> DataFrame:
    """Last known value of each repository in month order, 0 where there is none yet."""
    upto = (Window.partitionBy(*REPO_KEY).orderBy("month")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    filled = {c: F.coalesce(F.last(c, ignorenulls=True).over(upto), F.lit(0)) for c in columns}
    if "repo_index" in df.columns:
        filled["repo_index"] = F.coalesce("repo_index", F.lit(NO_COHORT))
    return df.withColumns(filled)


def _bucket(value: Column) -> Column:
    """Order-preserving coarse bucket: about a million a sign over the whole double range, whatever the rows."""
    return F.signum(value) * F.floor(F.log2(F.abs(value) + 1) * _BUCKETS_PER_DOUBLING)


def exact_percentiles(df: DataFrame, keys: Sequence[str], columns: Sequence[str], q: float) -> DataFrame:
    """Exact, linearly interpolated quantile of each column per group, as ``<column>_p``.

    A group may hold a large share of all rows, so no task ever sees a whole one: equal values are
    counted first (combined map-side), then rows per coarse bucket (a bounded number) locate the
    one or two buckets with the wanted ranks, and only the values inside those are put in order.
    """
    keys = list(keys)
    pairs = ", ".join(f"'{c}', CAST({c} AS DOUBLE)" for c in columns)
    group = [*keys, "metric"]
    counted = (
        df.select(*keys, F.expr(f"stack({len(columns)}, {pairs}) AS (metric, value)"))
        .filter(F.col("value").isNotNull())
        .groupBy(*group, "value").agg(F.count("*").alias("rows"))
        .withColumn("bucket", _bucket(F.col("value")))
    )

    # Ranks are 1-based; the quantile lies between the lower and the upper rank.
    position = (F.col("n") - 1) * F.lit(q)
    whole, in_order = Window.partitionBy(*group), Window.partitionBy(*group).orderBy("bucket")
    wanted = (
        counted.groupBy(*group, "bucket").agg(F.sum("rows").alias("bucket_rows"))
        .withColumn("upto", F.sum("bucket_rows").over(in_order))
        .withColumn("n", F.sum("bucket_rows").over(whole))
        .withColumn("lower", F.floor(position) + 1).withColumn("upper", F.ceil(position) + 1)
        .withColumn("before", F.col("upto") - F.col("bucket_rows"))
        .filter((F.col("before") < F.col("upper")) & (F.col("upto") >= F.col("lower")))
        .select(*group, "bucket", "n", "before", "lower", "upper")
    )
    by_value = Window.partitionBy(*group, "bucket").orderBy("value")
    ranked = (
        counted.join(wanted, [*group, "bucket"])
        .withColumn("last", F.col("before") + F.sum("rows").over(by_value))
        .withColumn("first", F.col("last") - F.col("rows") + 1)
    )

    def at(rank: str) -> Column:
        return F.max(F.when(F.col(rank).between(F.col("first"), F.col("last")), F.col("value")))

    fraction = F.max(position) - (F.max("lower") - 1)
    quantile = at("lower") + fraction * (at("upper") - at("lower"))
    return (
        ranked.groupBy(*group).agg(quantile.alias("p"))
        .groupBy(*keys)
        .agg(*[F.max(F.when(F.col("metric") == c, F.col("p"))).alias(f"{c}_p") for c in columns])
    )


def cohort_p95(filled: DataFrame) -> DataFrame:
    """95th percentile of the 16 metrics per user type, project month and creation cohort."""
    return exact_percentiles(filled, COHORT, METRICS, 0.95)


def capped_ratio(value: Column, p95: Column) -> Column:
    """Share of the 95th percentile, at most 1; the raw value where the percentile is 0."""
    return (F.when(p95 == 0, value.cast("double"))
            .when(value > p95, F.lit(1.0))
            .otherwise(value / p95))


def normalized_metrics(cumulative: DataFrame) -> DataFrame:
    """Forward fill, cohort percentiles, capped ratios.

    The percentile table has one row per user type, project month and cohort: its size follows the
    calendar (two types, twelve months a year, a dozen cohorts), not the data, so it is broadcast
    and a cohort with a third of all repositories needs no shuffle.
    """
    filled = forward_fill(cumulative)
    return filled.join(F.broadcast(cohort_p95(filled)), COHORT).select(
        *REPO_KEY, "user_type", "month", "repo_index", "repo_created_at",
        *[capped_ratio(F.col(m), F.col(f"{m}_p")).alias(m) for m in METRICS])
