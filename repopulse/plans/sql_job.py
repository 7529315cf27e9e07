"""Results of the jobs as tables for SQL text."""

import dataclasses

from pyspark.sql import DataFrame, SparkSession

from repopulse.functions import sql
from repopulse.plans.metrics_job import MetricsRun
from repopulse.plans.posts_job import Rankings


def offer(spark: SparkSession, *runs: MetricsRun | Rankings | dict[str, DataFrame], base_year: int = 2014, years: int = 3) -> list[str]:
    """Register every result of the given runs under its name, and the date functions; returns the names.

    Results of runs are views: SQL text is planned together with what makes them, so its filters and columns reach the
    scans. Two results of one name are an error.
    """
    frames: dict[str, DataFrame] = {}
    for run in runs:
        results = run if isinstance(run, dict) else {f.name: getattr(run, f.name) for f in dataclasses.fields(run)}
        if twice := frames.keys() & results.keys():
            raise ValueError(f"two results are named {sorted(twice)}")
        frames |= results
    sql.register_sql_functions(spark, base_year, years)
    sql.register_views(frames)
    return sorted(frames)


def ask(spark: SparkSession, text: str, *runs: MetricsRun | Rankings | dict[str, DataFrame], base_year: int = 2014, years: int = 3) -> DataFrame:
    """The rows of one query in SQL text over the results of the given runs."""
    offer(spark, *runs, base_year=base_year, years=years)
    return spark.sql(text)
