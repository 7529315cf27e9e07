"""Timeline and repositories -> monthly, cumulative and normalised metrics, vectors, scores."""

import dataclasses

from pyspark.sql import DataFrame

from repopulse.operators import features, metrics, normalize, scoring
from repopulse.operators.metrics import AgeBand
from repopulse.session import cut_lineage
from repopulse.sources import files


@dataclasses.dataclass(frozen=True)
class MetricsRun:
    """Lazy results of one run. Both user types are in every frame; writers partition by them."""
    monthly: DataFrame
    cumulative: DataFrame
    normalized: DataFrame
    vectors: DataFrame


def monthly_of(timeline: DataFrame, repo: DataFrame, base_year: int = 2014, years: int = 3) -> DataFrame:
    return metrics.monthly_metrics(timeline, repo, base_year, years)


def run_metrics(timeline: DataFrame, repo: DataFrame, base_year: int = 2014, years: int = 3,
                bands: list[AgeBand] | None = None) -> MetricsRun:
    """The events are read once: the monthly table is written and everything else starts there."""
    monthly = cut_lineage(metrics.monthly_metrics(timeline, repo, base_year, years), "monthly")
    return derive(monthly, bands)


def derive(monthly: DataFrame, bands: list[AgeBand] | None = None) -> MetricsRun:
    """Cumulative metrics are a result of their own and feed two later steps, so they are written."""
    cumulative = cut_lineage(
        metrics.cumulative_metrics(metrics.project_month_metrics(monthly, bands)), "cumulative")
    normalized = normalize.normalized_metrics(cumulative)
    return MetricsRun(monthly, cumulative, normalized, features.feature_vectors(normalized))


def write_results(run: MetricsRun, out: str, scores: DataFrame | None = None) -> None:
    """Headered CSV results: monthly by calendar month, the others by user type."""
    files.write_csv(run.monthly, f"{out}/monthly_metrics.csv", ["calendar_month"])
    for name, df in {"derived_metrics": run.cumulative, "derived_metrics_normalized": run.normalized,
                     "model_score": scores}.items():
        if df is not None:
            files.write_csv(df, f"{out}/{name}.csv", ["user_type"])


def score(run: MetricsRun, models: scoring.Models) -> DataFrame:
    return scoring.score_repositories(run.vectors, models)
