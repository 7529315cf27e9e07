"""The two rewrites that matter, timed against the plain form: ``python -m checks.ratios [sf_dir]``."""

import sys
import time

from pyspark.sql import functions as F

from checks.queries import BANDS, BASE_YEAR, YEARS, _consolidated
from checks.tables import Tables
from checks.verify import local_session
from repopulse.operators import mentions, metrics
from repopulse.schemas import COUNT_METRICS, MEAN_METRICS
from repopulse.session import cut_lineage


def seconds(make) -> float:
    make().write.format("noop").mode("overwrite").save()
    start = time.perf_counter()
    make().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def theta_cumulative(months):
    a, b = months.alias("a"), months.alias("b")
    same = (F.col("a.repo_owner") == F.col("b.repo_owner")) & (F.col("a.repo_name") == F.col("b.repo_name"))
    return (a.join(b, same & (F.col("a.month") >= F.col("b.month")))
            .groupBy("a.repo_owner", "a.repo_name", "a.user_type", "a.month")
            .agg(*[F.sum(f"b.{m}").alias(m) for m in [*COUNT_METRICS, "contributors"]],
                 *[F.avg(f"b.{m}").alias(m) for m in MEAN_METRICS]))


def nested_loop_mentions(info):
    keys = mentions.mention_keys(info).select("key").distinct()
    return keys.join(info.select("doc_id", "description"), F.contains(F.col("description"), F.col("key")))


def main() -> None:
    spark = local_session()
    t = Tables(spark, sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
    bands = [metrics.AgeBand(1, None, 0, 0)]
    months = cut_lineage(metrics.project_month_metrics(
        metrics.monthly_metrics(t["f_timeline"], t["f_repo"], BASE_YEAR, YEARS), bands or BANDS))
    info = _consolidated(t)
    for name, ours, plain in (
            ("cumulative_metrics", lambda: metrics.cumulative_metrics(months), lambda: theta_cumulative(months)),
            ("name_mentions", lambda: mentions.name_mentions(info, mentions.mention_keys(info)),
             lambda: nested_loop_mentions(info))):
        fast, slow = seconds(ours), seconds(plain)
        print(f"{name}: {fast:.2f} s, plain form {slow:.2f} s, ratio {slow / fast:.1f}", flush=True)


if __name__ == "__main__":
    main()
