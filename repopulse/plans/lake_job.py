"""Landed archive files -> timeline and repository tables of the lake, loaded day by day.

Every load has its own folder in each table and a row in the ledger ``loads``, written last, that commits it. The
table ``landed`` holds a checksum of every row that a load took, by lane: one lane a day, and one for rows of
no readable day. A load takes the days after the last loaded one as they come; of all other rows, late ones of
loaded days and undated ones, it takes what ``landed`` doesn't have yet. So it doesn't matter
whether the new rows alone or the whole archive is given, once or again.
"""

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repopulse import schemas
from repopulse.functions.dates import months_back
from repopulse.operators import events as ev
from repopulse.operators.metrics import AgeBand
from repopulse.plans import metrics_job
from repopulse.session import cut_lineage, shared_path
from repopulse.sources import files

UNDATED = "undated"
COPIES_PER_ROW = 100_000

_LOADS = "load int, last_day date, rows long, late_rows long"
_TIMELINE = T.StructType(schemas.TIMELINE.fields + [T.StructField(c, T.IntegerType()) for c in ("load", "year", "month", "half")])
_REPOSITORIES = T.StructType(schemas.REPO.fields + [T.StructField("load", T.IntegerType())])


def content_key(columns: list[str]) -> Column:
    """128 bits that stand for all of a row's fields; missing and empty ones differ."""
    return F.unhex(F.md5(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"})))


def lane(created: Column) -> Column:
    """The day of a row as text, or the lane of the rows whose time can't be read."""
    return _lane(ev.created_time(created))


def _lane(time: Column) -> Column:
    return F.coalesce(F.date_format(time, "yyyy-MM-dd"), F.lit(UNDATED))


def committed(spark: SparkSession, lake: str, first_run: dt.date) -> tuple[int, dt.date]:
    """Number of the last complete load, 0 if none, and the last loaded day."""
    newest = files.read_partitioned(spark, f"{lake}/loads", _LOADS).agg(F.max("load").alias("n"), F.max("last_day").alias("day")).first()
    return newest["n"] or 0, newest["day"] or first_run


def read_loaded(spark: SparkSession, lake: str, table: str, schema: T.StructType | None = None) -> DataFrame:
    """A table of the lake without what an unfinished load left behind; without a schema it is read from the files."""
    rows = files.read_partitioned(spark, f"{lake}/{table}", schema) if schema else spark.read.parquet(f"{lake}/{table}")
    return rows.filter(F.col("load") <= committed(spark, lake, dt.date.min)[0])


def read_timeline(spark: SparkSession, lake: str) -> DataFrame:
    """Timeline rows with their year, month and half, by which reads can be pruned."""
    return read_loaded(spark, lake, "timeline", _TIMELINE).drop("load")


def read_repositories(spark: SparkSession, lake: str) -> DataFrame:
    """The earliest creation of every repository over all loads."""
    return ev.dedupe_repositories(read_loaded(spark, lake, "repositories", _REPOSITORIES).drop("load"))


def unseen_rows(rows: DataFrame, seen: DataFrame) -> DataFrame:
    """Rows of ``rows`` beyond the copies that ``seen`` has of the same (lane, key).

    ``rows`` are written and have a different number ``_id`` each. Equal rows are one key with a count, combined before
    they are shuffled; only keys, counts and numbers move, and whole rows just of the keys that have new copies, one row
    each, met by its number. The copies are made again in steps that are dealt out, so a row that is delivered very often
    is no task's load.
    """
    at, columns = ["lane", "key"], [c for c in rows.columns if c != "_id"]
    grouped = rows.groupBy(*at).agg(F.count("*").alias("_n"), F.min("_id").alias("_id"))
    counted = seen.groupBy(*at).agg(F.count("*").alias("_seen"))
    left = (grouped.join(counted, at, "left").withColumn("_n", F.col("_n") - F.coalesce("_seen", F.lit(0)))
            .filter(F.col("_n") > 0).select("_id", "_n"))
    steps = rows.join(left, "_id").select(*columns, "_n", F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / COPIES_PER_ROW))).alias("_step"))
    copies = F.least(F.lit(COPIES_PER_ROW), F.col("_n") - F.col("_step") * COPIES_PER_ROW).cast("int")
    return steps.hint("rebalance").select(*columns, F.explode(F.array_repeat(F.lit(0), copies)).alias("_copy")).drop("_copy")


def load_days(raw: DataFrame, lake: str, as_of: dt.date, first_run: dt.date) -> dt.date:
    """Load the days before ``as_of`` that are not loaded yet; returns the last loaded day.

    ``raw`` may hold the new rows only or any others too. Rows of days up to ``first_run`` belong to no load, rows
    from ``as_of`` on to a later one. Late rows of loaded days are added. A row that is given
    again is the same row; if it comes in more copies than before, the further copies are added. Broken rows,
    those without a readable time among them, go to ``rejects`` once. The archive is parsed once; a load that
    is repeated after a failure replaces what it wrote.
    """
    spark, columns = raw.sparkSession, raw.columns
    number, last = committed(spark, lake, first_run)
    load, newest = number + 1, max(last, as_of - dt.timedelta(days=1))
    day = F.to_date("_time")
    wanted = day.isNull() | ((day > F.lit(first_run)) & (day <= F.lit(newest)))
    classified = ev.classify_events(ev.timed(raw).filter(wanted)).withColumns({
        "lane": _lane(F.col("_time")), "key": content_key(columns), "late": day.isNull() | (day <= F.lit(last)),
        "_id": F.monotonically_increasing_id()}).drop("_time")
    path = shared_path(spark, "classified")
    classified.write.partitionBy("late", "outcome").parquet(path)
    numbered = spark.read.schema(classified.schema).parquet(path)
    given = numbered.drop("_id")

    again = numbered.filter("late")
    lanes = [r.lane for r in again.select("lane").distinct().collect()]  # days of the calendar
    seen = files.read_partitioned(spark, f"{lake}/landed", "key binary, load int, lane string").filter(
        (F.col("load") <= number) & F.col("lane").isin(lanes))
    added = cut_lineage(unseen_rows(again, seen), "late-rows")
    rows, late_rows = given.count(), added.count()
    rows += late_rows - again.count()
    if not rows and newest == last:
        return last
    taken = given.filter("NOT late").unionByName(added)

    def put(table: DataFrame, name: str, partitions: list[str]) -> None:
        out = table.hint("rebalance", *partitions).write.mode("overwrite")
        (out.partitionBy(*partitions) if partitions else out).parquet(f"{lake}/{name}/load={load}")

    put(files.with_half_month(ev.timeline_events(taken), "created_at"), "timeline", ["year", "month", "half"])
    found = ev.dedupe_repositories(ev.new_repositories(taken))
    key = ["repository_owner", "repository_name"]
    known = files.read_partitioned(spark, f"{lake}/repositories", _REPOSITORIES).filter(F.col("load") <= number)
    earlier = known.groupBy(*key).agg(F.min("repo_created_at").alias("_known"))
    fresh = found.join(earlier, key, "left").filter(F.col("_known").isNull() | (F.col("repo_created_at") < F.col("_known"))).drop("_known")
    put(fresh.withColumn("year", F.year("repo_created_at")), "repositories", ["year"])
    put(ev.rejected_events(taken, columns), "rejects", [])
    put(taken.select("lane", "key"), "landed", ["lane"])
    spark.createDataFrame([(newest, rows, late_rows)], "last_day date, rows long, late_rows long").write.mode("overwrite").parquet(
        f"{lake}/loads/load={load}")
    return newest


def run_metrics(spark: SparkSession, lake: str, as_of: dt.datetime, n_months: int, base_year: int = 2014,
                years: int = 3, bands: list[AgeBand] | None = None) -> metrics_job.MetricsRun:
    """Recompute the monthly table of the last ``n_months`` months and derive from all months."""
    timeline = files.prune_months(read_timeline(spark, lake), as_of, n_months)
    fresh = metrics_job.monthly_of(timeline.drop("year", "month", "half"), read_repositories(spark, lake), base_year, years)
    files.write_partitioned(fresh, f"{lake}/monthly", ["calendar_month"])
    return metrics_job.derive(spark.read.parquet(f"{lake}/monthly"), bands)


def months_of(as_of: dt.datetime, n_months: int) -> list[str]:
    """Names of the months a run covers, e.g. 2016_Apr."""
    (y0, m0), (y1, m1) = months_back(as_of, n_months)
    numbers = range(y0 * 12 + m0 - 1, y1 * 12 + m1)
    return [dt.date(n // 12, n % 12 + 1, 1).strftime("%Y_%b") for n in numbers]
