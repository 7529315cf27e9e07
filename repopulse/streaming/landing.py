"""Landing of spooled files, and the event normaliser as a stream.

Each function starts a query that takes everything present and stops (``availableNow``), the way
a scheduled landing run does. Progress lives in the checkpoint; starting over means passing a new checkpoint
folder. The two-lane landing keeps a manifest of the files it has landed, so it starts over without
landing anything twice.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from repopulse import schemas
from repopulse.operators import events as ev
from repopulse.session import delete
from repopulse.sources import files

# --- Fixed values ---------------------------------------------------------------------------
MAX_FILES_PER_BATCH = 1_000
# -------------------------------------------------------------------------------------------

_MANIFEST = "path string, name string, size long, modified timestamp, file string, version string, batch int"
_FILE = ["path", "name", "size", "modified", "file", "version"]


def spooled_lines(spark: SparkSession, spool_dir: str, pattern: str = "*",
                  max_files: int = MAX_FILES_PER_BATCH) -> DataFrame:
    return (spark.readStream.option("pathGlobFilter", pattern)
            .option("maxFilesPerTrigger", max_files).text(spool_dir))


def spooled_lines_by_file(spark: SparkSession, spool_dir: str, pattern: str = "*",
                          max_files: int = MAX_FILES_PER_BATCH) -> DataFrame:
    """Lines with what tells their file from all others: full path, size and modification time."""
    about = F.col("_metadata")
    return spooled_lines(spark, spool_dir, pattern, max_files).select(
        "value", about["file_path"].alias("path"), about["file_name"].alias("name"), about["file_size"].alias("size"),
        about["file_modification_time"].alias("modified"))


def land_lines(spark: SparkSession, spool_dir: str, lake_dir: str, checkpoint: str,
               pattern: str = "*", max_files: int = MAX_FILES_PER_BATCH) -> StreamingQuery:
    """Copy new spooled lines unchanged."""
    return (spooled_lines(spark, spool_dir, pattern, max_files).writeStream.format("text")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(lake_dir))


def manifest(spark: SparkSession, lake_dir: str) -> DataFrame:
    """Every landed version of every file, and the batch that landed it; hidden from readers of the lake."""
    return files.read_partitioned(spark, f"{lake_dir}/_manifest", _MANIFEST)


def landed_lines(spark: SparkSession, lake_dir: str) -> DataFrame:
    """Landed lines with their lane and the path and name of their file; batches that were never finished don't count."""
    last = F.max_by(F.struct(*_FILE), "batch").alias("last")
    current = manifest(spark, lake_dir).groupBy("file").agg(last).select("last.*")
    lines = spark.read.schema("value string, file string, version string, lane string").text(lake_dir)
    return lines.join(current, ["file", "version"]).select("value", "lane", "path", "name")


def land_with_rejects(lines: DataFrame, is_valid: Column, lake_dir: str,
                      checkpoint: str) -> StreamingQuery:
    """Lines in two lanes, ``lane=valid`` and ``lane=reject``, written in one pass per batch.

    ``lines`` are ``spooled_lines_by_file``. A file is known by its full path, so equal names in several folders are
    different files, and a version of it by size and modification time. A batch lands the versions that the
    manifest does not have, then enters them in the manifest, then removes older versions of the same
    files. Whatever is repeated - a batch after a failure, or everything with a new checkpoint - is found in the
    manifest, or replaces what the failed batch wrote. Rows of files that have left the spool stay.
    """
    lane = F.when(is_valid, F.lit("valid")).otherwise(F.lit("reject"))
    named = lines.withColumns({"file": F.md5("path"), "version": F.md5(F.concat_ws(" ", "size", F.unix_micros("modified"))), "lane": lane})

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known = manifest(spark, lake_dir)
        # A batch has at most as many files as a trigger takes, so both lists below are bounded by that.
        present = F.broadcast(batch.select(*_FILE).distinct())
        number = (known.agg(F.max("batch")).first()[0] or 0) + 1
        landed = known.join(present.select("file", "version"), ["file", "version"], "left_semi").select("file", "version").collect()
        done = spark.createDataFrame([tuple(r) for r in landed], "file string, version string")
        new = batch.join(F.broadcast(done), ["file", "version"], "left_anti")
        entries = spark.createDataFrame(new.select(*_FILE).distinct().collect(), ", ".join(_MANIFEST.split(", ")[:-1]))
        if entries.isEmpty():
            return
        (new.select("value", "file", "version", "lane").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("file", "version", "lane").text(lake_dir))
        entries.coalesce(1).write.mode("overwrite").parquet(f"{lake_dir}/_manifest/batch={number}")
        older = known.join(F.broadcast(entries.select("file", F.col("version").alias("now"))), "file").filter(F.col("version") != F.col("now"))
        for r in older.select("file", "version").distinct().collect():
            delete(spark, f"{lake_dir}/file={r.file}/version={r.version}")

    return (named.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def archive_stream(spark: SparkSession, path: str, max_files: int = MAX_FILES_PER_BATCH) -> DataFrame:
    return (spark.readStream.schema(schemas.ARCHIVE).option("maxFilesPerTrigger", max_files)
            .json(path))


def normalise_stream(raw: DataFrame, out_dir: str, checkpoint: str,
                     pick: Callable[[DataFrame], DataFrame] = ev.timeline_events) -> StreamingQuery:
    """The batch normaliser on a stream; ``pick`` chooses the timeline or the new repositories."""
    return (pick(ev.classify_events(raw)).writeStream.format("parquet")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out_dir))
