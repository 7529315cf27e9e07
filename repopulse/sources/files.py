"""Headered CSV and line files: readers, writers, partition layouts, freshness."""

import datetime as dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repopulse.functions.dates import months_back
from repopulse.functions.text import SPONSORED

# --- Fixed values ---------------------------------------------------------------------------
FRESHNESS_FILE = "last_updated_at"
CSV_TIME = "yyyy-MM-dd HH:mm:ss"
# -------------------------------------------------------------------------------------------


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType,
             drop_malformed: bool = False, multi_line: bool = False) -> DataFrame:
    """Headered CSV files of one or many folders under a declared schema (no inference pass)."""
    return (spark.read.schema(schema).option("header", True).option("escape", '"')
            .option("multiLine", multi_line)
            .option("mode", "DROPMALFORMED" if drop_malformed else "PERMISSIVE")
            .option("columnPruning", not drop_malformed)
            .option("timestampNTZFormat", CSV_TIME)
            .csv(paths if isinstance(paths, str) else list(paths)))


def read_text_csv(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Every column as text; an empty field is the empty string."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return read_csv(spark, paths, schema).na.fill("")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines without sponsored posts, split on every comma (quotes are not special)."""
    lines = spark.read.text(path).filter(~F.contains("value", F.lit(SPONSORED)))
    return lines.select(F.split("value", ",").alias("fields"))


def drop_header_rows(df: DataFrame, column: str) -> DataFrame:
    """Rows that repeat the header, as repeated appends leave behind; NULLs are kept."""
    return df.filter(~F.col(column).eqNullSafe(F.lit(column)))


def source_of_file(df: DataFrame, prefix: str) -> DataFrame:
    """``source`` from files or folders named ``<prefix><source>.csv``."""
    return df.withColumn("source", F.regexp_extract(
        F.col("_metadata.file_path"), rf"{prefix}(.+?)\.csv", 1))


def prune_months(df: DataFrame, as_of: dt.datetime, n_months: int) -> DataFrame:
    """Only the year/month partitions a run of ``n_months`` back needs."""
    (y0, m0), (y1, m1) = months_back(as_of, n_months)
    number = F.col("year") * 12 + F.col("month")
    return df.filter(number.between(y0 * 12 + m0, y1 * 12 + m1))


def with_half_month(df: DataFrame, column: str) -> DataFrame:
    """Partition columns of the timeline: year, month, half (1 up to day 15, else 2)."""
    return df.withColumns({
        "year": F.year(column), "month": F.month(column),
        "half": F.when(F.dayofmonth(column) <= 15, 1).otherwise(2)})


def bucket_name(column: str, half: str = "half"):
    """Name of a half-month file, e.g. 1995_Mar_1."""
    return F.concat_ws("_", F.date_format(column, "yyyy_MMM"), F.col(half))


def write_partitioned(df: DataFrame, path: str, partitions: Sequence[str]) -> None:
    """Parquet, replacing only the partitions present in ``df``, so a rerun is harmless.

    Rows are sent to their partition first (salted by Spark's own adaptive rebalancing), which
    keeps the number of files low without one task per large partition.
    """
    (df.hint("rebalance", *partitions).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path))


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A partitioned table under a declared schema; empty where nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def write_timeline(timeline: DataFrame, path: str) -> None:
    write_partitioned(with_half_month(timeline, "created_at"), path, ["year", "month", "half"])


def write_repositories(repos: DataFrame, path: str) -> None:
    write_partitioned(repos.withColumn("year", F.year("repo_created_at")), path, ["year"])


def write_csv(df: DataFrame, path: str, partitions: Sequence[str] = ()) -> None:
    """Headered CSV result; arrays are written as JSON text."""
    arrays = {f.name: F.to_json(f.name) for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)}
    out = (df.withColumns(arrays) if arrays else df).write.mode("overwrite") \
        .option("header", True).option("escape", '"').option("emptyValue", '""') \
        .option("timestampFormat", CSV_TIME).option("timestampNTZFormat", CSV_TIME)
    (out.partitionBy(*partitions) if partitions else out).csv(path)


def file_freshness(spark: SparkSession, path: str) -> DataFrame:
    """Result name and latest modification for every result below ``path`` except this table.

    Only file metadata is read; a result is a folder of part files here.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
             .select("path", "modificationTime"))
    relative = F.substring_index(F.col("path"), path.rstrip("/") + "/", -1)
    return (files.withColumn("file_name", F.split_part(relative, F.lit("/"), F.lit(1)))
            .filter(~F.startswith("file_name", F.lit(FRESHNESS_FILE)))
            .groupBy("file_name").agg(F.max("modificationTime").alias("last_modified")))
