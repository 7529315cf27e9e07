"""Landed feed items -> posts of the lake, with the newest time of each source as its mark."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repopulse.session import cut_lineage
from repopulse.sources import feeds, files

_MARKS = T.StructType([T.StructField("source", T.StringType()), T.StructField("latest", T.TimestampNTZType()),
                       T.StructField("load", T.IntegerType())])


def read_marks(spark: SparkSession, lake: str) -> tuple[DataFrame, int]:
    """(source, latest) after the last complete load, and that load's number."""
    versions = files.read_partitioned(spark, f"{lake}/marks", _MARKS)
    number = versions.agg(F.max("load")).first()[0] or 0
    return versions.where(F.col("load") == number).drop("load"), number


def load_items(items: DataFrame, lake: str, boilerplate: dict[str, str] | None = None, pages: DataFrame | None = None) -> int:
    """Append the posts that are newer than their source's mark, then move the marks; returns the load's number.

    items: source, title, description, link, pubDate. pages: url, html of landed pages; the text of a post's page follows
    its summary, both in stored form. Items without a readable date go to ``rejects`` as they are. Each
    load has its own folders and its marks are written last, so a load that is repeated after a failure replaces
    what it wrote.
    """
    marks, last = read_marks(items.sparkSession, lake)
    load = last + 1
    posts = cut_lineage(feeds.item_posts(items.withColumns({"raw_date": F.col("pubDate"), "raw_text": F.col("description")})), "posts")
    unread = F.col("date_published").isNull()
    fresh = cut_lineage(feeds.newer_posts(posts.filter(~unread).drop("raw_date", "raw_text"), marks), "new-posts")
    full = fresh if pages is None else feeds.with_page_text(fresh, pages)
    feeds.clean_posts(full, boilerplate).write.mode("overwrite").parquet(f"{lake}/posts/load={load}")
    broken = posts.filter(unread).select("source", "title", F.col("raw_text").alias("description"), "link", F.col("raw_date").alias("pubDate"))
    broken.write.mode("overwrite").parquet(f"{lake}/rejects/load={load}")
    merged = feeds.merged_marks(marks, feeds.new_marks(fresh))
    merged.coalesce(1).write.mode("overwrite").parquet(f"{lake}/marks/load={load}")  # one row a source
    return load
