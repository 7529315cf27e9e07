"""Feed posts: landed RSS items, per-source high-water marks, field clean-up."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repopulse.functions import text as tx
from repopulse.operators import skew
from repopulse.session import cut_lineage

# --- Fixed values: the forms of dates in feeds, after ``_plain_time`` ------------------------
DATE_FORMATS = ["d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm:ss z", "d MMM yyyy HH:mm Z", "d MMM yyyy HH:mm z",
                "d MMMM yyyy HH:mm:ss Z", "d MMMM yyyy HH:mm:ss z", "MMM d yyyy HH:mm:ss Z", "MMMM d yyyy HH:mm:ss Z",
                "yyyy-MM-dd HH:mm:ss Z", "yyyy-MM-dd HH:mm:ss z", "yyyy-MM-dd HH:mm Z"]
# Zone names of RFC 822 with their offsets, whatever the season.
ZONES = {"EST": "-0500", "EDT": "-0400", "CST": "-0600", "CDT": "-0500", "MST": "-0700", "MDT": "-0600", "PST": "-0800", "PDT": "-0700"}
BOILERPLATE_PATTERNS = {"high_scalablity": " - High Scalability.*}  "}
ITEM_SCHEMA = "title STRING, description STRING, link STRING, pubDate STRING"
# -------------------------------------------------------------------------------------------


def _plain_time(text):
    """One spelling for RFC 822 and ISO times: no day name, no ``T``, no fraction, zone as +hhmm, UTC without one."""
    for old, new in ((r"^\s*[A-Za-z]{3,9}\.?,\s*", ""), (r"^(\d{4}-\d{2}-\d{2})T", "$1 "), (r"(:\d{2})[.,]\d+", "$1"), (r",", " "),
                     (r"\s*([+-]\d{2}):?(\d{2})\s*$", " $1$2"), (r"(\d)(?:Z| UT| Z)\s*$", "$1 +0000"),
                     (r"^(\d{4}-\d{2}-\d{2})\s*$", "$1 00:00:00"), (r"(\d{1,2}:\d{2}(?::\d{2})?)\s*$", "$1 +0000"), (r"\s+", " ")):
        text = F.regexp_replace(text, old, new)
    for name, offset in ZONES.items():
        text = F.regexp_replace(text, rf" {name}\s*$", f" {offset}")
    return F.trim(text)


def published_time(text):
    """RFC 822 and ISO times with a numeric, named or no zone (UTC), as zone-less UTC; NULL for anything else."""
    bare = _plain_time(text)
    instant = F.coalesce(*[F.try_to_timestamp(bare, F.lit(f)) for f in DATE_FORMATS])
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz"))


def landed_items(spark: SparkSession, path: str) -> DataFrame:
    """Items of landed RSS files as they are: title, description, link, pubDate."""
    return spark.read.format("xml").option("rowTag", "item").schema(ITEM_SCHEMA).load(path)


def item_posts(items: DataFrame) -> DataFrame:
    """Posts of landed items: other columns, date_published, title, content without mark-up, link."""
    rest = [c for c in items.columns if c not in ("title", "description", "link", "pubDate")]
    return items.select(*rest, published_time(F.col("pubDate")).alias("date_published"), "title",
                        tx.page_text(F.col("description")).alias("content"), "link")


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """Posts of landed RSS files: date_published, title, content, link."""
    return item_posts(landed_items(spark, path))


def clean_posts(posts: DataFrame, boilerplate: dict[str, str] | None = None) -> DataFrame:
    """Feed fields as stored. ``boilerplate`` is the text pattern to cut per source; the sources
    are those of the feed configuration, so they go into the expression and nothing is joined."""
    content = tx.clean_feed_text(F.col("content"))
    for source, pattern in (BOILERPLATE_PATTERNS if boilerplate is None else boilerplate).items():
        cut = tx.clean_feed_text(F.col("content"), pattern)
        content = F.when(F.col("source") == source, cut).otherwise(content)
    return posts.withColumns({
        "title": tx.clean_feed_text(F.col("title")),
        "content": content,
        "link": tx.clean_feed_link(F.col("link")),
    })


def newer_posts(posts: DataFrame, marks: DataFrame) -> DataFrame:
    """Posts published after the mark of their source; every post of a source without a mark."""
    return (posts.join(marks.select("source", "latest"), "source", "left")
            .filter(F.col("latest").isNull() | (F.col("date_published") > F.col("latest")))
            .drop("latest"))


def new_marks(posts: DataFrame) -> DataFrame:
    return posts.groupBy("source").agg(F.max("date_published").alias("latest"))


def merged_marks(old: DataFrame, new: DataFrame) -> DataFrame:
    """Marks of all sources: a source without new posts keeps its own."""
    both = old.select("source", "latest").unionByName(new.select("source", "latest"))
    return both.groupBy("source").agg(F.max("latest").alias("latest"))


def page_texts(pages: DataFrame) -> DataFrame:
    """Visible text of landed pages in stored form."""
    return pages.withColumn("text", tx.clean_feed_text(tx.page_text(F.col("html")))).drop("html")


def link_key(link):
    """One spelling of a link: no scheme, host in lower case, no fragment, no slashes at the end; NULL if nothing is left."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(link), r"#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(bare, r"^[^/?]*", 0))
    key = F.regexp_replace(F.concat(host, F.substring(bare, F.length(host) + 1, F.length(bare))), "/+$", "")
    return F.when(key != "", key)


def with_page_text(posts: DataFrame, pages: DataFrame, rows_per_split: int = skew.ROWS_PER_SPLIT) -> DataFrame:
    """Posts with the visible text of their landed page behind their own content.

    ``pages`` has (url, html) and meets posts by ``link_key``; of several pages with one key the one with the least url, then
    html, counts. Only pages that a post asks for are moved. A page that very many posts link to is copied to
    the tasks they are spread over. Posts without a page stay as they are; a missing content is empty before a page.
    """
    keyed = posts.withColumn("_key", link_key(F.col("link"))).withColumn("_row", F.monotonically_increasing_id())
    keyed = cut_lineage(keyed, "posts_by_link")
    wanted = keyed.select("_key").filter(F.col("_key").isNotNull()).distinct()
    found = (pages.select(link_key(F.col("url")).alias("_key"), "url", "html").join(wanted, "_key", "left_semi")
             .groupBy("_key").agg(F.min(F.struct("url", "html"))["html"].alias("_html"))
             .select("_key", tx.page_text(F.col("_html")).alias("_page")))
    hot = skew.hot_keys(keyed.filter(F.col("_key").isNotNull()), ["_key"], rows_per_split)
    joined = skew.split_join(keyed, found, ["_key"], ["_row"], hot, how="left")
    text = F.when(F.col("_page").isNull(), F.col("content")).otherwise(F.concat(F.coalesce("content", F.lit("")), "_page"))
    return joined.withColumn("content", text).select(*posts.columns)
