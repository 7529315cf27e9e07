"""Every operator as a query over the given tables."""

import datetime as dt
import functools

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.tables import CUT_SOURCE, FLOOR_SOURCE, Tables
from repopulse import schemas
from repopulse.functions import dates, sql
from repopulse.functions import text as tx
from repopulse.operators import contributors as co
from repopulse.operators import events as ev
from repopulse.operators import features, keywords, mentions, metrics, normalize, ranking, repositories, scoring
from repopulse.operators.metrics import AgeBand
from repopulse.plans import feeds_job, graphs_job, lake_job, metrics_job, posts_job, sql_job
from repopulse.schemas import METRICS, REPO_KEY
from repopulse.session import cut_lineage, shared_path
from repopulse.sources import feeds, files, responses
from repopulse.streaming import landing

# Parameters that stand in for "now" and for the operator's own settings on the given tables.
AS_OF = dt.datetime(2016, 6, 5)
DETAILS_AS_OF = dt.datetime(2001, 12, 1)
BASE_YEAR, YEARS = 1995, 3
BANDS = [AgeBand(13, None, 50, 50), AgeBand(2, 12, 10, 10), AgeBand(1, 1, 5, 5)]
FLOORS = {FLOOR_SOURCE: dt.date(2015, 9, 1)}
# Invented marks; the sources are those of the fixture views.
MARKS = [(CUT_SOURCE, dt.datetime(2016, 3, 1, 8)), ("plain_blog", dt.datetime(2016, 4, 15, 20)), (FLOOR_SOURCE, dt.datetime(2016, 2, 10))]
LAST_RUN, LOAD_AS_OF = dt.date(2024, 1, 5), dt.date(2024, 1, 20)
PRUNE_AS_OF, PRUNE_MONTHS = dt.datetime(2001, 10, 20), 6

QUERIES = {}


def _plain(df: DataFrame) -> DataFrame:
    """Times as text, integers as long, doubles rounded: the same in both engines."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType)):
            c = c.cast("long")
        elif isinstance(f.dataType, T.DoubleType):
            c = F.round(c, 6)
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, " ")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(fn):
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return _plain(fn(Tables(spark, sf_dir)))

    QUERIES[fn.__name__] = run
    return fn


def _path(t: Tables, name: str) -> str:
    return shared_path(t.spark, name)


# ---------------------------------------------------------------- scans, sources, sinks
@query
def scan_csv(t):
    path = _path(t, "scan_csv")
    files.write_csv(t["f_timeline"], path)
    return files.read_text_csv(t.spark, path, t["f_timeline"].columns)


@query
def month_prune(t):
    path = _path(t, "month_prune")
    files.write_timeline(t["f_timeline"], path)
    pruned = files.prune_months(t.spark.read.parquet(path), PRUNE_AS_OF, PRUNE_MONTHS)
    return pruned.groupBy("year", "month").agg(F.count("*").alias("rows"))


@query
def scan_union(t):
    repo = t["f_repo"]
    paths = {name: _path(t, f"scan_union_{name}") for name in ("users", "orgs", "bad")}
    files.write_csv(repo.filter("user_type = 'User'"), paths["users"])
    files.write_csv(repo.filter("user_type = 'Organization'"), paths["orgs"])
    files.write_csv(t["nation"].selectExpr("n_name a", "n_name b", "n_name c", "n_name d", "n_nationkey e"),
                    paths["bad"])
    return files.read_csv(t.spark, list(paths.values()), schemas.REPO, drop_malformed=True)


def _stored_posts(t):
    return feeds.clean_posts(t["f_posts"])


@query
def scan_lines(t):
    path = _path(t, "scan_lines")
    _stored_posts(t).select(F.concat_ws(",", F.date_format("date_published", "yyyy-MM-dd HH:mm:ss"),
                                        "title", "content", "link")).write.text(path)
    lines = files.read_lines(t.spark, path)
    return lines.select(F.array_join("fields", "|").alias("fields"), F.size("fields").alias("n_fields"))


@query
def time_slices(t):
    return ev.day_slices(t["events"], "ts").groupBy("day", "slice").agg(F.count("*").alias("rows"))


@query
def incremental_days(t):
    new = ev.days_to_load(t["events"], "ts", LAST_RUN, LOAD_AS_OF).withColumn("day", F.to_date("ts"))
    per_day = new.groupBy("day").agg(F.count("*").alias("rows"))
    return per_day.withColumn("new_mark", F.max("day").over(Window.partitionBy()))


def _marks(t):
    return t.spark.createDataFrame(MARKS, "source string, latest timestamp_ntz")


@query
def incremental_feeds(t):
    new = feeds.newer_posts(t["f_posts"], _marks(t))
    return new.join(feeds.new_marks(new), "source").select("source", "doc_id", "date_published", "latest")


@query
def feed_items(t):
    path = _path(t, "feed_items")
    stamp = F.concat(F.date_format("date_published", "EEE, dd MMM yyyy HH:mm:ss"),
                     F.when(F.col("doc_id") % 2 == 0, F.lit(" +0000")).otherwise(F.lit(" GMT")))

    posts = t["f_posts"].select("title", F.col("content").alias("description"), "link", stamp.alias("pubDate"))
    posts.write.format("xml").option("rootTag", "channel").option("rowTag", "item").save(path)
    return feeds.read_items(t.spark, path)


@query
def half_month_buckets(t):
    path = _path(t, "half_month")
    files.write_timeline(t["f_timeline"], path)
    return (t.spark.read.parquet(path)
            .groupBy(files.bucket_name("created_at").alias("bucket"), "year", "month", "half")
            .agg(F.count("*").alias("rows")))


@query
def repo_year_buckets(t):
    path = _path(t, "repo_year")
    files.write_repositories(t["f_repo"], path)
    return t.spark.read.parquet(path).groupBy("year").agg(F.count("*").alias("rows"))


@query
def sink_roundtrip(t):
    path = _path(t, "sink")
    files.write_csv(_post_keywords(t).drop("title", "link"), path, ["source"])
    schema = T.StructType().add("doc_id", "long").add("date_published", T.TimestampNTZType()) \
        .add("top_words", "string").add("source", "string")
    back = files.read_csv(t.spark, path, schema)
    return back.withColumn("top_words", F.from_json("top_words", "array<string>"))


@query
def file_freshness(t):
    """Every written result, and whether it is as new as this run; the shared folder's clock may be a little off."""
    path, began = _path(t, "results"), dt.datetime.now(dt.timezone.utc) - dt.timedelta(minutes=5)
    files.write_csv(t["f_repo"], f"{path}/repositories.csv")
    files.write_csv(repositories.project_recency(t["f_repository_info"]), f"{path}/project_recency.csv")
    files.write_csv(t["f_timeline"], f"{path}/timeline.csv", ["event"])
    files.write_csv(t["f_repo"], f"{path}/{files.FRESHNESS_FILE}.csv")
    fresh = F.col("last_modified") >= F.timestamp_seconds(F.lit(began.timestamp()))
    return files.file_freshness(t.spark, path).select("file_name", fresh.alias("is_new"))


@query
def drop_header_rows(t):
    repo = t["f_repo"].select(*[F.col(c).cast("string") for c in schemas.REPO.fieldNames()])
    header = t["nation"].select(*[F.lit(c).alias(c) for c in repo.columns])
    return files.drop_header_rows(repo.unionByName(header), "repository_owner")


@query
def repo_details(t):
    d = t["f_details"]
    body = F.to_json(F.struct(
        "name", F.struct(F.col("owner_login").alias("login"), F.col("owner_type").alias("type")).alias("owner"),
        "description", "size", "language", F.col("doc_id").alias("watchers_count"),
        F.lit(3).alias("forks_count"), F.lit("master").alias("default_branch")))
    response = F.when(F.col("state") == "ok", body).when(F.col("state") == "cut", F.substring(body, 1, 40))
    return responses.repository_details(
        d.select("full_name", "created_at", "score", response.alias("response")))


@query
def contributor_rows(t):
    stats = t["f_stats"]
    item = F.struct(F.when(F.col("login").isNotNull(), F.struct("login")).alias("author"), "total")
    body = F.to_json(F.collect_list(item))
    landed = stats.groupBy("full_name", "state").agg(body.alias("body")).select(
        "full_name", F.lit("2016-01-01").alias("created_at"),
        F.when(F.col("state") == "ok", F.col("body")).when(F.col("state") == "empty", F.lit("[]"))
        .when(F.col("state") == "cut", F.lit("{\"message")).alias("response"))
    return responses.contributor_rows(landed)


@query
def packed_records(t):
    names = ["l_linenumber", "l_returnflag", "l_linestatus"]
    record = responses.pack([F.col(c).cast("string") for c in names])
    packed = t["lineitem"].groupBy("l_orderkey").agg(F.concat_ws(",", F.collect_list(record)).alias("records"))
    return responses.unpack(packed, "records", names)


# ---------------------------------------------------------------- event normaliser
@query
def event_whitelist(t):
    return ev.drop_untracked(t["f_archive"]).select("event_id", "type")


@query
def required_fields(t):
    return ev.require_fields(t["f_archive"]).select("event_id", "repo_name", "type", "created")


@query
def split_repo(t):
    return ev.split_repository(t["f_archive"]).select("event_id", "repository_owner", "repository_name")


@query
def canonical_action(t):
    action = F.get_json_object("payload", "$.action")
    rows = t["f_archive"].withColumn("event_action", ev.canonical_action(F.col("type"), action))
    return rows.filter(F.col("event_action").isNotNull()).select("event_id", "type", "event_action")


@query
def normalize_events(t):
    return ev.timeline_events(ev.classify_events(t["f_archive"]))


@query
def new_repos(t):
    return ev.new_repositories(ev.classify_events(t["f_archive"]))


@query
def rejected_events(t):
    return ev.rejected_events(ev.classify_events(t["f_archive"]), ["event_id"])


def _loaded_lake(t):
    """The archive in four loads: rows without a readable time come with each, late rows of the first days with the
    second, the whole archive with the third, some of it once more with the last."""
    lake, raw = _path(t, "lake"), cut_lineage(t["f_archive"], "archive")  # landed once, as each load reads it
    late, undated = F.col("event_id") % 5 == 0, lake_job.lane(F.col("created")) == lake_job.UNDATED
    first, second, end = dt.date(2024, 1, 10), dt.date(2024, 1, 20), dt.date(2024, 2, 1)
    before = F.col("created") < first.isoformat()
    given = [(undated | before & ~late, first), (undated | before & late | (F.col("created") >= first.isoformat()), second),
             (F.lit(True), end), (undated | (F.col("event_id") % 3 == 0), end)]
    for rows, as_of in given:
        lake_job.load_days(raw.filter(rows), lake, as_of, dt.date(2023, 12, 31))
    return lake


@query
def lake_load(t):
    return lake_job.read_timeline(t.spark, _loaded_lake(t)).select(*schemas.TIMELINE.fieldNames())


@query
def lake_rejects(t):
    return lake_job.read_loaded(t.spark, _loaded_lake(t), "rejects").select("event_id", "reason")


@query
def feed_load(t):
    lake = _path(t, "feeds")
    stamp = F.date_format("date_published", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    items = t["f_posts"].select("source", "doc_id", "title", F.col("content").alias("description"), "link", stamp.alias("pubDate"))
    for given in (items.filter(F.col("pubDate") < "2016-01-01"), items):
        feeds_job.load_items(given, lake, {}, t["f_pages"])
    posts = t.spark.read.parquet(f"{lake}/posts")
    return posts.select("source", "doc_id", "date_published", "link", F.md5(F.encode("content", "utf-8")).alias("content_md5"))


@query
def dedupe_repos(t):
    return ev.dedupe_repositories(ev.new_repositories(ev.classify_events(t["f_archive"])))


# ---------------------------------------------------------------- metrics and scores
def _timeline_repo(t):
    return metrics.join_repository(t["f_timeline"], t["f_repo"], BASE_YEAR, YEARS)


def _monthly(t):
    return metrics.monthly_metrics(t["f_timeline"], t["f_repo"], BASE_YEAR, YEARS)


def _run(t):
    return metrics_job.run_metrics(t["f_timeline"], t["f_repo"], BASE_YEAR, YEARS, BANDS)


def _project_months(t):
    return metrics.project_month_metrics(_monthly(t), BANDS)


@query
def timeline_repo(t):
    return _timeline_repo(t)


@query
def monthly_metrics(t):
    return _monthly(t)


@query
def response_times(t):
    return _monthly(t).select(*REPO_KEY, "month", "calendar_month", *schemas.MEAN_METRICS)


@query
def monthly_contributors(t):
    return _monthly(t).select(*REPO_KEY, "month", "calendar_month", "contributors")


@query
def active_repos(t):
    return metrics.active_repositories(_monthly(t), BANDS)


@query
def project_month_metrics(t):
    return _project_months(t)


@query
def cumulative_metrics(t):
    return metrics.cumulative_metrics(_project_months(t))


@query
def forward_fill(t):
    return normalize.forward_fill(metrics.cumulative_metrics(_project_months(t)))


@query
def cohort_p95(t):
    return normalize.cohort_p95(normalize.forward_fill(_run(t).cumulative))


@query
def normalized_metrics(t):
    return _run(t).normalized


@query
def month_spine(t):
    return features.month_spine(_project_months(t), METRICS)


def _positions(vectors):
    return vectors.select("repo_owner", "repo_name", "user_type", "repo_created_at", "max_month",
                          F.posexplode("features").alias("pos", "value"))


@query
def feature_vectors(t):
    normalized = metrics_job.derive(_monthly(t), BANDS).normalized
    return _positions(features.feature_vectors(normalized))


@query
def repo_scores_features(t):
    return _positions(_run(t).vectors)


@query
def score_repos(t):
    """Scores by a registry of forests that is a table."""
    return scoring.score_by_nodes(_run(t).vectors, t["f_forest"])


@query
def score_repos_fitted(t):
    """Scores by forests that are fitted here and laid down as a table."""
    vectors = cut_lineage(_run(t).vectors, "vectors")
    labels = t["labels"].select(F.concat(F.lit("repo"), "doc_id").alias("repo_name"),
                                F.col("quality").alias("label"))
    models = scoring.fit_cohort_models(vectors.join(labels, "repo_name"))
    return scoring.score_repositories(vectors, models)


@query
def score_cutoff(t):
    return repositories.score_cutoff(t["f_scores"])


@query
def date_diff_units(t):
    o = t["orders"].join(t["lineitem"], F.col("o_orderkey") == F.col("l_orderkey"))
    return o.select("l_orderkey", "l_linenumber",
                    dates.elapsed_units(F.col("l_shipdate"), F.col("o_orderdate"), "Month").alias("months"),
                    dates.elapsed_units(F.col("o_orderdate"), F.col("l_shipdate"), "Hour").alias("hours"))


@query
def cohort_index(t):
    return t["orders"].select("o_orderkey", dates.cohort_index(F.col("o_orderdate"), BASE_YEAR, YEARS).alias("repo_index"))


@query
def whole_months(t):
    now = F.lit("1997-06-15 12:00:00").cast("timestamp_ntz")
    shifted = F.col("ts") - F.expr("INTERVAL '26' YEAR")
    return t["events"].select("event_id", dates.whole_months(shifted, now).alias("months"))


@query
def sql_functions(t):
    sql.register_sql_functions(t.spark, BASE_YEAR, YEARS)
    return t.spark.sql(
        "SELECT l_orderkey, l_linenumber, date_diff_units(l_shipdate, o_orderdate, 'Month') AS months,"
        " date_diff_units(l_shipdate, o_orderdate, 'Hour') AS hours, get_index(o_orderdate) AS repo_index"
        " FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey",
        lineitem=t["lineitem"], orders=t["orders"])


@query
def sql_results(t):
    """One question in SQL text over results of two jobs and the SQL functions."""
    run, tables = _run(t), {"repositories": t["f_repo"], "posts": t["f_posts"]}
    return sql_job.ask(t.spark, """
        SELECT get_index(r.repo_created_at) AS repo_index, c.month, count(*) AS repos, sum(c.watchers) AS watchers,
               count(n.repo_name) AS normalized, max(p.n) AS posts
        FROM cumulative c JOIN repositories r ON r.repository_owner = c.repo_owner AND r.repository_name = c.repo_name
        LEFT JOIN normalized n ON n.repo_owner = c.repo_owner AND n.repo_name = c.repo_name AND n.month = c.month AND n.user_type = c.user_type
        CROSS JOIN (SELECT count(*) AS n FROM posts) p
        GROUP BY 1, 2""", run, tables, base_year=BASE_YEAR, years=YEARS)


# ---------------------------------------------------------------- repository tables
def _info(t):
    return repositories.consolidate(t["f_repository_info"], [F.col("doc_id")])


def _consolidated(t):
    return cut_lineage(_info(t), "consolidated")


@query
def consolidated_info(t):
    return _info(t)


@query
def age_split(t):
    return repositories.age_split(t["f_repository_info"], AS_OF.date()).select("doc_id", "created_at", "is_young")


@query
def project_recency(t):
    return repositories.project_recency(t["f_repository_info"])


def _metric_files(t):
    """Cumulative metrics as found in last year's and this year's result file."""
    cumulative = cut_lineage(metrics.cumulative_metrics(_project_months(t)), "cumulative")
    older = cumulative.withColumn("watchers", F.col("watchers") - 1).withColumn("file_year", F.lit(2000))
    return cumulative.withColumn("file_year", F.lit(2001)).unionByName(older)


@query
def dedupe_metrics(t):
    return repositories.dedupe_metrics(_metric_files(t), [-F.col("file_year")])


@query
def plausible_months(t):
    return repositories.plausible_months(
        metrics.cumulative_metrics(_project_months(t)), DETAILS_AS_OF).select(*REPO_KEY, "month")


@query
def project_details(t):
    return repositories.project_details(_metric_files(t), DETAILS_AS_OF, [-F.col("file_year")])


@query
def sorted_details(t):
    return repositories.sorted_details(
        repositories.project_details(_metric_files(t), DETAILS_AS_OF, [-F.col("file_year")]))


@query
def union_sources(t):
    posts = t["f_posts"].select("source", "doc_id", "title")
    info = t["f_repository_info"].select(F.col("repository_owner").alias("source"), "doc_id",
                                         F.col("full_name").alias("title"))
    return posts.unionByName(info)


# ---------------------------------------------------------------- text and key words
def _clean(max_tokens=None):
    return tx.clean_text(F.col("title"), F.col("content"), max_tokens)


@query
def clean_text(t):
    return t["f_posts"].select("doc_id", _clean().alias("text"))


@query
def clean_text_leading(t):
    return t["f_posts"].select("doc_id", _clean(tx.LEADING_TOKENS).alias("text"))


@query
def clean_text_units(t):
    return t["f_posts"].select(
        "doc_id", tx.clean_text_units(F.col("title"), F.col("content")).alias("text"))


@query
def leading_tokens(t):
    return t["documents"].select("doc_id", tx.leading_tokens(F.col("text")).alias("text"))


@query
def ascii_only(t):
    return t["documents"].select("doc_id", tx.ascii_only(F.col("text")).alias("text"))


@query
def page_text(t):
    return feeds.page_texts(t["pages"])


@query
def clean_feed_fields(t):
    return feeds.clean_posts(t["f_posts"], {CUT_SOURCE: "The .*? the "})


@query
def source_from_file(t):
    root = _path(t, "pages2")
    for source, _ in MARKS:
        files.write_csv(t["f_posts"].filter(F.col("source") == source).select("doc_id", "link"),
                        f"{root}/dashboard_2ndpage_{source}.csv")
    schema = T.StructType().add("doc_id", "long").add("link", "string")
    pages = files.read_csv(t.spark, f"{root}/dashboard_2ndpage_*.csv", schema)
    return files.source_of_file(pages, "dashboard_2ndpage_").withColumn("no_of_links", F.lit(1))


@query
def stopword_set(t):
    path = _path(t, "stopwords")
    t["f_stop_lines"].write.text(path)
    return keywords.stop_word_set(t.spark.read.text(path))


def _tokens(t):
    return posts_job.post_terms(t["f_posts"])


def _tfidf(t):
    return keywords.tfidf(t["f_posts"], _tokens(t))


def _top(t):
    return keywords.top_terms(_tfidf(t))


def _unit_tokens(t):
    clean = tx.clean_text_units(F.col("title"), F.col("content"))
    return keywords.term_counts(t["f_posts"], tx.spaced_words(clean))


def _plain_tfidf(t):
    return keywords.tfidf_plain(t["f_posts"], _unit_tokens(t))


def _post_keywords(t, max_tokens=None):
    return posts_job.post_keywords(t["f_posts"], t["f_lexicon"], max_tokens)


def _tagged(t):
    return cut_lineage(_post_keywords(t), "post_keywords")


@query
def tokens(t):
    return _tokens(t)


@query
def tokens_units(t):
    return _unit_tokens(t)


@query
def tfidf(t):
    return _tfidf(t).select("doc_id", "term", "tf", "tfidf")


@query
def tfidf_plain(t):
    return _plain_tfidf(t).select("doc_id", "term", "tf", "tfidf")


@query
def tfidf_hashed(t):
    clean = tx.clean_text_units(F.col("title"), F.col("content"))
    vectors = keywords.tfidf_hashed(t["f_posts"], tx.spaced_words(clean))
    return vectors.select("source", "doc_id", "n_words", F.inline_outer(F.arrays_zip("indices", "tf", "tfidf"))).withColumnRenamed("indices", "bucket")


@query
def top_terms(t):
    return _top(t).select("doc_id", "term", "rank", "tfidf")


@query
def top_terms_strict(t):
    return keywords.top_terms_strict(_plain_tfidf(t)).select("doc_id", "term", "rank", "tfidf")


@query
def lexicon_filter(t):
    return keywords.keep_lexicon_words(_top(t), t["f_lexicon"]).select("doc_id", "term")


@query
def top_terms_clean(t):
    return keywords.clean_top_terms(_top(t), t["f_lexicon"]).select("doc_id", "term")


@query
def post_keywords(t):
    return _post_keywords(t)


@query
def post_keywords_leading(t):
    return _post_keywords(t, tx.LEADING_TOKENS)


@query
def post_keywords_strict(t):
    return posts_job.post_keywords_strict(t["f_posts"], t["f_lexicon"])


@query
def word_pairs(t):
    posts = cut_lineage(_tagged(t).select("doc_id", "top_words"), "tagged")
    return ranking.list_pairs(posts, "top_words").select("doc_id", "word", "other")


# ---------------------------------------------------------------- rankings
@query
def trailing_scores(t):
    return ranking.trailing_scores(ranking.post_words(_tagged(t)), AS_OF.date())


@query
def first_seen(t):
    return ranking.first_seen(ranking.post_words(_tagged(t)), AS_OF)


@query
def cooccurrence(t):
    return ranking.cooccurrence(_tagged(t), FLOORS)


@query
def cooccurrence_ranked(t):
    return ranking.sorted_cooccurrence(ranking.cooccurrence(_tagged(t), FLOORS))


@query
def recency_frequency(t):
    return keywords.recency_frequency(ranking.first_seen(ranking.post_words(_tagged(t)), AS_OF))


# ---------------------------------------------------------------- graphs
@query
def name_mentions(t):
    info = _consolidated(t)
    return mentions.name_mentions(info, mentions.mention_keys(info))


@query
def mention_counts(t):
    info = _consolidated(t)
    return mentions.mention_counts(info, mentions.name_mentions(info, mentions.mention_keys(info)))


@query
def mention_graph(t):
    return mentions.mention_graph(_consolidated(t))


@query
def mention_graph_sorted(t):
    return mentions.mention_graph_sorted(_consolidated(t))


@query
def shared_contributor_pairs(t):
    return co.both_directions(co.shared_contributor_pairs(t["f_contributors"]), apart=True)


@query
def contributor_graph(t):
    return graphs_job.contributor_outputs(t["f_contributors"])


# ---------------------------------------------------------------- streaming
def _event_lines(t):
    return t["events"].select(F.concat_ws(",", "event_id", "user_id", "event_type", "value"))


@query
def stream_landing(t):
    spool, lake, mark = (_path(t, n) for n in ("spool", "lake", "checkpoint"))
    _event_lines(t).write.text(spool)
    landing.land_lines(t.spark, spool, lake, mark).awaitTermination()
    return t.spark.read.text(lake)


@query
def stream_rejects(t):
    """Files of equal names in several folders; landed, then landed again from the start."""
    spool, lake = _path(t, "spool"), _path(t, "lake")
    folder = F.pmod(F.xxhash64("value"), F.lit(3))
    _event_lines(t).toDF("value").withColumn("folder", folder).write.partitionBy("folder").text(spool)
    valid = F.try_element_at(F.split("value", ","), F.lit(3)) != "error"
    for _ in range(2):
        lines = landing.spooled_lines_by_file(t.spark, f"{spool}/*", max_files=1)
        landing.land_with_rejects(lines, valid, lake, _path(t, "checkpoint")).awaitTermination()
    return landing.landed_lines(t.spark, lake).select("value", "lane")


@query
def stream_normalize(t):
    spool, out, mark = (_path(t, n) for n in ("archive", "timeline", "checkpoint"))
    t["f_archive"].drop("event_id").write.json(spool)
    landing.normalise_stream(landing.archive_stream(t.spark, spool), out, mark).awaitTermination()
    return t.spark.read.schema(schemas.TIMELINE).parquet(out)
