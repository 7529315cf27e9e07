import datetime as dt
import json

from conftest import rows
from pyspark.sql import functions as F

from repopulse import schemas
from repopulse.plans import feeds_job
from repopulse.sources import feeds, files, responses

T = dt.datetime


def test_csv_blank_header_and_broken_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("repository_owner,repository_name,repo_created_at,user_type\n"
                                    "o,r,2016-01-01 00:00:00,User\nrepository_owner,repository_name,repo_created_at,user_type\n"
                                    "o,,,\"\"\n")
    (tmp_path / "b.csv").write_text("repository_owner,repository_name,repo_created_at,user_type\n"
                                    "p,q,2016-01-02 00:00:00,User\nbroken,line,with,too,many,fields\n")
    columns = schemas.REPO.fieldNames()
    text = files.read_text_csv(spark, str(tmp_path / "a.csv"), columns)
    assert rows(files.drop_header_rows(text, "repository_owner")) == [("o", "", "", ""), ("o", "r", "2016-01-01 00:00:00", "User")]
    typed = files.read_csv(spark, [str(tmp_path / "b.csv")], schemas.REPO, drop_malformed=True)
    assert rows(typed) == [("p", "q", T(2016, 1, 2), "User")]


def test_csv_round_trip_with_quotes_and_lists(spark, frame, tmp_path):
    df = frame("t string, w array<string>", [('say "hi", all', ["a", 'b"c']), ("", [])])
    files.write_csv(df, str(tmp_path / "out"))
    back = files.read_text_csv(spark, str(tmp_path / "out"), ["t", "w"])
    assert {r.t: json.loads(r.w) for r in back.collect()} == {'say "hi", all': ["a", 'b"c'], "": []}


def test_lines_drop_sponsored_posts(spark, tmp_path):
    (tmp_path / "l.csv").write_text('a,"b,c",d\nx,Sponsored Post: y,z\n')
    assert [r.fields for r in files.read_lines(spark, str(tmp_path)).collect()] == [["a", '"b', 'c"', "d"]]


def test_half_month_partitions_are_replaced_not_doubled(spark, frame, tmp_path):
    df = frame("created_at timestamp_ntz, x int", [(T(2016, 3, 15), 1), (T(2016, 3, 16), 2)])
    for _ in range(2):
        files.write_timeline(df, str(tmp_path / "t"))
    back = spark.read.parquet(str(tmp_path / "t"))
    assert sorted((r.month, r.half, r.x) for r in back.collect()) == [(3, 1, 1), (3, 2, 2)]
    assert [r.b for r in back.select(files.bucket_name("created_at").alias("b")).sort("b").collect()] == ["2016_Mar_1", "2016_Mar_2"]


def test_month_pruning_reaches_the_scan(spark, frame, tmp_path, capsys):
    df = frame("created_at timestamp_ntz", [(T(2016, m, 20),) for m in range(1, 13)])
    files.write_timeline(df, str(tmp_path / "t"))
    pruned = files.prune_months(spark.read.parquet(str(tmp_path / "t")), T(2016, 6, 25), 2)
    assert sorted(r.month for r in pruned.select("month").collect()) == [4, 5, 6]
    pruned.explain("formatted")
    assert "PartitionFilters: [" in capsys.readouterr().out.replace("PartitionFilters: []", "")


def test_file_freshness(spark, frame, tmp_path):
    for name in ("a.csv", "b.csv", f"{files.FRESHNESS_FILE}.csv"):
        files.write_csv(frame("x int", [(1,)]), str(tmp_path / name))
    assert [r[0] for r in rows(files.file_freshness(spark, str(tmp_path)))] == ["a.csv", "b.csv"]


def test_source_from_file(spark, frame, tmp_path):
    files.write_csv(frame("x string", [("1",)]), str(tmp_path / "dashboard_2ndpage_dzone.csv"))
    df = files.read_text_csv(spark, str(tmp_path / "dashboard_2ndpage_*.csv"), ["x"])
    raw = spark.read.option("header", True).csv(str(tmp_path / "dashboard_2ndpage_*.csv"))
    assert df.count() == 1 and files.source_of_file(raw, "dashboard_2ndpage_").first().source == "dzone"


def test_feed_dates_and_items(spark, tmp_path):
    item = "<item><title>{t}</title><description>d &amp; e</description><link>l</link><pubDate>{d}</pubDate></item>"
    (tmp_path / "f.xml").write_text("<?xml version='1.0'?><rss><channel><title>feed</title>"
                                    + item.format(t="a", d="Thu, 12 May 2016 16:06:22 +0000")
                                    + item.format(t="b", d="Thu, 02 Jun 2016 14:41:39 GMT")
                                    + item.format(t="c", d="yesterday") + "</channel></rss>")
    got = feeds.read_items(spark, str(tmp_path)).collect()
    assert [(r.title, r.content, r.date_published) for r in sorted(got, key=lambda r: r.title)] == [
        ("a", "d & e", T(2016, 5, 12, 16, 6, 22)), ("b", "d & e", T(2016, 6, 2, 14, 41, 39)), ("c", "d & e", None)]


def test_feed_dates_in_many_forms(frame):
    forms = {"Tue, 3 May 2016 06:07:08 +0200": T(2016, 5, 3, 4, 7, 8), "3 May 2016 06:07 GMT": T(2016, 5, 3, 6, 7),
             "2016-05-03T06:07:08Z": T(2016, 5, 3, 6, 7, 8), "2016-05-03T06:07:08.123+02:00": T(2016, 5, 3, 4, 7, 8),
             "2016-05-03 06:07:08": T(2016, 5, 3, 6, 7, 8), "2016-05-03": T(2016, 5, 3), "Tuesday, 03 May 2016 06:07:08 EST": T(2016, 5, 3, 11, 7, 8),
             "03 May 2016 06:07:08": T(2016, 5, 3, 6, 7, 8), "May 3, 2016 06:07:08 +0000": T(2016, 5, 3, 6, 7, 8), "soon": None, "": None}
    df = frame("t string", [(f,) for f in forms]).select("t", feeds.published_time(F.col("t")).alias("p"))
    assert {r.t: r.p for r in df.collect()} == forms


def test_feed_job_moves_marks_and_keeps_rejects(spark, frame, tmp_path):
    schema, lake = "source string, title string, description string, link string, pubDate string", str(tmp_path / "lake")
    item = lambda s, t, d: (s, t, f"<p>{t} &mdash; it&#39;s <b>new</b></p>", "l,1", d)
    first = [item("a", "one", "2016-05-03T06:07:08Z"), item("b", "x", "1 May 2016 00:00:00 GMT"), item("a", "broken", "soon")]
    assert feeds_job.load_items(frame(schema, first), lake, {}) == 1
    second = [first[0], item("a", "two", "2016-05-04"), item("c", "y", "2016-05-01")]
    assert feeds_job.load_items(frame(schema, second), lake, {}) == 2
    posts = spark.read.parquet(f"{lake}/posts")
    assert rows(posts.select("source", "title", "link")) == [("a", "one", "lCOMMA1"), ("a", "two", "lCOMMA1"), ("b", "x", "lCOMMA1"), ("c", "y", "lCOMMA1")]
    assert posts.filter("title = 'one'").first().content == "one  its new"
    marks, number = feeds_job.read_marks(spark, lake)
    assert number == 2 and rows(marks) == [("a", T(2016, 5, 4)), ("b", T(2016, 5, 1)), ("c", T(2016, 5, 1))]
    assert rows(spark.read.parquet(f"{lake}/rejects").select("title", "pubDate")) == [("broken", "soon")]


def test_feed_marks(frame):
    posts = frame("source string, date_published timestamp_ntz", [("a", T(2016, 1, 1)), ("a", T(2016, 1, 2)), ("b", T(2016, 1, 1))])
    new = feeds.newer_posts(posts, frame("source string, latest timestamp_ntz", [("a", T(2016, 1, 1))]))
    assert rows(feeds.new_marks(new)) == [("a", T(2016, 1, 2)), ("b", T(2016, 1, 1))]


def test_clean_posts_boilerplate(frame):
    posts = frame("source string, title string, content string, link string",
                  [("a", "T,\n'x'", "body - Feed stuff}  rest, end", "l,1"), ("b", "t", "body - Feed stuff}  rest", "l")])
    clean = feeds.clean_posts(posts, {"a": " - Feed.*}  "})
    assert rows(clean.select("source", "title", "content", "link")) == [
        ("a", "T x", "bodyrest  end", "lCOMMA1"), ("b", "t", "body - Feed stuff}  rest", "l")]


def test_repository_details(frame):
    ok = {"name": "r", "owner": {"login": "o", "type": "User"}, "description": "it's, \"x\"", "size": 5}
    df = frame("full_name string, created_at string, score string, response string",
               [("o/r", "d", "0.5", json.dumps(ok)), ("o/s", "d", "0.6", json.dumps(ok)[:30]), ("o/t", "d", "0.7", None)])
    got = {r.full_name: r for r in responses.repository_details(df).collect()}
    assert got["o/r"].description == "it s   x " and got["o/r"]["size"] == "5" and got["o/r"].language == ""
    assert got["o/r"].asDict().keys() == set(schemas.REPOSITORY_INFO_COLUMNS)
    for name in ("o/s", "o/t"):
        assert got[name].repository_owner == "" and got[name].score in ("0.6", "0.7")


def test_contributor_rows(frame):
    body = json.dumps([{"author": {"login": "a"}, "total": 3}, {"author": None, "total": None}])
    df = frame("full_name string, created_at string, response string",
               [("o/r", "d", body), ("o/s", "d", "[]"), ("o/t", "d", "{bad"), ("o/u", "d", None)])
    assert rows(responses.contributor_rows(df)) == [
        ("o/r", "", "", "d"), ("o/r", "a", "3", "d"), ("o/s", "", "", "d"), ("o/t", "", "", "d"), ("o/u", "", "", "d")]


def test_pack_unpack(frame):
    df = frame("a string, b string", [("1", None), ("2", "y")])
    packed = df.agg(F.concat_ws(",", F.collect_list(responses.pack([F.col("a"), F.col("b")]))).alias("p"))
    assert rows(responses.unpack(packed, "p", ["a", "b"])) == [("1", ""), ("2", "y")]
