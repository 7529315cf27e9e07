from conftest import rows
from test_events import PULL, event

from pyspark.sql import functions as F

from repopulse import schemas
from repopulse.operators import events as ev
from repopulse.streaming import landing


def test_landing_copies_new_lines_once(spark, tmp_path):
    spool, lake, mark = (str(tmp_path / n) for n in ("spool", "lake", "mark"))
    (tmp_path / "spool").mkdir()
    (tmp_path / "spool" / "a.csv").write_text("x,1\ny,2\n")
    (tmp_path / "spool" / "skip.txt").write_text("no\n")
    landing.land_lines(spark, spool, lake, mark, pattern="*.csv").awaitTermination()
    (tmp_path / "spool" / "b.csv").write_text("z,3\n")
    for _ in range(2):
        landing.land_lines(spark, spool, lake, mark, pattern="*.csv", max_files=1).awaitTermination()
    assert rows(spark.read.text(lake)) == [("x,1",), ("y,2",), ("z,3",)]
    again = str(tmp_path / "lake2")
    landing.land_lines(spark, spool, again, str(tmp_path / "mark2"), pattern="*.csv").awaitTermination()
    assert spark.read.text(again).count() == 3


def test_reject_lane(spark, tmp_path):
    (tmp_path / "spool").mkdir()
    (tmp_path / "spool" / "a").write_text("good,1\nbad\n")
    lake = str(tmp_path / "lake")
    valid = F.size(F.split("value", ",")) == 2

    def land(mark):
        lines = landing.spooled_lines_by_file(spark, str(tmp_path / "spool"))
        landing.land_with_rejects(lines, valid, lake, str(tmp_path / mark)).awaitTermination()
        return rows(spark.read.text(lake).select("value", "lane"))

    assert land("mark") == [("bad", "reject"), ("good,1", "valid")]
    (tmp_path / "spool" / "b").write_text("more,2\n")
    every = [("bad", "reject"), ("good,1", "valid"), ("more,2", "valid")]
    assert land("mark") == every
    (tmp_path / "spool" / "a").unlink()
    assert land("fresh") == every  # starting over repeats nothing and loses nothing


def test_stream_equals_batch(spark, tmp_path):
    raw = spark.createDataFrame([event("WatchEvent"), event("PullRequestEvent", PULL), event("PublicEvent"),
                                 event("WatchEvent", "{"), event("GollumEvent")], schemas.ARCHIVE)
    raw.write.json(str(tmp_path / "in"))
    batch = ev.classify_events(raw)
    for name, pick in (("timeline", ev.timeline_events), ("repos", ev.new_repositories)):
        out = str(tmp_path / name)
        landing.normalise_stream(landing.archive_stream(spark, str(tmp_path / "in")), out,
                                 str(tmp_path / f"mark_{name}"), pick).awaitTermination()
        assert rows(spark.read.parquet(out)) == rows(pick(batch))
