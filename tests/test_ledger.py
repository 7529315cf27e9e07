"""Loads and landings that are repeated, interrupted, late or fed rows that belong to no day."""

import datetime as dt
import os
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_events import event

from repopulse import schemas
from repopulse.plans import lake_job
from repopulse.streaming import landing

D, FIRST = dt.date, dt.date(2015, 12, 31)
BAD_TIMES = ["n/a", "20150102 030000", None, "", "  ", "2016-02-30 03:00:00.000000", "2016-01-03 10:00:00", "9999", "zzz"]


def at(day, repo="o/r", type_="WatchEvent", month=1):
    return event(type_, "{}", repo, f"2016-{month:02d}-{day:02d} 10:00:00.000000")


def bad(created, repo="o/r"):
    return event("WatchEvent", "{}", repo, created)


@pytest.fixture
def lake(spark, tmp_path):
    class Lake:
        path = str(tmp_path / "lake")

        def load(self, data, as_of):
            return lake_job.load_days(spark.createDataFrame(data, schemas.ARCHIVE).repartition(3), self.path, as_of, FIRST)

        def timeline(self):
            return Counter((r.repository_name, r.created_at.month, r.created_at.day) for r in lake_job.read_timeline(spark, self.path).collect())

        def rejects(self):
            return Counter((r.repo_name, r.created, r.reason) for r in lake_job.read_loaded(spark, self.path, "rejects").collect())

    return Lake()


def test_rows_without_a_readable_time_are_rejected_once(lake):
    data = [bad(t) for t in BAD_TIMES]
    want = Counter(("o/r", t, "blank_field" if not (t or "").strip() else "bad_time") for t in BAD_TIMES)
    assert lake.load([*data, at(2)], D(2016, 1, 4)) == D(2016, 1, 3)
    assert lake.rejects() == want and lake.timeline() == {("r", 1, 2): 1}
    assert lake.load([*data, at(2), at(5)], D(2016, 1, 7)) == D(2016, 1, 6)
    assert lake.load(data, D(2016, 1, 7)) == D(2016, 1, 6)
    assert lake.rejects() == want and lake.timeline() == {("r", 1, 2): 1, ("r", 1, 5): 1}
    lake.load([bad("n/a", "o/s")], D(2016, 1, 7))  # another row with the same bad time
    assert lake.rejects() == want + Counter({("o/s", "n/a", "bad_time"): 1})


def test_copies_of_a_row_are_counted(lake, monkeypatch):
    monkeypatch.setattr(lake_job, "COPIES_PER_ROW", 2)
    lake.load([bad("n/a")] * 3 + [at(2)] * 2, D(2016, 1, 4))
    lake.load([bad("n/a")] * 2 + [at(2)], D(2016, 1, 5))
    assert lake.rejects() == {("o/r", "n/a", "bad_time"): 3} and lake.timeline() == {("r", 1, 2): 2}
    lake.load([bad("n/a")] * 10 + [at(2)] * 5, D(2016, 1, 5))
    assert lake.rejects() == {("o/r", "n/a", "bad_time"): 10} and lake.timeline() == {("r", 1, 2): 5}


def test_late_rows_of_loaded_days_are_kept(lake, spark):
    lake.load([at(2), at(20, "o/s", "PublicEvent")], D(2016, 1, 25))
    lake.load([at(3), at(26), at(4, "o/s", "PublicEvent"), bad("2016-01-03 1:00:00.000000")], D(2016, 1, 28))
    everything = [at(2), at(3), at(26), at(20, "o/s", "PublicEvent"), at(4, "o/s", "PublicEvent"), bad("2016-01-03 1:00:00.000000")]
    for _ in range(2):
        lake.load(everything, D(2016, 1, 28))
        assert lake.timeline() == {("r", 1, 2): 1, ("r", 1, 3): 1, ("r", 1, 26): 1}
        assert sum(lake.rejects().values()) == 1
        known = lake_job.read_repositories(spark, lake.path)
        assert [(r.repository_name, r.repo_created_at.day) for r in known.collect()] == [("s", 4)]  # the earlier creation came late


def test_days_outside_the_load_wait_or_stay_out(lake):
    data = [event("WatchEvent", "{}", "o/r", "2015-12-31 23:59:59.000000"), at(2), at(9)]
    lake.load(data, D(2016, 1, 5))
    assert lake.timeline() == {("r", 1, 2): 1}
    lake.load(data, D(2016, 1, 10))
    assert lake.timeline() == {("r", 1, 2): 1, ("r", 1, 9): 1}


def test_an_interrupted_load_is_replaced(lake, spark, monkeypatch):
    lake.load([at(2), bad("n/a")], D(2016, 1, 4))
    data = [at(2), at(3), at(5), bad("n/a"), bad("zzz")]
    half = lake_job.ev.rejected_events

    def fail(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(lake_job.ev, "rejected_events", fail)
    with pytest.raises(RuntimeError):
        lake.load(data, D(2016, 1, 7))
    assert lake.timeline() == {("r", 1, 2): 1} and sum(lake.rejects().values()) == 1  # nothing of it is seen
    monkeypatch.setattr(lake_job.ev, "rejected_events", half)
    lake.load(data, D(2016, 1, 7))
    assert lake.timeline() == {("r", 1, 2): 1, ("r", 1, 3): 1, ("r", 1, 5): 1}
    assert sorted(c for _, c, _ in lake.rejects().elements()) == ["n/a", "zzz"]
    ledger = spark.read.parquet(f"{lake.path}/loads").sort("load").select("load", "last_day", "rows", "late_rows").collect()
    assert [tuple(r) for r in ledger] == [(1, D(2016, 1, 3), 2, 1), (2, D(2016, 1, 6), 3, 2)]


def test_an_empty_archive_moves_the_day_only(lake):
    assert lake.load([], D(2016, 1, 4)) == D(2016, 1, 3)
    assert lake.load([], D(2016, 1, 4)) == D(2016, 1, 3)
    assert lake.timeline() == {} and lake.rejects() == {}


def test_content_keys_tell_rows_apart(frame):
    df = frame("a string, b string", [("x", None), ("x", ""), (None, "x"), ("", "x"), ('","b":"', None), ("x", "x")])
    assert df.select(lake_job.content_key(["a", "b"])).distinct().count() == 6


def test_only_keys_move_to_tell_which_rows_are_new(frame, spark, tmp_path):
    given = [("a", b"1", "x", 1), ("a", b"1", "x", 2), ("a", b"1", "x", 3), ("a", b"2", "y", 4), ("b", b"1", "z", 5), ("b", None, "w", 6)]
    frame("lane string, key binary, payload string, _id long", given).write.parquet(str(tmp_path / "rows"))
    seen = frame("lane string, key binary", [("a", b"1"), ("a", b"2"), ("b", b"2"), ("b", None)])
    new = lake_job.unseen_rows(spark.read.parquet(str(tmp_path / "rows")), seen)
    assert new.columns == ["lane", "key", "payload"]
    assert rows(new) == rows(frame("lane string, key binary, payload string", [("a", b"1", "x")] * 2 + [("b", b"1", "z"), ("b", None, "w")]))
    assert "SortAggregate" not in new._jdf.queryExecution().executedPlan().toString()  # of whole rows


@pytest.fixture
def spool(spark, tmp_path):
    class Spool:
        lake = str(tmp_path / "lake")

        def put(self, name, text, modified=None):
            path = tmp_path / "spool" / name
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_text(text)
            if modified:
                os.utime(path, (modified, modified))
            return path

        def land(self, mark):
            lines = landing.spooled_lines_by_file(spark, str(tmp_path / "spool" / "*"), max_files=1)
            landing.land_with_rejects(lines, F.size(F.split("value", ",")) == 2, self.lake, str(tmp_path / mark)).awaitTermination()
            stored = rows(spark.read.text(self.lake).select("value", "lane"))
            assert rows(landing.landed_lines(spark, self.lake).select("value", "lane")) == stored
            return stored

    return Spool()


def test_equal_names_in_two_folders_both_land(spool, spark):
    spool.put("x/part.csv", "a,1\nbad\n")
    spool.put("y/part.csv", "b,2\nc,3\n")
    every = [("a,1", "valid"), ("b,2", "valid"), ("bad", "reject"), ("c,3", "valid")]
    assert spool.land("m1") == every
    assert spool.land("m1") == every
    assert spool.land("m2") == every  # starting over adds nothing
    assert landing.manifest(spark, spool.lake).count() == 2
    names = landing.landed_lines(spark, spool.lake).filter("value = 'b,2'").first()
    assert names.name == "part.csv" and names.path.endswith("/y/part.csv")


def test_a_changed_file_replaces_its_older_version(spool, spark):
    spool.put("x/a", "one,1\nbad\n", 1_600_000_000)
    spool.put("x/b", "keep,1\n", 1_600_000_000)
    assert spool.land("m1") == [("bad", "reject"), ("keep,1", "valid"), ("one,1", "valid")]
    spool.put("x/a", "two,2\n", 1_600_000_100).touch()
    spool.put("x/a", "two,2\n", 1_600_000_100)
    assert spool.land("m2") == [("keep,1", "valid"), ("two,2", "valid")]
    assert landing.manifest(spark, spool.lake).count() == 3


def test_a_batch_that_failed_before_its_manifest_is_replaced(spool, spark, monkeypatch):
    spool.put("x/a", "one,1\nbad\n")
    monkeypatch.setattr(landing, "delete", lambda *_: None)
    real = landing.files.read_partitioned
    assert spool.land("m1") == [("bad", "reject"), ("one,1", "valid")]
    # as if the manifest had never been written
    monkeypatch.setattr(landing.files, "read_partitioned", lambda s, path, schema: s.createDataFrame([], schema))
    lines = landing.spooled_lines_by_file(spark, spool.lake.replace("lake", "spool/*"))
    landing.land_with_rejects(lines, F.size(F.split("value", ",")) == 2, spool.lake, spool.lake + "-m2").awaitTermination()
    monkeypatch.setattr(landing.files, "read_partitioned", real)
    assert rows(spark.read.text(spool.lake).select("value", "lane")) == [("bad", "reject"), ("one,1", "valid")]
    assert landing.manifest(spark, spool.lake).count() == 1
