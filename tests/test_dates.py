import datetime as dt

from conftest import rows
from pyspark.sql import functions as F

from repopulse.functions import dates, sql

T = dt.datetime
ZERO = T(2016, 1, 1)


def _units(frame, seconds, unit):
    df = frame("a timestamp_ntz, b timestamp_ntz", [(ZERO + dt.timedelta(seconds=seconds), ZERO)])
    return df.select(dates.elapsed_units(F.col("a"), F.col("b"), unit)).first()[0]


def test_elapsed_units_round_away_from_zero(frame):
    month = 30 * 86400
    assert [_units(frame, s, "Month") for s in (0, 1, -1, month, month + 1, -month - 1)] == [0, 1, -1, 1, 2, -2]
    assert [_units(frame, s, "Hour") for s in (0, 1, 3600, 3601, -1)] == [0, 1, 1, 2, -1]


def test_elapsed_units_null(frame):
    df = frame("a timestamp_ntz, b timestamp_ntz", [(None, ZERO)])
    assert df.select(dates.elapsed_units(F.col("a"), F.col("b"), "Month")).first()[0] is None


def test_cohort_index_range(frame):
    days = [T(2013, 12, 31), T(2014, 1, 1), T(2014, 5, 1), T(2016, 12, 31), T(2017, 1, 1), None]
    df = frame("d timestamp_ntz", [(d,) for d in days])
    got = [r[0] for r in df.select(dates.cohort_index(F.col("d"))).collect()]
    assert got == [None, "1", "2", "9", None, None]


def test_whole_months_same_day(frame):
    now = T(2016, 6, 15, 12, 0, 0)
    cases = [(T(2016, 5, 15, 12, 0, 0), 1), (T(2016, 5, 15, 12, 0, 1), 0), (T(2016, 5, 16), 0),
             (T(2016, 5, 14), 1), (T(2016, 7, 15, 13, 0, 0), 1), (T(2015, 6, 15, 11, 59, 59), 12)]
    df = frame("d timestamp_ntz, now timestamp_ntz, want long", [(d, now, w) for d, w in cases])
    got = df.select(dates.whole_months(F.col("d"), F.col("now")).alias("got"), "want").collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_inverse_age(frame):
    as_of = T(2016, 6, 5)
    df = frame("d timestamp_ntz, now timestamp_ntz",
               [(T(2016, 6, 4), as_of), (T(2016, 6, 4, 12), as_of), (T(2016, 6, 1), as_of)])
    assert [r[0] for r in df.select(dates.inverse_age(F.col("d"), F.col("now"))).collect()] == [1.0, None, 0.25]


def test_months_back_follows_the_25_day_rule():
    assert dates.months_back(T(2016, 6, 20), 2) == ((2016, 4), (2016, 6))
    # 50 days before 1 June is 12 April, so on 5 June the run has not reached June yet.
    assert dates.months_back(T(2016, 6, 5), 2) == ((2016, 4), (2016, 5))


def test_months_back_steps_like_a_calendar():
    def stepped(as_of, n):
        step, months = dt.date(as_of.year, as_of.month, 1) - dt.timedelta(days=25 * n), []
        while step <= as_of:
            months.append((step.year, step.month))
            after = dt.date(step.year + step.month // 12, step.month % 12 + 1, 1)
            length = (dt.date(after.year + after.month // 12, after.month % 12 + 1, 1) - after).days
            step = after.replace(day=min(step.day, length))
        return months[0], months[-1]

    assert dates.months_back(T(2014, 2, 28), 5) == ((2013, 9), (2014, 2))
    for day in range(6 * 365 + 1):
        as_of = dt.date(2014, 1, 1) + dt.timedelta(days=day)
        for n in range(1, 25):
            assert dates.months_back(T(as_of.year, as_of.month, as_of.day), n) == stepped(as_of, n), (as_of, n)


def test_sql_functions_match_expressions(spark, frame):
    sql.register_sql_functions(spark)
    df = frame("a timestamp_ntz, b timestamp_ntz", [(T(2016, 3, 1, 5), T(2016, 1, 1)), (T(2015, 1, 1), T(2016, 1, 1))])
    as_sql = spark.sql("SELECT date_diff_units(a, b, 'Month'), date_diff_units(a, b, 'Hour'), get_index(a) FROM {df}", df=df)
    native = df.select(dates.elapsed_units(F.col("a"), F.col("b"), "Month"),
                       dates.elapsed_units(F.col("a"), F.col("b"), "Hour"), dates.cohort_index(F.col("a")))
    assert rows(as_sql) == rows(native)
