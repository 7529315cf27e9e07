"""Time arithmetic of the metric jobs as plain column expressions."""

import calendar
import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_SECONDS = 86_400
# --- Fixed values: length of one unit in seconds --------------------------------------------
UNIT_SECONDS = {"Month": 30 * DAY_SECONDS, "Hour": 3_600}
# -------------------------------------------------------------------------------------------


def elapsed_units(end: Column, start: Column, unit: str) -> Column:
    """Units between two timestamps, rounded away from zero; NULL when either side is NULL."""
    units = F.timestamp_diff("SECOND", start, end) / F.lit(UNIT_SECONDS[unit])
    return F.when(units > 0, F.ceil(units)).otherwise(F.floor(units))


def cohort_index(created: Column, base_year: int = 2014, years: int = 3) -> Column:
    """Four-month creation cohort as text, '1' for the first third of ``base_year``."""
    offset = F.year(created) - F.lit(base_year)
    return F.when(
        offset.between(0, years - 1),
        (offset * 3 + F.ceil(F.month(created) / 4)).cast("long").cast("string"),
    )


def _day_seconds(ts: Column) -> Column:
    return F.hour(ts) * 3_600 + F.minute(ts) * 60 + F.floor(F.second(ts))


def whole_months(a: Column, b: Column) -> Column:
    """Completed calendar months between two timestamps, whichever comes first."""
    start, end = F.least(a, b), F.greatest(a, b)
    months = (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)
    unfinished = (F.dayofmonth(start) > F.dayofmonth(end)) | (
        (F.dayofmonth(start) == F.dayofmonth(end)) & (_day_seconds(start) > _day_seconds(end))
    )
    months = F.when(unfinished, months - 1).otherwise(months).cast("long")
    return F.when(a.isNotNull() & b.isNotNull(), months)


def whole_days(later: Column, earlier: Column) -> Column:
    return F.floor(F.timestamp_diff("SECOND", earlier, later) / F.lit(DAY_SECONDS))


def inverse_age(published: Column, as_of: Column) -> Column:
    """One over the whole days since publication; NULL on the day itself."""
    return F.try_divide(F.lit(1.0), whole_days(as_of, published).cast("double"))


def first_day_not_before(ts: Column) -> Column:
    """The day a post first counts at a midnight cut: its own day at 00:00:00, else the next."""
    day = F.to_date(ts)
    return F.when(ts == day.cast("timestamp_ntz"), day).otherwise(F.date_add(day, 1))


def months_back(as_of: dt.datetime, n_months: int) -> tuple[tuple[int, int], tuple[int, int]]:
    """First and last (year, month) of a run: 25 days per month before this month's first day, then
    stepped month by month up to now. A day that a short month clips stays clipped, so the current
    month counts once the smallest day met is reached."""
    step = dt.datetime(as_of.year, as_of.month, 1) - dt.timedelta(days=25 * n_months)
    first = last = (step.year, step.month)
    while True:
        year, month = divmod(step.year * 12 + step.month, 12)
        step = step.replace(year=year, month=month + 1, day=min(step.day, calendar.monthrange(year, month + 1)[1]))
        if step > as_of:
            return first, last
        last = (step.year, step.month)
