"""Date scalars as column expressions. The session's time zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..profile import DEFAULT, Profile


def window(start: Column, end: Column, duration: Column, late: bool = False, profile: Profile = DEFAULT) -> tuple[Column, Column]:
    """First and last day of an event's window. No duration counts as a day; without an end it follows the duration."""
    days = F.when(F.coalesce(duration, F.lit(0)) <= 0, 1).otherwise(duration)
    last = F.coalesce(end.cast("date"), F.date_add(start.cast("date"), (days - 1).cast("int")))
    if late:
        return F.date_add(last, profile.late_skip_days), F.date_add(last, profile.late_post_days)
    post = F.when(days > profile.long_duration, profile.post_days_long).otherwise(profile.post_days)
    return F.date_sub(start.cast("date"), profile.pre_days), F.date_add(last, post)


def compact(ts: Column) -> Column:
    """14 digits."""
    return F.date_format(ts, "yyyyMMddHHmmss")


def expand(digits: Column) -> Column:
    return F.try_to_timestamp(digits, F.lit("yyyyMMddHHmmss"))


def _dated(c: Column, pattern: str) -> Column:
    y, m, d = (F.regexp_extract(c, pattern, k) for k in (1, 2, 3))
    good = y.try_cast("int").between(2000, 2030) & m.try_cast("int").between(1, 12) & d.try_cast("int").between(1, 31)
    return F.when(good, F.concat_ws("-", y, m, d))


def find_date(c: Column) -> Column:
    """YYYY-MM-DD in a text, by ranges alone (no calendar); null if there is none."""
    return _dated(c, "([0-9]{4})-([0-9]{2})-([0-9]{2})")


def url_date(url: Column) -> Column:
    return F.coalesce(_dated(url, "/([0-9]{4})/([0-9]{2})/([0-9]{2})/"), _dated(url, "/([0-9]{4})-([0-9]{2})-([0-9]{2})"))


def in_window(day: Column, first: Column, last: Column) -> Column:
    """Null where the day or the window is unknown or no date."""
    d = day.try_cast("date")
    return F.when(d.isNotNull() & first.isNotNull() & last.isNotNull(), d.between(first.cast("date"), last.cast("date")))
