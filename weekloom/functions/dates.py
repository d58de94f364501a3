"""Week arithmetic and calendar parts.  Weeks run Monday to Sunday."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NEW_RELEASE_DAYS = 28


def parse_date(c: Column) -> Column:
    """Timestamp of a text or date column, null where it does not parse."""
    return F.try_to_timestamp(c.cast("string"))


def iso_date(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def week_end(c: Column) -> Column:
    """Sunday that closes the week of a date, by day arithmetic alone."""
    return F.next_day(F.date_sub(c, 1), "SU")


def week_period(c: Column) -> Column:
    """``monday/sunday`` text of the week of a date."""
    sunday = week_end(c)
    return F.concat_ws("/", F.date_sub(sunday, 6).cast("string"), sunday.cast("string"))


def period_end(c: Column) -> Column:
    """Date after the slash of a ``monday/sunday`` text, null when malformed."""
    return F.try_to_date(F.try_element_at(F.split(c, "/"), F.lit(2)), "yyyy-MM-dd")


def month_end(c: Column) -> Column:
    return F.last_day(c)


def calendar_parts(c: Column) -> dict[str, Column]:
    """year, month, quarter and ISO week."""
    return {
        "year": F.year(c),
        "month": F.month(c),
        "quarter": F.quarter(c),
        "weekofyear": F.weekofyear(c),
    }


def age_days(date: Column, release: Column) -> Column:
    return F.datediff(date, release)


def release_age_days(date: Column, release: Column) -> Column:
    """Days since release, -1 when either date is missing."""
    return F.coalesce(age_days(date, release), F.lit(-1))


def release_parts(date: Column, release: Column) -> dict[str, Column]:
    """Release year and month (0 when missing) and weekday (Monday 0, missing -1)."""
    known = date.isNotNull() & release.isNotNull()
    return {
        "release_year": F.coalesce(F.when(known, F.year(release)), F.lit(0)),
        "release_month": F.coalesce(F.when(known, F.month(release)), F.lit(0)),
        "release_dayofweek": F.coalesce(F.when(known, F.weekday(release)), F.lit(-1)),
    }


def is_new_release(date: Column, release: Column, days: int = NEW_RELEASE_DAYS) -> Column:
    """1 within ``days`` of release, else 0; unknown ages and future releases are 0."""
    return F.coalesce(age_days(date, release).between(0, days), F.lit(False)).cast("int")
