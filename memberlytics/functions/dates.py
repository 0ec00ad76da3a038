"""Date windows and calendar arithmetic.

Windows are written as half-open ranges on the bare column, never as a function of it, so that
they reach the Parquet scan as pushed filters and serve date and timestamp columns alike.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the suffix of an age group label ("30대").
AGE_GROUP_SUFFIX = "대"


def timestamp_literal(moment: datetime) -> Column:
    """A zone-free timestamp literal; `F.lit(datetime)` would give one tied to the session zone."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def in_last_days(column: Column, as_of: date, days: int) -> Column:
    """True on the `days` calendar days that end with `as_of`, both ends included."""
    return (column >= F.lit(as_of - timedelta(days=days - 1))) & (column < F.lit(as_of + timedelta(days=1)))


def in_month(column: Column, yyyymm: str) -> Column:
    """True when a date or timestamp falls in the month `yyyymm`."""
    first = date(int(yyyymm[:4]), int(yyyymm[4:]), 1)
    following = (first + timedelta(days=31)).replace(day=1)
    return (column >= F.lit(first)) & (column < F.lit(following))


def full_months(start: Column, end: Column) -> Column:
    """Completed calendar months from `start` to `end`, truncated towards zero when negative.

    `months_between` is not used: it counts the last day of two months as a whole month even
    when the day number is smaller.
    """

    def elapsed(a: Column, b: Column) -> Column:
        months = (F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a)
        return months - F.when(F.dayofmonth(b) < F.dayofmonth(a), 1).otherwise(0)

    return F.when(start <= end, elapsed(start, end)).otherwise(-elapsed(end, start)).cast("int")


def age_group(birth_date: Column, as_of: Column) -> Column:
    """Decade of age with its suffix; an unknown birth date leaves the suffix alone."""
    decades = (full_months(birth_date, as_of) / F.lit(120)).cast("int") * 10
    return F.concat_ws("", decades.cast("string"), F.lit(AGE_GROUP_SUFFIX))
