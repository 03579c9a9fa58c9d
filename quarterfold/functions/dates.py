"""Date and period column helpers.

Clock functions never appear here: whatever the rules call "today" is the
``as_of`` argument, so a job gives the same answer when it is run again.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F


def _lit_day(value: str | date | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(str(value)).cast("date")


def day(c: Column) -> Column:
    """Calendar day of a timestamp."""
    return F.to_date(c)


def ddiff(a: Column, b: Column) -> Column:
    """Whole days from ``b`` to ``a``."""
    return F.datediff(a, b)


def ddiff_or(a: Column, b: Column, default: int) -> Column:
    """``ddiff`` when both ends are known, else ``default``."""
    return F.when(a.isNotNull() & b.isNotNull(), F.datediff(a, b)).otherwise(F.lit(default))


def in_period(c: Column, start, end) -> Column:
    """Closed period test on the calendar day of ``c``."""
    return day(c).between(_lit_day(start), _lit_day(end))


def up_to(c: Column, end) -> Column:
    """Calendar day of ``c`` is on or before ``end``."""
    return day(c) <= _lit_day(end)


def not_after_midnight(c: Column, end) -> Column:
    """``c`` is at or before 00:00 of ``end``; a later time on that day fails."""
    return c.cast("timestamp_ntz") <= _lit_day(end).cast("timestamp_ntz")


def same_day(a: Column, b: Column) -> Column:
    return day(a) == day(b)


def add_days(c: Column, n: Column) -> Column:
    """Timestamp plus ``n`` days; a fraction of a day is rounded first."""
    return c.cast("timestamp_ntz") + F.make_dt_interval(F.round(n).cast("int"))


def quarter_start(c: Column) -> Column:
    """First day of the calendar quarter of ``c``."""
    return F.trunc(F.to_date(c), "quarter")


def quarter_index(c: Column) -> Column:
    """Quarters counted from year 0, so that the next quarter is one more."""
    return F.year(c) * 4 + F.quarter(c) - 1


def ceil_day(c: Column) -> Column:
    """First day whose midnight is at or after ``c``."""
    d = F.to_date(c)
    return F.when(d.cast("timestamp_ntz") < c.cast("timestamp_ntz"), F.date_add(d, 1)).otherwise(d)


def elapsed_years(birth: Column, visit: Column) -> Column:
    """Years between two days, read off as the calendar year of the day count.

    Day counts below 366 are year zero; day 366 is 1 January of year 1.
    """
    n = F.datediff(visit, birth)
    return (
        F.when(n.isNull(), F.lit(None).cast("int"))
        .when(n < 366, F.lit(0))
        .otherwise(F.year(F.date_add(F.lit("0001-01-01").cast("date"), n - 366)))
    )


def age_years(birth: Column, visit: Column, created: Column, estimated: Column, as_of) -> Column:
    """Age at ``visit``, one more for an estimated mid-year birth.

    The extra year is given when the birth date is an estimated 1 July, the
    record was created in the year of ``as_of`` and ``as_of`` is before July.
    """
    today = _lit_day(as_of)
    years = elapsed_years(day(birth), day(visit))
    mid_year = (
        (F.month(birth) == 7) & (F.dayofmonth(birth) == 1) & (estimated.cast("int") == 1)
        & (F.month(today) < 7) & (F.year(created) == F.year(today))
    )
    return F.when(mid_year, years + 1).otherwise(years)


def period_label(start: Column, end: Column) -> Column:
    """``2000 - 4th Quarter`` inside one quarter, else ``01/Oct/2000 to 15/Jan/2001``."""
    ordinal = F.element_at(F.array(*map(F.lit, ("1st", "2nd", "3rd", "4th"))), F.quarter(start))
    one_quarter = F.trunc(start, "quarter") == F.trunc(end, "quarter")
    return F.when(
        one_quarter, F.concat(F.year(start).cast("string"), F.lit(" - "), ordinal, F.lit(" Quarter"))
    ).otherwise(
        F.concat(F.date_format(start, "dd/MMM/yyyy"), F.lit(" to "), F.date_format(end, "dd/MMM/yyyy"))
    )
