"""Fiscal-calendar column expressions (Sunday-to-Saturday weeks).

The fiscal year of a week is the calendar year of its Saturday; the week number
is ``(day_of_year(saturday) - 1) div 7 + 1`` and ``fisc_yr_wk`` is the year
followed by the two-digit week, so year-weeks compare correctly as text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def week_end(d: Column) -> Column:
    return F.date_add(d, (F.lit(7) - F.dayofweek(d)).cast("int"))


def week_start(d: Column) -> Column:
    return F.date_sub(week_end(d), 6)


def fiscal_year(d: Column) -> Column:
    return F.year(week_end(d))


def fiscal_week(d: Column) -> Column:
    return (F.floor((F.dayofyear(week_end(d)) - 1) / 7) + 1).cast("int")


def fiscal_year_week(d: Column) -> Column:
    return F.concat(
        fiscal_year(d).cast("string"), F.lpad(fiscal_week(d).cast("string"), 2, "0")
    )
