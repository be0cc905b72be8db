"""Report measures on people dimensions (ages, tenure, anniversaries, previous period).

All whole-year arithmetic compares (month, day) pairs instead of using
``months_between``, which treats two month-ends as a full month.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import ColumnOrName, _c


def whole_years(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Completed years from ``start`` to ``end``."""
    s, e = _c(start), _c(end)
    before = (F.month(e) * 100 + F.dayofmonth(e)) < (F.month(s) * 100 + F.dayofmonth(s))
    return (F.year(e) - F.year(s) - F.when(before, 1).otherwise(0)).cast("int")


def whole_months(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Completed months from ``start`` to ``end``."""
    s, e = _c(start), _c(end)
    return ((F.year(e) - F.year(s)) * 12 + F.month(e) - F.month(s)
            - F.when(F.dayofmonth(e) < F.dayofmonth(s), 1).otherwise(0)).cast("int")


def age(birth: ColumnOrName, as_of: ColumnOrName) -> Column:
    return whole_years(birth, as_of)


def age_upcoming(birth: ColumnOrName, as_of: ColumnOrName) -> Column:
    return age(birth, as_of) + 1


def tenure_years(start: ColumnOrName, termination: ColumnOrName, as_of: ColumnOrName) -> Column:
    return whole_years(start, F.coalesce(_c(termination), _c(as_of)))


def tenure_text(start: ColumnOrName, termination: ColumnOrName, as_of: ColumnOrName) -> Column:
    """``'<years> Jahre, <months> Monate'`` of company affiliation."""
    m = whole_months(start, F.coalesce(_c(termination), _c(as_of)))
    return F.format_string("%d Jahre, %d Monate", F.floor(m / 12).cast("int"), (m % 12).cast("int"))


def next_anniversary(start: ColumnOrName, as_of: ColumnOrName) -> Column:
    """First ``start + k years`` (k >= 0) on or after ``as_of``."""
    s, a = _c(start), _c(as_of)
    k = F.greatest(F.year(a) - F.year(s), F.lit(0))
    cand = F.add_months(s, k * 12)
    return F.when(cand >= a, cand).otherwise(F.add_months(s, (k + 1) * 12))


def next_birthday(birth: ColumnOrName, as_of: ColumnOrName) -> Column:
    """First birthday on or after ``as_of`` (Feb 29 births fall on Feb 28 in other years)."""
    return next_anniversary(birth, as_of)


def birthday_in_year(birth: ColumnOrName, year: ColumnOrName) -> Column:
    b = _c(birth)
    return F.add_months(b, (_c(year) - F.year(b)) * 12)


def previous_period(dates: DataFrame, date_col: str = "date", months: int = 12,
                    as_: str = "previous_date") -> DataFrame:
    """Date table with the comparison date ``months`` earlier."""
    return dates.withColumn(as_, F.add_months(F.col(date_col), -months))
