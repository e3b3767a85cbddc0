"""Time axes of the common calendar and of calendars without leap days, as expressions.

A timestamp column follows the common calendar. Model output often has years of 365 or 360 days; its axis is a number of
days since a date of that calendar. Both give year, month, day, day of the year and hour here, so operators take a calendar
and a column and need not know which.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridyield.constants import DAYS_PER_MONTH
from gridyield.functions import calendar as common

CHUNK_DAYS = 90


class Standard:
    """Timestamps in UTC."""

    def year(self, t: Column) -> Column:
        return F.year(t)

    def month(self, t: Column) -> Column:
        return F.month(t)

    def day(self, t: Column) -> Column:
        return F.dayofmonth(t)

    def day_of_year(self, t: Column) -> Column:
        return common.day_of_year(t)

    def hour(self, t: Column) -> Column:
        return F.hour(t)

    def hour_decimal(self, t: Column) -> Column:
        return common.hour_decimal(t)

    def month_number(self, t: Column) -> Column:
        """Months on one axis: neighbouring months differ by one."""
        return self.year(t) * 12 + self.month(t)

    def step_of_month(self, t: Column, steps_per_day: int) -> Column:
        return common.step_of_month(t, steps_per_day)

    def chunk(self, t: Column) -> Column:
        return common.time_chunk(t, CHUNK_DAYS)


@dataclass(frozen=True)
class DayCount(Standard):
    """Numbers of days since ``since`` (year, month, day) in a calendar whose years have all ``days_per_month``.

    Times are rounded to whole seconds, because fractions of days are not exact.
    """

    days_per_month: tuple[int, ...]
    since: tuple[int, int, int]

    def __post_init__(self):
        year, month, day = self.since
        if not (1 <= month <= 12 and 1 <= day <= self.days_per_month[month - 1]):
            raise ValueError(f"{self.since} is no date of this calendar")

    @property
    def _before(self) -> list[int]:
        return [sum(self.days_per_month[:m]) for m in range(12)]

    @property
    def _year_days(self) -> int:
        return sum(self.days_per_month)

    def _seconds(self, t: Column) -> Column:
        return F.round(t.cast("double") * 86400.0).cast("bigint")

    def _days(self, t: Column) -> Column:
        """Whole days since the first day of the year 0."""
        year, month, day = self.since
        start = year * self._year_days + self._before[month - 1] + day - 1
        return F.floor(self._seconds(t) / F.lit(86400)) + F.lit(start)

    def _of_year(self, t: Column) -> Column:
        return F.pmod(self._days(t), F.lit(self._year_days)).cast("int")

    def _of_day(self, t: Column) -> Column:
        return F.pmod(self._seconds(t), F.lit(86400))

    def _table(self, values: list[int], of: Column) -> Column:
        return F.get(F.lit(np.array(values, np.int32)), of)

    def year(self, t: Column) -> Column:
        return F.floor(self._days(t) / F.lit(self._year_days)).cast("int")

    def month(self, t: Column) -> Column:
        months = [m for m, n in enumerate(self.days_per_month, 1) for _ in range(n)]
        return self._table(months, self._of_year(t))

    def day(self, t: Column) -> Column:
        return self._table([d for n in self.days_per_month for d in range(1, n + 1)], self._of_year(t))

    def day_of_year(self, t: Column) -> Column:
        return self._of_year(t) + 1

    def hour(self, t: Column) -> Column:
        return F.floor(self._of_day(t) / F.lit(3600)).cast("int")

    def hour_decimal(self, t: Column) -> Column:
        return self._of_day(t) / F.lit(3600.0)

    def step_of_month(self, t: Column, steps_per_day: int) -> Column:
        of_day = F.floor(self._of_day(t) / F.lit(86400.0 / steps_per_day))
        return ((self.day(t) - 1) * steps_per_day + of_day).cast("int")

    def chunk(self, t: Column) -> Column:
        return F.floor(self._days(t) / F.lit(CHUNK_DAYS))


STANDARD = Standard()
MONTHS_OF_30_DAYS = (30,) * 12


def calendar_of(name: str, since: tuple[int, int, int] | None = None) -> Standard:
    """Calendar by its usual name; those without leap days need the date from which days are counted."""
    if name in ("standard", "gregorian", "proleptic_gregorian"):
        return STANDARD
    months = {"noleap": tuple(DAYS_PER_MONTH), "365_day": tuple(DAYS_PER_MONTH), "360_day": MONTHS_OF_30_DAYS}.get(name)
    if months is None:
        raise ValueError(f"unknown calendar: {name!r}")
    if since is None:
        raise ValueError(f"days of the calendar {name} are counted from a date: give since=(year, month, day)")
    return DayCount(months, since)


def with_calendar(df: DataFrame, calendar: Standard, t: str = "t") -> DataFrame:
    """Add year, month, doy and hour, which period filters, annual means and the sun position take as columns."""
    c = F.col(t)
    return df.withColumns(
        {"year": calendar.year(c), "month": calendar.month(c), "doy": calendar.day_of_year(c), "hour": calendar.hour_decimal(c)}
    )
