"""Calendar columns and period arguments."""

from __future__ import annotations

import math
from typing import Iterable

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from gridyield.constants import DAYS_PER_MONTH


def parse_years(years: str | tuple[int, int]) -> tuple[int, int]:
    """``'2015-2060'`` or ``'2020'`` to an inclusive pair."""
    if isinstance(years, tuple):
        first, last = years
    else:
        head, _, tail = years.strip().partition("-")
        first, last = int(head), int(tail or head)
    if last < first:
        raise ValueError(f"years out of order: {years}")
    return first, last


def parse_months(months: str | Iterable[int] = "") -> list[int]:
    """``'1,2,7'`` to a list; empty means all twelve."""
    parts = months.split(",") if isinstance(months, str) else list(months)
    chosen = [int(part) for part in parts if str(part).strip()] or list(range(1, 13))
    outside = [m for m in chosen if not 1 <= m <= 12]
    if outside:
        raise ValueError(f"months must be within 1..12: {outside}")
    return chosen


def day_of_year(t: Column) -> Column:
    return F.dayofyear(t)


def hour_decimal(t: Column) -> Column:
    return F.hour(t) + F.minute(t) / F.lit(60.0) + F.second(t) / F.lit(3600.0)


def month_start(t: Column) -> Column:
    return F.trunc(t, "month")


def time_chunk(t: Column, days: int = 90) -> Column:
    """Number of the stretch of days a timestamp falls into; plain arithmetic, cheap to hash and sort."""
    return F.floor(F.unix_seconds(t) / F.lit(float(days * 86400)))


def by_month(month: Column, values: Iterable[int]) -> Column:
    """Value of a twelve-entry list for the month number (1..12)."""
    return F.get(F.array(*[F.lit(v) for v in values]), month - F.lit(1))


def steps_in_month(month: Column, steps_per_day: int = 24) -> Column:
    return by_month(month, [d * steps_per_day for d in DAYS_PER_MONTH])


def steps_before_month(month: Column, steps_per_day: int = 24) -> Column:
    offsets = [sum(DAYS_PER_MONTH[:m]) * steps_per_day for m in range(12)]
    return by_month(month, offsets)


def step_of_month(t: Column, steps_per_day: int = 24) -> Column:
    """Zero-based step within the month of a complete regular axis."""
    seconds = F.lit(86400.0 / steps_per_day)
    of_day = F.floor((F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)) / seconds)
    return ((F.dayofmonth(t) - 1) * steps_per_day + of_day).cast("int")


def fourier_series(series, angle, cos=F.cos, sin=F.sin):
    """a0 + sum(a_k cos(k x) + b_k sin(k x)); works on columns and on floats."""
    constant, harmonics = series
    total = constant
    for k, (a, b) in enumerate(harmonics, start=1):
        total = total + a * cos(k * angle) + b * sin(k * angle)
    return total


def day_angle(doy):
    return (doy - 1.0) * (2.0 * math.pi / 365.0)


def per_day_of_year(function, doy: Column) -> Column:
    """Look up a function of the day number in a 366-entry constant array.

    The array is one constant of the plan, so a row pays one array access instead of
    several trigonometric calls. Only for whole day numbers.
    """
    # a numpy array becomes a single literal, which keeps the plan small
    table = F.lit(np.array([float(function(day)) for day in range(1, 367)]))
    return F.get(table, doy.cast("int") - F.lit(1))
