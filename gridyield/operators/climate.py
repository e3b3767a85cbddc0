"""Multi-year climatologies per cell and mean profiles."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridyield import constants as K
from gridyield.functions import units, wind
from gridyield.functions.calendar import steps_before_month, steps_in_month
from gridyield.functions.calendars import STANDARD, Standard
from gridyield.operators.accumulation import deaccumulate, monthly_difference
from gridyield.operators.increments import mean_of_parts, mean_parts
from gridyield.operators.masking import attach_mask
from gridyield.operators.sizing import broadcast_if_small


def hub_wind_speed(u: str = "u10", v: str = "v10") -> Column:
    """What the wind climatology averages; with ``increments.mean_parts`` it grows year by year."""
    return wind.hub_speed(wind.speed(F.col(u), F.col(v)))


def celsius(t2m: str = "t2m") -> Column:
    """What the temperature climatology averages."""
    return F.col(t2m) - F.lit(K.KELVIN_OFFSET)


def mean_hub_wind_speed(df: DataFrame, u: str = "u10", v: str = "v10", cell: str = "cell") -> DataFrame:
    return df.groupBy(cell).agg(F.avg(hub_wind_speed(u, v)).alias("value"))


def mean_temperature(df: DataFrame, t2m: str = "t2m", cell: str = "cell") -> DataFrame:
    return df.groupBy(cell).agg(F.avg(celsius(t2m)).alias("value"))


def mean_sunshine_hours(
    df: DataFrame, total: str = "ssrd", cell: str = "cell", t: str = "t", rule: str = "monthly", calendar: Standard = STANDARD
) -> DataFrame:
    """Mean daily hours with irradiance above the threshold, over days with any value.

    ``rule='monthly'`` differences within the month from 0; ``rule='reset'`` restarts at 01:00 like
    the capacity-factor job. Days are grouped by (cell, year, month, day), which needs no shuffle beyond
    that of the monthly window.
    """
    if rule == "monthly":
        steps = monthly_difference(df, total, [cell], t, calendar=calendar)
    elif rule == "reset":
        parts = {"year": calendar.year(F.col(t)), "month": calendar.month(F.col(t))}
        steps = deaccumulate(df, total, [cell], t, calendar=calendar).withColumns(parts)
    else:
        raise ValueError(f"rule must be 'monthly' or 'reset': {rule!r}")
    days = (
        steps.groupBy(cell, "year", "month", calendar.day(F.col(t)).alias("day"))
        .agg(F.count_if(units.is_sunny(F.col("increment"))).alias("hours"), F.count(total).alias("_valid"))
        .where(F.col("_valid") > 0)
    )
    return days.groupBy(cell).agg(F.avg("hours").alias("value"))


def climatology(df: DataFrame, var: str, units_text: str, long_name: str, cell: str = "cell") -> DataFrame:
    """Result rows of the climatology table."""
    return df.select(
        F.lit(var).alias("var"),
        cell,
        F.col("value").cast("float").alias("value"),
        F.lit(units_text).alias("units"),
        F.lit(long_name).alias("long_name"),
    )


def month_position(
    df: DataFrame, keys: Sequence[str], t: str, how: str, steps_per_day: int, calendar: Standard = STANDARD
) -> DataFrame:
    """Zero-based ``position`` of a row within its month.

    ``calendar``: from the timestamp alone, for complete regular axes (no window, no shuffle).
    ``axis``: rank on the shared time axis of the month, as positions in a file.
    ``row``: rank among the rows of the key, for keys with their own axes.
    """
    dated = df.withColumns({"year": calendar.year(F.col(t)), "month": calendar.month(F.col(t))})
    if how == "calendar":
        return dated.withColumn("position", calendar.step_of_month(F.col(t), steps_per_day))
    if how == "row":
        within = W.partitionBy(*keys, "year", "month").orderBy(t)
        return dated.withColumn("position", F.row_number().over(within) - 1)
    if how == "axis":
        axis = dated.select(t, "year", "month").distinct()
        rank = F.row_number().over(W.partitionBy("year", "month").orderBy(t)) - 1
        table = axis.withColumn("position", rank).select(t, "position")
        return dated.join(broadcast_if_small(table), t)
    raise ValueError(f"how must be 'calendar', 'axis' or 'row': {how!r}")


def mean_profile(
    df: DataFrame,
    value: str = "cf",
    keys: Sequence[str] = ("cell",),
    t: str = "t",
    mask: DataFrame | None = None,
    how: str = "calendar",
    steps_per_day: int = 24,
    calendar: Standard = STANDARD,
) -> DataFrame:
    """Mean over the years per (key, month, position in month); February is cut to 28 days.

    Missing values are skipped, ocean cells become NULL. ``n_years`` counts the values of each mean.
    """
    placed = _placed(df, keys, t, how, steps_per_day, calendar)
    means = placed.groupBy(*keys, "month", "position").agg(
        F.avg(value).alias(value), F.count(value).alias("n_years")
    )
    return _masked(means, value, mask)


def _placed(df: DataFrame, keys: Sequence[str], t: str, how: str, steps_per_day: int, calendar: Standard) -> DataFrame:
    placed = month_position(df, keys, t, how, steps_per_day, calendar)
    return placed.where(F.col("position") < steps_in_month(F.col("month"), steps_per_day))


def _masked(means: DataFrame, value: str, mask: DataFrame | None) -> DataFrame:
    if mask is None:
        return means
    masked = attach_mask(means, mask)
    return masked.withColumn(value, F.when(F.col("is_land"), F.col(value))).drop("is_land")


def profile_parts(
    df: DataFrame, value: str = "cf", keys: Sequence[str] = ("cell",), t: str = "t", how: str = "calendar", steps_per_day: int = 24,
    calendar: Standard = STANDARD,
) -> DataFrame:
    """The mean profile's sums and counts per year, from which ``profile_of_parts`` forms it when a year has been added."""
    return mean_parts(_placed(df, keys, t, how, steps_per_day, calendar), value, [*keys, "month", "position"])


def profile_of_parts(parts: DataFrame, value: str = "cf", keys: Sequence[str] = ("cell",), mask: DataFrame | None = None) -> DataFrame:
    """``mean_profile`` of all years in ``parts``."""
    return _masked(mean_of_parts(parts, [*keys, "month", "position"], value, "n_years"), value, mask)


def merge_months(profile: DataFrame, steps_per_day: int = 24) -> DataFrame:
    """Continuous position in the 8760-hour year; month lengths are fixed, so no sort is needed."""
    offset = steps_before_month(F.col("month"), steps_per_day)
    return profile.withColumn("hour_of_year", (offset + F.col("position")).cast("int"))


def month_grid_sizes(profile: DataFrame, cell: str = "cell") -> DataFrame:
    """Number of cells per month; a merge needs the same number in all twelve."""
    return profile.select("month", cell).distinct().groupBy("month").agg(F.count(F.lit(1)).alias("n_cells"))


def require_twelve_months(profile: DataFrame, cell: str = "cell") -> None:
    sizes = {r["month"]: r["n_cells"] for r in month_grid_sizes(profile, cell).collect()}  # twelve rows
    missing = [m for m in range(1, 13) if m not in sizes]
    if missing:
        raise ValueError(f"months without a mean profile: {missing}")
    if len(set(sizes.values())) > 1:
        raise ValueError(f"months differ in grid size: {sizes}")


