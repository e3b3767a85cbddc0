"""Running totals to increments."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridyield.functions.calendars import STANDARD, Standard
from gridyield.functions.nulls import at_least
from gridyield.operators.neighbours import with_carried, with_previous

POLICIES = ("zero", "nan", "current")


def deaccumulate(
    df: DataFrame,
    value: str,
    keys: Sequence[str] = ("cell",),
    t: str = "t",
    policy: str = "zero",
    output: str = "increment",
    chunk: Column | None = None,
    tails: DataFrame | None = None,
    calendar: Standard = STANDARD,
) -> DataFrame:
    """Increments of a running total that restarts at 01:00 UTC every day.

    The 01:00 row is an increment already; every other row is its total minus that of the previous
    row, if that lies in the same or the directly preceding month. ``policy`` decides every other row, such as the
    first of a key and the first after a missing month. A negative difference falls
    back to the total; what is still negative becomes 0. To process a range of months, pass one more
    month before it and filter afterwards, or its last steps as ``tails`` (see ``month_tails``): then ``df`` is read once and
    needs no rows of the month before. ``calendar`` says how hours and months follow from ``t``.
    """
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}: {policy!r}")
    total = F.col(value).cast("double")  # stored in single precision
    # A missing month leaves no predecessor: it must lie in the same or the directly preceding month.
    month = calendar.month_number(F.col(t))
    near = month - calendar.month_number(F.col(f"previous_{t}")) <= 1
    first = {"zero": F.lit(0.0), "nan": F.lit(None).cast("double"), "current": total}[policy]
    step = (
        F.when(calendar.hour(F.col(t)) == 1, total)
        .when(F.col("has_previous") & near, total - F.col(f"previous_{value}"))
        .otherwise(first)
    )
    if tails is None:
        found = with_previous(df, keys, t, [value, t], calendar.chunk(F.col(t)) if chunk is None else chunk)
    else:
        # The last step of a month only ever precedes the first of the next, so it goes to that month's window.
        found = with_carried(df, tails.select(*keys, t, value, (month + 1).alias("_to")), keys, t, [value, t], month)
    return (
        found.withColumn("_step", step)
        .withColumn(output, at_least(F.when(F.col("_step") < 0, total).otherwise(F.col("_step")), 0.0))
        .drop("_step", "has_previous", f"previous_{value}", f"previous_{t}")
    )


def month_tails(
    df: DataFrame, value: str, keys: Sequence[str] = ("cell",), t: str = "t", calendar: Standard = STANDARD
) -> DataFrame:
    """The last step of every key and month: keys, year, month, t, value.

    One row for several hundred. Kept next to the months (``sinks.write_month_tails``) it is all that the month behind needs.
    """
    months = df.groupBy(*keys, calendar.year(F.col(t)).alias("year"), calendar.month(F.col(t)).alias("month"))
    return months.agg(F.max_by(value, t).alias(value), F.max(t).alias(t)).select(*keys, "year", "month", t, value)


def monthly_difference(
    df: DataFrame, value: str, keys: Sequence[str] = ("cell",), t: str = "t", output: str = "increment",
    calendar: Standard = STANDARD,
) -> DataFrame:
    """Difference to the previous row of the same month, 0 before its first row, negatives to 0.

    This is the rule of the sunshine climatology: no reset at 01:00 and no look across the border.
    """
    within = W.partitionBy(*keys, "year", "month").orderBy(t)
    return (
        df.withColumns({"year": calendar.year(F.col(t)), "month": calendar.month(F.col(t))})
        .withColumn("_previous", F.lag(value, 1, 0.0).over(within))
        .withColumn(output, at_least(F.col(value).cast("double") - F.col("_previous"), 0.0))
        .drop("_previous")
    )
