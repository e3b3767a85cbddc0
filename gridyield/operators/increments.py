"""Means that grow by new periods.

A mean over decades is kept as sums and counts per period. A new year adds its part; the mean is formed from the
parts, so the years before are never read again, and a corrected year replaces its own part only.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mean_parts(df: DataFrame, value: Column | str, keys: Sequence[str], period: Sequence[str] = ("year",)) -> DataFrame:
    """Sum and count of a value per key and period: keys, period, ``part_sum``, ``part_n``."""
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    return df.groupBy(*keys, *period).agg(F.sum(v).alias("part_sum"), F.count(v).alias("part_n"))


def merged_parts(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Parts of a coarser key or a longer period: sums of sums and counts."""
    return parts.groupBy(*keys).agg(F.sum("part_sum").alias("part_sum"), F.sum("part_n").alias("part_n"))


def mean_of_parts(parts: DataFrame, keys: Sequence[str], value: str = "value", count: str | None = None) -> DataFrame:
    """The mean per key over all periods in ``parts``, NULL where no value counted; ``count`` names a column for their number."""
    whole = merged_parts(parts, keys)
    number = [F.col("part_n").alias(count)] if count else []
    return whole.select(*keys, F.try_divide("part_sum", F.col("part_n").cast("double")).alias(value), *number)
