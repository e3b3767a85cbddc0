"""Magnitude rules for files without a usable unit."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridyield import constants as K
from gridyield.functions import units as U
from gridyield.functions.nulls import finite
from gridyield.operators.sizing import broadcast_if_small


def quantile_exceeds(value: Column, quantile: float, limit: float) -> Column:
    """Exact test "linearly interpolated quantile > limit" as an aggregate.

    A quantile needs all values of a group in one place; the comparison with a fixed limit does not.
    With c values at or below the limit, only the two order statistics around the limit can matter:
    the largest value below and the smallest above. Counts, a maximum and a minimum merge map-side,
    so one huge file is no hot spot.
    """
    v = finite(value)
    edge = F.lit(float(limit))
    n = F.count(v)
    low = F.count(F.when(v <= edge, v))
    below, above = F.max(F.when(v <= edge, v)), F.min(F.when(v > edge, v))
    rank = (n - 1) * F.lit(float(quantile))
    left = F.floor(rank)
    return F.coalesce(
        F.when(n == 0, F.lit(False))
        .when(left >= low, F.lit(True))
        .when(left + 1 < low, F.lit(False))
        .otherwise(below + (rank - left) * (above - below) > edge),
        F.lit(False),
    )


def _flags(df: DataFrame, keys: Sequence[str], value: str, known: Column, quantile: float, limit: float) -> DataFrame:
    return (
        df.where(~known)
        .groupBy(*keys)
        .agg(quantile_exceeds(F.col(value), quantile, limit).alias("_exceeds"))
    )


def irradiance_flags(df: DataFrame, value: str, keys: Sequence[str]) -> DataFrame:
    """Per file with unknown units whether its values are as large as W m-2, straight from the delivered rows."""
    return _flags(df, keys, value, F.lit(False), K.IRRADIANCE_QUANTILE, K.IRRADIANCE_LIMIT)


def temperature_flags(df: DataFrame, value: str, keys: Sequence[str]) -> DataFrame:
    """Per file with unknown units whether its values are as large as Kelvin, straight from the delivered rows."""
    return _flags(df, keys, value, F.lit(False), K.TEMPERATURE_QUANTILE, K.TEMPERATURE_LIMIT)


def _convert(df, keys, value, known, quantile, limit, convert, output, flags):
    flags = _flags(df, keys, value, known, quantile, limit) if flags is None else flags
    joined = df.join(broadcast_if_small(flags), list(keys), "left")
    flag = F.coalesce(F.col("_exceeds"), F.lit(False))
    return joined.withColumn(output, convert(finite(F.col(value)), flag)).drop("_exceeds")


def convert_irradiance(
    df: DataFrame, value: str, units: str = "units", keys: Sequence[str] = ("file",), output: str = "ghi_kw", flags: DataFrame | None = None
) -> DataFrame:
    """Irradiance in kW m-2; files with unknown units count as W m-2 when their 99th percentile exceeds 10."""
    known = U.irradiance_units_known(F.col(units))
    return _convert(
        df, keys, value, known, K.IRRADIANCE_QUANTILE, K.IRRADIANCE_LIMIT,
        lambda v, flag: U.irradiance_kw(v, F.col(units), flag), output, flags,
    )


def convert_temperature(
    df: DataFrame, value: str, units: str = "units", keys: Sequence[str] = ("file",), output: str = "tas_c", flags: DataFrame | None = None
) -> DataFrame:
    """Temperature in degrees Celsius; files with unknown units count as Kelvin when their median exceeds 100."""
    known = U.temperature_units_known(F.col(units))
    return _convert(
        df, keys, value, known, K.TEMPERATURE_QUANTILE, K.TEMPERATURE_LIMIT,
        lambda v, flag: U.temperature_celsius(v, F.col(units), flag), output, flags,
    )


def convert_wind(df: DataFrame, value: str, units: str = "units", output: str | None = None) -> DataFrame:
    return df.withColumn(output or value, U.wind_ms(F.col(value), F.col(units)))
