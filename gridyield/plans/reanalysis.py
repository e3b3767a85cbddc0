"""Capacity factors of hourly reanalysis months."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridyield.functions import units as U
from gridyield.operators.accumulation import deaccumulate
from gridyield.operators.alignment import combine
from gridyield.operators.filters import select_period
from gridyield.operators.masking import apply_land_mask
from gridyield.operators.photovoltaic import add_solar_cf
from gridyield.operators.windpower import add_wind_cf


def _combined(weather: DataFrame | dict[str, DataFrame], names: tuple[str, ...], years=None, months="") -> DataFrame:
    """The period of one table, or of variables that were delivered separately and must share their grid and time axis."""
    def cut(df):
        return select_period(df, years, months) if years else df

    return cut(weather) if isinstance(weather, DataFrame) else combine({n: cut(weather[n]) for n in names})


def solar(
    weather: DataFrame | dict[str, DataFrame], mask: DataFrame, years=None, months="", policy: str = "zero",
    temperature_units: str = "K", wind_units: str = "m s-1", tails: DataFrame | None = None,
) -> DataFrame:
    """Running irradiance totals to increments, then the solar chain.

    ``weather`` includes the month before the requested ones, and the period filter follows the window. With ``tails``, the last
    steps of the months before (``accumulation.month_tails``), only the requested months are read, once. Variables may come as
    tables of their own (ssrd, t2m, u10, v10); then a step or cell that one of them lacks, has twice or places elsewhere ends the job.
    """
    names = ("ssrd", "t2m", "u10", "v10")
    if tails is None:
        steps = deaccumulate(_combined(weather, names), "ssrd", policy=policy)
        wanted = select_period(steps, years, months) if years else steps
    else:
        wanted = deaccumulate(_combined(weather, names, years, months), "ssrd", policy=policy, tails=tails)
    ready = wanted.withColumns(
        {
            "ghi_kw": U.ghi_kw_from_increment(F.col("increment")),
            "tas_c": U.temperature_celsius(F.col("t2m"), F.lit(temperature_units), F.lit(False)),
            "u10": U.wind_ms(F.col("u10"), F.lit(wind_units)),
            "v10": U.wind_ms(F.col("v10"), F.lit(wind_units)),
        }
    )
    out = add_solar_cf(ready, u="u10", v="v10", missing_wind="zero_wind")
    return apply_land_mask(out, mask).drop("ghi_kw", "tas_c", "increment", "ssrd", "t2m", "u10", "v10")


def wind(
    weather: DataFrame | dict[str, DataFrame], mask: DataFrame, knots, rated_kw: float, years=None, months="", wind_units: str = "m s-1"
) -> DataFrame:
    """Hub-height wind to capacity factors. The two components may come as tables of their own (u10, v10), as in ``solar``."""
    wanted = _combined(weather, ("u10", "v10"), years, months)
    ready = wanted.withColumns({n: U.wind_ms(F.col(n), F.lit(wind_units)) for n in ("u10", "v10")})
    out = add_wind_cf(ready, knots, rated_kw, "u10", "v10")
    return apply_land_mask(out, mask).drop("ssrd", "t2m", "u10", "v10")
