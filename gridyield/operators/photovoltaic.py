"""Solar capacity factor of weather rows.

Each stage is its own projection: an intermediate used twice is computed once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridyield.functions import solar, wind
from gridyield.functions.calendar import day_of_year, hour_decimal
from gridyield.functions.nulls import or_zero

MISSING_WIND = ("zero_cf", "zero_wind")
_STAGES = ["_speed", "_doy", "_hour", "_cosz", "_etr", "_kt", "_fd", "_plane", "_factor"]


def add_geometry(df: DataFrame, t: str = "t", doy: str | None = None, hour: str | None = None,
                 whole_days: bool = True) -> DataFrame:
    """Columns ``_doy``, ``_hour``, ``_cosz``. Calendar columns may be given (other calendars, averages)."""
    return df.withColumns(
        {
            "_doy": F.col(doy) if doy else day_of_year(F.col(t)),
            "_hour": F.col(hour) if hour else hour_decimal(F.col(t)),
        }
    ).withColumn(
        "_cosz", solar.cos_zenith(F.col("_doy"), F.col("_hour"), F.col("lat"), F.col("lon"), whole_days)
    )


def add_diffuse_fraction(df: DataFrame, ghi_kw: str = "ghi_kw", whole_days: bool = True) -> DataFrame:
    return (
        df.withColumn("_etr", solar.extraterrestrial_kw(F.col("_doy"), F.col("_cosz"), whole_days))
        .withColumn("_kt", solar.clearness_index(F.col(ghi_kw), F.col("_etr")))
        .withColumn("_fd", solar.erbs_diffuse_fraction(F.col("_kt")))
    )


def add_plane(df: DataFrame, ghi_kw: str = "ghi_kw") -> DataFrame:
    return df.withColumn("_plane", solar.plane_irradiance_kw(F.col(ghi_kw), F.col("_fd"), F.col("_cosz")))


def add_solar_cf(
    df: DataFrame,
    ghi_kw: str = "ghi_kw",
    tas_c: str = "tas_c",
    u: str | None = "uas",
    v: str | None = "vas",
    speed: str | None = None,
    t: str = "t",
    doy: str | None = None,
    hour: str | None = None,
    missing_wind: str = "zero_cf",
    output: str = "cf",
    whole_days: bool = True,
    keep_stages: bool = False,
) -> DataFrame:
    """Add the photovoltaic capacity factor.

    Wind comes as components ``u``/``v`` or as scalar ``speed``. Missing wind makes the factor 0
    (``zero_cf``) or counts as calm (``zero_wind``). Missing irradiance counts as 0, missing
    temperature gives 0.
    """
    if missing_wind not in MISSING_WIND:
        raise ValueError(f"missing_wind must be one of {MISSING_WIND}: {missing_wind!r}")
    fill = or_zero if missing_wind == "zero_wind" else (lambda c: c)
    windy = fill(F.col(speed)) if speed else wind.speed(fill(F.col(u)), fill(F.col(v)))
    staged = add_geometry(
        df.withColumns({"_speed": windy, "_ghi": or_zero(F.col(ghi_kw))}), t, doy, hour, whole_days
    )
    staged = add_plane(add_diffuse_fraction(staged, "_ghi", whole_days), "_ghi")
    staged = staged.withColumn(
        "_factor", solar.temperature_factor(F.col("_plane"), F.col(tas_c), F.col("_speed"))
    )
    out = staged.withColumn(output, solar.solar_cf(F.col("_plane"), F.col("_factor"))).drop("_ghi")
    return out if keep_stages else out.drop(*_STAGES)
