"""Solar geometry, radiation split and photovoltaic capacity factor."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridyield import constants as K
from gridyield.functions.calendar import day_angle, fourier_series, per_day_of_year
from gridyield.functions.nulls import at_least, clip, positive_or_zero


def _of_day(series, doy: Column, whole_days: bool, outer=None) -> Column:
    """A Fourier series of the day angle, from the constant table when day numbers are whole."""
    if whole_days:
        last = outer or (lambda x: x)
        return per_day_of_year(
            lambda day: last(fourier_series(series, day_angle(day), math.cos, math.sin)), doy
        )
    value = fourier_series(series, day_angle(doy.cast("double")))
    return {None: lambda x: x, math.sin: F.sin, math.cos: F.cos}[outer](value)


def equation_of_time(doy: Column, whole_days: bool = True) -> Column:
    """Minutes."""
    return F.lit(K.EQUATION_OF_TIME_SCALE) * _of_day(K.EQUATION_OF_TIME_SERIES, doy, whole_days)


def cos_zenith(doy: Column, hour_utc: Column, lat: Column, lon: Column, whole_days: bool = True) -> Column:
    """Cosine of the solar zenith angle, 0 below the horizon. Longitude in degrees east.

    ``whole_days=False`` for averaged, fractional day numbers.
    """
    solar_minutes = hour_utc * F.lit(60.0) + equation_of_time(doy, whole_days) + lon * F.lit(4.0)
    hour_angle = F.radians(solar_minutes / F.lit(4.0) - F.lit(180.0))
    phi = F.radians(lat)
    sin_decl = _of_day(K.DECLINATION_SERIES, doy, whole_days, math.sin)
    cos_decl = _of_day(K.DECLINATION_SERIES, doy, whole_days, math.cos)
    return at_least(F.sin(phi) * sin_decl + F.cos(phi) * cos_decl * F.cos(hour_angle), 0.0)


def extraterrestrial_kw(doy: Column, cosz: Column, whole_days: bool = True) -> Column:
    """Horizontal irradiance outside the atmosphere, kW m-2."""
    return F.lit(K.SOLAR_CONSTANT_KW) * _of_day(K.ECCENTRICITY_SERIES, doy, whole_days) * cosz


def clearness_index(ghi_kw: Column, etr_kw: Column) -> Column:
    ratio = F.when(etr_kw > F.lit(K.MIN_EXTRATERRESTRIAL_KW), ghi_kw / etr_kw).otherwise(F.lit(0.0))
    return clip(ratio, 0.0, 1.0)


def _polynomial(coefficients, x: Column) -> Column:
    total = F.lit(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        total = total * x + F.lit(c)
    return total


def erbs_diffuse_fraction(kt: Column) -> Column:
    """Share of diffuse irradiance; both polynomials stay within 0..1 on their ranges."""
    return (
        F.when(kt <= F.lit(0.0), F.lit(1.0))
        .when(kt <= F.lit(K.ERBS_LOW_LIMIT), _polynomial(K.ERBS_LOW, kt))
        .when(kt <= F.lit(K.ERBS_HIGH_LIMIT), _polynomial(K.ERBS_MIDDLE, kt))
        .when(kt.isNotNull(), F.lit(K.ERBS_CLEAR))
    )


def plane_irradiance_kw(ghi_kw: Column, diffuse_fraction: Column, cosz: Column) -> Column:
    """Irradiance on a two-axis tracked plane: beam at normal incidence plus isotropic diffuse."""
    diffuse = ghi_kw * diffuse_fraction
    beam = F.when(
        cosz > F.lit(K.MIN_COS_ZENITH), F.greatest(ghi_kw - diffuse, F.lit(0.0)) / cosz
    ).otherwise(F.lit(0.0))
    plane = beam + diffuse * (F.lit(1.0) + cosz) / F.lit(2.0)
    return positive_or_zero(F.when(cosz > F.lit(0.0), plane))


def temperature_factor(plane_kw: Column, tas_c: Column, wind_speed: Column) -> Column:
    """Efficiency factor of the module; missing input gives 0."""
    cell = (
        F.lit(K.CELL_TEMPERATURE_OFFSET)
        + F.lit(K.CELL_TEMPERATURE_AIR) * tas_c
        + F.lit(K.CELL_TEMPERATURE_IRRADIANCE) * (plane_kw * F.lit(1000.0))
        - F.lit(K.CELL_TEMPERATURE_WIND) * wind_speed
    )
    factor = F.lit(1.0) - F.lit(K.TEMPERATURE_GAMMA) * (cell - F.lit(K.REFERENCE_CELL_TEMPERATURE))
    return positive_or_zero(factor)


def solar_cf(plane_kw: Column, factor: Column) -> Column:
    return clip(plane_kw * factor * F.lit(K.SYSTEM_COEFFICIENT), 0.0, 1.0)
