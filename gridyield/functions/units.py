"""Unit conversion. Unknown units are decided by a flag column computed per file and variable."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridyield.constants import (
    JOULE_PER_KWH,
    KELVIN_OFFSET,
    KMH_PER_MS,
    KMH_SPELLINGS,
    MM_PER_M,
    SECONDS_PER_HOUR,
    SUNSHINE_THRESHOLD,
)
from gridyield.functions.nulls import finite, or_zero, positive_or_zero


def _spelling(units: Column, keep_blanks: bool = False) -> Column:
    text = F.lower(F.coalesce(units, F.lit("")))
    return text if keep_blanks else F.replace(text, F.lit(" "), F.lit(""))


def irradiance_units_known(units: Column) -> Column:
    text = _spelling(units)
    return text.contains("kw") | (text.contains("w") & text.contains("m"))


def irradiance_kw(value: Column, units: Column, looks_like_watt: Column) -> Column:
    """kW m-2; missing becomes 0, negative becomes 0."""
    text = _spelling(units)
    in_watt = (~text.contains("kw")) & (
        (text.contains("w") & text.contains("m")) | (~irradiance_units_known(units) & looks_like_watt)
    )
    scaled = F.when(in_watt, value / F.lit(1000.0)).otherwise(value)
    return positive_or_zero(finite(scaled))


def temperature_units_known(units: Column) -> Column:
    text = _spelling(units, keep_blanks=True)
    return (text.contains("k") & ~text.contains("deg")) | text.contains("c")


def temperature_celsius(value: Column, units: Column, looks_like_kelvin: Column) -> Column:
    """Degrees Celsius; missing stays missing."""
    text = _spelling(units, keep_blanks=True)
    in_kelvin = (text.contains("k") & ~text.contains("deg")) | (
        ~temperature_units_known(units) & looks_like_kelvin
    )
    return F.when(in_kelvin, value - F.lit(KELVIN_OFFSET)).otherwise(value)


def wind_ms(value: Column, units: Column, missing_is_calm: bool = True) -> Column:
    """m s-1; missing becomes 0, or NULL where it must stay apart from calm."""
    text = _spelling(units)
    in_kmh = F.lit(False)
    for spelling in KMH_SPELLINGS:
        in_kmh = in_kmh | text.contains(spelling)
    speed = finite(F.when(in_kmh, value / F.lit(KMH_PER_MS)).otherwise(value))
    return or_zero(speed) if missing_is_calm else speed


def ghi_kw_from_increment(increment: Column) -> Column:
    """Energy per hour in J m-2 to mean power in kW m-2."""
    return positive_or_zero(finite(increment / F.lit(JOULE_PER_KWH)))


def precipitation_mm_h(increment: Column) -> Column:
    """Water depth per hour in m to mm h-1."""
    return positive_or_zero(finite(increment * F.lit(MM_PER_M)))


def is_sunny(increment: Column, threshold: float = SUNSHINE_THRESHOLD) -> Column:
    """Hourly energy increment in J m-2 above the sunshine threshold in W m-2; missing is not sunny."""
    return F.coalesce(increment / F.lit(SECONDS_PER_HOUR) > F.lit(float(threshold)), F.lit(False))
