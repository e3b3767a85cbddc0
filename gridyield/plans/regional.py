"""Capacity factors of a regional domain (country files, one scalar-wind domain, rotated grid)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridyield.functions import units as U
from gridyield.operators.alignment import align_inner, fail_if
from gridyield.operators.filters import select_around, select_period
from gridyield.operators.interpolation import bracket_table, interpolate, interpolate_shared_axis
from gridyield.operators.masking import apply_land_mask
from gridyield.operators.photovoltaic import add_solar_cf
from gridyield.operators.unit_flags import convert_irradiance, convert_temperature, irradiance_flags, temperature_flags
from gridyield.operators.windpower import add_wind_cf


def solar(
    flux: DataFrame,
    states: DataFrame,
    mask: DataFrame,
    years=None,
    months="",
    scalar_wind: bool = False,
    missing_wind: str = "zero_cf",
    shared_axis: bool = True,
    keys: Sequence[str] = ("cell",),
    irradiance_units: str | None = "W m-2",
    temperature_units: str | None = "K",
    wind_units: str = "m s-1",
    file_keys: Sequence[str] = (),
    flux_axis: DataFrame | None = None,
    state_axis: DataFrame | None = None,
    pad_hours: int = 24,
    check: bool = True,
) -> DataFrame:
    """Solar job: keep the flux axis, interpolate the instantaneous variables to it, mask the ocean.

    ``flux`` has keys, lat, lon, t, rsds; ``states`` keys, t, tas and uas/vas or sfcWind. With ``years`` both are cut to
    the period before they meet, ``states`` padded by ``pad_hours``, which must cover one of its steps. Time axes
    kept as tables of their own (column t) spare a pass over the data. Units given as None are judged
    by magnitude per ``file_keys``: columns of ``flux`` that tell the files apart, and of ``states``, where they are
    judged before the join. ``missing_wind="zero_cf"`` keeps missing wind apart from calm after its conversion.
    ``check`` ends the job at cells without states, missing and doubled steps. The counts are part of the aggregates and windows
    that interpolate, so nothing runs before the job and nothing is read twice.
    """
    if irradiance_units is None or temperature_units is None:
        if not file_keys:
            raise ValueError("unknown units are judged per file: name the columns in file_keys")
    wanted = select_period(flux, years, months) if years else flux
    around = select_around(states, years, months, pad_hours=pad_hours) if years else states
    names = ["tas", "sfcWind"] if scalar_wind else ["tas", "uas", "vas"]
    if shared_axis:
        table = bracket_table(
            (wanted if flux_axis is None else flux_axis).select("t").distinct(),
            (around if state_axis is None else state_axis).select("t").distinct(),
        )
        found = interpolate_shared_axis(table, around, names, keys, check=check).withColumn("_met", F.lit(True))
        aligned = wanted.join(found, [*keys, "t"], "left")
        if check:
            at = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
            problem = F.when(F.col("_met").isNull(), F.concat(F.lit("no states for "), at))
            aligned = aligned.withColumns({n: fail_if(problem, F.col(n), "double") for n in names})
        aligned = aligned.drop("_met")
    else:
        aligned = interpolate(wanted, around, names, keys, check=check)
    # with zero_wind the conversion turns missing into calm, with zero_cf it stays missing
    calm = missing_wind == "zero_wind"
    aligned = aligned.withColumns({w: U.wind_ms(F.col(w), F.lit(wind_units), calm) for w in names[1:]})
    labelled = aligned.withColumns(
        {"_flux_units": F.lit(irradiance_units).cast("string"), "_tas_units": F.lit(temperature_units).cast("string")}
    )
    if irradiance_units is None:
        flags = irradiance_flags(wanted, "rsds", file_keys)
        ready = convert_irradiance(labelled, "rsds", "_flux_units", file_keys, flags=flags)
    else:
        ready = labelled.withColumn("ghi_kw", U.irradiance_kw(F.col("rsds"), F.col("_flux_units"), F.lit(False)))
    if temperature_units is None:
        judged = around if set(file_keys) <= set(around.columns) else labelled
        ready = convert_temperature(ready, "tas", "_tas_units", file_keys, flags=temperature_flags(judged, "tas", file_keys))
    else:
        ready = ready.withColumn("tas_c", U.temperature_celsius(F.col("tas"), F.col("_tas_units"), F.lit(False)))
    speed = "sfcWind" if scalar_wind else None
    out = add_solar_cf(ready, speed=speed, missing_wind=missing_wind)
    return apply_land_mask(out, mask).drop("ghi_kw", "tas_c", "rsds", "_flux_units", "_tas_units", *names)


def wind(
    u: DataFrame,
    v: DataFrame | None,
    mask: DataFrame,
    knots,
    rated_kw: float,
    years=None,
    months="",
    keys: Sequence[str] = ("cell", "t"),
    wind_units: str = "m s-1",
) -> DataFrame:
    """Wind job: align both components on common keys, or take one scalar speed (``v=None``).

    Both sides are cut to the period before they meet, on partition columns where they have them.
    """
    scalar = v is None
    cut = (lambda df: select_period(df, years, months)) if years else (lambda df: df)
    rows = cut(u) if scalar else align_inner(cut(u), cut(v).select(*keys, "vas"), keys)
    names = ["sfcWind"] if scalar else ["uas", "vas"]
    ready = rows.withColumns({n: U.wind_ms(F.col(n), F.lit(wind_units)) for n in names})
    out = add_wind_cf(ready, knots, rated_kw, speed="sfcWind" if scalar else None)
    return apply_land_mask(out, mask).drop(*names)
