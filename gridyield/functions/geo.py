"""Coordinates and the 0.1 degree lattice."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridyield.constants import (
    LATTICE_NLAT,
    LATTICE_NLON,
    LATTICE_STEPS_PER_DEGREE,
    LATTICE_TOLERANCE,
)
from gridyield.functions.nulls import clip

_N = float(LATTICE_STEPS_PER_DEGREE)


def lon_180(lon: Column) -> Column:
    """Longitude to [-180, 180)."""
    return F.pmod(lon + F.lit(180.0), F.lit(360.0)) - F.lit(180.0)


def lon_0360(lon: Column) -> Column:
    """Longitude to [0, 360); values that are 360 up to rounding become 0."""
    wrapped = F.pmod(lon, F.lit(360.0))
    # relative 1e-5 plus absolute 1e-8, the usual closeness test
    return F.when(F.abs(wrapped - F.lit(360.0)) <= F.lit(1e-8 + 1e-5 * 360.0), F.lit(0.0)).otherwise(wrapped)


def lat_clipped(lat: Column) -> Column:
    return clip(lat, -90.0, 90.0)


def lattice_lat(lat_idx: Column) -> Column:
    return (F.lit(90 * LATTICE_STEPS_PER_DEGREE) - lat_idx) / F.lit(_N)


def lattice_lon(lon_idx: Column) -> Column:
    return lon_idx / F.lit(_N)


def lattice_lat_idx(lat: Column) -> Column:
    """Exact lattice row; coordinates are lattice centres up to a tolerance."""
    return F.rint((F.lit(90.0) - lat) / F.lit(1.0 / _N)).cast("int")


def lattice_lon_idx(lon: Column) -> Column:
    """Exact lattice column, cyclic."""
    return F.pmod(F.rint(lon_0360(lon) / F.lit(1.0 / _N)), F.lit(float(LATTICE_NLON))).cast("int")


def on_lattice(lat: Column, lon: Column, lat_idx: Column, lon_idx: Column) -> Column:
    """True when the coordinate is the centre of that lattice cell within the tolerance."""
    lon_gap = F.abs(lon_180(lattice_lon(lon_idx) - lon_0360(lon)))
    return (
        lat_idx.between(0, LATTICE_NLAT - 1)
        & (F.abs(lattice_lat(lat_idx) - lat) <= F.lit(LATTICE_TOLERANCE))
        & (lon_gap <= F.lit(LATTICE_TOLERANCE))
    )


def _nearest_step(value: Column) -> Column:
    """Nearest multiple of the lattice step as an integer; on a tie the smaller value."""
    below = F.floor(value * F.lit(_N))
    to_below = F.abs(value - below / F.lit(_N))
    to_above = F.abs(value - (below + F.lit(1)) / F.lit(_N))
    return F.when(to_below <= to_above, below).otherwise(below + F.lit(1))


def nearest_lat_idx(lat: Column) -> Column:
    """Nearest lattice row of any latitude."""
    step = _nearest_step(lat)
    limit = 90 * LATTICE_STEPS_PER_DEGREE
    bounded = F.greatest(F.least(step, F.lit(limit)), F.lit(-limit))
    return F.when(lat.isNotNull(), (F.lit(limit) - bounded).cast("int"))


def nearest_lon_idx(lon: Column, cyclic: bool = False) -> Column:
    """Nearest lattice column. Not cyclic by default: 359.97 snaps to 359.9, not to 0."""
    wrapped = F.pmod(lon, F.lit(360.0))
    step = _nearest_step(wrapped)
    if cyclic:
        return F.pmod(step, F.lit(LATTICE_NLON)).cast("int")
    return F.when(lon.isNotNull(), F.least(step, F.lit(LATTICE_NLON - 1)).cast("int"))
