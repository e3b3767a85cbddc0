"""Annual regional and global means, from regional tables or from the global lattice."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridyield.functions.geo import lat_clipped, lon_180
from gridyield.operators.filters import select_period, select_regions
from gridyield.operators.regions import global_weighted_mean, region_annual_mean, region_annual_mean_snapped
from gridyield.operators.snapping import snap_to_lattice


def from_regions(
    cf: DataFrame, mask: DataFrame | None, keys: Sequence[str] = ("energy", "model", "scenario"), years=None,
    timesteps: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    rows = select_period(cf, years) if years else cf
    regional = region_annual_mean(rows, mask, [*keys, "region"], timesteps=timesteps)
    return regional, global_weighted_mean(regional, [*keys, "year"])


def region_cells(grid: DataFrame, land: DataFrame | None, include=None, exclude=None) -> DataFrame:
    """Region cells with their lattice cell; ``land`` (lat, lon, is_land) is looked up at the region's own coordinates.

    Both sides are brought to one convention of longitudes and joined on whole thousandths of a degree. Region cells
    without a row in the mask are an error, because they would silently count as ocean.
    """
    chosen = select_regions(grid, include, exclude)
    snapped = snap_to_lattice(chosen)
    if land is None:
        return snapped.withColumn("is_land", F.lit(True))
    keys = {"_lat": F.round(lat_clipped(F.col("lat")) * 1000).cast("int"), "_lon": F.round(lon_180(F.col("lon")) * 1000).cast("int")}
    there = land.withColumns(keys).groupBy("_lat", "_lon").agg(F.max("is_land").alias("is_land"))
    found = snapped.withColumns(keys).join(there, ["_lat", "_lon"], "left").drop("_lat", "_lon")
    lost = found.where(F.col("is_land").isNull()).head(5)
    if lost:
        raise ValueError(f"region cells without a row in the land mask, for instance {lost}")
    return found


def from_lattice(
    cf: DataFrame, cells: DataFrame, keys: Sequence[str] = ("energy", "source"), years=None, use_mask: bool = True,
    timesteps: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    rows = select_period(cf, years) if years else cf
    regional = region_annual_mean_snapped(rows, cells, keys, use_mask=use_mask, timesteps=timesteps)
    return regional, global_weighted_mean(regional, [*keys, "year"])
