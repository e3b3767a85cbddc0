"""Annual map on the lattice from overlapping regions."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridyield.operators.filters import crop_to_valid, mask_zero
from gridyield.operators.mosaic import mosaic
from gridyield.operators.snapping import add_lattice_index


def region_order(cf: DataFrame, regions: Sequence[str] | None = None) -> DataFrame:
    """Add ``ord``: position in the given list, else the region name itself (alphabetical)."""
    if not regions:
        return cf.withColumn("ord", F.col("region"))
    position = F.array_position(F.lit(list(regions)), F.col("region"))
    return cf.withColumn("ord", position).where(F.col("ord") > 0)


def annual_map(
    cf: DataFrame, year: int, policy: str = "mean", regions: Sequence[str] | None = None, t: str = "t"
) -> DataFrame:
    """Yearly mean per region cell, placed on the lattice and merged."""
    of_year = cf.where((F.col("year") if "year" in cf.columns else F.year(t)) == year)
    ordered = region_order(of_year, regions)
    means = ordered.groupBy("region", "ord", "lat", "lon").agg(F.avg("cf").alias("cf"))
    return mosaic(add_lattice_index(means), policy)


def plot_table(
    merged: DataFrame, zero_threshold: float | None = 1e-6, extent: str = "world", pad_degrees: float = 2.0
) -> DataFrame:
    """Cells to draw: cropped to the valid ones, zeros left out."""
    return mask_zero(crop_to_valid(merged, pad_degrees=pad_degrees, extent=extent), threshold=zero_threshold)
