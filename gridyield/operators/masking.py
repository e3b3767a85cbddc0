"""Land mask."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridyield.operators.sizing import broadcast_if_small


def attach_mask(df: DataFrame, mask: DataFrame, on: Sequence[str] = ("cell",)) -> DataFrame:
    """Add ``is_land``: true on land, NULL elsewhere. The mask has at most the size of the lattice; only its land cells travel."""
    land = mask.where("is_land").select(*on, "is_land")
    return df.join(broadcast_if_small(land), list(on), "left")


def apply_land_mask(
    df: DataFrame, mask: DataFrame, values: Sequence[str] = ("cf",), on: Sequence[str] = ("cell",)
) -> DataFrame:
    """Ocean rows stay, their values become NULL. Cells without a mask entry count as ocean."""
    joined = attach_mask(df, mask, on)
    return joined.withColumns({v: F.when(F.col("is_land"), F.col(v)) for v in values}).drop("is_land")


def drop_ocean(df: DataFrame, mask: DataFrame, on: Sequence[str] = ("cell",)) -> DataFrame:
    """Remove ocean rows at ingest."""
    land = mask.where("is_land").select(*on)
    return df.join(broadcast_if_small(land), list(on), "left_semi")


def land_share(mask: DataFrame) -> DataFrame:
    return mask.agg(
        F.avg(F.col("is_land").cast("int")).alias("land_share"), F.count(F.lit(1)).alias("n_cells")
    )
