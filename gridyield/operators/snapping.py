"""Regions and points on the global lattice."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridyield.functions import geo
from gridyield.operators.neighbours import bracket
from gridyield.operators.sizing import broadcast_if_small


def region_grid(df: DataFrame, region: str = "region") -> DataFrame:
    """Coordinates per region, without data and time."""
    return df.select(region, "lat", "lon").distinct()


def add_lattice_index(df: DataFrame) -> DataFrame:
    """Exact lattice index of centre coordinates, with ``on_lattice`` telling whether they are centres."""
    return df.withColumns(
        {"lat_idx": geo.lattice_lat_idx(F.col("lat")), "lon_idx": geo.lattice_lon_idx(F.col("lon"))}
    ).withColumn(
        "on_lattice", geo.on_lattice(F.col("lat"), F.col("lon"), F.col("lat_idx"), F.col("lon_idx"))
    )


def snap_to_lattice(df: DataFrame, cyclic: bool = False) -> DataFrame:
    """Nearest lattice cell per row.

    Latitude and longitude are snapped independently, so this serves regular regions (whose rows are
    the product of two axes) and curvilinear points alike. The row's own coordinates stay: the land
    mask is looked up there, the value at the snapped cell.
    """
    return df.withColumns(
        {
            "gi_lat": geo.nearest_lat_idx(F.col("lat")),
            "gi_lon": geo.nearest_lon_idx(F.col("lon"), cyclic),
        }
    )


def stretch_of(value: Column, borders: Sequence[float]) -> Column:
    """Number of the stretch between sorted borders that a value falls into, as a balanced tree of comparisons."""
    edges = sorted(set(borders))

    def tree(first: int, last: int) -> Column:
        if first == last:
            return F.lit(first)
        middle = (first + last) // 2
        return F.when(value < F.lit(edges[middle]), tree(first, middle)).otherwise(tree(middle + 1, last))

    return tree(0, len(edges))


def snap_to_axis(
    df: DataFrame, column: str, axis: DataFrame, axis_value: str, carry: Sequence[str], chunk_width: float | None = None,
    chunks: int = 256,
) -> DataFrame:
    """Nearest value of an irregular axis per row, on a tie the smaller one; adds ``carry`` of that axis row.

    Only the distinct values are looked up, with the neighbour search over chunks of the value range: ``chunks`` stretches with about as
    many values each, however unevenly they lie (one pass for the borders, when the plan is built), or stretches of ``chunk_width``.
    """
    wanted = df.select(F.lit(0).alias("_axis"), F.col(column).cast("double").alias("_v")).where(
        F.col("_v").isNotNull()
    ).distinct()
    known = axis.select(F.lit(0).alias("_axis"), F.col(axis_value).cast("double").alias("_v"), *carry)
    if chunk_width is None:
        both = wanted.select("_v").unionByName(known.select("_v"))
        chunk = stretch_of(F.col("_v"), both.approxQuantile("_v", [k / chunks for k in range(1, chunks)], 1 / (8 * chunks)))
    else:
        chunk = F.floor(F.col("_v") / F.lit(float(chunk_width)))
    found = bracket(wanted, known, ["_axis"], "_v", list(carry), chunk)
    to_left, to_right = F.abs(F.col("_v") - F.col("left._v")), F.abs(F.col("right._v") - F.col("_v"))
    take_left = F.col("right").isNull() | (F.col("left").isNotNull() & (to_left <= to_right))
    chosen = F.when(take_left, F.col("left")).otherwise(F.col("right"))
    lookup = found.select(
        F.col("_v").alias("_key"),
        *[chosen.getField(c).alias(c) for c in carry],
    )
    return df.join(broadcast_if_small(lookup), F.col(column).cast("double") == F.col("_key"), "left").drop("_key")
