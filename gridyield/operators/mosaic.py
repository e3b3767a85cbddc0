"""Overlapping regions on one lattice."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

POLICIES = ("mean", "first", "last", "max")


def mosaic(df: DataFrame, policy: str = "mean", value: str = "cf", order: str = "ord") -> DataFrame:
    """One value per lattice cell from the region values that cover it.

    ``order`` is the position of the region in the list. All policies are partial aggregates, so
    heavily covered cells are reduced before the shuffle. Only ``mean`` counts the overlap. With an
    ``on_lattice`` column the job fails on coordinates that are no lattice centres; the test sits on the
    aggregate, because a filter would be pushed down to every time step.
    """
    rule = {
        "mean": F.avg(value),
        "first": F.min_by(value, order),
        "last": F.max_by(value, order),
        "max": F.max(value),
    }
    if policy not in rule:
        raise ValueError(f"policy must be one of {POLICIES}: {policy!r}")
    overlap = F.count(F.lit(1)) if policy == "mean" else F.lit(1)
    checked = "on_lattice" in df.columns
    centred = F.every(F.coalesce("on_lattice", F.lit(False))) if checked else F.lit(True)
    merged = (
        df.where(F.col(value).isNotNull())
        .groupBy("lat_idx", "lon_idx")
        .agg(rule[policy].alias(value), overlap.cast("int").alias("overlap_count"), centred.alias("_centred"))
    )
    if checked:
        problem = F.raise_error(F.concat(F.lit("coordinates are no lattice centres near row "), F.col("lat_idx")))
        merged = merged.withColumn(value, F.when(F.col("_centred"), F.col(value)).otherwise(problem.cast("double")))
    return merged.drop("_centred")


def mosaic_totals(merged: DataFrame) -> DataFrame:
    return merged.agg(
        F.count_if(F.col("overlap_count") > 0).alias("filled_cells"),
        F.count_if(F.col("overlap_count") > 1).alias("overlap_cells"),
        F.coalesce(F.max("overlap_count"), F.lit(0)).alias("max_overlap"),
    )
