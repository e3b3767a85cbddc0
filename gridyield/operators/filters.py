"""Row selection."""

from __future__ import annotations

import math
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridyield.constants import LATTICE_NLAT, LATTICE_NLON, LATTICE_STEPS_PER_DEGREE
from gridyield.functions.calendar import month_start, parse_months, parse_years
from gridyield.functions.geo import lattice_lat
from gridyield.operators.sizing import broadcast_if_small


def select_period(df: DataFrame, years, months="", t: str = "t", require_rows: bool = False) -> DataFrame:
    """Inclusive year range and month set.

    Tables partitioned by ``year``/``month`` are filtered on those columns, which prunes files.
    """
    first, last = parse_years(years)
    chosen = parse_months(months)
    year = F.col("year") if "year" in df.columns else F.year(t)
    month = F.col("month") if "month" in df.columns else F.month(t)
    out = df.where(year.between(first, last))
    if len(chosen) < 12:
        out = out.where(month.isin(chosen))
    if require_rows and out.isEmpty():
        raise ValueError(f"no time step matches years={years}, months={months or 'all'}")
    return out


def select_around(df: DataFrame, years, months="", t: str = "t", pad_hours: int = 24) -> DataFrame:
    """Rows of the period and those up to ``pad_hours`` before and after each of its months.

    Tables partitioned by ``year``/``month`` are cut to the months and their neighbours first, which prunes files.
    """
    first, last = parse_years(years)
    wanted = [12 * y + m for y in range(first, last + 1) for m in parse_months(months)]
    number = lambda c: F.year(c) * 12 + F.month(c)
    pad = F.expr(f"interval {int(pad_hours)} hours")
    out = df
    if {"year", "month"} <= set(df.columns):
        near = sorted({n + d for n in wanted for d in (-1, 0, 1)})
        out = out.where((F.col("year") * 12 + F.col("month")).isin(near))
    if dict(df.dtypes)[t] not in ("timestamp", "timestamp_ntz", "date"):
        return out
    return out.where(number(F.col(t)).isin(wanted) | number(F.col(t) + pad).isin(wanted) | number(F.col(t) - pad).isin(wanted))


def split_names(values: str | Iterable[str] | None) -> list[str]:
    """Comma lists and plain lists of names, also mixed."""
    if not values:
        return []
    items = [values] if isinstance(values, str) else list(values)
    return [part.strip() for item in items for part in item.split(",") if part.strip()]


def select_regions(df: DataFrame, include=None, exclude=None, region: str = "region") -> DataFrame:
    kept, dropped = split_names(include), split_names(exclude)
    out = df
    if kept:
        out = out.where(F.col(region).isin(kept))
    if dropped:
        out = out.where(~F.col(region).isin(dropped))
    return out


def mask_zero(df: DataFrame, value: str = "cf", threshold: float | None = 1e-6) -> DataFrame:
    """Values at or below the threshold become NULL; a negative or missing threshold switches it off."""
    if threshold is None or threshold < 0:
        return df
    return df.withColumn(value, F.when(F.col(value) > F.lit(float(threshold)), F.col(value)))


def first_steps(df: DataFrame, n: int, t: str = "t") -> DataFrame:
    """Rows of the first ``n`` time steps of the shared axis."""
    axis = df.select(t).distinct().orderBy(t).limit(n)
    return df.join(broadcast_if_small(axis), t, "left_semi")


def step_index(df: DataFrame, t: str = "t") -> DataFrame:
    """Table (t, step): zero-based position of every distinct time on the shared axis.

    Ranked within months; the offsets come from one row per month, so no task sees the whole axis.
    """
    axis = df.select(t).distinct().withColumn("_month", month_start(F.col(t)))
    before = W.orderBy("_month").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        axis.groupBy("_month")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_month", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    rank = F.row_number().over(W.partitionBy("_month").orderBy(t)) - 1
    return (
        axis.withColumn("_rank", rank)
        .join(broadcast_if_small(offsets), "_month")
        .select(t, (F.col("_offset") + F.col("_rank")).alias("step"))
    )


def with_step(df: DataFrame, t: str = "t", axis: DataFrame | None = None) -> DataFrame:
    return df.join(broadcast_if_small(step_index(df, t) if axis is None else axis), t)


def on_phase(step: Column, offset: int, every: int = 3) -> Column:
    """Every k-th step starting at an offset."""
    return (step >= F.lit(offset)) & (F.pmod(step - F.lit(offset), F.lit(every)) == 0)


def _plot_row_col(df: DataFrame) -> DataFrame:
    """Row and column of the map recentred on longitude 0."""
    half = LATTICE_NLON // 2
    return df.withColumns({"row": F.col("lat_idx"), "col": F.pmod(F.col("lon_idx") + half, F.lit(LATTICE_NLON))})


def valid_extent(mosaic: DataFrame, value: str = "cf", pad_degrees: float = 2.0, extent: str = "data") -> DataFrame:
    """One row: index box of the valid cells after recentring, padded, and its coordinates."""
    pad = int(math.ceil(pad_degrees * LATTICE_STEPS_PER_DEGREE))
    last_row, last_col = LATTICE_NLAT - 1, LATTICE_NLON - 1
    valid = _plot_row_col(mosaic).where(F.col(value).isNotNull())
    if extent == "world":
        valid = valid.where(F.lit(False))
    box = valid.agg(
        F.greatest(F.min("row") - pad, F.lit(0)).alias("r0"),
        F.least(F.max("row") + pad, F.lit(last_row)).alias("r1"),
        F.greatest(F.min("col") - pad, F.lit(0)).alias("c0"),
        F.least(F.max("col") + pad, F.lit(last_col)).alias("c1"),
        F.count(F.lit(1)).alias("_n"),
    )
    whole = F.col("_n") == 0
    edges = box.select(
        *[
            F.when(whole, F.lit(edge)).otherwise(F.col(name)).alias(name)
            for name, edge in [("r0", 0), ("r1", last_row), ("c0", 0), ("c1", last_col)]
        ],
        whole.alias("_whole"),
    )
    lon = lambda c: F.col(c) / F.lit(float(LATTICE_STEPS_PER_DEGREE)) - F.lit(180.0)
    return edges.select(
        "r0",
        "r1",
        "c0",
        "c1",
        lon("c0").alias("lon_min"),
        F.when(F.col("_whole"), F.lit(180.0)).otherwise(lon("c1")).alias("lon_max"),
        lattice_lat(F.col("r1")).alias("lat_min"),
        lattice_lat(F.col("r0")).alias("lat_max"),
    )


def crop_to_valid(mosaic: DataFrame, value: str = "cf", pad_degrees: float = 2.0, extent: str = "data") -> DataFrame:
    """Rows of the mosaic inside the padded box of its valid cells.

    The box is a scalar subquery of one row: nothing runs while the plan is built. Pass a stored mosaic, which is
    then read twice instead of computed twice.
    """
    edges = valid_extent(mosaic, value, pad_degrees, extent)
    box = edges.select(F.struct("r0", "r1", "c0", "c1")).scalar()
    return _plot_row_col(mosaic).where(
        F.col("lat_idx").between(box["r0"], box["r1"]) & F.col("col").between(box["c0"], box["c1"])
    )


def block_means(
    df: DataFrame, values: Sequence[str], keys: Sequence[str] = ("cell",), step: str = "step", size: int = 3
) -> DataFrame:
    """Means over consecutive blocks of steps; incomplete blocks are dropped, a missing value spoils its mean."""
    block = F.floor(F.col(step) / F.lit(size)).alias("block")
    means = {
        v: F.when(F.count(v) == size, F.avg(v)).alias(v) for v in values
    }
    return (
        df.groupBy(*keys, block)
        .agg(F.count(F.lit(1)).alias("_n"), *means.values())
        .where(F.col("_n") == size)
        .drop("_n")
    )
