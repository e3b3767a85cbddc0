"""Annual means of regions and of the globe."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridyield.operators.masking import attach_mask
from gridyield.operators.sizing import broadcast_if_small


def _dated(df: DataFrame, t: str) -> DataFrame:
    return df if "year" in df.columns else df.withColumn("year", F.year(t))


def cell_year_mean(
    df: DataFrame, keys: Sequence[str] = ("region",), value: str = "cf", cell: str = "cell", t: str = "t"
) -> DataFrame:
    """Mean over the time steps of a year per cell."""
    return _dated(df, t).groupBy(*keys, "year", cell).agg(F.avg(value).alias(value))


def timestep_counts(df: DataFrame, keys: Sequence[str], t: str = "t") -> DataFrame:
    """Distinct time steps per key. Reads the axis columns only."""
    return (
        _dated(df, t).select(*keys, "year", t).distinct()
        .groupBy(*keys, "year").agg(F.count(F.lit(1)).alias("n_timesteps"))
    )


def cell_means_and_steps(
    df: DataFrame, keys: Sequence[str], cells: Sequence[str], value: str, t: str
) -> DataFrame:
    """Means per (keys, cells) and the time steps per keys from one scan: keys, cells, value, ``_step``.

    Two grouping sets of one aggregate. Rows with ``_step`` stand for one time step each and have no cell; the others are cell means.
    """
    sets = [[*keys, *cells], [*keys, t]]
    grouped = df.groupingSets([[F.col(c) for c in one] for one in sets], *keys, *cells, t)
    # grouping(t) is 0 in the set that has t
    return grouped.agg(F.avg(value).alias("_mean"), (F.grouping(t) == 0).alias("_step")).select(
        *keys, *cells, F.when(~F.col("_step"), F.col("_mean")).alias(value), "_step"
    )


def region_annual_mean(
    df: DataFrame,
    mask: DataFrame | None = None,
    keys: Sequence[str] = ("energy", "region"),
    value: str = "cf",
    cell: str = "cell",
    t: str = "t",
    timesteps: DataFrame | None = None,
) -> DataFrame:
    """Two-stage mean: over the year per cell, then unweighted over the land cells of the region.

    Both stages merge partial sums map-side, so a region with most of the rows is no hot spot. The
    mask meets cell means, not time steps. Time steps are counted in the same scan unless ``timesteps`` gives them. Region-years without a valid cell stay, with a NULL mean.
    """
    keys = list(keys)
    if timesteps is None:
        cells = cell_means_and_steps(_dated(df, t), [*keys, "year"], [cell], value, t)
    else:
        cells = cell_year_mean(df, keys, value, cell, t).withColumn("_step", F.lit(False))
    if mask is not None:
        cells = attach_mask(cells, mask, [cell]).withColumn(value, F.when(F.col("is_land"), F.col(value)))
    means = cells.groupBy(*keys, "year").agg(
        F.avg(value).alias("mean_cf"), F.count_if("_step").alias("n_timesteps"), F.count(value).alias("n_land_cells")
    )
    if timesteps is not None:
        means = means.drop("n_timesteps").join(timesteps, [*keys, "year"])
    return means.select(*keys, "year", "mean_cf", "n_timesteps", "n_land_cells")


def snapped_cell_means(
    global_cf: DataFrame,
    region_cells: DataFrame,
    keys: Sequence[str] = ("energy",),
    value: str = "cf",
    t: str = "t",
) -> DataFrame:
    """Yearly mean of the lattice cell behind every region cell: (keys, year, region, cell row, value).

    The global table is reduced to one row per lattice cell and year before it meets the regions, in
    one scan that serves all of them; a lattice cell behind several region cells counts several times.
    """
    yearly = _dated(global_cf, t).join(broadcast_if_small(_lattice_cells(region_cells)), ["lat_idx", "lon_idx"], "left_semi")
    yearly = yearly.groupBy(*keys, "year", "lat_idx", "lon_idx").agg(F.avg(value).alias(value))
    cells = region_cells.withColumnsRenamed({"gi_lat": "lat_idx", "gi_lon": "lon_idx"})
    return cells.join(yearly, ["lat_idx", "lon_idx"])


def _lattice_cells(region_cells: DataFrame) -> DataFrame:
    return region_cells.select(F.col("gi_lat").alias("lat_idx"), F.col("gi_lon").alias("lon_idx")).distinct()


def region_annual_mean_snapped(
    global_cf: DataFrame,
    region_cells: DataFrame,
    keys: Sequence[str] = ("energy",),
    value: str = "cf",
    t: str = "t",
    use_mask: bool = True,
    timesteps: DataFrame | None = None,
) -> DataFrame:
    """Annual regional means from a global lattice table.

    ``region_cells`` holds one row per region cell: region, snapped ``gi_lat``/``gi_lon`` and
    ``is_land`` at the cell's own coordinates. Every region of the table gets a row per year.
    """
    keys = list(keys)
    kept = F.when(F.col("is_land"), F.col(value)) if use_mask else F.col(value)
    if timesteps is None:
        # One scan: lattice cells that no region needs keep their time steps only.
        needed = _lattice_cells(region_cells).withColumn("_needed", F.lit(True))
        dated = _dated(global_cf, t).join(broadcast_if_small(needed), ["lat_idx", "lon_idx"], "left")
        dated = dated.withColumns({c: F.when(F.col("_needed"), F.col(c)) for c in ("lat_idx", "lon_idx", value)})
        yearly = cell_means_and_steps(dated, [*keys, "year"], ["lat_idx", "lon_idx"], value, t)
        # Steps and the cells of a year come together; a year's cells travel as one row each, its steps as one number.
        cells = region_cells.withColumnsRenamed({"gi_lat": "lat_idx", "gi_lon": "lon_idx"})
        met = yearly.join(cells, ["lat_idx", "lon_idx"], "left")
        per_region = met.groupBy(*keys, "year", "region").agg(
            F.avg(kept).alias("mean_cf"), F.count(kept).alias("n_land_cells"), F.count_if("_step").alias("_steps")
        )
        # The group without a region holds the steps; it hands them to the regions of its year, whose number the result has anyway.
        found = F.collect_list(F.when(F.col("region").isNotNull(), F.struct("region", "mean_cf", "n_land_cells")))
        years = per_region.groupBy(*keys, "year").agg(F.max("_steps").alias("n_timesteps"), found.alias("_found"))
        frame = region_cells.select("region").distinct().groupBy().agg(F.collect_set("region").alias("_regions"))
        kind = dict(region_cells.dtypes)["region"]
        by_region = F.map_from_entries(F.transform("_found", lambda x: F.struct(x["region"], x)))
        spine = years.withColumn("_by", by_region).withColumn("region", F.explode(frame.select("_regions").scalar().cast(f"array<{kind}>")))
        mine = F.try_element_at("_by", F.col("region"))
        return spine.select(
            *keys, "region", "year", mine["mean_cf"].alias("mean_cf"), "n_timesteps", F.coalesce(mine["n_land_cells"], F.lit(0)).alias("n_land_cells")
        )
    cells = snapped_cell_means(global_cf, region_cells, keys, value, t)
    means = cells.groupBy(*keys, "region", "year").agg(
        F.avg(kept).alias("mean_cf"), F.count(kept).alias("n_land_cells")
    )
    regions = region_cells.select("region").distinct()
    # regions x years is the shape of the result: both sides are the result's own axes
    frame = regions.groupBy().agg(F.collect_set("region").alias("_regions"))
    spine = timesteps.withColumn("region", F.explode(frame.select("_regions").scalar()))
    return (
        spine.join(means, [*keys, "region", "year"], "left")
        .select(
            *keys, "region", "year", "mean_cf", "n_timesteps",
            F.coalesce("n_land_cells", F.lit(0)).alias("n_land_cells"),
        )
    )


def global_weighted_mean(region_year: DataFrame, keys: Sequence[str] = ("energy", "year")) -> DataFrame:
    """Mean over regions weighted with their cell numbers."""
    n = F.col("n_land_cells")
    return (
        region_year.where(F.col("mean_cf").isNotNull() & (n > 0))
        .groupBy(*keys)
        .agg(
            (F.sum(F.col("mean_cf") * n) / F.sum(n)).alias("mean_cf"),
            F.count(F.lit(1)).alias("n_regions"),
            F.sum(n).alias("total_land_cells"),
        )
    )


def global_mean_excluding(
    region_year: DataFrame, exclude: Sequence[str], keys: Sequence[str] = ("energy", "year")
) -> DataFrame:
    """Weighted mean with and without some regions, in one pass; years with excluded regions only go."""
    n = F.col("n_land_cells")
    kept = ~F.col("region").isin(list(exclude))
    weighted = F.col("mean_cf") * n
    return (
        region_year.where(F.col("mean_cf").isNotNull() & (n > 0))
        .groupBy(*keys)
        .agg(
            (F.sum(weighted) / F.sum(n)).alias("mean_cf_all"),
            F.try_divide(F.sum(F.when(kept, weighted)), F.sum(F.when(kept, n))).alias("mean_cf_kept"),
            F.sum(F.when(kept, n)).alias("kept_land_cells"),
        )
        .where(F.col("kept_land_cells").isNotNull())
    )


def dataset_ratio(
    left: DataFrame, right: DataFrame, on: Sequence[str] = ("energy", "year"), value: str = "mean_cf"
) -> DataFrame:
    """Value of one dataset next to another, with the ratio where the other is positive."""
    a = left.select(*on, F.col(value).alias("value"))
    b = right.select(*on, F.col(value).alias("other"))
    return a.join(b, list(on), "left").withColumn(
        "ratio", F.when(F.col("other") > 0, F.col("value") / F.col("other"))
    )


def global_and_land_means(
    df: DataFrame, mask: DataFrame, value: str = "cf", keys: Sequence[str] = ("energy",), t: str = "t"
) -> DataFrame:
    """Means over all cells and over land cells per month, in one pass.

    Values are reduced per cell and month first, so that the mask meets one row per cell and month.
    """
    per_cell = (
        df.withColumns({"year": F.year(t), "month": F.month(t)})
        .groupBy(*keys, "year", "month", "cell")
        .agg(F.sum(value).alias("_s"), F.count(value).alias("_n"))
    )
    land = F.coalesce(F.col("is_land"), F.lit(False))
    return (
        attach_mask(per_cell, mask)
        .groupBy(*keys, "year", "month")
        .agg(
            F.try_divide(F.sum("_s"), F.sum("_n")).alias("mean_global"),
            F.try_divide(F.sum(F.when(land, F.col("_s"))), F.sum(F.when(land, F.col("_n")))).alias("mean_land"),
        )
    )


def monthly_means(wind: DataFrame, solar: DataFrame, mask: DataFrame, value: str = "cf", t: str = "t") -> DataFrame:
    """Wind and solar, global and land means per month side by side."""
    def side(df, name):
        means = global_and_land_means(df, mask, value, (), t)
        return means.withColumnsRenamed({"mean_global": f"{name}_cf_global", "mean_land": f"{name}_cf_land"})

    return side(wind, "wind").join(side(solar, "solar"), ["year", "month"])
