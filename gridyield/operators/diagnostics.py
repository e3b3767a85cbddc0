"""Statistics of runs, regions and weather."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridyield.functions import wind
from gridyield.functions.calendar import day_of_year, hour_decimal
from gridyield.functions.geo import lon_0360
from gridyield.operators.filters import block_means, on_phase, with_step
from gridyield.operators.masking import attach_mask
from gridyield.operators.photovoltaic import add_solar_cf
from gridyield.operators.regions import cell_means_and_steps
from gridyield.operators.windpower import add_wind_cf


def cf_statistics(df: DataFrame, value: str = "cf", keys: Sequence[str] = ()) -> DataFrame:
    """Mean, maximum, share of positive values and mean of the positive ones."""
    cf = F.col(value)
    return df.groupBy(*keys).agg(
        F.count(cf).alias("n_values"),
        F.avg(cf).alias("mean_cf"),
        F.max(cf).alias("max_cf"),
        F.try_divide(F.count_if(cf > 0), F.count(cf)).alias("share_positive"),
        F.avg(F.when(cf > 0, cf)).alias("mean_positive"),
    )


def region_log(
    df: DataFrame, keys: Sequence[str] = ("region",), value: str = "cf", t: str = "t", cell_keys=("lat", "lon")
) -> DataFrame:
    """Per region: time steps, valid cells, mean of cell means and bounding box, all from one scan."""
    keys = list(keys)
    cells = cell_means_and_steps(df, keys, cell_keys, value, t)
    lon = lon_0360(F.col("lon"))
    return cells.groupBy(*keys).agg(
        F.count_if("_step").alias("n_time"),
        F.count(value).alias("n_valid"),
        F.avg(value).alias("mean_cf"),
        F.min("lat").alias("lat_min"),
        F.max("lat").alias("lat_max"),
        F.min(lon).alias("lon_min_0360"),
        F.max(lon).alias("lon_max_0360"),
    )


def formatted_region_log(log: DataFrame) -> DataFrame:
    """Text columns of the log file: mean with eight digits, coordinates with four."""
    coordinates = ("lat_min", "lat_max", "lon_min_0360", "lon_max_0360")
    return log.withColumns(
        {"mean_cf": F.format_string("%.8f", "mean_cf")}
        | {c: F.format_string("%.4f", F.col(c).cast("double")) for c in coordinates}
    )


def weather_statistics(
    df: DataFrame, mask: DataFrame, keys: Sequence[str] = ("country",), u="uas", v="vas", rsds="rsds"
) -> DataFrame:
    """Per country over land: wind speed and irradiance, and the share of land cells.

    Rows are reduced per cell first; the mask meets cells only.
    """
    keys = list(keys)
    ws = wind.speed(F.col(u), F.col(v))
    cells = df.groupBy(*keys, "cell").agg(
        F.sum(ws).alias("_ws"), F.count(ws).alias("_nws"), F.max(ws).alias("_mws"),
        F.sum(rsds).alias("_rs"), F.count(rsds).alias("_nrs"), F.max(rsds).alias("_mrs"),
    )
    land = F.coalesce(F.col("is_land"), F.lit(False))

    def over(c):
        return F.when(land, F.col(c))

    return attach_mask(cells, mask).groupBy(*keys).agg(
        F.avg(land.cast("int")).alias("land_share"),
        F.try_divide(F.sum(over("_ws")), F.sum(over("_nws"))).alias("mean_wind_speed"),
        F.max(over("_mws")).alias("max_wind_speed"),
        F.try_divide(F.sum(over("_rs")), F.sum(over("_nrs"))).alias("mean_rsds"),
        F.max(over("_mrs")).alias("max_rsds"),
    )


def resolution_experiment(
    df: DataFrame,
    mask: DataFrame,
    knots,
    rated_kw: float,
    t: str = "t",
    every: int = 3,
    axis: DataFrame | None = None,
) -> DataFrame:
    """Regional solar and wind means at full resolution, at each phase of a coarser sampling, and of blocks.

    ``df`` has cell, lat, lon, t, ghi_kw, tas_c, u, v. Full resolution and all phases come out of one
    aggregation with conditional means per cell; only the block means need a second branch, because
    they average the weather before the kernels.
    """
    stepped = with_step(df, t, axis).withColumns({"doy": day_of_year(F.col(t)), "hour": hour_decimal(F.col(t))})

    def factors(rows, whole_days):
        with_solar = add_solar_cf(rows, u="u", v="v", doy="doy", hour="hour", output="solar", whole_days=whole_days)
        return add_wind_cf(with_solar, knots, rated_kw, "u", "v", output="wind")

    names = ["hourly", *[f"phase_{k}" for k in range(every)]]
    full = factors(stepped, True)
    conditions = [F.lit(True), *[on_phase(F.col("step"), k, every) for k in range(every)]]
    per_cell = full.groupBy("cell").agg(
        *[
            F.avg(F.when(condition, F.col(energy))).alias(f"{energy}_{name}")
            for name, condition in zip(names, conditions)
            for energy in ("solar", "wind")
        ]
    )
    variants = F.array(
        *[
            F.struct(
                F.lit(name).alias("variant"),
                F.col(f"solar_{name}").alias("solar"),
                F.col(f"wind_{name}").alias("wind"),
            )
            for name in names
        ]
    )
    sampled = per_cell.select("cell", F.explode(variants).alias("x")).select("cell", "x.*")
    blocks = block_means(stepped, ["ghi_kw", "tas_c", "u", "v", "doy", "hour"], ["cell", "lat", "lon"], size=every)
    averaged = (
        factors(blocks, False)
        .groupBy("cell")
        .agg(F.avg("solar").alias("solar"), F.avg("wind").alias("wind"))
        .select("cell", F.lit("block_mean").alias("variant"), "solar", "wind")
    )
    masked = attach_mask(sampled.unionByName(averaged), mask)
    land = F.col("is_land")
    return masked.groupBy("variant").agg(
        F.avg(F.when(land, F.col("solar"))).alias("solar_cf"), F.avg(F.when(land, F.col("wind"))).alias("wind_cf")
    )
