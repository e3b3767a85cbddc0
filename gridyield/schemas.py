"""Table schemas in Spark DDL. NULL = missing, timestamps UTC, values FLOAT, computed values DOUBLE."""

from __future__ import annotations

from pyspark.sql import types as T

_AXES = "cell bigint, lat double, lon double, t timestamp"

WEATHER_COUNTRY = (
    "model string, region string, scenario string, year int, month int, "
    f"{_AXES}, doy int, hour_decimal double, rsds float, tas float, uas float, vas float"
)
WEATHER_CHINA = (
    "model string, region string, scenario string, year int, month int, "
    f"{_AXES}, doy int, hour_decimal double, rsds float, tas float, sfcWind float"
)
WEATHER_REANALYSIS = f"year int, month int, {_AXES}, ssrd float, t2m float, u10 float, v10 float"
WEATHER_ROTATED = (
    "gcm string, realization string, rcm string, scenario string, year int, rlat_i int, rlon_i int, "
    "lat double, lon double, t timestamp, rsds float, tas float, uas float, vas float"
)
UNITS = "path string, var string, units string"
CELLS = "grid string, cell bigint, lat double, lon double, lat_idx int, lon_idx int"
LAND_MASK = "cell bigint, is_land boolean"
POWER_CURVE = "turbine string, ws double, power_w double"
TURBINE = "turbine string, rated_w double"
REGION_GRID = "region string, lat double, lon double, pointwise boolean"
CF = f"energy string, source string, region string, scenario string, year int, month int, {_AXES}, cf float"
MEAN_HOURLY_CF = (
    "energy string, cell bigint, month int, hour_of_month int, hour_of_year int, cf float, n_years bigint"
)
CLIMATOLOGY = "var string, cell bigint, value float, units string, long_name string"
ANNUAL_REGION_CF = (
    "energy string, model string, scenario string, region string, year int, "
    "mean_cf double, n_timesteps bigint, n_land_cells bigint"
)
ANNUAL_REGION_CF_REANALYSIS = (
    "energy string, source string, region string, year int, "
    "mean_cf double, n_timesteps bigint, n_land_cells bigint"
)
ANNUAL_GLOBAL_CF = (
    "energy string, model string, scenario string, year int, "
    "mean_cf double, n_regions bigint, total_land_cells bigint"
)
ANNUAL_GLOBAL_CF_REANALYSIS = (
    "energy string, source string, year int, mean_cf double, n_regions bigint, total_land_cells bigint"
)
MOSAIC = "lat_idx int, lon_idx int, cf float, overlap_count int"
REGION_LOG = (
    "region string, file string, n_time bigint, n_valid bigint, mean_cf double, "
    "lat_min double, lat_max double, lon_min_0360 double, lon_max_0360 double"
)
MONTHLY_MEAN = (
    "year int, month int, wind_cf_global double, wind_cf_land double, "
    "solar_cf_global double, solar_cf_land double"
)

ALL = {
    name: ddl for name, ddl in globals().items() if name.isupper() and isinstance(ddl, str) and not name.startswith("_")
}


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)
