"""Complete jobs over stored months: what is requested, what is there, what is done already, compute, write.

Which months a table holds comes from a listing of its folders. Months that are missing are skipped and reported; that none of
the requested ones is there is an error. Results that exist stay, unless they are to be overwritten.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridyield import schemas
from gridyield.operators import climate
from gridyield.operators.coverage import missing_months, year_month_spine
from gridyield.plans import annual, reanalysis
from gridyield.sources import sinks, tables


@dataclass(frozen=True)
class Climatology:
    """``compute`` gives cell and value. The texts are fixed values of the result table."""

    var: str
    units: str
    long_name: str
    compute: Callable[[DataFrame], DataFrame]


CLIMATOLOGIES = {
    "wind_speed_100m": Climatology("wind_speed_100m", "m s-1", "Multi-year mean 100m wind speed", climate.mean_hub_wind_speed),
    "sunshine_hours": Climatology("sunshine_hours", "h day-1", "Multi-year mean daily sunshine hours", climate.mean_sunshine_hours),
    "t2m_mean": Climatology("t2m_mean", "degC", "Multi-year mean 2m air temperature", climate.mean_temperature),
}


def covered_months(spark: SparkSession, path: str, years, months="") -> tuple[DataFrame, DataFrame]:
    """(present, missing) of the requested months (year, month) of a table partitioned by them."""
    spine = year_month_spine(spark, years, months)
    there = sinks.existing_partitions(spark, path, ["year", "month"])
    if there is None:
        return spine.limit(0), spine
    present = spine.join(there, ["year", "month"], "left_semi")
    return present, missing_months(spine, there)


def _require_months(present: DataFrame, path: str, years, months) -> None:
    if present.isEmpty():
        raise ValueError(f"{path} holds no month of years={years}, months={months or 'all'}")


def climatology(
    spark: SparkSession, kind: str, weather: str, output: str, years, months="", overwrite: bool = False
) -> DataFrame | None:
    """Multi-year mean of the stored months, written to ``output``; returns the months that were missing, None if it was there already."""
    if not overwrite and sinks.exists(spark, output):
        return None
    present, missing = covered_months(spark, weather, years, months)
    _require_months(present, weather, years, months)
    job = CLIMATOLOGIES[kind]
    means = job.compute(tables.scan(spark, weather, None, years, months))
    about = {"source": weather, "years": str(years), "months": months or "all"}
    sinks.write_climatology(climate.climatology(means, job.var, job.units, job.long_name), output, about)
    return missing


def _upserted(spark: SparkSession, results: tuple[DataFrame, DataFrame], folder: str, keys: Sequence[str], ddls: tuple[str, str], overwrite: bool):
    names, key = ("per_region_annual_cf", "global_annual_cf"), list(keys)
    merged = []
    for name, new, ddl, on in zip(names, results, ddls, ([*key, "region", "year"], [*key, "year"])):
        merged.append(sinks.upsert_csv(spark, f"{folder}/{name}.csv", new, on, ddl, overwrite))
    return tuple(merged)


def annual_means(
    spark: SparkSession, cf: str, mask: DataFrame | None, folder: str, years=None, overwrite: bool = False, **partitions
) -> tuple[DataFrame, DataFrame]:
    """Annual means of regional tables, merged into the two result tables of a folder; returns both.

    ``partitions`` choose energies, models, scenarios and regions. Region-years that are computed again replace their rows.
    """
    rows = tables.scan(spark, cf, None, years, **partitions)
    if rows.isEmpty():
        raise ValueError(f"{cf} holds no rows of years={years or 'all'} and {partitions}")
    results = annual.from_regions(rows, mask)
    return _upserted(spark, results, folder, ["energy", "model", "scenario"], (schemas.ANNUAL_REGION_CF, schemas.ANNUAL_GLOBAL_CF), overwrite)


def annual_means_of_lattice(
    spark: SparkSession, cf: str, cells: DataFrame, folder: str, years=None, use_mask: bool = True, overwrite: bool = False, **partitions
) -> tuple[DataFrame, DataFrame]:
    """As ``annual_means`` for regions snapped to a global table (``annual.region_cells``), in one scan for all regions."""
    rows = tables.scan(spark, cf, None, years, **partitions)
    if rows.isEmpty():
        raise ValueError(f"{cf} holds no rows of years={years or 'all'} and {partitions}")
    results = annual.from_lattice(rows, cells, use_mask=use_mask)
    ddls = (schemas.ANNUAL_REGION_CF_REANALYSIS, schemas.ANNUAL_GLOBAL_CF_REANALYSIS)
    return _upserted(spark, results, folder, ["energy", "source"], ddls, overwrite)


def reanalysis_month(
    spark: SparkSession, weather: str, tails: str, mask: DataFrame, output: str, year: int, month: int, policy: str = "zero",
) -> bool:
    """Solar capacity factors of one stored month and the last steps for the month behind; False if they were there already."""
    wanted = spark.createDataFrame([(year, month)], "year int, month int")
    if sinks.pending_partitions(wanted, output, ["year", "month"]).isEmpty():
        return False
    period = (str(year), str(month))
    present, _ = covered_months(spark, weather, *period)
    _require_months(present, weather, *period)
    months = tables.scan(spark, weather, None, *period)
    sinks.write_month_tails(months, tails)
    before = tables.tails_before(spark, tails, *period)
    cf = reanalysis.solar(months, mask, *period, policy=policy, tails=before)
    sinks.write_cf(cf.withColumns({"year": F.lit(year), "month": F.lit(month)}), output, ["year", "month"])
    return True
