"""Tables that are written and read back: choices from the catalog, footers, buckets."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridyield.checks.cases_time import SHARED_AXIS_SQL, profile_sql
from gridyield.checks.registry import case
from gridyield.operators import alignment, climate, increments, interpolation
from gridyield.session import shared_path
from gridyield.sources import bucketed, catalog, footers, sinks, tables, versions

BUCKETS = 8


def folders(spark, root: str):
    """Catalog (path, name) of the folders that hold the Parquet files below a root."""
    files = catalog.list_files(spark, root, "*.parquet")
    path = F.regexp_replace("path", "/[^/]*$", "")
    return files.select(path.alias("path")).distinct().withColumn("name", F.element_at(F.split("path", "/"), -1))


@case("scan_chosen_version", "cf_daily", "energy region cell t ~cf",
      "select energy, region, cell, t, cf from cf_daily where year between 1993 and 1995")
def _(d):
    # Three versions of each technology; the narrowest that covers the request is read, its name gives the technology.
    root = shared_path(d.spark, "versions")
    for first, last in ((1992, 1998), (1993, 1995), (1996, 1998)):
        part = d.cf_daily.where(F.col("year").between(first, last))
        for energy in ("solar", "wind"):
            part.where(F.col("energy") == energy).drop("energy").write.parquet(f"{root}/{energy}_CF_all_{first}-{last}.nc")
    found = folders(d.spark, root).withColumn("energy", F.split("name", "_")[0])
    chosen = catalog.best_version(found, ["energy"], "1993-1995", name="name")
    return tables.scan_chosen(chosen, ["energy"])


def by_block(d) -> str:
    """One folder per technology and pair of years; there are few, so a large one is written by several tasks as several files."""
    root = shared_path(d.spark, "blocks")
    rows = d.cf_daily.withColumns({"block": F.floor(F.col("year") / 2), "t": F.col("t").cast("timestamp")})
    sinks.write_cf(rows, root, partitions=["energy", "block"], clustering=["cell", "t"])
    return root


def block_of(path):
    return F.regexp_extract(path, "energy=([^/]*)", 1).alias("energy"), F.regexp_extract(path, "block=([^/]*)", 1).cast("int").alias("block")


@case("years_of_files", "cf_daily", "energy #block #year",
      "select distinct energy, cast(floor(year / 2) as int) as block, year from cf_daily")
def _(d):
    files = catalog.list_files(d.spark, by_block(d), "*.parquet")
    return footers.years_of_files(files).select(*block_of("path"), "year").distinct()


@case("file_ranges", "cf_daily", "energy #block #n_rows least most", """
    select energy, cast(floor(year / 2) as int) as block, count(*) as n_rows, cast(min(t) as timestamp) as least, cast(max(t) as timestamp) as most
    from cf_daily group by 1, 2""")
def _(d):
    ranges = footers.footer_ranges(catalog.list_files(d.spark, by_block(d), "*.parquet"))
    return ranges.groupBy(*block_of("path")).agg(F.sum("n_rows").alias("n_rows"), F.min("least").alias("least"), F.max("most").alias("most"))


@case("first_file_with_year_footers", "cf_daily", "energy #block #n_candidates", """
    select energy, cast(floor(year / 2) as int) as block, 1 as n_candidates from cf_daily where year = 1995 group by 1, 2""")
def _(d):
    # The folder of a block is what is chosen, as many files as it holds; the footers are those of its files.
    root = by_block(d)
    blocks = folders(d.spark, root).withColumn("energy", F.regexp_extract("path", "energy=([^/]*)", 1))
    years = footers.years_of_files(catalog.list_files(d.spark, root, "*.parquet")).withColumn("path", F.regexp_replace("path", "/[^/]*$", ""))
    found = catalog.first_with_year(blocks, years, 1995, ["energy"])
    return found.select("energy", block_of("path")[1], "n_candidates")


def in_buckets(spark, root: str, name: str, df):
    bucketed.write_bucketed(df, f"{root}/{name}", BUCKETS)
    return bucketed.read_bucketed(spark, f"{root}/{name}", BUCKETS)


@case("align_bucketed", "component_u component_v", "cell t ~uas ~vas", """
    select u.cell, u.t, uas, vas from component_u u join component_v v on u.cell = v.cell and u.t = v.t""")
def _(d):
    root = shared_path(d.spark, "buckets")
    u, v = in_buckets(d.spark, root, "u", d.component_u), in_buckets(d.spark, root, "v", d.component_v.select("cell", "t", "vas"))
    return alignment.align_inner(u, v)


@case("interp_join_bucketed", "flux_axis instant_grid", "cell t ~tas", SHARED_AXIS_SQL)
def _(d):
    root = shared_path(d.spark, "buckets")
    flux, states = in_buckets(d.spark, root, "flux", d.flux_axis), in_buckets(d.spark, root, "states", d.instant_grid)
    interpolation.bracket_table(flux.select("t").distinct(), states.select("t").distinct()).write.parquet(f"{root}/brackets")
    table = d.spark.read.parquet(f"{root}/brackets")  # its size is known, so it is sent and not shuffled
    return flux.join(interpolation.interpolate_shared_axis(table, states, ["tas"]), ["cell", "t"], "left")


@case("remask_versioned", "cf_daily daily_mask", "energy region cell #year t ~cf", """
    select energy, region, c.cell, year, t, case when m.is_land then cf end as cf from cf_daily c left join daily_mask m on m.cell = c.cell""")
def _(d):
    root = shared_path(d.spark, "versioned")
    versions.write_partitions(d.cf_daily.where("year < 1997"), root, ["energy", "year"])
    versions.write_partitions(d.cf_daily.where("year >= 1996"), root, ["energy", "year"])  # 1996 is replaced, the later years are added
    versions.remask(d.spark, root, d.daily_mask, grace_seconds=0, together=7)
    return versions.read_current(d.spark, root)


@case("mean_profile_incremental", "cf_daily daily_mask", "energy cell #month #position ~cf #n_years", profile_sql("day(t) - 1"))
def _(d):
    # Six years are there, the seventh is added; the mean is formed from what is stored.
    root, keys = shared_path(d.spark, "profile"), ("energy", "cell")
    for years in ("year < 1998", "year >= 1998"):
        parts = climate.profile_parts(d.cf_daily.where(years), keys=keys, steps_per_day=1)
        versions.write_partitions(parts, root, ["year"], clustering=["cell"])
    return climate.profile_of_parts(versions.read_current(d.spark, root), keys=keys, mask=d.daily_mask)


@case("mean_temperature_incremental", "weather_grid", "cell ~value", "select cell, avg(tas - 273.15e0) as value from weather_grid group by cell")
def _(d):
    rows = d.weather_grid.withColumns({"year": F.year("t"), "month": F.month("t")})
    parts = increments.mean_parts(rows, climate.celsius("tas"), ["cell"], ["year", "month"])
    return increments.mean_of_parts(increments.merged_parts(parts, ["cell", "year"]), ["cell"])
