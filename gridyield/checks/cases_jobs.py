"""Complete jobs and sinks: written to the shared folder, read back, compared."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridyield.checks.cases_time import JOB_SQL
from gridyield.checks.registry import case
from gridyield.plans import jobs
from gridyield.session import shared_path
from gridyield.sources import ingest, sinks, tables


def stored_months(d) -> str:
    """Hourly months as a partitioned table."""
    path = shared_path(d.spark, "months")
    weather = d.accum_months.withColumnsRenamed({"tas": "t2m", "uas": "u10", "vas": "v10"})
    weather = weather.withColumns({"year": F.year("t"), "month": F.month("t")})
    weather.hint("rebalance", "year", "month").write.partitionBy("year", "month").parquet(path)
    return path


for _kind, _value in [
    ("wind_speed_100m", "avg(sqrt(uas * uas + vas * vas) * pow(10.0e0, 1.0e0 / 7.0e0))"), ("t2m_mean", "avg(tas - 273.15e0)"),
]:

    @case(f"climatology_job_{_kind}", "accum_months", "var cell ~value months", f"""
        select '{_kind}' as var, cell, cast(cast({_value} as float) as double) as value, '1,2' as months
        from accum_months where month(t) <= 2 group by cell""")
    def _(d, kind=_kind):
        path, output = stored_months(d), shared_path(d.spark, "climatology")
        jobs.climatology(d.spark, kind, path, output, "2023-2024", "1,2")
        return d.spark.read.parquet(output)


@case("climatology_job_missing_months", "accum_months", "#year #month", """
    select y as year, m as month from range(2023, 2025) a(y), range(1, 13) b(m) except select year(t), month(t) from accum_months""")
def _(d):
    return jobs.climatology(d.spark, "t2m_mean", stored_months(d), shared_path(d.spark, "climatology"), "2023-2024")


ANNUAL_SQL = """select energy, 'M' as model, 'S' as scenario, region, year, avg(case when m.is_land then v end) as mean_cf, max(n) as n_timesteps, count(case when m.is_land then v end) as n_land_cells
    from (select energy, region, cell, year, avg(cf) as v from cf_daily group by 1, 2, 3, 4) c
      join (select energy, region, year, count(distinct t) as n from cf_daily group by 1, 2, 3) s using (energy, region, year)
      left join daily_mask m on m.cell = c.cell group by energy, region, year"""


@case("annual_job_regions", "cf_daily daily_mask", "energy model scenario region #year ~mean_cf #n_timesteps #n_land_cells", ANNUAL_SQL)
def _(d):
    # Years in two runs that overlap: the second replaces the rows of 1998.
    cf, folder = shared_path(d.spark, "cf"), shared_path(d.spark, "annual")
    rows = d.cf_daily.withColumns({"model": F.lit("M"), "scenario": F.lit("S")})
    rows.repartition("year").write.partitionBy("energy", "model", "scenario", "year").parquet(cf)
    jobs.annual_means(d.spark, cf, d.daily_mask, folder, "1992-1998", model="M")
    return jobs.annual_means(d.spark, cf, d.daily_mask, folder, "1998-2010", scenario=["S", "T"])[0]


@case("reanalysis_month_job", "accum_months land_mask", "cell t ~cf", JOB_SQL)
def _(d):
    path, tails, output = stored_months(d), shared_path(d.spark, "tails"), shared_path(d.spark, "cf")
    for month in (1, 2):
        jobs.reanalysis_month(d.spark, path, tails, d.land_mask, output, 2024, month)
    return tables.scan(d.spark, output, None, "2024", "2")


@case("write_cf_replaces_months", "cf_daily", "energy region #year #month cell t ~cf", """
    select energy, region, year, month(t) as month, cell, t, case when year = 1996 then cf * 2 else cf end as cf from cf_daily""")
def _(d):
    path, keys = shared_path(d.spark, "cf"), ["energy", "year", "month"]
    rows = d.cf_daily.withColumn("month", F.month("t"))
    sinks.write_cf(rows, path, keys)
    sinks.write_cf(rows.where("year = 1996").withColumn("cf", F.col("cf") * 2), path, keys)
    return d.spark.read.parquet(path)


@case("upsert_csv_table", "cf_daily", "energy region #year ~mean_cf", """
    select energy, region, year, avg(cf) as mean_cf from cf_daily group by 1, 2, 3""")
def _(d):
    path, keys = f"{shared_path(d.spark, 'table')}.csv", ["energy", "region", "year"]
    means = d.cf_daily.groupBy(*keys).agg(F.avg("cf").alias("mean_cf"))
    ddl = "energy string, region string, year int, mean_cf double"
    sinks.upsert_csv(d.spark, path, means.where("year < 1999").withColumn("mean_cf", F.when(F.col("year") < 1998, F.col("mean_cf")).otherwise(-1.0)), keys, ddl)
    return sinks.upsert_csv(d.spark, path, means.where("year >= 1998"), keys, ddl)


@case("ingest_canonical_table", "weather_grid", "cell t ~lat ~lon ~tas", """
    select cell, t, lat, lon, tas from weather_grid""")
def _(d):
    # As delivered: other names of the axes, a dimension with one value, NaN for missing, one variable under its long name.
    raw = d.weather_grid.withColumnsRenamed({"t": "valid_time", "lat": "latitude", "lon": "longitude", "tas": "tas_bcsd"})
    raw = raw.select("cell", "valid_time", "latitude", "longitude", F.coalesce("tas_bcsd", F.lit(float("nan"))).alias("tas_bcsd"), F.lit(2).alias("height"))
    return ingest.canonical_table(raw, "tas")


@case("ingest_dimensions_per_file", "weather_grid", "#file height_varies number_varies", """
    select cast(cell % 4 as int) as file, count(distinct hour(t)) > 1 as height_varies, false as number_varies from weather_grid group by 1""")
def _(d):
    rows = d.weather_grid.select((F.col("cell") % 4).cast("int").alias("file"), F.hour("t").alias("height"), F.lit(1).alias("number"))
    return ingest.several_values(rows, ["height", "number"], ["file"]).withColumnsRenamed({"height": "height_varies", "number": "number_varies"})


@case("cells_of_table", "weather_grid", "cell ~lat ~lon", "select cell, min(lat) as lat, min(lon) as lon from weather_grid group by cell")
def _(d):
    return ingest.cells_of(d.weather_grid)
