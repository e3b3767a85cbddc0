"""Complete jobs: what is there, what is done, what is written."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gridyield.plans import jobs
from gridyield.sources import sinks


@pytest.fixture()
def months(spark, folder):
    """Three stored months (December, January, March) of three cells, six-hourly."""
    rows = spark.sql("""
        select cast(c as bigint) as cell, c * 1.0 as lat, 2.0 as lon, timestamp'2019-12-01' + make_interval(0, 0, 0, k div 4, (k % 4) * 6, 0, 0) as t,
          (k % 4) * 1e6 + 1.0 as ssrd, 280.0 + c as t2m, 3.0 as u10, 4.0 as v10
        from (select explode(sequence(0, 2)) as c), (select explode(sequence(0, 120 * 4)) as k)""")
    dated = rows.withColumns({"year": F.year("t"), "month": F.month("t")}).where("month in (12, 1, 3)")
    dated.write.partitionBy("year", "month").parquet(f"{folder}/months")
    return f"{folder}/months"


def test_climatology_skips_missing_months_and_existing_results(spark, folder, months):
    out = f"{folder}/wind"
    missing = jobs.climatology(spark, "wind_speed_100m", months, out, "2019-2020", "12,1,2,3")
    assert {(r.year, r.month) for r in missing.collect()} == {(2019, 1), (2019, 2), (2019, 3), (2020, 2), (2020, 12)}
    got = spark.read.parquet(out).collect()
    assert {(r.var, r.units, r.months, r.years) for r in got} == {("wind_speed_100m", "m s-1", "12,1,2,3", "2019-2020")}
    assert all(abs(r.value - 5.0 * 10 ** (1 / 7)) < 1e-4 for r in got) and len(got) == 3
    assert jobs.climatology(spark, "t2m_mean", months, out, "2019-2020") is None  # it is there
    assert spark.read.parquet(out).first()["var"] == "wind_speed_100m"
    jobs.climatology(spark, "t2m_mean", months, out, "2019-2020", overwrite=True)
    assert sorted(round(r.value, 3) for r in spark.read.parquet(out).collect()) == [6.85, 7.85, 8.85]
    jobs.climatology(spark, "sunshine_hours", months, f"{folder}/sun", "2019-2020")
    assert spark.read.parquet(f"{folder}/sun").first()["units"] == "h day-1"


def test_nothing_that_matches_is_an_error(spark, folder, months):
    for path in (months, f"{folder}/nowhere"):
        with pytest.raises(ValueError, match="holds no month"):
            jobs.climatology(spark, "t2m_mean", path, f"{folder}/t", "2031")
    assert not sinks.exists(spark, f"{folder}/t")
    with pytest.raises(ValueError, match="holds no rows"):
        jobs.annual_means(spark, months, None, folder, "2031")


def test_months_are_computed_once_and_in_turn(spark, folder, months):
    mask = spark.createDataFrame([(0, True), (1, True), (2, False)], "cell bigint, is_land boolean")
    tails, out = f"{folder}/tails", f"{folder}/cf"
    assert [jobs.reanalysis_month(spark, months, tails, mask, out, *p) for p in ((2019, 12), (2020, 1), (2020, 1))] == [True, True, False]
    with pytest.raises(ValueError, match="holds no month"):
        jobs.reanalysis_month(spark, months, tails, mask, out, 2020, 2)
    assert jobs.reanalysis_month(spark, months, tails, mask, out, 2020, 3)  # without a month before
    got = spark.read.parquet(out)
    assert {(r.year, r.month) for r in got.select("year", "month").distinct().collect()} == {(2019, 12), (2020, 1), (2020, 3)}
    assert got.where("cell = 2 and cf is not null").count() == 0
    assert got.where("t = timestamp'2020-01-01 00:00:00' and cell = 0").count() == 1


def test_results_of_several_runs_are_merged(spark, folder):
    rows = spark.sql("""
        select 'solar' as energy, 'M' as model, 'S' as scenario, concat('R', c) as region, y as year, make_timestamp(y, 1, d, 0, 0, 0) as t, c as cell, c + y / 1e4 as cf
        from (select explode(sequence(1, 2)) as c), (select explode(sequence(2020, 2022)) as y), (select explode(sequence(1, 3)) as d)""")
    rows.write.partitionBy("energy", "model", "scenario", "region", "year").parquet(f"{folder}/cf")
    for years in ("2020-2021", "2021-2022"):
        regional, world = jobs.annual_means(spark, f"{folder}/cf", None, f"{folder}/out", years, model="M")
    assert [(r.region, r.year, r.n_timesteps) for r in regional.orderBy("region", "year").collect()] == [(f"R{c}", y, 3) for c in (1, 2) for y in (2020, 2021, 2022)]
    assert [(r.year, round(r.mean_cf, 6), r.n_regions) for r in world.orderBy("year").collect()] == [(y, round(1.5 + y / 1e4, 6), 2) for y in (2020, 2021, 2022)]
    lattice = rows.select("energy", F.lit("E").alias("source"), F.lit(500).alias("lat_idx"), F.col("cell").alias("lon_idx"), "year", "t", "cf")
    lattice.write.partitionBy("energy", "source", "year").parquet(f"{folder}/global")
    cells = spark.createDataFrame([("A", 500, 1, True), ("B", 500, 9, True)], "region string, gi_lat int, gi_lon int, is_land boolean")
    regional, world = jobs.annual_means_of_lattice(spark, f"{folder}/global", cells, f"{folder}/out2", "2020-2022", source="E")
    assert {(r.region, r.n_land_cells, r.n_timesteps) for r in regional.collect()} == {("A", 1, 3), ("B", 0, 3)} and world.count() == 3
