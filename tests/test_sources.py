"""Catalogs, ingest, scans, sinks and jobs on written tables."""

from __future__ import annotations

import math
import os
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridyield import schemas
from gridyield.operators import coverage, regions, upsert
from gridyield.operators.sizing import broadcast_if_small, estimated_bytes
from gridyield.plans import profiles, reanalysis, regional
from gridyield.sources import catalog, ingest, sinks, tables


def pick(spark, names, years=None):
    df = spark.createDataFrame([("k", n) for n in names], "key string, path string")
    return catalog.best_version(df, ["key"], years).first()["path"]


def test_version_choice(spark):
    names = ["tas_x_ssp126_2015-2016.nc", "tas_x_ssp126_2015-2060.nc", "tas_x_ssp126_2015-2100.nc"]
    assert pick(spark, names, "2020-2050") == names[1]
    assert pick(spark, names, "2015-2016") == names[0]
    assert pick(spark, names, "2090-2110") == names[2]  # nothing covers: the widest
    assert pick(spark, names) == names[2]
    assert pick(spark, ["b_latest.nc", "a_latest.nc"], "2020") == "a_latest.nc"
    assert pick(spark, ["z_2015.nc", "a_latest.nc"], "2020") == "z_2015.nc"
    assert pick(spark, ["a_2014-2060.nc", "a_2015-2061.nc"], "2020") == "a_2014-2060.nc"  # same length: earlier start


def test_first_format_that_matches_wins(spark):
    rows = [("R", "M", "s", "tas", n) for n in (
        "tas_3h_bcsd_on_0p1deg_R_M_s_2015-2016.nc", "tas_day_R_M_s_2015-2100.nc", "tas_s.nc", "uas_s.nc", "tas_R_M_s_.txt")]
    rows += [("Q", "M", "s", "tas", n) for n in ("tas_any_s_2015-2020.nc", "tas_s_2015-2030.nc")]
    df = spark.createDataFrame(rows, "region string, model string, scenario string, var string, path string")
    keys = ["region", "model", "scenario", "var"]
    got = {(r["region"], r["path"]) for r in catalog.match_patterns(df, catalog.COUNTRY_PATTERNS, keys, "path").collect()}
    assert got == {("R", "tas_3h_bcsd_on_0p1deg_R_M_s_2015-2016.nc"), ("Q", "tas_any_s_2015-2020.nc"), ("Q", "tas_s_2015-2030.nc")}
    best = {r["region"]: r["path"] for r in catalog.find_files(df, catalog.COUNTRY_PATTERNS, keys, "2015-2018").collect()}
    assert best == {"R": "tas_3h_bcsd_on_0p1deg_R_M_s_2015-2016.nc", "Q": "tas_any_s_2015-2020.nc"}
    with pytest.raises(ValueError):
        catalog.match_patterns(df, ["{unknown}_*.nc"], keys, "path")


def test_other_catalog_choices(spark):
    df = spark.createDataFrame([("k", "b_2015-2060_x.nc"), ("k", "a_2010.nc"), ("j", "c.nc"), ("j", "d.nc")], "key string, path string")
    assert {r["key"]: r["path"] for r in catalog.preferred_file(df, ["key"]).collect()} == {"k": "b_2015-2060_x.nc", "j": "c.nc"}
    contents = spark.createDataFrame([("c.nc", 2020), ("d.nc", 2021), ("b_2015-2060_x.nc", 2021)], "path string, year int")
    assert {r["key"]: r["path"] for r in catalog.first_with_year(df, contents, 2021, ["key"]).collect()} == {"k": "b_2015-2060_x.nc", "j": "d.nc"}
    names = spark.createDataFrame([(n,) for n in ("A", "_A", "A_", "A_repeated", "")], "region string")
    assert [r[0] for r in catalog.discover_regions(names).collect()] == ["A"]
    assert {r[0] for r in catalog.annual_regions(names).collect()} == {"A", "_A", "A_", "A_repeated", "", "china"}
    stamps = spark.createDataFrame([("v", "v_1hr_202001010000-202012312300.nc"), ("v", "v_1hr_201901010000-201912312300.nc"), ("v", "v_fx.nc")], "var string, name string")
    assert [r["year"] for r in catalog.yearly_files(stamps, ["var"], "2020-2060", path="name").collect()] == [2020]


def test_files_are_listed_without_reading(spark, folder):
    for name in ("x/a_2015.nc", "x/y/b_2015-2016.nc", "x/c.txt"):
        os.makedirs(os.path.dirname(f"{folder}/{name}"), exist_ok=True)
        with open(f"{folder}/{name}", "w") as file:
            file.write("content")
    listed = catalog.add_file_period(catalog.list_files(spark, folder, "*.nc"))
    assert {(r["name"], r["first_year"], r["last_year"]) for r in listed.collect()} == {("a_2015.nc", 2015, 2015), ("b_2015-2016.nc", 2015, 2016)}


def test_names_of_variables_and_coordinates(spark):
    assert ingest.pick_variable(["tas_bcsd", "tas"], "tas") == "tas_bcsd"
    assert ingest.pick_variable(["tas", "x"], "tas") == "tas" and ingest.pick_variable(["x"], "tas") == "x"
    assert ingest.pick_cf_variable(["pv_cf", "other"], "solar") == "pv_cf" and ingest.pick_cf_variable(["my_CF", "x"]) == "my_CF"
    for bad in (lambda: ingest.pick_variable(["x", "y"], "tas"), lambda: ingest.pick_cf_variable(["x", "y"]), lambda: ingest.pick_name(["x"], ["lat"])):
        with pytest.raises(KeyError):
            bad()
    df = spark.createDataFrame([(1, datetime(2020, 1, 1), 1.0, 2.0, 5.0, 0), (1, datetime(2020, 1, 2), 1.0, 2.0, float("nan"), 0)],
                               "cell int, valid_time timestamp, latitude double, longitude double, tas_bcsd double, height int")
    out = ingest.canonical_table(df, "tas")
    assert set(out.columns) == {"cell", "t", "lat", "lon", "tas"} and {r["tas"] for r in out.collect()} == {5.0, None}
    with pytest.raises(ValueError):
        ingest.squeeze(df.withColumn("height", F.dayofmonth("valid_time")), ["height"])
    assert ingest.cells_of(out).collect()[0].asDict() == {"cell": 1, "lat": 1.0, "lon": 2.0}


def test_every_schema_parses():
    assert len(schemas.ALL) == 20
    for ddl in schemas.ALL.values():
        assert schemas.struct(ddl).fields


def cf_rows(spark, value=0.5, months=(1, 2)):
    rows = [("solar", "e5", "R", "s", 2020, m, c, 0.0, 0.0, datetime(2020, m, 1, h), value) for m in months for c in range(4) for h in range(3)]
    return spark.createDataFrame(rows, schemas.CF)


def test_cf_sink_replaces_only_its_partitions_and_prunes(spark, folder, plan):
    path = f"{folder}/cf"
    sinks.write_cf(cf_rows(spark), path, provenance={"method": "two-axis"})
    sinks.write_cf(cf_rows(spark, 0.25, (2,)), path, provenance={"method": "two-axis"})
    back = tables.capacity_factors(spark, path)
    assert {r["month"]: r["m"] for r in back.groupBy("month").agg(F.avg("cf").alias("m")).collect()} == {1: 0.5, 2: 0.25}
    chosen = tables.capacity_factors(spark, path, "2020", "2", energy="solar", region=["R", "Q"])
    assert chosen.count() == 12
    text = plan(chosen.select("cf"))
    filters = text[text.index("PartitionFilters"):].split("]")[0]
    assert all(c in filters for c in ("year", "month", "energy", "region")) and "ReadSchema: struct<cf:float>" in text
    requested = coverage.year_month_spine(spark, "2020", "1,2,3")
    assert [tuple(r) for r in sinks.pending_partitions(requested, path, ["year", "month"]).collect()] == [(2020, 3)]
    assert sinks.pending_partitions(requested, path, ["year", "month"], overwrite=True).count() == 3
    assert sinks.pending_partitions(requested, f"{folder}/none", ["year", "month"]).count() == 3


def test_remask_in_place_and_elsewhere(spark, folder):
    path, mask = f"{folder}/cf", spark.createDataFrame([(c, c % 2 == 0) for c in range(4)], schemas.LAND_MASK)
    sinks.write_cf(cf_rows(spark), path)
    sinks.remask(spark, path, mask, f"{folder}/masked")
    assert spark.read.parquet(path).where("cf is null").count() == 0
    assert spark.read.parquet(f"{folder}/masked").where("cf is null").count() == 12
    sinks.remask(spark, path, mask)
    spark.catalog.clearCache()
    assert spark.read.parquet(path).where("cf is null").count() == 12 and spark.read.parquet(path).count() == 24


def test_failed_write_leaves_the_old_table(spark, folder):
    path = f"{folder}/t"
    sinks.write_climatology(spark.range(3), path)
    with pytest.raises(Exception):
        sinks.write_climatology(spark.range(3).withColumn("x", F.raise_error(F.lit("stop")).cast("int")), path)
    assert spark.read.parquet(path).count() == 3 and [n for n in os.listdir(folder) if n != "t"] == []


def annual(spark, rows):
    return spark.createDataFrame([("solar", "m", "s", r, y, v, 1, 1) for r, y, v in rows], schemas.ANNUAL_REGION_CF)


def test_csv_upsert(spark, folder):
    path, keys = f"{folder}/annual.csv", ["energy", "model", "scenario", "region", "year"]
    sinks.upsert_csv(spark, path, annual(spark, [("B", 2020, 0.1), ("A", 2021, 0.2), ("A", 2020, None)]), keys, schemas.ANNUAL_REGION_CF)
    out = sinks.upsert_csv(spark, path, annual(spark, [("A", 2021, 0.9), ("C", 2020, 0.3)]), keys, schemas.ANNUAL_REGION_CF)
    assert [(r["region"], r["year"], r["mean_cf"]) for r in out.collect()] == [("A", 2020, None), ("A", 2021, 0.9), ("B", 2020, 0.1), ("C", 2020, 0.3)]
    out = sinks.upsert_csv(spark, path, annual(spark, [("C", 2020, 0.4)]), keys, schemas.ANNUAL_REGION_CF, overwrite=True)
    assert out.count() == 1 and sorted(n for n in os.listdir(folder)) == ["annual.csv"]


def test_upsert_with_a_hot_key(spark):
    old = spark.range(5000).select(F.lit(1).alias("k"), F.col("id").alias("seq"), F.lit("old").alias("v"))
    new = spark.range(3).select(F.col("id").cast("int").alias("k"), F.col("id").alias("seq"), F.lit("new").alias("v"))
    got = {r["k"]: (r["seq"], r["v"]) for r in upsert.upsert(old, new, ["k"], "seq").collect()}
    assert got == {0: (0, "new"), 1: (1, "new"), 2: (2, "new")}
    assert upsert.upsert(old, None or old.limit(0), ["k"], "seq").first()["seq"] == 4999


def test_text_sinks(spark, folder):
    log = spark.createDataFrame([("A", "f.nc", 2, 1, 0.5, 1.0, 2.0, 3.0, 4.0)], schemas.REGION_LOG)
    sinks.write_region_log(log, f"{folder}/log")
    assert spark.read.option("header", True).csv(f"{folder}/log").first()["mean_cf"] == "0.50000000"
    sinks.write_monthly_means(spark.createDataFrame([(2020, 1, 0.1, 0.2, 0.3, 0.4)], schemas.MONTHLY_MEAN), f"{folder}/m")
    assert spark.read.option("header", True).csv(f"{folder}/m").count() == 1
    sinks.write_mosaic(spark.createDataFrame([(1, 2, 0.5, 1)], schemas.MOSAIC), f"{folder}/mosaic", "wind", {"year": "2020"})
    assert set(spark.read.parquet(f"{folder}/mosaic").columns) == {"lat_idx", "lon_idx", "wind_cf_yearmean", "overlap_count", "year"}


def test_year_reports(spark):
    df = spark.createDataFrame([("u", 2020), ("v", 2020), ("u", 2021), ("w", 2021)], "var string, year int")
    assert [r[0] for r in coverage.common_years(df, ["u", "v"]).collect()] == [2020]
    assert [tuple(r) for r in coverage.missing_years(df, ["u", "v"]).collect()] == [(2021, "v")]
    spine = coverage.year_month_spine(spark, "2020-2021", "1,2")
    have = spark.createDataFrame([(2020, 1), (2021, 2)], "year int, month int")
    assert {tuple(r) for r in coverage.missing_months(spine, have).collect()} == {(2020, 2), (2021, 1)}


def test_broadcast_only_when_small(spark, folder, plan):
    big = spark.range(10)
    assert estimated_bytes(big) is not None
    assert "broadcast" in plan(big.join(broadcast_if_small(big), "id")).lower()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "broadcast" not in plan(big.join(broadcast_if_small(big, max_bytes=1), "id")).lower()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(scope="module")
def reanalysis_table(spark, tmp_path_factory):
    rng = np.random.default_rng(21)
    rows = []
    for cell in range(3):
        total = 0.0
        for h in range(24 * 45):
            t = datetime(2020, 1, 15) + timedelta(hours=h)
            inc = 3.6e6 * max(0.0, math.sin((t.hour - 6) / 12 * math.pi)) * 0.7
            total = inc if t.hour == 1 else total + inc
            rows.append((t.year, t.month, cell, 10.0 + cell, 0.1, t, total, 290.0, float(rng.normal(0, 6)), None if h % 50 == 0 else 2.0))
    path = str(tmp_path_factory.mktemp("weather") / "w")
    spark.createDataFrame(rows, schemas.WEATHER_REANALYSIS).write.partitionBy("year", "month").parquet(path)
    return path


def test_reanalysis_job_uses_the_month_before(spark, reanalysis_table, plan):
    mask = spark.createDataFrame([(0, True), (1, True), (2, False)], schemas.LAND_MASK)
    february = tables.reanalysis_weather(spark, reanalysis_table, "2020", "2")
    padded = tables.reanalysis_weather(spark, reanalysis_table, "2020", "2", with_month_before=True)
    assert {r["month"] for r in padded.select("month").distinct().collect()} == {1, 2}
    assert "PartitionFilters: [" in plan(padded) and "PartitionFilters: []" not in plan(padded)
    assert tables.previous_month(2020, 1) == (2019, 12)
    with_before = reanalysis.solar(padded, mask, "2020", "2").where("cell = 0").orderBy("t").toPandas()
    assert len(with_before) == 28 * 24 and with_before["cf"].between(0, 1).all() and with_before["cf"].max() > 0.2
    ocean = reanalysis.solar(february, mask, "2020", "2").where("cell = 2")
    assert ocean.count() == 28 * 24 and ocean.where("cf is not null").count() == 0


def test_wind_job_and_mean_year(spark, reanalysis_table):
    mask = spark.createDataFrame([(0, True), (1, True), (2, False)], schemas.LAND_MASK)
    weather = tables.reanalysis_weather(spark, reanalysis_table, "2020")
    knots = [(3.0, 0.0), (12.0, 3000.0), (25.0, 3000.0)]
    cf = reanalysis.wind(weather, mask, knots, 3000.0, "2020", "1,2")
    assert cf.where("cell = 0 and cf is null").count() == 0 and cf.where("cf < 0 or cf > 1").count() == 0
    profile = profiles.mean_year(cf.withColumn("energy", F.lit("wind")), mask, "2020", merge=False)
    assert profile.where("month = 2 and cell = 0").count() == 672
    with pytest.raises(ValueError):
        profiles.mean_year(cf.withColumn("energy", F.lit("wind")), mask, "2020")


def regional_input(spark, scalar=False):
    hours = [datetime(2021, 6, 1) + timedelta(hours=3 * k) for k in range(40)]
    states = pd.DataFrame([(c, t, 290.0 + c, 3.0 + np.sin(i), 1.0) for c in range(3) for i, t in enumerate(hours)], columns=["cell", "t", "tas", "uas", "vas"])
    flux = pd.DataFrame([(c, 30.0 + c, 5.0, t + timedelta(minutes=90), 600.0) for c in range(3) for t in hours], columns=["cell", "lat", "lon", "t", "rsds"])
    s = spark.createDataFrame(states)
    if scalar:
        s = s.select("cell", "t", "tas", F.sqrt(F.col("uas") ** 2 + F.col("vas") ** 2).alias("sfcWind"))
    return spark.createDataFrame(flux), s, spark.createDataFrame([(0, True), (1, True), (2, False)], "cell long, is_land boolean")


def test_regional_job_is_the_same_with_shared_and_own_axes(spark):
    flux, states, mask = regional_input(spark)
    a, b = (regional.solar(flux, states, mask, "2021", shared_axis=x).orderBy("cell", "t").toPandas() for x in (True, False))
    np.testing.assert_allclose(a["cf"].astype(float), b["cf"].astype(float), atol=1e-12)
    assert len(a) == 120 and a["cf"].isna().sum() == 40 and a["cf"].max() > 0.3


def test_regional_job_with_scalar_wind_keeps_missing_wind_rule(spark):
    flux, states, mask = regional_input(spark, scalar=True)
    none = states.withColumn("sfcWind", F.lit(None).cast("double"))
    zero = regional.solar(flux, none, mask, scalar_wind=True)
    calm = regional.solar(flux, none, mask, scalar_wind=True, missing_wind="zero_wind")
    assert zero.where("cell = 0").agg(F.max("cf")).first()[0] == 0.0
    assert calm.where("cell = 0").agg(F.max("cf")).first()[0] > 0.3


def test_wind_job_takes_common_keys(spark):
    t = datetime(2021, 1, 1)
    u = spark.createDataFrame([(0, t, 9.0), (0, t + timedelta(hours=3), 9.0)], "cell long, t timestamp, uas double")
    v = spark.createDataFrame([(0, t + timedelta(hours=3), 0.0), (0, t + timedelta(hours=6), 0.0)], "cell long, t timestamp, vas double")
    mask = spark.createDataFrame([(0, True)], "cell long, is_land boolean")
    rows = regional.wind(u, v, mask, [(3.0, 0.0), (12.0, 3000.0), (25.0, 3000.0)], 3000.0, "2021").collect()
    assert [r["t"] for r in rows] == [t + timedelta(hours=3)] and rows[0]["cf"] > 0.9


def test_rotated_grid_cells(spark, folder):
    rows = [("g", "r", "c", "s", 2020, i, j, 40.0 + i, -90.0 + j, datetime(2020, 1, 1), 1.0, 1.0, 1.0, 1.0) for i in range(3) for j in range(2)]
    spark.createDataFrame(rows, schemas.WEATHER_ROTATED).write.partitionBy("gcm", "realization", "rcm", "scenario", "year").parquet(f"{folder}/w")
    df = tables.rotated_weather(spark, f"{folder}/w", "g", "r", "c", "s", "2020")
    assert df.select("cell").distinct().count() == 6


def test_global_lattice_scan_serves_all_regions_once(spark, folder, plan):
    rows = [("wind", 500, 100 + i % 3, 2020, datetime(2020, 1, 1 + i % 5), 0.1 * (i % 7)) for i in range(60)]
    spark.createDataFrame(rows, "energy string, lat_idx int, lon_idx int, year int, t timestamp, cf double").write.parquet(f"{folder}/g")
    cells = spark.createDataFrame([(f"R{k}", 500, 100 + k % 3, True) for k in range(20)], "region string, gi_lat int, gi_lon int, is_land boolean")
    cells.write.parquet(f"{folder}/c")
    out = regions.region_annual_mean_snapped(spark.read.parquet(f"{folder}/g"), spark.read.parquet(f"{folder}/c"))
    assert out.count() == 20
    text = plan(out)
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_rotated_sink(spark, folder):
    rows = [("wind", "g", "r", "c", "s", y, 1, 2, 40.0, -90.0, datetime(y, 1, 1), 0.5) for y in (2020, 2021)]
    ddl = ("energy string, gcm string, realization string, rcm string, scenario string, year int, rlat_i int, rlon_i int, "
           "lat double, lon double, t timestamp, cf double")
    sinks.write_cf(spark.createDataFrame(rows, ddl), f"{folder}/cf", sinks.ROTATED_PARTITIONS, ("rlat_i", "rlon_i", "t"))
    assert {r["year"] for r in coverage.available_years(spark.read.parquet(f"{folder}/cf")).collect()} == {2020, 2021}


def test_choice_of_cf_files(spark):
    names = ["wind_CF_A_M_ssp126_2015-2060_allmonths.nc", "wind_CF_A_M_ssp126_2010-2014_allmonths.nc", "solar_CF_A_M_ssp126_2015-2060_allmonths.nc"]
    files = spark.createDataFrame([("A", "ssp126", n) for n in names] + [("B", "ssp126", "any_ssp126.nc")], "region string, scenario string, path string")
    contents = spark.createDataFrame([(names[0], 2020), (names[1], 2012), (names[2], 2020), ("any_ssp126.nc", 2020)], "path string, year int")
    got = {r["region"]: (r["path"], r["n_candidates"]) for r in catalog.choose_cf_files(files, contents, 2020, "wind").collect()}
    assert got == {"A": (names[0], 1), "B": ("any_ssp126.nc", 1)}


def test_unknown_units_are_judged_by_magnitude(spark):
    flux, states, mask = regional_input(spark)
    named = flux.withColumn("file", F.lit("f"))
    known = regional.solar(named, states, mask).orderBy("cell", "t").toPandas()
    guessed = regional.solar(named, states, mask, irradiance_units=None, temperature_units=None, file_keys=["file"]).orderBy("cell", "t").toPandas()
    np.testing.assert_allclose(known["cf"].astype(float), guessed["cf"].astype(float), atol=1e-12)
    assert set(known.columns) == {"cell", "lat", "lon", "t", "file", "cf"} == set(guessed.columns)
    with pytest.raises(ValueError):
        regional.solar(named, states, mask, irradiance_units=None)
