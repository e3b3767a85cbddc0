"""Annual means, snapping, mosaics and their invariants."""

from __future__ import annotations

from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridyield.functions import geo
from gridyield.operators import diagnostics, filters, masking, mosaic, regions, snapping
from gridyield.plans import annual, comparison, maps

DDL = "energy string, region string, cell int, t timestamp, cf double"


def day(year, n):
    return datetime(year, 1, n)


@pytest.fixture(scope="module")
def cf(spark):
    rows = [
        ("solar", "A", 1, day(2020, 1), 0.2), ("solar", "A", 1, day(2020, 2), 0.4), ("solar", "A", 2, day(2020, 1), 0.9),
        ("solar", "A", 3, day(2020, 3), None), ("solar", "B", 4, day(2020, 1), None), ("solar", "B", 4, day(2021, 1), 0.5),
        ("solar", "B", 5, day(2021, 1), 0.1),
    ]
    return spark.createDataFrame(rows, DDL)


@pytest.fixture(scope="module")
def mask(spark):
    return spark.createDataFrame([(1, True), (2, True), (3, True), (4, True), (5, False)], "cell int, is_land boolean")


def test_two_stage_mean(cf, mask):
    got = {(r["region"], r["year"]): tuple(r)[3:] for r in regions.region_annual_mean(cf, mask).collect()}
    mean, steps, cells = got[("A", 2020)]
    assert abs(mean - (0.3 + 0.9) / 2) < 1e-12 and (steps, cells) == (3, 2)
    assert got[("B", 2020)] == (None, 1, 0)  # region-year without a valid cell stays
    assert got[("B", 2021)] == (0.5, 1, 1)
    plain = {(r["region"], r["year"]): r["mean_cf"] for r in regions.region_annual_mean(cf).collect()}
    assert abs(plain[("B", 2021)] - 0.3) < 1e-12


def test_global_mean_weights_cells_and_skips_empty_regions(cf, mask):
    regional, overall = annual.from_regions(cf, mask, ["energy"])
    got = {r["year"]: tuple(r)[2:] for r in overall.collect()}
    assert abs(got[2020][0] - 0.6) < 1e-12 and got[2020][1:] == (1, 2)
    assert got[2021] == (0.5, 1, 1)
    excluded = {r["year"]: (r["mean_cf_all"], r["mean_cf_kept"], r["kept_land_cells"]) for r in regions.global_mean_excluding(regional, ["B"]).collect()}
    assert set(excluded) == {2020} and abs(excluded[2020][1] - 0.6) < 1e-12


def test_years_may_be_one_or_a_range(cf, mask):
    assert {r["year"] for r in annual.from_regions(cf, mask, ["energy"], "2021")[0].collect()} == {2021}
    assert {r["year"] for r in annual.from_regions(cf, mask, ["energy"], "2020-2021")[0].collect()} == {2020, 2021}


def lattice_table(spark, n=30, seed=9):
    rng = np.random.default_rng(seed)
    rows = [("wind", 500 + i % 6, 100 + i // 6, day(y, 1 + k), float(rng.random()) if rng.random() > 0.1 else None)
            for i in range(n) for y in (2019, 2020) for k in range(4)]
    return spark.createDataFrame(rows, "energy string, lat_idx int, lon_idx int, t timestamp, cf double")


def test_snapped_means_equal_direct_means_when_region_grid_is_the_lattice(spark):
    table = lattice_table(spark)
    cells = table.select("lat_idx", "lon_idx").distinct().select(
        F.lit("R").alias("region"), geo.lattice_lat(F.col("lat_idx")).alias("lat"), geo.lattice_lon(F.col("lon_idx")).alias("lon"),
        (F.col("lon_idx") % 2 == 0).alias("is_land"))
    snapped = regions.region_annual_mean_snapped(table, snapping.snap_to_lattice(cells))
    key = F.col("lat_idx") * 10000 + F.col("lon_idx")
    direct = regions.region_annual_mean(
        table.select("energy", F.lit("R").alias("region"), key.alias("cell"), "t", "cf"),
        table.select(key.alias("cell"), (F.col("lon_idx") % 2 == 0).alias("is_land")).distinct())
    a, b = ({r["year"]: tuple(r) for r in x.select("year", F.round("mean_cf", 10), "n_timesteps", "n_land_cells").collect()} for x in (snapped, direct))
    assert a == b and len(a) == 2


def test_lattice_cell_behind_several_region_cells_counts_each_time(spark):
    table = spark.createDataFrame([("wind", 500, 100, day(2020, 1), 0.2), ("wind", 500, 101, day(2020, 1), 0.8)],
                                  "energy string, lat_idx int, lon_idx int, t timestamp, cf double")
    cells = spark.createDataFrame(
        [("R", 40.0, 10.0, True), ("R", 40.01, 10.0, True), ("R", 40.0, 10.1, True), ("Q", 40.0, 10.1, False), ("E", -40.0, 10.1, True)],
        "region string, lat double, lon double, is_land boolean")
    got = {r["region"]: (r["mean_cf"], r["n_land_cells"]) for r in regions.region_annual_mean_snapped(table, snapping.snap_to_lattice(cells)).collect()}
    assert abs(got["R"][0] - (0.2 + 0.2 + 0.8) / 3) < 1e-12 and got["R"][1] == 3
    assert got["Q"] == (None, 0) and got["E"] == (None, 0)  # every region has a row per year
    unmasked = {r["region"]: r["mean_cf"] for r in regions.region_annual_mean_snapped(table, snapping.snap_to_lattice(cells), use_mask=False).collect()}
    assert unmasked["Q"] == 0.8


def test_region_cells_take_the_land_flag_at_their_own_coordinates(spark):
    grid = spark.createDataFrame([("R", 40.02, 10.0), ("R", 39.98, 10.0), ("S", 0.0, 0.0)], "region string, lat double, lon double")
    land = spark.createDataFrame([(40.02, 10.0, True), (39.98, 10.0, False), (0.0, 0.0, True)], "lat double, lon double, is_land boolean")
    got = {(r["region"], r["lat"]): (r["gi_lat"], r["is_land"]) for r in annual.region_cells(grid, land, exclude="S").collect()}
    assert got == {("R", 40.02): (500, True), ("R", 39.98): (500, False)}


def test_irregular_axis_equals_search(spark):
    rng = np.random.default_rng(6)
    axis, values = np.sort(rng.uniform(0, 1000, 60)), rng.uniform(-50, 1050, 500)
    a = spark.createDataFrame([(float(v), int(i)) for i, v in enumerate(axis)], "v double, i int")
    p = spark.createDataFrame([(k, float(v)) for k, v in enumerate(values)] + [(999, None)], "k int, x double")
    got = {r["k"]: r["i"] for r in snapping.snap_to_axis(p, "x", a, "v", ["i"], 37.0).collect()}
    assert got.pop(999) is None
    assert got == {k: int(np.abs(axis - v).argmin()) for k, v in enumerate(values)}


def test_irregular_axis_tie_takes_the_smaller(spark):
    a = spark.createDataFrame([(1.0, "low"), (3.0, "high")], "v double, name string")
    p = spark.createDataFrame([(2.0,)], "x double")
    assert snapping.snap_to_axis(p, "x", a, "v", ["name"], 1.0).first()["name"] == "low"


HAND = [(10, 10, 0.2, 1), (10, 10, 0.4, 2), (11, 10, 0.7, 2), (12, 10, None, 1)]


@pytest.mark.parametrize("policy, value, count", [("mean", 0.3, 2), ("first", 0.2, 1), ("last", 0.4, 1), ("max", 0.4, 1)])
def test_mosaic_policies(spark, policy, value, count):
    df = spark.createDataFrame(HAND, "lat_idx int, lon_idx int, cf double, ord int")
    got = {r["lat_idx"]: (r["cf"], r["overlap_count"]) for r in mosaic.mosaic(df, policy).collect()}
    assert abs(got[10][0] - value) < 1e-12 and got[10][1] == count
    assert got[11] == (0.7, 1) and 12 not in got  # same under every policy where nothing overlaps


def test_mosaic_totals_and_unknown_policy(spark):
    df = spark.createDataFrame(HAND, "lat_idx int, lon_idx int, cf double, ord int")
    assert tuple(mosaic.mosaic_totals(mosaic.mosaic(df)).first()) == (2, 1, 2)
    assert tuple(mosaic.mosaic_totals(mosaic.mosaic(df.where("cf > 9"))).first()) == (0, 0, 0)
    with pytest.raises(ValueError):
        mosaic.mosaic(df, "median")


def test_mosaic_refuses_coordinates_off_the_lattice(spark):
    good = spark.createDataFrame([(40.0, 359.9, 0.1, 1)], "lat double, lon double, cf double, ord int")
    assert mosaic.mosaic(snapping.add_lattice_index(good)).first()["lon_idx"] == 3599
    off = good.withColumn("lat", F.lit(40.02))
    with pytest.raises(Exception, match="no lattice centres"):
        mosaic.mosaic(snapping.add_lattice_index(off)).collect()


def test_annual_map_follows_the_given_region_order(spark):
    rows = [("A", 40.0, 10.0, day(2020, 1), 0.1), ("B", 40.0, 10.0, day(2020, 1), 0.5), ("B", 40.0, 10.0, day(2020, 2), 0.7), ("A", 40.0, 10.0, day(2021, 1), 0.9)]
    cf = spark.createDataFrame(rows, "region string, lat double, lon double, t timestamp, cf double")
    assert abs(maps.annual_map(cf, 2020, "first").first()["cf"] - 0.1) < 1e-12
    assert abs(maps.annual_map(cf, 2020, "first", ["B", "A"]).first()["cf"] - 0.6) < 1e-12
    assert abs(maps.annual_map(cf, 2020, "mean", ["B"]).first()["cf"] - 0.6) < 1e-12


def test_extent_of_the_world_when_nothing_is_valid(spark):
    df = spark.createDataFrame([(10, 10, None)], "lat_idx int, lon_idx int, cf double")
    got = filters.valid_extent(df).first().asDict()
    assert (got["r0"], got["r1"], got["c0"], got["c1"]) == (0, 1800, 0, 3599)
    assert (got["lon_min"], got["lon_max"], got["lat_min"], got["lat_max"]) == (-180.0, 180.0, -90.0, 90.0)
    assert filters.crop_to_valid(df).count() == 1


def test_crop_joins_both_sides_of_the_zero_meridian(spark):
    df = spark.createDataFrame([(500, 3595, 0.1), (500, 5, 0.2), (500, 1800, None)], "lat_idx int, lon_idx int, cf double")
    got = filters.valid_extent(df, pad_degrees=0.25).first()
    assert (got["c0"], got["c1"], got["r0"], got["r1"]) == (1792, 1808, 497, 503)
    assert filters.crop_to_valid(df, pad_degrees=0.25).count() == 2


def test_zero_mask_can_be_switched_off(spark):
    df = spark.createDataFrame([(0.0,), (1e-6,), (0.5,), (None,)], "cf double")
    assert [r[0] for r in filters.mask_zero(df).collect()] == [None, None, 0.5, None]
    assert [r[0] for r in filters.mask_zero(df, threshold=-1).collect()] == [0.0, 1e-6, 0.5, None]


def test_names_in_both_forms():
    assert filters.split_names(["A,B", " C "]) == ["A", "B", "C"] and filters.split_names("") == []


def test_land_mask_keeps_ocean_rows(spark, cf, mask):
    out = masking.apply_land_mask(cf.where("region = 'B'"), mask)
    assert out.count() == 3 and out.where("cf is not null").count() == 1
    assert masking.drop_ocean(cf.where("region = 'B'"), mask).count() == 2


def test_means_over_all_and_over_land(spark, cf, mask):
    got = {(r["year"], r["month"]): (r["mean_global"], r["mean_land"]) for r in regions.global_and_land_means(cf, mask).collect()}
    assert abs(got[(2020, 1)][0] - 0.5) < 1e-12 and abs(got[(2021, 1)][0] - 0.3) < 1e-12 and got[(2021, 1)][1] == 0.5


def test_ratio_is_missing_where_the_other_is_absent_or_zero(spark):
    a = spark.createDataFrame([("w", 1, 0.4), ("w", 2, 0.4), ("w", 3, 0.4)], "energy string, year int, mean_cf double")
    b = spark.createDataFrame([("w", 1, 0.2), ("w", 2, 0.0)], "energy string, year int, mean_cf double")
    assert {r["year"]: r["ratio"] for r in regions.dataset_ratio(a, b).collect()} == {1: 2.0, 2: None, 3: None}
    got = comparison.with_published(a, b.drop("energy"), ["year"], ["mean_cf"])
    assert {r["year"]: r["mean_cf_ratio"] for r in got.collect()} == {1: 2.0, 2: None, 3: None}


def test_statistics_of_a_run(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (0.25,), (None,)], "cf double")
    assert tuple(diagnostics.cf_statistics(df).first()) == (3, 0.25, 0.5, 2 / 3, 0.375)


def test_region_log_text(spark):
    rows = [("A", 1.0, -0.1, day(2020, 1), 0.123456789), ("A", 1.0, -0.1, day(2020, 2), 0.123456789), ("A", 2.0, 5.0, day(2020, 1), None)]
    log = diagnostics.region_log(spark.createDataFrame(rows, "region string, lat double, lon double, t timestamp, cf double"))
    got = diagnostics.formatted_region_log(log).first().asDict()
    assert got == {"region": "A", "n_valid": 1, "n_time": 2, "mean_cf": "0.12345679", "lat_min": "1.0000", "lat_max": "2.0000",
                   "lon_min_0360": "5.0000", "lon_max_0360": "359.9000"}


def test_hot_region_gives_the_same_means(spark):
    """A third of all rows in one region, over few cells."""
    rng = np.random.default_rng(12)
    n = 30000
    region = np.where(rng.random(n) < 0.34, 0, rng.integers(1, 50, n))
    pdf = pd.DataFrame({"energy": "wind", "region": region.astype(str), "cell": region * 10 + rng.integers(0, 3, n),
                        "t": pd.Timestamp("2020-01-01") + pd.to_timedelta(rng.integers(0, 366 * 24, n), unit="h"), "cf": rng.random(n)})
    got = regions.region_annual_mean(spark.createDataFrame(pdf)).toPandas().set_index("region")
    cells = pdf.groupby(["region", "cell"])["cf"].mean().groupby("region").agg(["mean", "count"])
    np.testing.assert_allclose(got.loc[cells.index, "mean_cf"], cells["mean"])
    assert (got.loc[cells.index, "n_land_cells"] == cells["count"]).all()
    assert (got.loc[cells.index, "n_timesteps"] == pdf.groupby("region")["t"].nunique()[cells.index]).all()


def test_means_and_time_steps_come_from_one_scan(spark, folder, plan, mask):
    lattice_table(spark).withColumns({"region": F.lit("R"), "cell": F.col("lat_idx") * 1000 + F.col("lon_idx"), "lat": F.lit(1.0), "lon": F.lit(2.0)}).write.parquet(f"{folder}/cf")
    facts = spark.read.parquet(f"{folder}/cf")
    cells = spark.createDataFrame([("R", 500, 100, True), ("E", 1, 1, True)], "region string, gi_lat int, gi_lon int, is_land boolean")
    for job in (
        regions.region_annual_mean(facts, mask), regions.region_annual_mean_snapped(facts, cells), diagnostics.region_log(facts),
    ):
        assert sum("FileScan parquet" in line for line in plan(job).splitlines()) == 1
    got = {(r["region"], r["year"]): (r["n_timesteps"], r["n_land_cells"]) for r in regions.region_annual_mean_snapped(facts, cells).collect()}
    assert got == {("R", 2019): (4, 1), ("R", 2020): (4, 1), ("E", 2019): (4, 0), ("E", 2020): (4, 0)}
