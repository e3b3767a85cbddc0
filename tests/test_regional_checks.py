"""The regional jobs read the period only and refuse inputs that do not fit."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from gridyield.operators.accumulation import deaccumulate
from gridyield.operators.alignment import combine
from gridyield.operators.windpower import curve_knots
from gridyield.plans import annual, reanalysis, regional
from gridyield.sources import sinks
from gridyield.sources import tables as tables_

KNOTS = [(0.0, 0.0), (10.0, 2000.0), (25.0, 2000.0)]


def tables(spark, folder):
    hours = spark.sql("select cast(id % 3 as int) as cell, timestamp'2016-01-01' + make_interval(0, 0, 0, 0, cast(id div 3 as int) * 6, 0, 0) as t from range(900)")
    dated = hours.withColumns({"year": F.year("t"), "month": F.month("t"), "lat": F.lit(10.0), "lon": F.lit(20.0)})
    values = {"rsds": F.lit(500.0), "tas": F.lit(290.0), "uas": F.lit(3.0), "vas": F.lit(4.0)}
    for name in ("flux", "states"):
        dated.withColumns(values).write.partitionBy("year", "month").parquet(f"{folder}/{name}")
    flux = spark.read.parquet(f"{folder}/flux").select("cell", "lat", "lon", "t", "year", "month", "rsds")
    states = spark.read.parquet(f"{folder}/states").select("cell", "t", "year", "month", "tas", "uas", "vas")
    mask = spark.createDataFrame([(c, True) for c in range(3)], "cell int, is_land boolean")
    return flux, states, mask


def test_every_scan_is_cut_to_the_period(spark, folder, plan):
    flux, states, mask = tables(spark, folder)
    for shared in (True, False):
        text = plan(regional.solar(flux, states, mask, "2016", "3", shared_axis=shared))
        assert re.findall(r"PartitionFilters: \[(.*?)\]", text) and "PartitionFilters: []" not in text
    keys = ("cell", "t", "year", "month")
    text = plan(regional.wind(states.drop("vas"), states.drop("uas"), mask, KNOTS, 2000.0, "2016", "3", keys=keys))
    assert len(re.findall("PartitionFilters: ", text)) >= 2 and "PartitionFilters: []" not in text


def test_padding_keeps_the_borders_of_a_month(spark, folder):
    flux, states, mask = tables(spark, folder)
    shifted = flux.withColumn("t", F.col("t") + F.expr("interval 3 hours"))
    rising = states.withColumn("tas", F.lit(250.0) + F.unix_timestamp("t") % 1000)
    for shared in (True, False):
        whole = {tuple(r) for r in regional.solar(shifted, rising, mask, shared_axis=shared).where("month = 3").collect()}
        assert whole == {tuple(r) for r in regional.solar(shifted, rising, mask, "2016", "3", shared_axis=shared).collect()}


def test_inputs_that_do_not_fit_end_the_job(spark, folder):
    flux, states, mask = tables(spark, folder)
    absent, doubled = states.where("cell <> 1"), states.unionByName(states.where("cell = 2 and t = timestamp'2016-01-20 06:00:00'"))
    for shared in (True, False):
        for bad in (absent, doubled):
            with pytest.raises(Exception, match="no states|no source rows|does not increase"):
                regional.solar(flux, bad, mask, shared_axis=shared).collect()
        assert regional.solar(flux, states, mask, shared_axis=shared).count() == 900
    with pytest.raises(Exception, match="a step is missing|no states"):
        regional.solar(flux, states.where("cell <> 1 or hour(t) <> 6"), mask).collect()
    assert regional.solar(flux, states.where("cell <> 1 or hour(t) <> 6"), mask, check=False).count() == 900


def test_no_job_runs_while_the_regional_plan_is_built(spark, folder):
    flux, states, mask = tables(spark, folder)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    for shared in (True, False):
        regional.solar(flux, states, mask, "2016", "3", shared_axis=shared)
    assert not tracker.getJobIdsForGroup("planning")
    spark.sparkContext.setJobGroup("", "")


def separate(spark, folder):
    """Three hourly variables of four cells over two months, as tables of their own."""
    rows = spark.sql("""select cast(id % 4 as int) as cell, timestamp'2020-01-30' + make_interval(0, 0, 0, 0, cast(id div 4 as int), 0, 0) as t from range(400)""")
    dated = rows.withColumns({"lat": F.col("cell") * 10.0, "lon": F.lit(5.0), "year": F.year("t"), "month": F.month("t"), "ssrd": F.hour("t") * 1e5,
                              "t2m": F.lit(280.0), "u10": F.lit(3.0), "v10": F.lit(4.0)})
    dated.write.partitionBy("year", "month").parquet(f"{folder}/months")
    stored = spark.read.parquet(f"{folder}/months")
    return stored, {v: stored.select("cell", "lat", "lon", "t", "year", "month", v) for v in ("ssrd", "t2m", "u10", "v10")}


def test_separate_variables_must_share_their_grid(spark, folder):
    stored, delivered = separate(spark, folder)
    mask = spark.createDataFrame([(c, True) for c in range(4)], "cell int, is_land boolean")
    whole = {tuple(r) for r in reanalysis.solar(stored, mask).select("cell", "t", "cf").collect()}
    assert whole == {tuple(r) for r in reanalysis.solar(delivered, mask).select("cell", "t", "cf").collect()}
    one = delivered["u10"].where("cell = 2 and t = timestamp'2020-01-31 05:00:00'")
    for bad, text in (
        (delivered["u10"].where("cell <> 3"), "u10 lacks a step"), (delivered["u10"].unionByName(one), "u10 has a step twice"),
        (delivered["u10"].withColumn("lat", F.col("lat") + 0.1), "differ in lat"),
    ):
        with pytest.raises(Exception, match=text):
            reanalysis.solar({**delivered, "u10": bad}, mask).collect()
    lost = Observation("lost")
    kept = combine({**delivered, "u10": delivered["u10"].where("cell <> 3")}, strict=False, lost=lost)
    assert kept.count() == 300 and lost.get == {"missing_ssrd": 0, "missing_t2m": 0, "missing_u10": 100, "missing_v10": 0, "lost": 100}


def test_month_tails_spare_the_month_before(spark, folder, plan):
    stored, _ = separate(spark, folder)
    mask = spark.createDataFrame([(c, True) for c in range(4)], "cell int, is_land boolean")
    sinks.write_month_tails(stored, f"{folder}/tails")
    tails = tables_.tails_before(spark, f"{folder}/tails", "2020", "2")
    job = reanalysis.solar(stored, mask, "2020", "2", policy="nan", tails=tails)
    scans = [line for line in plan(job).splitlines() if "FileScan" in line and "/months" in line]
    assert len(scans) == 1 and "month#" in scans[0].split("PartitionFilters:")[1]
    assert {tuple(r) for r in job.collect()} == {tuple(r) for r in reanalysis.solar(stored, mask, "2020", "2", policy="nan").collect()}
    # A month without the one before it: no tail, so the policy decides.
    first = deaccumulate(stored.where("month = 2"), "ssrd", policy="current", tails=tails.where("month = 7"))
    assert first.where("t = timestamp'2020-02-01 00:00:00' and increment <> ssrd").count() == 0


def test_no_difference_across_a_missing_month(spark):
    rows = [(1, dt.datetime(2020, 1, 31, 23), 900.0), (1, dt.datetime(2020, 3, 1, 0), 1000.0), (1, dt.datetime(2020, 4, 1, 0), 1100.0)]
    df = spark.createDataFrame(rows, "cell int, t timestamp, ssrd double")
    for policy, first in (("zero", 0.0), ("nan", None), ("current", 1000.0)):
        got = [r.increment for r in deaccumulate(df, "ssrd", policy=policy).orderBy("t").collect()]
        assert got[1:] == [first, 100.0]


def test_land_is_found_in_both_conventions(spark):
    grid = spark.createDataFrame([("R", 10.0, 350.0), ("R", 10.0, 20.0)], "region string, lat double, lon double")
    land = spark.createDataFrame([(10.0, -10.0, True), (10.0, 20.0, False)], "lat double, lon double, is_land boolean")
    assert {(r.lon, r.is_land) for r in annual.region_cells(grid, land).collect()} == {(350.0, True), (20.0, False)}
    with pytest.raises(ValueError):
        annual.region_cells(grid, land.where("lon > 0"))


def test_one_curve_at_a_time(spark):
    curves = spark.createDataFrame([("a", 3.0, 0.0), ("b", 3.0, 1.0)], "turbine string, ws double, power_kw double")
    with pytest.raises(ValueError):
        curve_knots(curves)
    assert curve_knots(curves.where("turbine = 'a'")) == [(3.0, 0.0)]
