"""Versioned tables, incremental means, concatenation, skewed axes."""

from __future__ import annotations

import glob
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridyield.operators import climate, coverage, increments, snapping
from gridyield.sources import versions


def days(spark, years=(2019, 2020, 2021), cells=4):
    lists = ", ".join(map(str, years))
    return spark.sql(f"""
        select cast(c as int) as cell, y as year, make_timestamp(y, m, d, 0, 0, 0) as t, cast(c + y * 0.37 + m * d * 0.11 as double) as cf
        from (select explode(array({lists})) as y), (select explode(sequence(0, {cells - 1})) as c), (select explode(sequence(1, 12)) as m),
          (select explode(array(1, 2, 15)) as d)""")


def rows_of(df):
    return sorted(map(tuple, df.select("cell", "year", "t", "cf").collect()))


def test_a_reader_sees_a_whole_table_while_it_is_rewritten(spark, folder):
    root, df = f"{folder}/cf", days(spark)
    versions.write_partitions(df, root, ["year"])
    before, seen = versions.read_current(spark, root), []

    def change(part):
        seen.append((rows_of(before), versions.read_current(spark, root).count()))
        return part.withColumn("cf", F.col("cf") * 0)

    versions.rewrite(spark, root, change, grace_seconds=3600)
    assert len(seen) == 3 and all(old == rows_of(df) and n == df.count() for old, n in seen)
    assert rows_of(before) == rows_of(df)  # a reader keeps what it found
    assert {r.cf for r in versions.read_current(spark, root).collect()} == {0.0}
    assert versions.vacuum(spark, root, 0) == 3 and versions.read_current(spark, root).count() == df.count()


def test_a_rewrite_that_fails_leaves_a_whole_table(spark, folder):
    root, df, calls = f"{folder}/cf", days(spark), []
    versions.write_partitions(df, root, ["year"])

    def change(part):
        calls.append(1)
        wrong = F.raise_error(F.lit("stop")).cast("double") if len(calls) == 2 else F.lit(1.0)
        return part.withColumn("cf", wrong)

    with pytest.raises(Exception, match="stop"):
        versions.rewrite(spark, root, change)
    got = versions.read_current(spark, root)
    assert got.count() == df.count() and {r.year for r in got.where("cf = 1").select("year").distinct().collect()} == {2019}


def test_remask_needs_the_space_of_one_partition(spark, folder):
    root, df = f"{folder}/cf", days(spark)
    versions.write_partitions(df, root, ["year"])
    mask, most = spark.createDataFrame([(0, True), (1, True), (2, False)], "cell int, is_land boolean"), []
    original = versions.vacuum

    def watched(*args):
        most.append(len({os.path.dirname(p) for p in glob.glob(f"{root}/**/*.parquet", recursive=True)}))
        return original(*args)

    versions.vacuum = watched
    try:
        versions.remask(spark, root, mask, grace_seconds=0)
    finally:
        versions.vacuum = original
    assert most == [4, 4, 4] and len(glob.glob(f"{root}/**/year=*", recursive=True)) == 3
    got = {(r.cell, r.cf is None) for r in versions.read_current(spark, root).collect()}
    assert got == {(0, False), (1, False), (2, True), (3, True)}


def test_partitions_are_replaced_and_added(spark, folder):
    root = f"{folder}/cf"
    with pytest.raises(FileNotFoundError):
        versions.read_current(spark, root)
    versions.write_partitions(days(spark, (2019, 2020)), root, ["year"])
    versions.write_partitions(days(spark, (2020, 2021), cells=2), root, ["year"])
    got = {r.year: r.n for r in versions.read_current(spark, root).groupBy("year").agg(F.countDistinct("cell").alias("n")).collect()}
    assert got == {2019: 4, 2020: 2, 2021: 2}
    versions.write_partitions(days(spark, (2022,)), root, ["year"], whole=True)
    assert {r.year for r in versions.read_current(spark, root).collect()} == {2022}
    with pytest.raises(ValueError):
        versions.write_partitions(days(spark, (2022,)), root, ["cell"])


def test_mean_of_stored_years_plus_one(spark, folder):
    root, df = f"{folder}/parts", days(spark, tuple(range(2010, 2020)))
    for years in ("year < 2019", "year = 2019", "year = 2012"):  # a year comes again
        versions.write_partitions(climate.profile_parts(df.where(years), steps_per_day=1), root, ["year"], clustering=["cell"])
    mask = spark.createDataFrame([(0, True), (1, False)], "cell int, is_land boolean")
    key = lambda r: (r.cell, r.month, r.position)
    grown = {key(r): r for r in climate.profile_of_parts(versions.read_current(spark, root), mask=mask).collect()}
    whole = {key(r): r for r in climate.mean_profile(df, mask=mask, steps_per_day=1).collect()}
    assert grown.keys() == whole.keys()
    assert all(grown[k].n_years == r.n_years == 10 and (grown[k].cf is None) == (r.cf is None) and abs((grown[k].cf or 0) - (r.cf or 0)) < 1e-9 for k, r in whole.items())
    empty = increments.mean_of_parts(increments.mean_parts(df.withColumn("cf", F.lit(None)), "cf", ["cell"]), ["cell"], count="n").collect()
    assert {(r.value, r.n) for r in empty} == {(None, 0)}


def test_sources_that_follow_each_other(spark):
    a, b, c = (days(spark, (y,)) for y in (2019, 2020, 2021))
    got = coverage.concat({"a": a, "b": b, "c": c})
    assert got.count() == 3 * a.count() and {r.source for r in got.select("source").distinct().collect()} == {"a", "b", "c"}
    with pytest.raises(Exception, match="overlap of c"):
        coverage.concat({"a": a, "b": b, "c": b.where("month(t) = 7")}).collect()
    with pytest.raises(Exception, match="gap of c"):
        coverage.concat({"a": a, "c": c}, step="40 days", refuse=("gap",)).collect()
    known = coverage.source_intervals({"a": a, "b": b})
    assert coverage.concat({"a": a, "b": b}, intervals=known, step="40 days", refuse=("gap", "overlap")).count() == 2 * a.count()
    assert coverage.interval_issues(coverage.source_intervals({"a": a.limit(0), "b": b})).count() == 0


def test_stretches_of_a_skewed_axis_hold_as_many_values(spark):
    n = 400_000
    skewed = spark.range(n).select((F.exp(F.col("id") * (18.0 / n))).alias("v"))  # most values lie close together
    borders = skewed.approxQuantile("v", [k / 64 for k in range(1, 64)], 1 / 512)
    sizes = [r.n for r in skewed.groupBy(snapping.stretch_of(F.col("v"), borders).alias("s")).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 64 and max(sizes) <= 2 * np.median(sizes)
    equal = [r.n for r in skewed.groupBy(F.floor(F.col("v") / (np.exp(18) / 64)).alias("s")).agg(F.count("*").alias("n")).collect()]
    assert max(equal) > 20 * np.median(equal)


def test_snapping_with_quantile_stretches_equals_brute_force(spark):
    draw = np.random.default_rng(4)
    axis, points = np.exp(draw.random(300) * 9).tolist(), (np.exp(draw.random(2000) * 9.2) - 1).tolist() + [-5.0, 1e9]
    got = snapping.snap_to_axis(spark.createDataFrame([(p,) for p in points], "x double"), "x", spark.createDataFrame([(a, a) for a in axis], "v double, at double"), "v", ["at"], chunks=17)
    for r in got.collect():
        assert abs(r.x - r.at) == min(abs(r.x - a) for a in axis)
    assert got.count() == len(points)
