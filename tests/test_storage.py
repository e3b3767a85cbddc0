"""Bucketed tables, choices that reach the scan, footers, calendars without leap days."""

from __future__ import annotations

import datetime as dt
import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from gridyield.checks import cases_storage
from gridyield.checks.all_cases import QUERIES
from gridyield.checks.relations import Data
from gridyield.functions.calendars import STANDARD, calendar_of, with_calendar
from gridyield.operators import accumulation, alignment, interpolation
from gridyield.sources import bucketed, catalog, footers, tables


def hourly(spark, cells=5, hours=200, start="2020-01-01"):
    return spark.sql(
        f"select cast(id % {cells} as int) as cell, timestamp'{start}' + make_interval(0, 0, 0, 0, cast(id div {cells} as int), 0, 0) as t, "
        f"cast(id as double) as value from range({cells * hours})"
    )


@pytest.fixture()
def buckets(spark, folder):
    fine, coarse = hourly(spark), hourly(spark).where("hour(t) % 3 = 0")
    for name, df in (("fine", fine), ("coarse", coarse)):
        bucketed.write_bucketed(df, f"{folder}/{name}", 4)
    return fine, coarse, *(bucketed.read_bucketed(spark, f"{folder}/{name}", 4) for name in ("fine", "coarse"))


def test_bucketed_tables_meet_without_an_exchange(spark, folder, plan, buckets):
    fine, coarse, a, b = buckets
    assert len(glob.glob(f"{folder}/fine/*.parquet")) <= 4
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = alignment.align_inner(a, b.withColumnRenamed("value", "other"))
        lines = plan(joined)
        assert "SortMergeJoin" in lines and "Exchange" not in lines and lines.count("Bucketed: true") == 2
        interpolation.bracket_table(fine.select("t").distinct(), coarse.select("t").distinct()).write.parquet(f"{folder}/brackets")
        brackets = spark.read.parquet(f"{folder}/brackets")  # its size is known, so it is sent and not shuffled
        found = a.drop("value").join(interpolation.interpolate_shared_axis(brackets, b, ["value"], check=True), ["cell", "t"], "left")
        assert "Exchange hashpartitioning" not in plan(found)
        plain = fine.drop("value").join(interpolation.interpolate_shared_axis(brackets, coarse, ["value"]), ["cell", "t"], "left")
        assert {tuple(r) for r in found.collect()} == {tuple(r) for r in plain.collect()}
        assert joined.count() == coarse.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_only_chosen_files_are_read(spark, folder, plan):
    for name, value in (("a", 1.0), ("b", 2.0), ("c", 3.0)):
        hourly(spark).withColumn("value", F.lit(value)).repartition(2).write.partitionBy("cell").parquet(f"{folder}/{name} x")
    one = glob.glob(f"{folder}/c x/cell=3/*.parquet")[0]
    chosen = spark.createDataFrame([(f"{folder}/b x", "B", 7), (one, "C", 8)], "path string, kind string, n int")
    df = tables.scan_chosen(chosen, ["kind", "n"])
    assert {(r.kind, r.n, r.value) for r in df.select("kind", "n", "value").distinct().collect()} == {("B", 7, 2.0), ("C", 8, 3.0)}
    assert not any("/a%20x/" in f for f in df.inputFiles())
    assert df.where("kind = 'B'").count() == 1000 and {r.cell for r in df.where("kind = 'C'").select("cell").distinct().collect()} == {3}
    typed = tables.scan_chosen(chosen, ["kind"], ddl="t timestamp, value float, cell bigint")
    assert dict(typed.dtypes) == {"t": "timestamp", "value": "float", "cell": "bigint", "kind": "string"}
    assert typed.where("kind = 'B'").select("cell").distinct().count() == 5
    assert tables.scan_chosen(chosen.limit(0)) is None
    with pytest.raises(ValueError):
        tables.scan_chosen(chosen.unionByName(chosen))


def test_footers_are_read_without_data_pages(spark, folder):
    long = hourly(spark, cells=1, hours=30_000, start="2019-12-20")
    long.orderBy("t").coalesce(1).write.option("parquet.block.size", 40_000).parquet(f"{folder}/long")
    long.withColumn("year", F.year("t")).repartition("year").write.partitionBy("year").parquet(f"{folder}/years")
    files = catalog.list_files(spark, folder, "*.parquet")
    with_data = {(os.path.dirname(r.path).rsplit("/", 1)[-1], r.year) for r in footers.years_of_files(files).collect()}
    assert with_data == {("long", y) for y in range(2019, 2024)} | {(f"year={y}", y) for y in range(2019, 2024)}
    before = sorted(map(tuple, footers.footer_ranges(files).collect()))
    assert sum(r[2] for r in before) == 60_000 and before[0][4].replace(tzinfo=None) >= dt.datetime(2019, 12, 20)
    for path in glob.glob(f"{folder}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(path).metadata
        first = meta.row_group(0).column(0)
        with open(path, "r+b") as file:
            file.seek(4)
            file.write(b"\0" * (first.total_compressed_size - 4))
    assert sorted(map(tuple, footers.footer_ranges(files).collect())) == before
    clear = files.where("path like '%/years/%'")
    assert {r.year for r in footers.years_of_files(clear).collect()} == set(range(2019, 2024))  # one year a file: no page is touched


def test_files_without_statistics_are_read(spark, folder):
    spark.conf.set("spark.sql.parquet.outputTimestampType", "INT96")
    try:
        hourly(spark, hours=10_000).withColumn("t", F.when(F.col("cell") < 4, F.col("t"))).coalesce(1).write.parquet(f"{folder}/old")
    finally:
        spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    files = catalog.list_files(spark, folder, "*.parquet")
    assert {(r.least, r.most) for r in footers.footer_ranges(files).collect()} == {(None, None)}
    assert {r.year for r in footers.years_of_files(files).collect()} == {2020, 2021}
    with pytest.raises(Exception, match="no column"):
        footers.footer_ranges(files, "time").collect()


@pytest.mark.parametrize(("name", "months"), [("noleap", [31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31]), ("360_day", [30] * 12)])
def test_days_without_leap_years(spark, name, months):
    calendar = calendar_of(name, (1999, 12, 15))
    got = {r.t: (r.year, r.month, r.day, r.doy, round(r.hour, 6)) for r in with_calendar(
        spark.range(-800, 1200).select((F.col("id") + F.lit(1) / 3).alias("t")), calendar).withColumn("day", calendar.day(F.col("t"))).collect()}
    year, month, day = 1999, 12, 15
    forward, date = {}, (year, month, day)
    for k in range(1200):
        forward[k] = date
        year, month, day = date
        date = (year, month, day + 1) if day < months[month - 1] else (year, month + 1, 1) if month < 12 else (year + 1, 1, 1)
    for k, (year, month, day) in forward.items():
        assert got[k + 1 / 3] == (year, month, day, sum(months[:month - 1]) + day, 8.0)
    assert got[-15 + 1 / 3][:3] == ((1999, 11, 30) if name == "360_day" else (1999, 11, 30))


def test_calendars_by_name():
    assert calendar_of("proleptic_gregorian") is STANDARD
    for bad in (("lunar", (2000, 1, 1)), ("noleap", None), ("noleap", (2000, 2, 29)), ("360_day", (2000, 1, 31))):
        with pytest.raises(ValueError):
            calendar_of(*bad)


def test_increments_across_months_of_360_days(spark):
    rows = spark.range(0, 24 * 70).select(F.lit(1).alias("cell"), (F.col("id") / 24.0).alias("t"), (F.pmod(F.col("id") - 1, F.lit(24)) + 1.0).alias("value"))
    calendar = calendar_of("360_day", (2001, 1, 1))
    got = [r.increment for r in accumulation.deaccumulate(rows, "value", policy="nan", calendar=calendar).orderBy("t").collect()]
    assert got[0] is None and set(got[1:]) == {1.0}
    tails = accumulation.month_tails(rows, "value", calendar=calendar)
    assert [(r.year, r.month) for r in tails.orderBy("month").collect()] == [(2001, 1), (2001, 2), (2001, 3)]
    second = rows.where("t >= 30 and t < 60")
    assert {r.increment for r in accumulation.deaccumulate(second, "value", policy="nan", tails=tails, calendar=calendar).collect()} == {1.0}


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="driver tables are not here")
def test_large_blocks_are_written_by_several_tasks(spark):
    data, sizes = Data(spark, "/root/testdata/sf0.001"), ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize")
    for key in sizes:
        spark.conf.set(key, "500b")
    try:
        root = cases_storage.by_block(data)
        found = {r.energy: r.n_candidates for r in QUERIES["first_file_with_year_footers"](spark, data.folder).collect()}
        years = [tuple(r) for r in QUERIES["years_of_files"](spark, data.folder).collect()]
    finally:
        for key in sizes:
            spark.conf.unset(key)
    files = glob.glob(f"{root.removeprefix('file:')}/*/*/*.parquet")
    assert len(files) > len({os.path.dirname(f) for f in files}) and set(found.values()) == {1} and len(set(years)) == len(years)
    assert spark.read.parquet(root).count() == data.cf_daily.count()
