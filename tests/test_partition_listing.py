"""Written partitions are found from the folders alone."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from gridyield.sources import sinks


def test_no_file_is_opened(spark, folder):
    df = spark.range(8).select(
        F.lit("solar").alias("energy"), F.concat(F.lit("R/="), F.col("id") % 2).alias("region"), (F.col("id") % 2 + 2020).cast("int").alias("year"),
        F.lit(3).alias("month"), F.col("id").alias("cell"), F.lit(0.5).alias("cf"))
    path = f"{folder}/cf"
    assert sinks.existing_partitions(spark, path, ["year"]) is None
    df.write.partitionBy("energy", "region", "year", "month").parquet(path)
    for top, _, names in os.walk(path):  # what stands in the files does not matter
        for name in names:
            if name.endswith(".parquet"):
                with open(os.path.join(top, name), "wb") as file:
                    file.write(b"no parquet")
    got = sinks.existing_partitions(spark, path, ["region", "year", "month"])
    assert sorted(map(tuple, got.collect())) == [("R/=0", 2020, 3), ("R/=1", 2021, 3)]
    wanted = spark.createDataFrame([("R/=0", 2020, 3), ("R/=0", 2021, 3)], "region string, year int, month int")
    assert [tuple(r) for r in sinks.pending_partitions(wanted, path, ["region", "year", "month"]).collect()] == [("R/=0", 2021, 3)]
