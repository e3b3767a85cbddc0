"""Result tables on shared storage.

Parquet writes commit as a whole through Spark's commit protocol. Tables that are read and
rewritten go through a staging folder that takes the place of the old one at the end.
"""

from __future__ import annotations

import uuid
from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridyield import schemas
from gridyield.operators.accumulation import month_tails
from gridyield.operators.coverage import pending
from gridyield.operators.diagnostics import formatted_region_log
from gridyield.operators.masking import apply_land_mask
from gridyield.operators.upsert import upsert_sorted

CF_PARTITIONS = ("energy", "source", "region", "scenario", "year", "month")
ROTATED_PARTITIONS = ("energy", "gcm", "realization", "rcm", "scenario", "year")
CLUSTERING = ("cell", "t")


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _filesystem(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _filesystem(spark, path).exists(_path(spark, path))


def replace_folder(spark: SparkSession, staged: str, path: str) -> None:
    """Put a complete staged folder in the place of the old one."""
    fs, target = _filesystem(spark, path), _path(spark, path)
    old = _path(spark, f"{path}.old-{uuid.uuid4().hex}")
    had_old = fs.exists(target)
    if had_old and not fs.rename(target, old):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(_path(spark, staged), target):
        if had_old:
            fs.rename(old, target)
        raise OSError(f"cannot move {staged} to {path}")
    if had_old:
        fs.delete(old, True)


def write_staged(df: DataFrame, path: str, write: Callable[[DataFrame, str], None]) -> None:
    """Write next to ``path`` and swap; on an error nothing of it stays."""
    spark = df.sparkSession
    staged = f"{path}.staging-{uuid.uuid4().hex}"
    try:
        write(df, staged)
        replace_folder(spark, staged, path)
    except BaseException:
        _filesystem(spark, staged).delete(_path(spark, staged), True)
        raise


def _write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def partition_folders(spark: SparkSession, path: str) -> list[list[tuple[str, str]]]:
    """(column, value) pairs of the folders that hold data files, as they are spelled in the names."""
    fs, root = _filesystem(spark, path), _path(spark, path)
    depth = 0
    while fs.globStatus(_path(spark, path + "/*=*" * (depth + 1))):
        depth += 1
    base = fs.getFileStatus(root).getPath().toString()
    found = set()
    for status in fs.globStatus(_path(spark, path + "/*=*" * depth + "/*.parquet")) or []:
        found.add(status.getPath().getParent().toString()[len(base):].strip("/"))
    return [[tuple(part.split("=", 1)) for part in name.split("/") if part] for name in sorted(found)]


def _partition_folders(spark: SparkSession, path: str) -> list[dict[str, str | None]]:
    """Partition values of the folders that hold data files."""
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    return [
        {k: None if v == "__HIVE_DEFAULT_PARTITION__" else unescape(v) for k, v in pairs} for pairs in partition_folders(spark, path)
    ]


def existing_partitions(spark: SparkSession, path: str, on: Sequence[str]) -> DataFrame | None:
    """Partition values already written, from a listing of the folders: no file is opened."""
    if not exists(spark, path):
        return None
    rows = {tuple(r.get(c) for c in on) for r in _partition_folders(spark, path)}
    if not rows:
        return None
    text = spark.createDataFrame(sorted(rows, key=str), ", ".join(f"{c} string" for c in on))
    types = {c: "int" for c in ("year", "month")}
    return text.select(*[F.col(c).cast(types.get(c, "string")).alias(c) for c in on])


def pending_partitions(requested: DataFrame, path: str, on: Sequence[str], overwrite: bool = False) -> DataFrame:
    have = existing_partitions(requested.sparkSession, path, on)
    return requested if have is None else pending(requested, have, on, overwrite)


def write_cf(
    df: DataFrame,
    path: str,
    partitions: Sequence[str] = CF_PARTITIONS,
    clustering: Sequence[str] = CLUSTERING,
    provenance: dict[str, str] | None = None,
) -> None:
    """Capacity factors, partitioned for pruning and clustered by cell inside each partition.

    The rebalance hint spreads a partition that is much larger than others over several files and
    merges small ones, so neither a hot region nor many small months matter. Only the partitions
    contained in ``df`` are replaced.
    """
    columns = {k: F.lit(v) for k, v in (provenance or {}).items()}
    out = df.withColumns(columns) if columns else df
    (
        out.hint("rebalance", *partitions)
        .sortWithinPartitions(*partitions, *clustering)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(*partitions)
        .parquet(path)
    )


def write_month_tails(
    df: DataFrame, path: str, value: str = "ssrd", keys: Sequence[str] = ("cell",), t: str = "t"
) -> None:
    """The last step of every key and month next to the months themselves; months in ``df`` replace their former rows."""
    (
        month_tails(df, value, keys, t)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy("year", "month")
        .parquet(path)
    )


def write_climatology(df: DataFrame, path: str, provenance: dict[str, str] | None = None) -> None:
    columns = {k: F.lit(v) for k, v in (provenance or {}).items()}
    out = df.withColumns(columns) if columns else df
    write_staged(out, path, lambda d, p: d.write.option("compression", "zstd").parquet(p))


def write_mosaic(merged: DataFrame, path: str, technology: str, provenance: dict[str, str] | None = None) -> None:
    """Yearly mean and overlap count per lattice cell."""
    name = {"solar": "solar_cf_yearmean", "wind": "wind_cf_yearmean"}.get(technology, "cf_yearmean")
    write_climatology(merged.withColumnRenamed("cf", name), path, provenance)


def upsert_csv(
    spark: SparkSession, path: str, new: DataFrame, keys: Sequence[str], ddl: str, overwrite: bool = False
) -> DataFrame:
    """Merge rows into a CSV table: new rows replace old ones with the same key, sorted by key."""
    schema = schemas.struct(ddl)
    old = None
    if not overwrite and exists(spark, path):
        old = spark.read.schema(schema).option("header", True).csv(path)
    fresh = new.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
    write_staged(upsert_sorted(old, fresh, keys, overwrite=overwrite), path, _write_csv)
    return spark.read.schema(schema).option("header", True).csv(path)


def write_region_log(log: DataFrame, path: str) -> None:
    names = schemas.struct(schemas.REGION_LOG).names
    text = formatted_region_log(log)
    write_staged(text.select(*[c for c in names if c in text.columns]).orderBy("region"), path, _write_csv)


def write_monthly_means(means: DataFrame, path: str) -> None:
    names = schemas.struct(schemas.MONTHLY_MEAN).names
    write_staged(means.select(*names).orderBy("year", "month"), path, _write_csv)


def remask(
    spark: SparkSession, source: str, mask: DataFrame, target: str | None = None, value: str = "cf",
    partitions: Sequence[str] = CF_PARTITIONS, overwrite: bool = False,
) -> None:
    """Set ocean values of a written table to NULL, in place or into another table.

    The new table is complete before it takes the place of the old one, so it needs the space twice.
    """
    if target and not overwrite and exists(spark, target):
        return
    df = spark.read.parquet(source)
    kept = [c for c in partitions if c in df.columns]
    masked = apply_land_mask(df, mask, [value])
    write_staged(masked, target or source, lambda d, p: write_cf(d, p, kept))
