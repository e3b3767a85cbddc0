"""Scans of partitioned Parquet tables.

Periods are filtered on the partition columns ``year`` and ``month``, other selections on the
partition columns of the source, so whole folders are skipped before a file is opened.
"""

from __future__ import annotations

import re
from typing import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridyield import schemas
from gridyield.functions.calendar import parse_months, parse_years
from gridyield.operators.filters import select_period
from gridyield.operators.sizing import MAX_BROADCAST_BYTES


def scan(
    spark: SparkSession, path: str, ddl: str | None = None, years=None, months="", **partitions
) -> DataFrame:
    """Read a table; keyword arguments select partition values (one value or a list)."""
    reader = spark.read if ddl is None else spark.read.schema(schemas.struct(ddl))
    df = reader.parquet(path)
    for column, value in partitions.items():
        df = df.where(F.col(column).isin(list(value)) if isinstance(value, (list, tuple)) else F.col(column) == value)
    return select_period(df, years, months) if years else df


def scan_chosen(
    chosen: DataFrame, attributes: Sequence[str] = (), path: str = "path", ddl: str | None = None, columns: Sequence[str] | None = None
) -> DataFrame | None:
    """Read exactly the files and folders that a choice from the catalog names; None if it names none.

    ``chosen`` has one row per path and the ``attributes`` that its rows get (variable, region, scenario, the path itself). The paths go to
    the driver, as those of any scan do; the attributes, and the values in folder names ``column=value``, come back by a join on the
    file name. The chosen folders may belong to different tables. The same path must not be chosen twice.
    """
    spark = chosen.sparkSession
    rows = chosen.select(F.col(path).alias("_path"), *[F.col(a).alias(f"_a_{a}") for a in attributes]).collect()
    if not rows:
        return None
    paths = [r["_path"] for r in rows]
    if len(set(paths)) < len(paths):
        raise ValueError("a path is chosen twice")
    # One scan for all. Folders of different tables have no common root, so Spark must not derive partition columns from it.
    reader = spark.read.option("recursiveFileLookup", "true")
    df = (reader if ddl is None else reader.schema(schemas.struct(ddl))).parquet(*paths)
    owner_of, files = {_plain(p): r for p, r in zip(paths, rows)}, []
    for name in df.inputFiles():
        parts = _plain(name).split("/")
        above = ("/".join(parts[:k]) for k in range(len(parts), 0, -1))
        files.append((_LOCAL.sub("file:/", name), owner_of[next(a for a in above if a in owner_of)], _partition_values(parts[:-1])))
    typed = dict(df.dtypes)
    inner = sorted({c for _, _, values in files for c in values if c not in typed or ddl is not None})
    if columns is not None:
        df, inner = df.select(*[c for c in columns if c not in inner]), [c for c in inner if c in columns]
    if not attributes and not inner:
        return df
    kinds = dict(chosen.dtypes)
    whole = {c: all(re.fullmatch(r"-?\d{1,9}", values.get(c) or "0") for _, _, values in files) for c in inner}
    facts = [
        (name, *owner[1:], *[None if values.get(c) is None else int(values[c]) if whole[c] else values[c] for c in inner]) for name, owner, values in files
    ]
    fields = ["_file string", *[f"`{a}` {kinds[a]}" for a in attributes], *[f"`{c}` {'int' if whole[c] else 'string'}" for c in inner]]
    tagged = df.drop(*inner).withColumn("_file", F.regexp_replace("_metadata.file_path", _LOCAL.pattern, "file:/"))
    names = spark.createDataFrame(facts, ", ".join(fields))
    small = sum(len(str(f)) for f in facts) <= MAX_BROADCAST_BYTES  # the list is here, so its size is known
    out = tagged.join(F.broadcast(names) if small else names, "_file").drop("_file")
    return out.withColumns({c: F.col(c).cast(typed[c]) for c in inner if c in typed})


def _partition_values(folders: list[str]) -> dict[str, str | None]:
    """Values in the names ``column=value`` of the innermost folders of a file."""
    values = {}
    for name in reversed(folders):
        column, mark, value = name.partition("=")
        if not mark:
            break
        values[column] = None if value == "__HIVE_DEFAULT_PARTITION__" else value
    return values


_LOCAL = re.compile("^file:/+")


def _plain(path: str) -> str:
    """A path without escapes, and without the scheme of local files."""
    return unquote(_LOCAL.sub("/", path)).rstrip("/")


def country_weather(spark, path, model, region, scenario, years=None, months="") -> DataFrame:
    return scan(spark, path, schemas.WEATHER_COUNTRY, years, months, model=model, region=region, scenario=scenario)


def china_weather(spark, path, model, scenario, years=None, months="") -> DataFrame:
    return scan(spark, path, schemas.WEATHER_CHINA, years, months, model=model, region="china", scenario=scenario)


def rotated_weather(spark, path, gcm, realization, rcm, scenario, years=None) -> DataFrame:
    """Rotated-pole grid; the cell key is made of the two grid indices."""
    df = scan(
        spark, path, schemas.WEATHER_ROTATED, years,
        gcm=gcm, realization=realization, rcm=rcm, scenario=scenario,
    )
    return df.withColumn("cell", F.col("rlat_i").cast("bigint") * F.lit(1 << 20) + F.col("rlon_i"))


def previous_month(year: int, month: int) -> tuple[int, int]:
    return (year - 1, 12) if month == 1 else (year, month - 1)


def reanalysis_weather(spark, path, years, months="", with_month_before: bool = False) -> DataFrame:
    """Reanalysis months; with the month before each, as the running totals need a predecessor."""
    df = scan(spark, path, schemas.WEATHER_REANALYSIS)
    if not with_month_before:
        return select_period(df, years, months)
    first, last = parse_years(years)
    wanted = [(y, m) for y in range(first, last + 1) for m in parse_months(months)]
    periods = sorted({p for y, m in wanted for p in ((y, m), previous_month(y, m))})
    return df.where((F.col("year") * F.lit(12) + F.col("month")).isin([y * 12 + m for y, m in periods]))


def tails_before(spark, path, years, months="") -> DataFrame:
    """Last steps of the months before the requested ones (``sinks.write_month_tails``); only their folders are read."""
    first, last = parse_years(years)
    before = {previous_month(y, m) for y in range(first, last + 1) for m in parse_months(months)}
    df = spark.read.parquet(path)
    return df.where((F.col("year") * F.lit(12) + F.col("month")).isin([y * 12 + m for y, m in sorted(before)]))


def capacity_factors(spark, path, years=None, months="", **partitions) -> DataFrame:
    return scan(spark, path, schemas.CF, years, months, **partitions)
