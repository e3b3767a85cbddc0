"""Choice of input versions from a catalog of file names, as queries over the catalog.

Group choices are ``min_by`` aggregates: they merge map-side and need no window per group.
"""

from __future__ import annotations

import re
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridyield.constants import PREFERRED_PERIOD
from gridyield.functions.calendar import parse_years

# File-name formats, most specific first; ``*`` stands for any text, names in braces are columns.
COUNTRY_PATTERNS = (
    "{var}_3h_bcsd_on_0p1deg_{region}_{model}_{scenario}_*.nc",
    "{var}_*_{region}_{model}_{scenario}_*.nc",
    "{var}_*{scenario}*.nc",
)
CHINA_PATTERNS = (
    "{var}_3h_bcsd_on_0.1deg_china_{scenario}_*.nc",
    "{var}_*china_{scenario}_*.nc",
    "{var}_*{scenario}*.nc",
)
SOLAR_CF_PATTERNS = (
    "solar_CF_{region}_*_{scenario}_*.nc",
    "solar*{region}*{scenario}*.nc",
    "*solar*{scenario}*.nc",
    "*{scenario}*.nc",
)
WIND_CF_PATTERNS = (
    "wind_CF_{region}_*_{scenario}_*.nc",
    "wind*{region}*{scenario}*.nc",
    "*wind*{scenario}*.nc",
    "*{scenario}*.nc",
)
OTHER_CF_PATTERNS = ("*{region}*{scenario}*.nc", "*{scenario}*.nc")
CF_PATTERNS = {"solar": SOLAR_CF_PATTERNS, "wind": WIND_CF_PATTERNS, "auto": OTHER_CF_PATTERNS}
PERIOD_IN_NAME = r"_(\d{4})-(\d{4})\.nc$"
YEAR_IN_NAME = r"_(\d{4})\.nc$"
STAMP_IN_NAME = r"_(\d{4})\d{8}-\d{12}\.nc$"


def list_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """Catalog (path, name) of a folder tree. Only names are listed, no content is read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(root)
        .select("path", F.element_at(F.split("path", "/"), -1).alias("name"))
    )


def _number(text: Column) -> Column:
    return F.when(text != "", text).cast("int")


def add_file_period(catalog: DataFrame, name: str = "name") -> DataFrame:
    """``first_year``/``last_year`` of the file name, NULL where it has none."""
    single = F.regexp_extract(name, YEAR_IN_NAME, 1)
    first, last = F.regexp_extract(name, PERIOD_IN_NAME, 1), F.regexp_extract(name, PERIOD_IN_NAME, 2)
    return catalog.withColumns(
        {"first_year": F.coalesce(_number(first), _number(single)), "last_year": F.coalesce(_number(last), _number(single))}
    )


def _template_parts(template: str, columns: Sequence[str]) -> list[Column]:
    """Literal text between the stars of a name format, with braces filled from the row."""
    parts = []
    for piece in template.split("*"):
        fields = re.split(r"\{(\w+)\}", piece)
        missing = [f for f in fields[1::2] if f not in columns]
        if missing:
            raise ValueError(f"name format {template} needs the columns {missing}")
        texts = [F.col(f).cast("string") if i % 2 else F.lit(f) for i, f in enumerate(fields) if f]
        parts.append(F.concat(*texts) if texts else F.lit(""))
    return parts


def add_pattern_rank(catalog: DataFrame, patterns: Sequence[str], name: str, output: str = "_rank") -> DataFrame:
    """Position of the first name format that matches, NULL where none does.

    A name has a format when the texts between the stars occur in order, the first and the last one
    at the ends. Text positions in staged projections replace regular expressions, which would be
    compiled for every row because the formats depend on it.
    """
    df, temporary, rank = catalog, [], F.lit(None).cast("int")
    for i, template in reversed(list(enumerate(patterns))):
        parts = [f"_part_{i}_{j}" for j in range(template.count("*") + 1)]
        ends = [f"_end_{i}_{j}" for j in range(len(parts))]
        temporary += parts + ends
        df = df.withColumns(dict(zip(parts, _template_parts(template, catalog.columns))))
        if len(parts) == 1:
            rank = F.when(F.col(name) == F.col(parts[0]), F.lit(i)).otherwise(rank)
            continue
        # _end: first free position after the part, NULL once a part is not found
        start = F.when(F.col(name).startswith(F.col(parts[0])), F.length(parts[0]) + 1)
        df = df.withColumn(ends[0], start)
        for j in range(1, len(parts) - 1):
            at = F.position(F.col(parts[j]), F.col(name), F.col(ends[j - 1]))
            df = df.withColumn(f"_at_{i}_{j}", at).withColumn(
                ends[j], F.when(F.col(f"_at_{i}_{j}") > 0, F.col(f"_at_{i}_{j}") + F.length(parts[j]))
            )
            temporary.append(f"_at_{i}_{j}")
        tail = F.col(name).endswith(F.col(parts[-1])) & (F.length(name) - F.length(parts[-1]) + 1 >= F.col(ends[len(parts) - 2]))
        rank = F.when(tail, F.lit(i)).otherwise(rank)
    return df.withColumn(output, rank).drop(*temporary)


def match_patterns(
    catalog: DataFrame, patterns: Sequence[str], keys: Sequence[str], name: str = "name"
) -> DataFrame:
    """Files (keys, name) of the first format that matches anything for a key; files of later formats go.

    The rank is an aggregate per file: tests on it stay above the aggregate instead of being pushed,
    with all their text expressions, into the scan.
    """
    ranked = add_pattern_rank(catalog, patterns, name).groupBy(*keys, name).agg(F.min("_rank").alias("_rank"))
    best = ranked.groupBy(*keys).agg(F.min("_rank").alias("_rank"))
    return ranked.join(best, [*keys, "_rank"], "left_semi").drop("_rank")


def _version_order(years, path: str, *before: Column) -> Column:
    span = F.col("last_year") - F.col("first_year")
    covers = F.lit(False)
    if years:
        first, last = parse_years(years)
        covers = F.coalesce((F.col("first_year") <= first) & (F.col("last_year") >= last), F.lit(False))
    return F.struct(
        *before,
        F.when(covers, 0).when(F.col("first_year").isNotNull(), 1).otherwise(2),
        F.when(covers, span).otherwise(-span),
        F.col("first_year"),
        F.col(path),
    )


def best_version(
    catalog: DataFrame, keys: Sequence[str], years=None, path: str = "path", name: str = "path"
) -> DataFrame:
    """One file per key: narrowest period covering the request, else the widest, else the first by name."""
    dated = add_file_period(catalog, name)
    return dated.groupBy(*keys).agg(F.min_by(path, _version_order(years, path)).alias(path))


def find_files(
    catalog: DataFrame,
    patterns: Sequence[str],
    keys: Sequence[str],
    years=None,
    path: str = "path",
    name: str = "path",
) -> DataFrame:
    """One file per key: best version among those of the first format that matches, in one aggregate."""
    unmatched = len(patterns)
    ranked = add_pattern_rank(add_file_period(catalog, name), patterns, name)
    rank = F.coalesce("_rank", F.lit(unmatched))
    best = ranked.groupBy(*keys).agg(
        F.min_by(path, _version_order(years, path, rank)).alias(path), F.min(rank).alias("_best")
    )
    return best.where(F.col("_best") < unmatched).drop("_best")


def preferred_file(catalog: DataFrame, keys: Sequence[str], path: str = "path", mark: str = PREFERRED_PERIOD) -> DataFrame:
    """One file per key: the first by name among those with the preferred period, else the first."""
    order = F.struct(~F.col(path).contains(mark), F.col(path))
    return catalog.groupBy(*keys).agg(F.min_by(path, order).alias(path))


def first_with_year(
    catalog: DataFrame, contents: DataFrame, year: int, keys: Sequence[str], path: str = "path"
) -> DataFrame:
    """First file per key that really contains the year; ``contents`` has (path, year) of the data."""
    having = contents.where(F.col("year") == year).select(path).distinct()
    found = catalog.join(having, path, "left_semi")
    return found.groupBy(*keys).agg(F.min(path).alias(path), F.count(F.lit(1)).alias("n_candidates"))


def choose_cf_files(
    catalog: DataFrame,
    contents: DataFrame,
    year: int,
    technology: str = "auto",
    keys: Sequence[str] = ("region", "scenario"),
    path: str = "path",
) -> DataFrame:
    """Capacity-factor file per region for one year: formats of the technology in order, then the content."""
    matched = match_patterns(catalog, CF_PATTERNS[technology], keys, path)
    return first_with_year(matched, contents, year, keys, path)


def yearly_files(catalog: DataFrame, keys: Sequence[str], years, name: str = "name", path: str = "path") -> DataFrame:
    """File per key and year from the time stamp in the name, the last by name where several match."""
    first, last = parse_years(years)
    return (
        catalog.withColumn("year", _number(F.regexp_extract(name, STAMP_IN_NAME, 1)))
        .where(F.col("year").between(first, last))
        .groupBy(*keys, "year")
        .agg(F.max(path).alias(path))
    )


def is_valid_region(region: Column) -> Column:
    return (
        (region != "")
        & ~region.startswith("_")
        & ~region.endswith("_")
        & ~region.endswith("_repeated")
    )


def discover_regions(catalog: DataFrame, region: str = "region") -> DataFrame:
    return catalog.select(region).distinct().where(is_valid_region(F.col(region)))


def annual_regions(catalog: DataFrame, region: str = "region", extra: str = "china") -> DataFrame:
    """Regions of the annual job: all names without filtering, plus one more domain."""
    spark = catalog.sparkSession
    more = spark.range(1).select(F.lit(extra).alias(region))
    return catalog.select(region).unionByName(more).distinct()


def combinations(catalog: DataFrame) -> DataFrame:
    """(gcm, realization, rcm, scenario) present, without set-aside folders."""
    scenario = F.col("scenario")
    return (
        catalog.select("gcm", "realization", "rcm", "scenario")
        .where(~F.col("gcm").startswith("_") & ~scenario.startswith("_") & ~scenario.endswith("_"))
        .distinct()
    )
