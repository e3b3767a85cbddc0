"""Which periods exist, which are complete and which are missing."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridyield.functions.calendar import parse_months, parse_years
from gridyield.operators.alignment import fail_if


def year_month_spine(spark, years, months="") -> DataFrame:
    """Requested (year, month) rows."""
    first, last = parse_years(years)
    return spark.range(first, last + 1).select(
        F.col("id").cast("int").alias("year"), F.explode(F.lit(parse_months(months))).alias("month")
    )


def observed_spine(df: DataFrame, keys: Sequence[str] = (), months="", year: str = "year") -> DataFrame:
    """All (key, year, month) between the first and the last observed year of each key."""
    span = df.groupBy(*keys).agg(F.min(year).alias("_y0"), F.max(year).alias("_y1"))
    return span.select(*keys, F.explode(F.sequence("_y0", "_y1")).alias("year")).select(
        *keys, "year", F.explode(F.lit(parse_months(months))).alias("month")
    )


def available_years(df: DataFrame, keys: Sequence[str] = (), years=None) -> DataFrame:
    out = df.select(*keys, "year").distinct()
    if years:
        first, last = parse_years(years)
        out = out.where(F.col("year").between(first, last))
    return out


def missing_months(spine: DataFrame, available: DataFrame, on: Sequence[str] = ("year", "month")) -> DataFrame:
    return spine.join(available.select(*on).distinct(), list(on), "left_anti")


def common_years(df: DataFrame, variables: Sequence[str], variable: str = "var", keys: Sequence[str] = ()) -> DataFrame:
    """Years for which every variable exists."""
    present = df.where(F.col(variable).isin(list(variables))).select(*keys, "year", variable).distinct()
    return (
        present.groupBy(*keys, "year")
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") == len(set(variables)))
        .drop("_n")
    )


def missing_years(df: DataFrame, variables: Sequence[str], variable: str = "var", keys: Sequence[str] = ()) -> DataFrame:
    """Years some variable has and another lacks: (keys, year, variable)."""
    present = df.where(F.col(variable).isin(list(variables))).select(*keys, "year", variable).distinct()
    wanted = present.select(*keys, "year").distinct().withColumn(variable, F.explode(F.lit(list(variables))))
    return wanted.join(present, [*keys, "year", variable], "left_anti")


def pending(requested: DataFrame, existing: DataFrame, on: Sequence[str], overwrite: bool = False) -> DataFrame:
    """Requested outputs that are not there yet; all of them when overwriting."""
    if overwrite:
        return requested
    return requested.join(existing.select(*on).distinct(), list(on), "left_anti")


def source_intervals(sources: dict[str, DataFrame], t: str = "t") -> DataFrame:
    """(source, first, last, n_rows) of tables that are to follow each other: one narrow pass, a row per source."""
    parts = [df.select(F.lit(name).alias("source"), F.col(t).alias("_t")) for name, df in sources.items()]
    return reduce(DataFrame.unionByName, parts).groupBy("source").agg(
        F.min("_t").alias("first"), F.max("_t").alias("last"), F.count(F.lit(1)).alias("n_rows")
    )


def interval_issues(intervals: DataFrame, step: str | None = None) -> DataFrame:
    """Sources that begin before all earlier ones have ended (``overlap``), or with ``step`` later than one step after them (``gap``).

    Rows: source, issue, first, ends (the last time of the earlier ones). ``intervals`` has a row per source.
    """
    before = W.orderBy("first", "last", "source").rowsBetween(W.unboundedPreceding, -1)
    ends = intervals.where(F.col("first").isNotNull()).withColumn("ends", F.max("last").over(before))
    gap = F.col("first") > F.col("ends") + F.expr(f"interval {step}") if step else F.lit(False)
    issue = F.when(F.col("first") <= F.col("ends"), "overlap").when(gap, "gap")
    return ends.withColumn("issue", issue).where(F.col("issue").isNotNull()).select("source", "issue", "first", "ends")


def concat(
    sources: dict[str, DataFrame], t: str = "t", step: str | None = None, intervals: DataFrame | None = None, refuse: Sequence[str] = ("overlap",)
) -> DataFrame:
    """The rows of tables that follow each other in time, with the name of their ``source``.

    The job ends where sources have an issue of those in ``refuse``. What the sources span comes from a pass over their time columns, or
    from ``intervals`` (source, first, last), for instance of footers; it is part of the query, so nothing runs before it.
    """
    known = source_intervals(sources, t) if intervals is None else intervals
    issues = interval_issues(known, step).where(F.col("issue").isin(list(refuse)))
    text = F.concat("issue", F.lit(" of "), "source", F.lit(" at "), F.col("first").cast("string"), F.lit(" and "), F.col("ends").cast("string"))
    problem = issues.agg(F.min(text).alias("problem")).scalar()
    rows = reduce(DataFrame.unionByName, [df.withColumn("source", F.lit(name)) for name, df in sources.items()])
    return rows.withColumn(t, fail_if(problem, F.col(t), dict(rows.dtypes)[t]))
