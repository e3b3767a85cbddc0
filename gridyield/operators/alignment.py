"""Alignment of variables on common keys and reports of what does not fit."""

from __future__ import annotations

from typing import Sequence

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from gridyield.constants import GRID_TOLERANCE
from gridyield.operators.neighbours import with_previous


def align_inner(left: DataFrame, right: DataFrame, on: Sequence[str] = ("cell", "t")) -> DataFrame:
    """Rows whose keys exist on both sides; the time is always the joined key."""
    return left.join(right, list(on), "inner")


def combine(
    variables: dict[str, DataFrame], keys: Sequence[str] = ("cell",), t: str = "t", strict: bool = True,
    lost: Observation | None = None, tolerance: float = GRID_TOLERANCE,
) -> DataFrame:
    """Variables delivered as tables of their own side by side: keys, t, lat, lon where given, and a column per variable.

    All tables meet in one aggregate on (keys, t), whose counts and extremes are also the check of the grids: a step that a variable has twice
    and coordinates further apart than ``tolerance`` fail the job while it runs. With ``strict`` so does a step that a variable lacks;
    without, only rows that all variables have stay, and ``lost`` observes how many rows each
    variable was missing in (``missing_<name>``) and how many went (``lost``). Nothing runs while the plan is built.
    """
    names, on = list(variables), [*keys, t]
    kinds = {n: dict(df.dtypes)[n] for n, df in variables.items()}
    places = [c for c in ("lat", "lon") if any(c in df.columns for df in variables.values())]

    def stacked(name: str, df: DataFrame) -> DataFrame:
        there = [F.col(c).cast("double") if c in df.columns else F.lit(None).cast("double").alias(c) for c in places]
        values = [F.col(n) if n == name else F.lit(None).cast(kinds[n]).alias(n) for n in names]
        return df.select(*on, *there, *values, F.lit(names.index(name)).alias("_of"))

    rows = reduce(DataFrame.unionByName, [stacked(n, df) for n, df in variables.items()])
    met = rows.groupBy(*on).agg(
        *[F.min(c).alias(c) for c in places],
        *[(F.max(c) - F.min(c)).alias(f"_spread_{c}") for c in places],
        *[F.max(n).alias(n) for n in names],
        *[F.count_if(F.col("_of") == k).alias(f"_n_{n}") for k, n in enumerate(names)],
    )
    every = reduce(Column.__and__, [F.col(f"_n_{n}") > 0 for n in names])
    if lost is not None:
        counts = [F.count_if(F.col(f"_n_{n}") == 0).alias(f"missing_{n}") for n in names]
        met = met.observe(lost, *counts, F.count_if(~every).alias("lost"))
    if not strict:
        met = met.where(every)
    where = F.concat_ws(", ", *[F.col(c).cast("string") for c in on])
    checks = [(F.col(f"_n_{n}") > 1, f"{n} has a step twice at ") for n in names]
    checks += [(F.col(f"_n_{n}") == 0, f"{n} lacks a step at ") for n in names] if strict else []
    checks += [(F.col(f"_spread_{c}") > tolerance, f"the variables differ in {c} at ") for c in places]
    problem = F.coalesce(*[F.when(bad, F.concat(F.lit(text), where)) for bad, text in checks])
    return met.select(*on, *places, *[fail_if(problem, F.col(n), kinds[n]).alias(n) for n in names])


def alignment_report(variables: dict[str, DataFrame], keys: Sequence[str] = ("cell",), t: str = "t") -> DataFrame:
    """What an alignment of the variables keeps and loses: (variable, n_rows, n_kept, n_lost, n_doubled), one aggregate for all."""
    names, on = list(variables), [*keys, t]
    rows = reduce(DataFrame.unionByName, [df.select(*on, F.lit(n).alias("variable")) for n, df in variables.items()])
    steps = rows.groupBy(*on).agg(*[F.count_if(F.col("variable") == n).alias(f"_n_{k}") for k, n in enumerate(names)])
    every = reduce(Column.__and__, [F.col(f"_n_{k}") > 0 for k in range(len(names))])
    counts = F.explode(F.array(*[F.struct(F.lit(n).alias("variable"), F.col(f"_n_{k}").alias("n")) for k, n in enumerate(names)])).alias("x")
    return (
        steps.select(every.alias("_every"), counts).groupBy(F.col("x.variable").alias("variable"))
        .agg(
            F.sum("x.n").alias("n_rows"),
            F.coalesce(F.sum(F.when(F.col("_every"), F.col("x.n"))), F.lit(0)).alias("n_kept"),
            F.coalesce(F.sum(F.when(~F.col("_every"), F.col("x.n"))), F.lit(0)).alias("n_lost"),
            F.count_if(F.col("x.n") > 1).alias("n_doubled"),
        )
    )


def fail_if(problem: Column, value: Column, kind: str) -> Column:
    """``value``, or an error that ends the job where ``problem`` is a text. It stands in a projection, so no optimizer moves it."""
    return F.when(problem.isNull(), value).otherwise(F.raise_error(problem).cast(kind))


def time_axis_report(reference: DataFrame, other: DataFrame, t: str = "t") -> DataFrame:
    """Time steps present on one side only: (t, issue)."""
    a = reference.select(t).distinct().withColumn("_a", F.lit(True))
    b = other.select(t).distinct().withColumn("_b", F.lit(True))
    issue = F.when(F.col("_b").isNull(), "missing_in_other").when(F.col("_a").isNull(), "missing_in_reference")
    return a.join(b, t, "full_outer").select(t, issue.alias("issue")).where(F.col("issue").isNotNull())


def _cells(df: DataFrame, cell: str, prefix: str) -> DataFrame:
    return df.groupBy(cell).agg(F.min("lat").alias(f"{prefix}_lat"), F.min("lon").alias(f"{prefix}_lon"))


def spatial_report(
    reference: DataFrame, other: DataFrame, cell: str = "cell", tolerance: float = GRID_TOLERANCE
) -> DataFrame:
    """Cells that are missing on one side or lie elsewhere: (cell, issue)."""
    joined = _cells(reference, cell, "a").join(_cells(other, cell, "b"), cell, "full_outer")
    limit = F.lit(float(tolerance))
    issue = (
        F.when(F.col("b_lat").isNull(), "missing_in_other")
        .when(F.col("a_lat").isNull(), "missing_in_reference")
        .when(F.abs(F.col("a_lat") - F.col("b_lat")) > limit, "latitude_differs")
        .when(F.abs(F.col("a_lon") - F.col("b_lon")) > limit, "longitude_differs")
    )
    return joined.select(cell, issue.alias("issue")).where(F.col("issue").isNotNull())


def grid_report(
    reference: DataFrame, other: DataFrame, cell: str = "cell", t: str = "t", tolerance: float = GRID_TOLERANCE
) -> DataFrame:
    """Both reports: (axis, cell, t, issue). Empty means the grids are identical."""
    times = time_axis_report(reference, other, t).select(
        F.lit("time").alias("axis"), F.lit(None).cast("bigint").alias("cell"), F.col(t).alias("t"), "issue"
    )
    cells = spatial_report(reference, other, cell, tolerance).select(
        F.lit("cell").alias("axis"),
        F.col(cell).cast("bigint").alias("cell"),
        F.lit(None).cast(dict(reference.dtypes)[t]).alias("t"),
        "issue",
    )
    return times.unionByName(cells)


def require_same_grid(reference: DataFrame, others: dict[str, DataFrame], with_time: bool = True, **options) -> None:
    """Raise when another variable is not on the reference grid (one bounded action per variable)."""
    check = grid_report if with_time else spatial_report
    for name, other in others.items():
        first = check(reference, other, **options).head(5)
        if first:
            raise ValueError(f"{name} is not on the reference grid, for instance {first}")


def require_partners(
    reference: DataFrame, others: dict[str, DataFrame], keys: Sequence[str], t: str = "t", shared_axis: bool = False
) -> None:
    """Raise when a cell of the reference has no row in another variable, or a variable has a time step twice.

    With ``shared_axis`` every cell must have as many steps as any other. Without this a cell would get missing
    values, which the capacity factor takes for zero.
    """
    cells = reference.select(*keys).distinct()
    for name, other in others.items():
        lost = cells.join(other.select(*keys).distinct(), list(keys), "left_anti").head(5)
        if lost:
            raise ValueError(f"cells without {name}, for instance {lost}")
        twice = other.groupBy(*keys, t).agg(F.count(F.lit(1)).alias("n")).where("n > 1").head(5)
        if twice:
            raise ValueError(f"the time axis of {name} does not increase, for instance {twice}")
        if shared_axis:
            steps = other.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.min("n").alias("least"), F.max("n").alias("most")).first()
            if steps["least"] != steps["most"]:
                raise ValueError(f"cells of {name} have between {steps['least']} and {steps['most']} steps, not one axis")


def monotonic_violations(
    df: DataFrame, keys: Sequence[str], step: str, t: str, block: int = 65536
) -> DataFrame:
    """Per key the number of steps whose time does not exceed that of the preceding step."""
    chunk: Column = F.floor(F.col(step) / F.lit(block))
    rows = with_previous(df.select(*keys, step, t), keys, step, [t], chunk)
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_steps"),
        F.count_if(F.col(t) <= F.col(f"previous_{t}")).alias("n_violations"),
    )
