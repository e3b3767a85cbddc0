"""Linear interpolation of instantaneous variables to another time axis."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridyield.functions.calendar import time_chunk
from gridyield.operators.alignment import fail_if
from gridyield.operators.neighbours import bracket
from gridyield.operators.sizing import broadcast_if_small

POLICIES = ("nearest", "nan")


NUMERIC_CHUNK_DAYS = 90.0


def _is_numeric(df: DataFrame, t: str) -> bool:
    return dict(df.dtypes)[t] in ("float", "double", "int", "bigint")


def _position(t: Column, numeric: bool) -> Column:
    return t if numeric else F.unix_micros(t)


def _default_chunk(t: str, numeric: bool) -> Column:
    """Stretches of ninety days; a numeric axis counts days (calendars without leap days)."""
    return F.floor(F.col(t) / F.lit(NUMERIC_CHUNK_DAYS)) if numeric else time_chunk(F.col(t))


def _weight(at: Column, left: Column, right: Column, numeric: bool = False) -> Column:
    """Share of the right row; 0 on an exact hit and outside the source range."""
    start = _position(left, numeric)
    span = _position(right, numeric) - start
    return F.when(span != 0, (_position(at, numeric) - start) / span).otherwise(F.lit(0.0))


def _check(policy: str) -> None:
    if policy not in POLICIES:
        raise ValueError(f"boundary policy must be one of {POLICIES}: {policy!r}")


def interpolate(
    targets: DataFrame,
    source: DataFrame,
    values: Sequence[str],
    keys: Sequence[str] = ("cell",),
    t: str = "t",
    policy: str = "nearest",
    chunk: Column | None = None,
    check: bool = False,
) -> DataFrame:
    """Interpolate ``values`` of ``source`` to the target rows; every key may have its own time axis.

    ``nearest`` repeats the first and last source value outside the source range; ``nan`` gives NULL
    there and on exact hits of the first and last source step. A NULL in a bracket gives NULL.
    ``t`` is a timestamp, or a number of days on one absolute axis for other calendars. ``check`` ends the job where a key has no
    source row at all, or has a step twice in a stretch of time that targets fall into.
    """
    _check(policy)
    numeric = _is_numeric(targets, t)
    found = bracket(targets, source, keys, t, values, _default_chunk(t, numeric) if chunk is None else chunk, check)
    low, high = F.coalesce("left", "right"), F.coalesce("right", "left")
    staged = found.withColumns({"_low": low, "_high": high}).withColumn(
        "_w", _weight(F.col(t), F.col(f"_low.{t}"), F.col(f"_high.{t}"), numeric)
    )
    inside = (F.col(t) > F.col("first_order")) & (F.col(t) < F.col("last_order"))
    problem = F.lit(None).cast("string")
    if check:
        at = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
        problem = F.when(F.col("_low").isNull(), F.concat(F.lit("no source rows for "), at)).when(
            F.col("doubled"), F.concat(F.lit("the time axis does not increase at "), at)
        )
    outputs = {}
    for v in values:
        mixed = F.col(f"_low.{v}") * (1.0 - F.col("_w")) + F.col(f"_high.{v}") * F.col("_w")
        mixed = mixed if policy == "nearest" else F.when(inside, mixed)
        outputs[v] = fail_if(problem, mixed, "double") if check else mixed
    return staged.withColumns(outputs).drop(
        "left", "right", "first_order", "last_order", "doubled", "_low", "_high", "_w"
    )


def bracket_table(target_axis: DataFrame, source_axis: DataFrame, t: str = "t", policy: str = "nearest") -> DataFrame:
    """Rows (source time, target time, weight, n) of the interpolation between two shared axes."""
    _check(policy)
    numeric = _is_numeric(target_axis, t)
    key = F.lit(0).alias("_axis")
    found = bracket(
        target_axis.select(key, t).distinct(),
        source_axis.select(key, t).distinct(),
        ["_axis"],
        t,
        [],
        _default_chunk(t, numeric),
    )
    low, high = F.coalesce(f"left.{t}", f"right.{t}"), F.coalesce(f"right.{t}", f"left.{t}")
    staged = found.select(
        F.col(t).alias("t_target"), low.alias("_low"), high.alias("_high"), "first_order", "last_order"
    ).withColumn("_w", _weight(F.col("t_target"), F.col("_low"), F.col("_high"), numeric))
    if policy == "nan":
        staged = staged.where(
            (F.col("t_target") > F.col("first_order")) & (F.col("t_target") < F.col("last_order"))
        )
    left = F.struct(F.col("_low").alias("t_source"), (1.0 - F.col("_w")).alias("weight"))
    right = F.struct(F.col("_high").alias("t_source"), F.col("_w").alias("weight"))
    parts = F.when(F.col("_low") == F.col("_high"), F.array(left)).otherwise(F.array(left, right))
    return staged.select("t_target", F.explode(parts).alias("p"), F.size(parts).alias("n")).select(
        "t_target", "p.t_source", "p.weight", "n"
    )


def interpolate_shared_axis(
    brackets: DataFrame,
    source: DataFrame,
    values: Sequence[str],
    keys: Sequence[str] = ("cell",),
    t: str = "t",
    check: bool = False,
) -> DataFrame:
    """Interpolation for dense grids, where all cells share one time axis.

    The bracket table depends on the axes only, so it is tiny and broadcast: each source row is sent
    once to the one or two target times it contributes to and summed there. One shuffle on
    (key, target time), which is also the key of the join that follows. ``check`` counts what contributed in the same
    aggregate and ends the job where a cell has a step twice or lacks one that the others have.
    """
    contributions = (
        source.select(*keys, F.col(t).alias("t_source"), *values)
        .join(broadcast_if_small(brackets), "t_source")
        .groupBy(*keys, F.col("t_target").alias(t))
        .agg(
            F.max("n").alias("_n"),
            *([F.count_if(F.col("t_source") <= F.col("t_target")).alias("_before"), F.count(F.lit(1)).alias("_rows")] if check else []),
            *[F.sum(F.col("weight") * F.col(v)).alias(f"_sum_{v}") for v in values],
            *[F.count(v).alias(f"_count_{v}") for v in values],
        )
    )
    whole = {v: F.when(F.col(f"_count_{v}") == F.col("_n"), F.col(f"_sum_{v}")) for v in values}
    if check:
        at = F.concat_ws(", ", *[F.col(k).cast("string") for k in [*keys, t]])
        # Of two steps one lies before the target and one behind it; a single one counts on either side.
        lacks = (F.col("_rows") < F.col("_n")) | ((F.col("_n") == 2) & F.col("_before").isin(0, 2) & (F.col("_rows") == 2))
        problem = F.when(lacks, F.concat(F.lit("a step is missing around "), at)).when(
            F.col("_rows") > F.col("_n"), F.concat(F.lit("the time axis does not increase around "), at)
        )
        whole = {v: fail_if(problem, c, "double") for v, c in whole.items()}
    return contributions.select(*keys, t, *[c.alias(v) for v, c in whole.items()])
