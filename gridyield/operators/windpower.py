"""Turbine curves and wind capacity factor."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridyield import constants as K
from gridyield.functions import wind
from gridyield.functions.nulls import or_zero


def prepare_power_curves(curves: DataFrame, turbine: str = "turbine") -> DataFrame:
    """Curves in kW up to the cut-out speed, for any number of turbines.

    Knots beyond cut-out go; a curve that ends earlier is continued with its last power in half-metre
    steps, and at the cut-out speed itself.
    """
    cut, step = F.lit(K.CUT_OUT_SPEED), F.lit(K.CURVE_EXTENSION_STEP)
    kept = curves.where(F.col("ws") <= cut).select(
        turbine, "ws", (F.col("power_w") / F.lit(1000.0)).alias("power_kw")
    )
    last = kept.groupBy(turbine).agg(F.max("ws").alias("_ws"), F.max_by("power_kw", "ws").alias("power_kw"))
    count = F.ceil((cut + F.lit(0.001) - F.col("_ws") - step) / step)
    steps = F.when(count > 0, F.sequence(F.lit(1), count.cast("int"))).otherwise(F.array().cast("array<int>"))
    grown = F.transform(steps, lambda i: F.col("_ws") + i * step)
    ends_early = F.coalesce(F.element_at(grown, -1), F.col("_ws")) < cut
    extended = F.when(ends_early, F.concat(grown, F.array(cut))).otherwise(grown)
    extra = (
        last.where(F.col("_ws") < cut)
        .withColumn("_n", F.greatest(count, F.lit(0)))
        .select(turbine, "power_kw", F.explode(F.when(F.col("_n") > 0, extended).otherwise(F.array(cut))).alias("ws"))
    )
    return kept.unionByName(extra)


def curve_knots(prepared: DataFrame, turbine: str = "turbine") -> list[tuple[float, float]]:
    """Knots of one prepared curve on the driver: a model parameter with the size of its own table."""
    rows = prepared.orderBy("ws").collect()
    if not rows:
        raise ValueError("the power curve has no knot below the cut-out speed")
    if turbine in prepared.columns and len({r[turbine] for r in rows}) > 1:
        raise ValueError("knots of several turbines do not make one curve; choose one before")
    return [(r["ws"], r["power_kw"]) for r in rows]


def add_wind_cf(
    df: DataFrame,
    knots: Sequence[tuple[float, float]],
    rated_kw: float,
    u: str | None = "uas",
    v: str | None = "vas",
    speed: str | None = None,
    output: str = "cf",
) -> DataFrame:
    """Add the capacity factor of one turbine type; missing wind counts as calm."""
    ws10 = or_zero(F.col(speed)) if speed else wind.speed(or_zero(F.col(u)), or_zero(F.col(v)))
    return (
        df.withColumn("_hub", wind.hub_speed(ws10))
        .withColumn(output, wind.wind_cf(wind.curve_power(F.col("_hub"), knots), rated_kw))
        .drop("_hub")
    )
