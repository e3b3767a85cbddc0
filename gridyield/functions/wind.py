"""Wind speed and turbine power curve."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridyield import constants as K
from gridyield.functions.nulls import clip


def speed(u: Column, v: Column) -> Column:
    u, v = u.cast("double"), v.cast("double")
    return F.sqrt(u * u + v * v)


def power_law_ratio(
    hub: float = K.HUB_HEIGHT, reference: float = K.REFERENCE_HEIGHT, exponent: float = K.POWER_LAW_EXPONENT
) -> float:
    return (hub / reference) ** exponent


def hub_speed(speed_10m: Column, ratio: float | None = None) -> Column:
    return speed_10m * F.lit(power_law_ratio() if ratio is None else float(ratio))


def curve_power(ws: Column, knots: Sequence[tuple[float, float]]) -> Column:
    """Piecewise-linear curve as a balanced tree of comparisons.

    The curve is padded with zero power at 0 m/s and just above cut-out; beyond the last knot the
    last value holds. A lookup costs log2(knots) comparisons inside generated code: no join, no UDF.
    """
    points = [(0.0, 0.0), *[(float(x), float(y)) for x, y in sorted(knots, key=lambda p: p[0])]]
    points.append((K.CUT_OUT_SPEED + K.CUT_OUT_RAMP, 0.0))
    segments = []  # (left edge, expression); valid up to the next left edge
    for (x0, y0), (x1, y1) in zip(points, points[1:]):
        if x1 <= x0:
            continue
        slope = (y1 - y0) / (x1 - x0)
        line = F.lit(y0) if slope == 0 else (ws - F.lit(x0)) * F.lit(slope) + F.lit(y0)
        segments.append((x0, line))
    segments.append((points[-1][0], F.lit(points[-1][1])))

    def tree(part):
        if len(part) == 1:
            return part[0][1]
        middle = len(part) // 2
        return F.when(ws < F.lit(part[middle][0]), tree(part[:middle])).otherwise(tree(part[middle:]))

    inside = F.when(ws < F.lit(points[0][0]), F.lit(points[0][1])).otherwise(tree(segments))
    return F.when(ws.isNotNull(), inside)


def wind_cf(power: Column, rated: float | Column) -> Column:
    rated = rated if isinstance(rated, Column) else F.lit(float(rated))
    return clip(power / rated, 0.0, 1.0)
