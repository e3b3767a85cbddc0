"""Results next to a small table of published values."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridyield.operators.sizing import broadcast_if_small


def with_published(
    results: DataFrame, published: DataFrame, on: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Every value with its published counterpart (``<v>_published``) and their ratio, NULL where absent or 0."""
    other = published.select(*on, *[F.col(v).alias(f"{v}_published") for v in values])
    joined = results.join(broadcast_if_small(other), list(on), "left")
    return joined.withColumns(
        {f"{v}_ratio": F.when(F.col(f"{v}_published") > 0, F.col(v) / F.col(f"{v}_published")) for v in values}
    )
