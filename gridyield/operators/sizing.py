"""Broadcast only what is known to be small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Estimates of Parquet scans are compressed sizes, so this leaves room for a table ten times larger in memory.
MAX_BROADCAST_BYTES = 16 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of a plan, None where the session does not expose it."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # a remote session has no JVM handle
        return None


def broadcast_if_small(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Mark a join side for broadcast when the plan's estimate proves it small, else leave the choice to Spark.

    Nothing runs while the plan is built. Estimates of aggregates over facts are upper bounds, so such sides are
    left to the adaptive execution, which sees their real size.
    """
    estimate = estimated_bytes(df)
    return F.broadcast(df) if estimate is not None and estimate <= max_bytes else df
