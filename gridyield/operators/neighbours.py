"""Previous row and bracketing rows per key, without ever putting one key into one task.

A window over (key) would collect a whole key. Here every key is cut into chunks along the order
column (ninety days, a block of steps); the window runs over (key, chunk) and the rows that matter across
a border are carried over from a summary of one row per (key, chunk). The summary is a partial
(map-side) aggregate, so what reaches the per-key window is the number of chunks, which the calendar
bounds.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_CHUNK, _CARRIED, _O, _KIND = "_chunk", "_carried", "_order", "_kind"


def with_previous(
    df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str], chunk: Column
) -> DataFrame:
    """Add ``has_previous`` and ``previous_<c>``: values of the preceding row of the key in ``order``."""
    keys, columns = list(keys), list(columns)
    rows = df.withColumn(_CHUNK, chunk).withColumn(_CARRIED, F.lit(False))
    tails = rows.groupBy(*keys, _CHUNK).agg(
        F.max(order).alias(order), *[F.max_by(c, order).alias(c) for c in columns if c != order]
    )
    following = W.partitionBy(*keys).orderBy(_CHUNK)
    carried = (
        tails.withColumn("_next", F.lead(_CHUNK).over(following))
        .where(F.col("_next").isNotNull())
        .drop(_CHUNK)
        .withColumnRenamed("_next", _CHUNK)
        .withColumn(_CARRIED, F.lit(True))
    )
    return _lagged(rows.unionByName(carried, allowMissingColumns=True), keys, order, columns)


def with_carried(
    df: DataFrame, carried: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str], chunk: Column
) -> DataFrame:
    """As ``with_previous``, with the rows that matter across a border given: keys, ``order``, values and ``_to``, the chunk they go to.

    ``df`` is read once. A carried row whose chunk has no rows goes nowhere.
    """
    rows = df.withColumn(_CHUNK, chunk).withColumn(_CARRIED, F.lit(False))
    more = carried.withColumnRenamed("_to", _CHUNK).withColumn(_CARRIED, F.lit(True))
    return _lagged(rows.unionByName(more, allowMissingColumns=True), list(keys), order, columns)


def _lagged(rows: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str]) -> DataFrame:
    within = W.partitionBy(*keys, _CHUNK).orderBy(order)
    return (
        rows.withColumn("has_previous", F.lag(F.lit(True), 1, False).over(within))
        .withColumns({f"previous_{c}": F.lag(c).over(within) for c in columns})
        .where(~F.col(_CARRIED))
        .drop(_CHUNK, _CARRIED)
    )


def bracket(
    targets: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    order: str,
    values: Sequence[str],
    chunk: Column,
    check: bool = False,
) -> DataFrame:
    """For every target row the nearest source rows at or before (``left``) and at or after (``right``).

    ``left``/``right`` are structs of the order value and ``values``; ``first_order``/``last_order``
    tell whether a source row exists before and after. Source rows with NULL values take part: brackets
    follow the axis, not the values. ``chunk`` is an expression over ``order`` that grows with it. ``check`` adds ``doubled``:
    whether an order value comes twice in the source rows of the key and chunk.
    """
    keys, values = list(keys), list(values)
    names = [order, *values]
    src = source.select(*keys, chunk.alias(_CHUNK), *names)
    tgt = targets.withColumn(_CHUNK, chunk)

    summary = src.groupBy(*keys, _CHUNK).agg(
        F.min(order).alias("_head"),
        F.max(order).alias("_tail"),
        *[F.min_by(v, order).alias(f"_head_{v}") for v in values],
        *[F.max_by(v, order).alias(f"_tail_{v}") for v in values],
    )
    wanted = tgt.select(*keys, _CHUNK).distinct().withColumn("_wanted", F.lit(True))
    # one row per (key, chunk): a source chunk and a target chunk meet in this aggregate
    chunks = (
        summary.withColumn("_wanted", F.lit(False))
        .unionByName(wanted, allowMissingColumns=True)
        .groupBy(*keys, _CHUNK)
        .agg(
            F.max("_wanted").alias("_wanted"),
            *[F.max(c).alias(c) for c in summary.columns if c not in (*keys, _CHUNK)],
        )
    )
    head = F.when(
        F.col("_head").isNotNull(),
        F.struct(F.col("_head").alias(order), *[F.col(f"_head_{v}").alias(v) for v in values]),
    )
    tail = F.when(
        F.col("_tail").isNotNull(),
        F.struct(F.col("_tail").alias(order), *[F.col(f"_tail_{v}").alias(v) for v in values]),
    )
    earlier = W.partitionBy(*keys).orderBy(F.col(_CHUNK).asc()).rowsBetween(W.unboundedPreceding, -1)
    later = W.partitionBy(*keys).orderBy(F.col(_CHUNK).desc()).rowsBetween(W.unboundedPreceding, -1)
    carried = (
        chunks.withColumn("_before", F.last(tail, ignorenulls=True).over(earlier))
        .withColumn("_after", F.last(head, ignorenulls=True).over(later))
        .where("_wanted")
        .select(*keys, _CHUNK, F.explode(F.array("_before", "_after")).alias("_row"))
        .where(F.col("_row").isNotNull())
        .select(*keys, _CHUNK, *[F.col(f"_row.{n}").alias(n) for n in names])
    )
    sources = src.unionByName(carried).select(
        *keys, _CHUNK, F.col(order).alias(_O), F.struct(*names).alias("_source")
    )
    goals = tgt.select(
        *keys, _CHUNK, F.col(order).alias(_O), F.struct(*[c for c in targets.columns if c not in keys]).alias("_target")
    )
    up = W.partitionBy(*keys, _CHUNK).orderBy(F.col(_O).asc())
    down = W.partitionBy(*keys, _CHUNK).orderBy(F.col(_O).desc())
    whole = W.partitionBy(*keys, _CHUNK)
    both = goals.unionByName(sources, allowMissingColumns=True)
    if check:
        before = F.last(f"_source.{order}", ignorenulls=True).over(up.rowsBetween(W.unboundedPreceding, -1))
        both = both.withColumn("_again", F.coalesce(before == F.col(f"_source.{order}"), F.lit(False)))
        both = both.withColumn("doubled", F.max("_again").over(whole))
    return (
        both.withColumn("left", F.last("_source", ignorenulls=True).over(up))
        .withColumn("right", F.last("_source", ignorenulls=True).over(down))
        .withColumn("first_order", F.min(f"_source.{order}").over(whole))
        .withColumn("last_order", F.max(f"_source.{order}").over(whole))
        .where(F.col("_target").isNotNull())
        .select(*keys, "_target.*", "left", "right", "first_order", "last_order", *(["doubled"] if check else []))
    )
