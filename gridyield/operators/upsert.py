"""Keyed merge of result tables."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(
    old: DataFrame | None,
    new: DataFrame,
    keys: Sequence[str],
    sequence: str | None = None,
    overwrite: bool = False,
) -> DataFrame:
    """Rows of both tables, per key the newest: new before old, then the highest ``sequence``.

    The choice is a ``max_by`` aggregate, so repeated keys shrink before the shuffle.
    """
    keys = list(keys)
    fresh = new.withColumn("_new", F.lit(1))
    both = fresh
    if old is not None and not overwrite:
        both = old.withColumn("_new", F.lit(0)).unionByName(fresh, allowMissingColumns=True)
    rank = F.struct("_new", sequence) if sequence else F.struct("_new")
    rest = [c for c in both.columns if c not in keys and c != "_new"]
    newest = both.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("_row"))
    return newest.select(*keys, "_row.*")


def upsert_sorted(old, new, keys: Sequence[str], sequence: str | None = None, overwrite: bool = False) -> DataFrame:
    return upsert(old, new, keys, sequence, overwrite).orderBy(*keys)
