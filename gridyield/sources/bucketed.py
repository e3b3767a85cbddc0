"""Tables that lie ready for joins by cell.

Rows of one cell are in one bucket of every table that was written with as many buckets. Joins, windows and aggregates whose keys hold
the cell then need no exchange: every task reads the same bucket of both sides. Worth it for tables that many jobs
align, interpolate or mask; the exchange is paid once, when they are written.
"""

from __future__ import annotations

import uuid
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession

#: Joins on (cell, t) may use tables that are dealt out by cell alone. Spark's default asks for all join keys.
PART_OF_THE_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


def _quoted(names: Sequence[str]) -> str:
    return ", ".join(f"`{n}`" for n in names)


def write_bucketed(
    df: DataFrame, path: str, buckets: int, keys: Sequence[str] = ("cell",), order: Sequence[str] = ("cell", "t")
) -> None:
    """Write a table in ``buckets`` files by the hash of ``keys``, each sorted by ``order``. The folder must be new or empty.

    The exchange deals rows out as the buckets do, so each task writes one file. A bucket should hold a few hundred MB.
    """
    name = f"bucketed_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, *keys).sortWithinPartitions(*order)
    try:
        dealt.write.format("parquet").option("compression", "zstd").option("path", path).bucketBy(buckets, *keys).sortBy(*order).saveAsTable(name)
    finally:
        df.sparkSession.sql(f"drop table if exists {name}")  # the table is external: its files stay


def read_bucketed(
    spark: SparkSession, path: str, buckets: int, keys: Sequence[str] = ("cell",), order: Sequence[str] = ("cell", "t")
) -> DataFrame:
    """A table of ``write_bucketed``, entered into the session's catalog with its buckets; ``buckets`` and ``keys`` as written."""
    spark.conf.set(PART_OF_THE_KEYS, "false")
    schema = spark.read.parquet(path).schema
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    name = f"bucketed_{uuid.uuid4().hex}"
    spark.sql(
        f"create table {name} ({columns}) using parquet clustered by ({_quoted(keys)}) sorted by ({_quoted(order)}) "
        f"into {int(buckets)} buckets location '{path}'"
    )
    return spark.table(name)
