"""Tables whose partitions are replaced without a moment in which a reader finds nothing.

A partition is a folder below ``version=<id>`` of the version it was written in. One small pointer file names, for
every partition, the version that counts. Writers put complete folders next to the old ones and then replace the pointer in one
step; readers look it up once and read the folders it names. Replaced folders stay for readers that still use them, until
``vacuum`` finds them older than a grace period. One writer at a time.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field
from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from gridyield.operators.masking import apply_land_mask
from gridyield.sources.sinks import partition_folders

POINTER = "_current.json"


@dataclass
class State:
    """``folders``: partition to version; ``retired``: replaced (version, partition, time)."""

    partitions: list[str] = field(default_factory=list)
    folders: dict[str, str] = field(default_factory=dict)
    retired: list[list] = field(default_factory=list)


def _hadoop(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def _state(spark: SparkSession, root: str) -> State:
    where, fs = _hadoop(spark, f"{root}/{POINTER}")
    if not fs.exists(where):
        return State()
    stream = fs.open(where)
    try:
        return State(**json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
    finally:
        stream.close()


def _point(spark: SparkSession, root: str, state: State) -> None:
    """Replace the pointer in one step: a rename over the old one (file systems), or a put of the whole file (object stores)."""
    target, fs = _hadoop(spark, f"{root}/{POINTER}")
    staged, _ = _hadoop(spark, f"{root}/_{uuid.uuid4().hex}.json")
    stream = fs.create(staged, True)
    stream.write(bytearray(json.dumps(vars(state)).encode()))
    stream.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    kinds = spark._jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(kinds, 1)
    options[0] = kinds.OVERWRITE
    context.rename(fs.makeQualified(staged), fs.makeQualified(target), options)


def _write(df: DataFrame, root: str, partitions: Sequence[str], clustering: Sequence[str]) -> tuple[str, list[str]]:
    """Write a version's folders; returns its id and its partitions."""
    version = f"{int(time.time() * 1000):013d}-{uuid.uuid4().hex[:8]}"
    there = [c for c in clustering if c in df.columns]
    dealt = df.hint("rebalance", *partitions).sortWithinPartitions(*partitions, *there)
    dealt.write.option("compression", "zstd").partitionBy(*partitions).parquet(f"{root}/version={version}")
    return version, ["/".join(f"{k}={v}" for k, v in pairs) for pairs in partition_folders(df.sparkSession, f"{root}/version={version}")]


def write_partitions(
    df: DataFrame, root: str, partitions: Sequence[str], clustering: Sequence[str] = ("cell", "t"), whole: bool = False
) -> None:
    """Write the partitions in ``df``; they take the place of those that were there. ``whole``: the table has no others."""
    spark = df.sparkSession
    version, written = _write(df, root, partitions, clustering)
    state = _state(spark, root)
    if state.partitions and state.partitions != list(partitions):
        raise ValueError(f"the table is partitioned by {state.partitions}")
    old = {p: v for p, v in state.folders.items() if whole or p in written}
    kept = {p: v for p, v in state.folders.items() if p not in old}
    state.retired += [[v, p, time.time()] for p, v in old.items()]
    _point(spark, root, State(list(partitions), {**kept, **{p: version for p in written}}, state.retired))


def _read(spark: SparkSession, root: str, folders: dict[str, str]) -> DataFrame:
    paths = [f"{root}/version={v}/{p}" for p, v in sorted(folders.items())]
    return spark.read.option("basePath", root).parquet(*paths).drop("version")


def read_current(spark: SparkSession, root: str) -> DataFrame:
    """The table as the pointer names it now; what writers do later does not change it."""
    state = _state(spark, root)
    if not state.folders:
        raise FileNotFoundError(f"no table at {root}")
    return _read(spark, root, state.folders)


def rewrite(
    spark: SparkSession, root: str, change: Callable[[DataFrame], DataFrame], clustering: Sequence[str] = ("cell", "t"),
    grace_seconds: float = 3600.0, together: int = 1,
) -> None:
    """Replace every partition by what ``change`` makes of it, ``together`` at a time.

    Partitions are replaced one after the other, so with a short grace period the space of ``together`` partitions is
    enough. A job that ends half-way leaves a whole table in which some partitions are new.
    """
    state = _state(spark, root)
    todo = sorted(state.folders)
    for k in range(0, len(todo), together):
        some = {p: state.folders[p] for p in todo[k:k + together]}
        write_partitions(change(_read(spark, root, some)), root, state.partitions, clustering)
        vacuum(spark, root, grace_seconds)


def vacuum(spark: SparkSession, root: str, grace_seconds: float = 3600.0) -> int:
    """Delete folders that were replaced longer than ``grace_seconds`` ago; returns how many."""
    state = _state(spark, root)
    late = [r for r in state.retired if time.time() - r[2] >= grace_seconds]
    for version, partition, _ in late:
        where, fs = _hadoop(spark, f"{root}/version={version}/{partition}")
        fs.delete(where, True)
    if late:
        state.retired = [r for r in state.retired if r not in late]
        _point(spark, root, state)
    return len(late)


def remask(spark: SparkSession, root: str, mask: DataFrame, value: str = "cf", grace_seconds: float = 3600.0, together: int = 1) -> None:
    """Set ocean values of a table to NULL, partition by partition."""
    rewrite(spark, root, lambda df: apply_land_mask(df, mask, [value]), grace_seconds=grace_seconds, together=together)
