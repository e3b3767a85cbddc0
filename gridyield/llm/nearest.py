"""Nearest neighbours through a few stable projections and kd-trees over them.

Projecting on m Gaussian directions turns the squared distance d2 of two vectors into d2 times a
chi-square variable with m degrees of freedom. So the projections are searched instead: a kd-tree gives
a query's neighbours in the projected space in growing distance, they are verified on the vectors themselves, and the
search ends when a true neighbour as near as the k-th one found would have come already with the given
confidence: projected distance squared > k-th distance squared times the chi-square quantile.

Rows are dealt out by the top levels of a kd-tree that is fitted on a bounded sample; every row is in the index.
A query first searches its own cell. The distance of its k-th neighbour there then decides by the same test which other cells
it must visit, so most cells never see it when the data have structure.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridyield.llm.common import written
from gridyield.llm.vectors import matrix, sampled

PROJECTIONS = 8
SAMPLE = 20_000  # rows the cells are fitted on
CELL = 8192  # rows a cell should hold
MOST_CELLS = 1024
BLOCK = 16_384  # rows of a cell in one task
ASKED = 512  # queries of a task
LEAF = 128  # rows of a leaf


def chi_square_quantile(p: float, m: int) -> float:
    """Quantile of the chi-square distribution for an even number of degrees of freedom."""
    if m % 2:
        raise ValueError("an even number of projections")

    def below(x: float) -> float:
        term, total = 1.0, 1.0
        for i in range(1, m // 2):
            term *= x / 2 / i
            total += term
        return 1 - np.exp(-x / 2) * total

    low, high = 0.0, 10.0 * m + 100
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if below(mid) < p else (low, mid)
    return high


@dataclass(frozen=True)
class Space:
    """Projection matrix and the boxes of the cells: lower and upper corners."""

    directions: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def project(self, values: np.ndarray) -> np.ndarray:
        return values @ self.directions

    def cell_of(self, points: np.ndarray) -> np.ndarray:
        out = np.empty(len(points), np.int64)
        for k in range(0, len(points), 1024):
            some = points[k:k + 1024, None, :]
            out[k:k + 1024] = ((some >= self.low) & (some < self.high)).all(2).argmax(1)
        return out

    def gaps(self, points: np.ndarray) -> np.ndarray:
        """Squared distance of each point to each cell."""
        return box_gaps(points, self.low, self.high)


def box_gaps(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    out = np.zeros((len(points), len(low)))
    for d in range(points.shape[1]):
        x = points[:, d:d + 1]
        out += np.maximum(np.maximum(low[:, d] - x, x - high[:, d]), 0.0) ** 2
    return out


def leaves(points: np.ndarray, size: int) -> list[np.ndarray]:
    """Row numbers of the leaves of a kd-tree: median splits of the widest side; equal points may share a large leaf."""
    todo, done = [np.arange(len(points))], []
    while todo:
        rows = todo.pop()
        if len(rows) <= size:
            done.append(rows)
            continue
        some = points[rows]
        axis = int((some.max(0) - some.min(0)).argmax())
        order = np.argsort(some[:, axis], kind="stable")
        half = len(rows) // 2
        todo += [rows[order[:half]], rows[order[half:]]]
    return done


def _split(points: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Boxes that tile the whole space, each with about as many points."""
    dims = points.shape[1]
    boxes = [(points, np.full(dims, -np.inf), np.full(dims, np.inf))]
    while len(boxes) < cells:
        boxes.sort(key=lambda b: len(b[0]))
        some, low, high = boxes.pop()
        axis = int((some.max(0) - some.min(0)).argmax()) if len(some) else 0
        cut = np.median(some[:, axis]) if len(some) else 0.0
        left = some[:, axis] < cut
        if len(some) < 4 or not left.any():
            boxes.append((some, low, high))
            break
        upper, lower = high.copy(), low.copy()
        upper[axis] = lower[axis] = cut
        boxes += [(some[left], low, upper), (some[~left], lower, high)]
    return np.array([b[1] for b in boxes]), np.array([b[2] for b in boxes])


def fit_space(vectors: DataFrame, vector: str, projections: int, cell: int, seed: int = 5) -> Space | None:
    """Projections, and cells from a sample of about ``SAMPLE`` vectors of the usual length; None for a table without vectors."""
    values, n = sampled(vectors, vector, SAMPLE, seed)
    if not len(values):
        return None
    directions = np.random.default_rng(seed).standard_normal((values.shape[1], projections))
    low, high = _split(values @ directions, int(np.clip(-(-n // cell), 1, MOST_CELLS)))
    return Space(directions, low, high)


def search(
    points: np.ndarray, values: np.ndarray, ids: np.ndarray, asked: np.ndarray, asked_values: np.ndarray, asked_ids: np.ndarray, bound: np.ndarray, k: int, limit: float, leaf: int = LEAF
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query its k nearest rows as (ids, distances), by the stopping test with ``limit``.

    ``bound`` holds a distance within which the query already knows k rows (infinite if it does not).
    """
    groups = leaves(points, leaf)
    low, high = (np.array([f(points[g], axis=0) for g in groups]) for f in (np.min, np.max))
    gaps = box_gaps(asked, low, high)
    out = []
    for q in range(len(asked)):
        best_id, best = np.zeros(0, np.int64), np.zeros(0)
        reach = bound[q]
        for g in np.argsort(gaps[q], kind="stable"):
            if gaps[q, g] > limit * reach * reach:
                break
            rows = groups[g]
            rows = rows[ids[rows] != asked_ids[q]]
            d = np.sqrt(((values[rows] - asked_values[q]) ** 2).sum(1))
            keep = d <= reach
            best_id, best = np.concatenate([best_id, ids[rows[keep]]]), np.concatenate([best, d[keep]])
            if len(best) > k:
                order = np.lexsort((best_id, best))
                best_id, best = best_id[order], best[order]
                # A vec_id on several rows counts once, at its nearest row.
                _, first = np.unique(best_id, return_index=True)
                first = np.sort(first)[:k]
                best_id, best = best_id[first], best[first]
            if len(best) >= k:
                reach = min(reach, best.max())
        order = np.lexsort((best_id, best))
        out.append((best_id[order], best[order]))
    return out


def nearest_neighbours(
    vectors: DataFrame, every: int = 100, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding", confidence: float = 0.99,
    projections: int = PROJECTIONS, cell: int = CELL, block: int = BLOCK, asked: int = ASKED,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest rows by Euclidean distance of each row whose vec_id is divisible by ``every``.

    Ties go to the smaller vec_id; rows with the query's own vec_id are not its neighbours. Null, zero and non-finite
    vectors, vectors of another length than most and null vec_ids take no part. A vec_id on several rows counts once, at its nearest row; as
    a query it asks with each of its rows and keeps the nearest answers.
    """
    spark = vectors.sparkSession
    empty = "query_id bigint, rank int, vec_id bigint, score double"
    space = fit_space(vectors, vector, projections, cell)
    if space is None:
        return spark.createDataFrame([], empty)
    dims, limit = len(space.directions), chi_square_quantile(confidence, projections)
    vector_type = pa.list_(pa.float64())

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, len(whole), 4096):
                batch = whole.slice(start, 4096)
                rows, values = matrix(batch.column(1), dims)
                if len(rows):
                    home = space.cell_of(space.project(values))
                    flat = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * dims), pa.array(values.ravel()))
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pa.array(home), flat], names=["id", "cell", "v"])

    some = vectors.where(F.col(vec_id).isNotNull()).select(F.col(vec_id).cast("bigint").alias("id"), F.col(vector).alias("v"))
    rows = written(some.mapInArrow(assign, "id bigint, cell bigint, v array<double>"), "projected")
    counts = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    blocks = counts.select("cell", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    queries = rows.where(F.col("id") % every == 0)
    own_block = F.pmod(F.xxhash64("id", "v"), F.col("blocks")).cast("int")
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def answer(table: pa.Table) -> pa.Table:
        v = np.stack(table.column("v").combine_chunks().to_numpy(zero_copy_only=False)).astype(np.float64)
        ids, asks, bound = (table.column(c).to_numpy() for c in ("id", "asks", "bound"))
        points = space.project(v)
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if asks.any() and not asks.all():
            found = search(points[~asks], v[~asks], ids[~asks], points[asks], v[asks], ids[asks], bound[asks], k, limit)
            out += [(np.full(len(i), q), i, d) for q, (i, d) in zip(ids[asks], found)]
        return pa.table([pa.array(np.concatenate(c), t) for c, t in zip(zip(*out), schema.types)], schema=schema)

    def searched(asking: DataFrame) -> DataFrame:
        """``asking``: id, v, bound, cell. Every block of a cell meets every slot of its queries, so a row is sent once per ``asked`` of them."""
        per_cell = asking.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / asked).cast("int").alias("slots"))
        sizes = written(blocks.join(per_cell, "cell"), "cells-asked")
        have = rows.join(sizes, "cell").withColumn("block", own_block).withColumn("slot", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)))
        have = have.select("cell", "block", "slot", "id", "v", F.lit(False).alias("asks"), F.lit(0.0).alias("bound"))
        ask = asking.join(sizes, "cell").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        ask = ask.withColumn("slot", F.pmod(F.xxhash64("id"), "slots").cast("int"))
        ask = ask.select("cell", "block", "slot", "id", "v", F.lit(True).alias("asks"), "bound")
        found = have.unionByName(ask).groupBy("cell", "block", "slot").applyInArrow(answer, "query_id bigint, vec_id bigint, score double")
        return found

    def best(found: DataFrame) -> DataFrame:
        once = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
        order = Window.partitionBy("query_id").orderBy("score", "vec_id")
        return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    first = written(searched(queries.withColumn("bound", F.lit(float("inf")))), "nearest-own-cell")
    reach = best(first).groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.max("score").alias("far"))
    reach = reach.select(F.col("query_id").alias("id"), F.when(F.col("n") == k, F.col("far")).otherwise(F.lit(float("inf"))).alias("bound"))
    bounded = queries.join(reach, "id", "left").select("id", "v", "cell", F.coalesce("bound", F.lit(float("inf"))).alias("bound"))

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = np.stack(batch.column(1).to_numpy(zero_copy_only=False)).astype(np.float64) if len(batch) else np.zeros((0, dims))
            home, bound = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            near = space.gaps(space.project(v)) <= limit * (bound * bound)[:, None]
            near[np.arange(len(v)), home] = False
            who, cells = np.nonzero(near)
            for k_ in range(0, len(who), 10_000):
                w = who[k_:k_ + 10_000]
                flat = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1, dtype=np.int32) * dims), pa.array(v[w].ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(w)), flat, pa.array(bound[w]), pa.array(cells[k_:k_ + 10_000])], names=["id", "v", "bound", "cell"])

    asking = bounded.mapInArrow(others, "id bigint, v array<double>, bound double, cell bigint")
    second = searched(written(asking, "nearest-visits"))
    return best(first.unionByName(second)).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
