"""Near duplicates among vectors with an inverted multi-index.

Unit vectors are split into two halves, each with a codebook of its own. A vector lies in the cell of the grid of
codewords that is nearest in both halves. A neighbour within the radius lies in another cell only if it is on the other side
of the planes between the codewords, so the distances to those planes order the cells: a multi-sequence
traversal visits the cells by the sum of both squared distances and stops where a neighbour is no longer expected. The
stop is the largest sum at which neighbours at exactly the threshold, drawn around sampled vectors, still lie
inside with the target recall; with a target of 1 it is the radius itself, which misses nothing. What is met is
verified by cosine in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridyield.llm.common import written
from gridyield.llm.components import connected
from gridyield.llm.vectors import is_vector, matrix, sampled
from gridyield.operators.sizing import broadcast_if_small

SAMPLE = 20_000  # vectors the codebooks are fitted on
OCCUPANCY = 128  # vectors that a cell should hold
MOST_WORDS = 1024  # codewords of a half; bounds what tasks receive
BLOCK = 2048  # vectors of a cell that are compared in one task
PROBES = 200  # sampled vectors for the stop


@dataclass(frozen=True)
class Grid:
    """Codebooks of both halves, the stop of the traversal and the cosine threshold."""

    left: np.ndarray
    right: np.ndarray
    stop: float
    cosine: float

    def plane_distances(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Own codewords (a, b) and the squared distances to the planes towards all codewords, for both halves."""
        half = self.left.shape[1]
        a, h1 = _planes(unit[:, :half], self.left)
        b, h2 = _planes(unit[:, half:], self.right)
        return a, b, h1, h2

    def visited(self, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cells (i, j) with h1[i] + h2[j] up to the stop, in the order of the sum (multi-sequence traversal).

        Both lists are sorted; for each i the j form a prefix, so only cells that are visited are formed.
        """
        first, second = np.argsort(h1, kind="stable"), np.argsort(h2, kind="stable")
        near = first[: np.searchsorted(h1[first], self.stop, "right")]
        reach = np.searchsorted(h2[second], self.stop - h1[near] + 1e-9, "right")
        i = np.repeat(near, reach)
        j = second[np.arange(reach.sum()) - np.repeat(np.cumsum(reach) - reach, reach)]
        total = h1[i] + h2[j]
        order = np.argsort(total, kind="stable")
        order = order[total[order] <= self.stop]
        return i[order], j[order]


def _planes(x: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d = (x * x).sum(1)[:, None] - 2 * x @ words.T + (words * words).sum(1)[None, :]
    own = d.argmin(1)
    apart = np.sqrt(np.maximum(((words[:, None, :] - words[None, :, :]) ** 2).sum(2), 0)) if len(words) <= 64 else _apart(words)
    gap = d - d[np.arange(len(d)), own][:, None]
    between = np.where(apart[own] > 0, 2 * apart[own], 1.0)
    # Rounded, so that the sums compared with the stop do not depend on how many rows are multiplied at once.
    return own, np.where(apart[own] > 0, np.maximum(gap, 0) / between, 0.0).round(6) ** 2


def _apart(words: np.ndarray) -> np.ndarray:
    square = (words * words).sum(1)
    return np.sqrt(np.maximum(square[:, None] + square[None, :] - 2 * words @ words.T, 0))


def _codebook(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    words = x[rng.permutation(len(x))[:k]]
    for _ in range(rounds):
        own = ((words * words).sum(1)[None, :] - 2 * x @ words.T).argmin(1)
        count = np.bincount(own, minlength=len(words))
        total = np.zeros_like(words)
        np.add.at(total, own, x)
        words = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], words)
    return np.unique(words, axis=0)


def fit_grid(vectors: DataFrame, vector: str, cosine: float, recall: float, seed: int = 3) -> Grid | None:
    """Codebooks from a sample of at most about ``SAMPLE`` vectors of the usual length; None for a table without vectors."""
    values, n = sampled(vectors, vector, SAMPLE, seed)
    if not len(values):
        return None
    values = values[np.lexsort(values.T[::-1])]  # the order of the rows must not matter
    unit = values / np.linalg.norm(values, axis=1, keepdims=True)
    half = max(1, unit.shape[1] // 2)
    k = int(np.clip(round((n / OCCUPANCY) ** 0.5), 2, MOST_WORDS))
    rng = np.random.default_rng(seed)
    left, right = _codebook(unit[:, :half], k, rng), _codebook(unit[:, half:], k, rng)
    radius = 2 - 2 * cosine
    grid = Grid(left, right, radius, cosine)
    if recall >= 1 or unit.shape[1] < 2:
        return grid
    # Neighbours at the threshold in random directions: how far out in the order does their cell come?
    base = unit[rng.integers(0, len(unit), PROBES * 20)]
    away = rng.standard_normal(base.shape)
    away -= (away * base).sum(1)[:, None] * base
    away /= np.linalg.norm(away, axis=1)[:, None]
    other = cosine * base + np.sqrt(1 - cosine * cosine) * away
    _, _, h1, h2 = grid.plane_distances(base)
    a, b, _, _ = grid.plane_distances(other)
    cost = h1[np.arange(len(a)), a] + h2[np.arange(len(b)), b]
    return Grid(left, right, float(min(radius, np.quantile(cost, recall))), cosine)


def _cells(classes: DataFrame, grid: Grid) -> DataFrame:
    """A row for each class of equal vectors and visited cell: label, cell, home, id, m, v. The first cell is the home of the vector."""
    dims, words = grid.left.shape[1] + grid.right.shape[1], len(grid.right)
    schema = pa.schema([("label", pa.string()), ("cell", pa.int64()), ("home", pa.int64()), ("id", pa.int64()), ("m", pa.int64()), ("v", pa.list_(pa.float64()))])

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, len(whole), 1000):
                batch = whole.slice(start, 1000)
                rows, values = matrix(batch.column(3), dims)
                if not len(rows):
                    continue
                unit = values / np.linalg.norm(values, axis=1, keepdims=True)
                a, b, h1, h2 = grid.plane_distances(unit)
                cells = [i * words + j for i, j in (grid.visited(p, q) for p, q in zip(h1, h2))]
                home = a * words + b
                count = np.array([len(c) for c in cells])
                take = np.repeat(np.arange(len(rows)), count)
                for k in range(0, len(take), 20_000):
                    some, cell = take[k:k + 20_000], np.concatenate(cells)[k:k + 20_000]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(1).take(pa.array(rows[some])), pa.array(cell), pa.array(home[some]), batch.column(0).take(pa.array(rows[some])),
                         batch.column(2).take(pa.array(rows[some])), pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1, dtype=np.int32) * dims), pa.array(unit[some].ravel()))], schema=schema,
                    )

    return classes.mapInArrow(visit, "label string, cell bigint, home bigint, id bigint, m bigint, v array<double>")


def _classes(vectors: DataFrame, vec_id: str, vector: str, label: str) -> tuple[DataFrame, DataFrame]:
    """(members, classes): vec_id, id, m; id, label, m, v. Equal vectors of a label are one class, named by its smallest vec_id.

    m is the number of its vec_ids. A vec_id that stands on several vectors is a class of its own with each of them, and no member.
    """
    some = vectors.where(F.col(label).isNotNull() & F.col(vec_id).isNotNull() & is_vector(vector))
    some = some.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(label).cast("string").alias("label"), F.col(vector).alias("v"))
    some = written(some.distinct(), "distinct-vectors")
    several = some.groupBy("vec_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("vec_id", F.lit(True).alias("several"))
    some = some.join(broadcast_if_small(written(several, "ids-of-several-vectors")), "vec_id", "left")
    own = F.when(F.col("several"), F.col("vec_id")).alias("own")
    classes = written(some.groupBy("label", "v", own).agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("m")), "vector-classes")
    shared = classes.where("own is null and m > 1").select("label", "v", "id", "m")
    return some.where("several is null").join(shared, ["label", "v"]).select("vec_id", "id", "m"), classes.select("id", "label", "m", "v")


def compare_blocks(grid: Grid, ask: np.ndarray, ask_id: np.ndarray, ask_m: np.ndarray, ask_home: np.ndarray, have: np.ndarray, have_id: np.ndarray, have_m: np.ndarray):
    """Links of classes that visit a cell with the classes that live in it.

    Returns (ids, counts, nodes, roots): for every class of either side the vectors linked with it here, each link counted for the
    side that would not find it elsewhere; and for the classes in a group of linked ones with a smaller id than theirs the smallest.
    """
    words = len(grid.right)
    _, _, h1, h2 = grid.plane_distances(have)
    back = h1[:, ask_home // words] + h2[:, ask_home % words] <= grid.stop  # does the resident visit the asker's home?
    hit = np.zeros((len(have), len(ask)), bool)
    for k in range(0, len(have), 512):
        hit[k:k + 512] = have[k:k + 512] @ ask.T >= grid.cosine
    hit &= have_id[:, None] != ask_id[None, :]
    # Sums of whole numbers below 2**53 are exact in doubles.
    counts_ask, counts_have = have_m.astype(float) @ hit, (hit & ~back) @ ask_m.astype(float)
    x, y = np.flatnonzero(hit.any(1)), np.flatnonzero(hit.any(0))
    roots_have, roots_ask, met = have_id[x], ask_id[y], hit[np.ix_(x, y)]
    while met.size:  # the smallest id travels along the links until nothing changes
        far = np.iinfo(np.int64).max
        new = np.minimum(roots_ask, np.where(met, roots_have[:, None], far).min(0))
        old = np.minimum(roots_have, np.where(met, new[None, :], far).min(1))
        if (new == roots_ask).all() and (old == roots_have).all():
            break
        roots_ask, roots_have = new, old
    nodes, roots = np.concatenate([have_id[x], ask_id[y]]), np.concatenate([roots_have, roots_ask])
    some = nodes != roots
    counts = np.concatenate([counts_ask, counts_have]).astype(np.int64)
    return np.concatenate([ask_id, have_id]), counts, nodes[some], roots[some]


def linked_vectors(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = 0.98, recall: float = 0.999, block: int = BLOCK
) -> DataFrame:
    """vec_id, n_links, component_id, kept: a row per row of ``vectors``.

    Vectors link when their labels are equal and not null and their cosine is at least ``cosine``. Null, zero and
    non-finite vectors and null labels link with nothing, vectors of another length than most only with equal ones. A null vec_id
    has no links and no component. Repeated rows count once and all come back; rows that share a vec_id but not the vector never
    link with each other, and share the sum of their links.

    Equal vectors are compared as one class with the number of its members, so a million copies cost as much as one vector.
    A cell of more than ``block`` classes is split; every block of visitors meets every block of residents, so no task holds
    a whole hot cell, and what it returns are counts and a forest, never its pairs.
    """
    base = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"))
    grid = fit_grid(vectors, vector, cosine, recall)
    if grid is None:
        return base.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    members, classes = _classes(vectors, vec_id, vector, label)
    cells = written(_cells(classes, grid), "cells")
    lives = F.col("cell") == F.col("home")
    sizes = cells.groupBy("label", "cell").agg(F.count(F.when(lives, 1)).alias("n"), F.count(F.lit(1)).alias("p")).where("n > 0 and p > 1")
    sized = cells.join(sizes, ["label", "cell"])
    residents, visitors = F.ceil(F.col("n") / block).cast("int"), F.ceil(F.col("p") / block).cast("int")
    own = lambda k: F.pmod(F.xxhash64("id", "v"), k).cast("int")
    asking = sized.select("label", "cell", "home", "id", "m", "v", F.lit(False).alias("lives"), own(visitors).alias("i"), F.explode(F.sequence(F.lit(0), residents - 1)).alias("j"))
    living = sized.where(lives).select("label", "cell", "home", "id", "m", "v", F.lit(True).alias("lives"), F.explode(F.sequence(F.lit(0), visitors - 1)).alias("i"), own(residents).alias("j"))

    def compare(table: pa.Table) -> pa.Table:
        v = np.stack(table.column("v").combine_chunks().to_numpy(zero_copy_only=False)).astype(np.float64)
        ids, home, m, lives_ = (table.column(c).to_numpy() for c in ("id", "home", "m", "lives"))
        if not lives_.any() or lives_.all():
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
        at, n, nodes, roots = compare_blocks(grid, v[~lives_], ids[~lives_], m[~lives_], home[~lives_], v[lives_], ids[lives_], m[lives_])
        some = n > 0
        a, b = np.concatenate([at[some], nodes]), np.concatenate([at[some], roots])
        return pa.table({"a": a, "b": b, "n": np.concatenate([n[some], np.zeros(len(nodes), np.int64)])})

    met = asking.unionByName(living).groupBy("label", "cell", "i", "j").applyInArrow(compare, "a bigint, b bigint, n bigint")
    met = written(met, "vector-links")
    counts = met.where("n > 0").groupBy("a").agg(F.sum("n").alias("found")).withColumnRenamed("a", "id")
    joined = connected(met.where("n = 0").select("a", "b")).withColumnRenamed("node", "id")
    # Members of a class link with each other and share what their class links with.
    named = base.join(members, "vec_id", "left").select("vec_id", F.coalesce("id", "vec_id").alias("id"), F.coalesce("m", F.lit(1)).alias("m"))
    out = named.join(counts, "id", "left").join(joined, "id", "left")
    component, n_links = F.coalesce("component", "id"), F.coalesce("found", F.lit(0)) + F.col("m") - 1
    return out.select("vec_id", n_links.cast("bigint").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"))
