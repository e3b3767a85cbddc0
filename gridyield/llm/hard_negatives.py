"""Hard negatives: for each anchor and positive the best rows of other labels whose inner product lies in a window.

Rows are dealt to cells, the nodes of a cover tree's upper level: centres from a bounded sample, covering radii from all rows.
A block of a cell is one task's work and holds a cover tree of its own (``cover_tree``). An anchor first asks its own cell. What it
finds there bounds what it still needs, and only cells and nodes whose bounds meet that are visited. So positives and
negatives are exact, whatever the sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridyield.llm.common import written
from gridyield.llm.cover_tree import asked, bounds, build, distances, dot, farthest_first, leaf_bounds, lifted

SAMPLE = 20_000  # rows the centres come from
CELL = 8192  # rows a cell should hold
MOST_CELLS = 1024  # beyond, cells get more blocks
BLOCK = 16_384  # rows of a cell in one task
ASKED = 512  # anchors of a task
TOGETHER = 8  # leaves verified at a time
LOWEST, HIGHEST = -(2**62), 2**62
NO_CELL = -1


@dataclass
class Cells:
    dims: int
    norm: float
    centres: np.ndarray
    radius: np.ndarray


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length as rows."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(n, len(flat) // n) if n else flat.reshape(0, 0)


def _lists(values: np.ndarray) -> pa.Array:
    n, dims = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * dims), pa.array(np.ascontiguousarray(values).reshape(-1)))


def _rows(vectors: DataFrame, vec_id: str, label: str, vector: str, scale: int) -> DataFrame:
    """id, label, v, dims: the rows that take part, each different one once; components floor(scale x)."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    some = vectors.where(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & F.coalesce(finite, F.lit(False)))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    some = some.select(F.col(vec_id).cast("bigint").alias("id"), F.col(label).cast("string").alias("label"), whole.alias("v"))
    return some.dropDuplicates().withColumn("dims", F.size("v"))


def _cells(rows: DataFrame, cell: int, sample: int, seed: int = 11) -> Cells:
    """Centres for the most frequent length; radii are still open. Rows of another length stay in one cell per length."""
    sizes = rows.groupBy("dims").agg(F.count(F.lit(1)).alias("n"))
    most = sizes.agg(F.max(F.struct("n", "dims")).alias("m")).first()["m"]
    if not most:
        return Cells(0, 0.0, np.zeros((0, 1)), np.zeros(0))
    same = rows.where(F.col("dims") == most["dims"])
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    norm = float(np.sqrt(same.agg(F.max(square)).first()[0]))
    some = same.select("v") if most["n"] <= sample else same.select("v").sample(fraction=sample / most["n"], seed=seed)
    points = lifted(_matrix(some.toArrow().column(0)).astype(np.float64), norm)
    if not len(points):
        return Cells(most["dims"], norm, np.zeros((0, most["dims"] + 1)), np.zeros(0))
    chosen, _, _ = farthest_first(points, int(np.clip(-(-most["n"] // cell), 1, MOST_CELLS)), 0.0)
    return Cells(most["dims"], norm, points[chosen], np.zeros(len(chosen)))


def _placed(rows: DataFrame, cells: Cells) -> DataFrame:
    """Rows of the usual length with their nearest cell and the distance to its centre."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, len(whole), 4096):
                batch = whole.slice(k, 4096)
                d = distances(lifted(_matrix(batch.column("v")).astype(np.float64), cells.norm), cells.centres)
                near = d.argmin(1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near), pa.array(d[np.arange(len(near)), near])], names=[*batch.schema.names, "cell", "d"])

    usual = rows.where(F.col("dims") == cells.dims) if len(cells.centres) else rows.limit(0)
    others = rows.where(F.col("dims") != cells.dims) if len(cells.centres) else rows
    placed = usual.mapInArrow(place, "id bigint, label string, v array<bigint>, dims int, cell bigint, d double")
    return placed.unionByName(others.withColumns({"cell": F.lit(NO_CELL).cast("bigint"), "d": F.lit(0.0)}))


def _top(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best by score, then id; an id counts once."""
    order = np.lexsort((ids, -scores))
    ids, scores = ids[order], scores[order]
    _, first = np.unique(ids, return_index=True)
    first = np.sort(first)[:k]
    return ids[first], scores[first]


def search(
    values: np.ndarray, ids: np.ndarray, labels: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, query_labels: np.ndarray,
    low: list[np.ndarray], high: list[np.ndarray], k: int, same: bool,
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(query, window, ids, scores): for each window the k best rows of the query's label, or of other labels, in [low, high]."""
    norm = float(np.sqrt((values.astype(np.float64) ** 2).sum(1).max(initial=0.0)))
    points, length = asked(queries.astype(np.float64), norm)
    tree = build(lifted(values.astype(np.float64), norm))
    least, most = np.array([x.min() for x in low], np.float64), np.array([x.max() for x in high], np.float64)
    best, open_ = leaf_bounds(tree, points, length, norm, least, most)
    for q in range(len(queries)):
        leaves = np.flatnonzero(open_[q])
        leaves = leaves[np.argsort(-best[q, leaves], kind="stable")]
        need, held = low[q].copy(), [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(low[q])
        for a in range(0, len(leaves), TOGETHER):
            some = leaves[a:a + TOGETHER]
            if best[q, some[0]] < need.min():
                break
            rows = np.concatenate([tree.order[tree.border[x]:tree.border[x + 1]] for x in some])
            rows = rows[((labels[rows] == query_labels[q]) == same) & (ids[rows] != query_ids[q])]
            score = dot(values[rows], queries[q:q + 1])[:, 0]
            for w in range(len(need)):
                fits = np.flatnonzero((score >= need[w]) & (score <= high[q][w]))
                if len(fits):
                    held[w] = _top(np.concatenate([held[w][0], ids[rows[fits]]]), np.concatenate([held[w][1], score[fits]]), k)
                    if len(held[w][0]) == k:
                        need[w] = held[w][1][-1]
        for w, (i, s) in enumerate(held):
            if len(i):
                yield q, w, i, s


def _searched(rows: DataFrame, asking: DataFrame, keys: list[str], k: int, same: bool, block: int, most_asked: int) -> DataFrame:
    """anchor, w, id, score: what each anchor finds in each block of the cells it asks.

    ``asking``: id, label, v, low, high and the keys. A row is sent once per ``most_asked`` anchors that ask its own cell.
    """
    sizes = rows.groupBy(keys).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    slots = asking.groupBy(keys).agg(F.ceil(F.count(F.lit(1)) / most_asked).cast("int").alias("slots"))
    both = written(sizes.join(slots, keys), "cells-asked")
    none = F.lit(None).cast("array<bigint>")
    columns = [*keys, "block", "slot", "id", "label_", "v", "low", "high"]

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    have = rows.withColumn("label_", F.col("label")).join(both, keys).withColumn("slot", every("slots"))
    have = have.withColumn("block", F.pmod(F.xxhash64("id", "v"), "blocks").cast("int")).withColumns({"low": none, "high": none}).select(columns)
    ask = asking.withColumn("label_", F.col("label")).join(both, keys).withColumn("block", every("blocks"))
    ask = ask.withColumn("slot", F.pmod(F.xxhash64("id"), "slots").cast("int")).select(columns)
    schema = pa.schema([("anchor", pa.int64()), ("w", pa.int32()), ("id", pa.int64()), ("score", pa.int64())])

    def answer(table: pa.Table) -> pa.Table:
        asks = table.column("low").is_valid().to_numpy()
        v, ids = _matrix(table.column("v")), table.column("id").to_numpy()
        labels = table.column("label_").to_numpy()
        low, high = ([np.asarray(x, np.int64) for x in table.column(c).filter(pa.array(asks)).to_pylist()] for c in ("low", "high"))
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64))]
        if asks.any() and not asks.all():
            of = ids[asks]
            for q, w, i, s in search(v[~asks], ids[~asks], labels[~asks], v[asks], of, labels[asks], low, high, k, same):
                out.append((np.full(len(i), of[q]), np.full(len(i), w, np.int32), i, s))
        return pa.table([pa.array(np.concatenate(c), t) for c, t in zip(zip(*out), schema.types)], schema=schema)

    return have.unionByName(ask).groupBy(*keys, "block", "slot").applyInArrow(answer, "anchor bigint, w int, id bigint, score bigint")


def _best(found: DataFrame, k: int) -> DataFrame:
    once = found.groupBy("anchor", "w", "id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("anchor", "w").orderBy(F.desc("score"), "id")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _complete(rows: DataFrame, asking: DataFrame, cells: Cells, keys: list[str], k: int, same: bool, block: int, most_asked: int) -> DataFrame:
    """The k best of all cells for each anchor and window: own cell first, then the cells that can hold better ones."""
    first = written(_searched(rows, asking, keys, k, same, block, most_asked), "own-cell")
    reached = _best(first, k).groupBy("anchor", "w").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).where(F.col("n") == k)
    known = reached.groupBy(F.col("anchor").alias("id")).agg(F.map_from_entries(F.collect_list(F.struct("w", "least"))).alias("known"))
    need = F.transform("low", lambda x, w: F.greatest(x, F.coalesce(F.try_element_at("known", w), x)))
    bounded = asking.join(known, "id", "left").withColumn("low", F.when(F.col("known").isNull(), F.col("low")).otherwise(need)).drop("known")

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, len(whole), 1024):
                batch = whole.slice(a, 1024)
                points, length = asked(_matrix(batch.column("v")).astype(np.float64), cells.norm)
                under, over = bounds(points, length, cells.centres, cells.radius, cells.norm)
                low, high = (batch.column(c).to_pylist() for c in ("low", "high"))
                meets = np.array([((over[q][:, None] >= np.array(low[q])) & (under[q][:, None] <= np.array(high[q]))).any(1) for q in range(len(batch))])
                meets[np.arange(len(batch)), batch.column("cell").to_numpy()] = False
                who, where = np.nonzero(meets)
                for b in range(0, len(who), 4096):
                    sent = batch.take(pa.array(who[b:b + 4096]))
                    at = sent.schema.get_field_index("cell")
                    yield sent.set_column(at, sent.schema.field(at), pa.array(where[b:b + 4096]))

    usual = bounded.where(F.col("cell") != NO_CELL)
    later = _searched(rows, written(usual.mapInArrow(visits, usual.schema), "visits"), keys, k, same, block, most_asked)
    return _best(first.unionByName(later), k)


def hard_negatives(
    vectors: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256,
    vec_id: str = "vec_id", label: str = "label", vector: str = "embedding", cell: int = CELL, block: int = BLOCK, most_asked: int = ASKED, sample: int = SAMPLE,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Components become floor(scale x). The score of two rows is their integer inner product; higher ones come first, ties by smaller
    vec_id. Anchors are the rows whose vec_id is divisible by ``every``; their positives the first other rows of their label. For
    each positive the first ``negatives`` rows of other labels with low * positive_score <= 100 * score <= high * positive_score are returned.

    Rows without vec_id or label, and vectors that are null or hold a null or non-finite component, take no part; zero and empty ones
    do. Only vectors of one length meet. A vec_id on several rows counts once for an anchor, at its best row, and is no neighbour of itself;
    as an anchor it asks with the smallest (label, vector). An inner product beyond 64 bits is an error. Further columns are not read.
    """
    rows = written(_rows(vectors, vec_id, label, vector, scale), "vectors")
    cells = _cells(rows, cell, sample)
    rows = written(_placed(rows, cells), "placed")
    for r in rows.where(F.col("cell") != NO_CELL).groupBy("cell").agg(F.max("d").alias("d")).collect():  # at most MOST_CELLS rows
        cells.radius[r["cell"]] = r["d"] * (1 + 1e-9) + 1e-9
    rows = rows.drop("d")
    one = rows.where(F.col("id") % every == 0).groupBy("id").agg(F.min(F.struct("label", "v", "dims", "cell")).alias("one"))
    anchors = written(one.select("id", "one.*"), "anchors")

    all_ = anchors.withColumns({"low": F.array(F.lit(LOWEST)), "high": F.array(F.lit(HIGHEST))})
    found = written(_complete(rows, all_, cells, ["dims", "cell", "label"], positives, True, block, most_asked), "positives")

    able = found.where(F.col("score") * low <= F.col("score") * high)
    window = F.struct(F.col("rank").alias("p"), F.expr(f"(score * {low} + 99) div 100").alias("low"), F.expr(f"score * {high} div 100").alias("high"))
    windows = able.groupBy(F.col("anchor").alias("id")).agg(F.sort_array(F.collect_list(window)).alias("windows"))
    asking = anchors.join(windows, "id").select("id", "label", "v", "dims", "cell", F.col("windows.low").alias("low"), F.col("windows.high").alias("high"))
    best = _complete(rows, written(asking, "windows"), cells, ["dims", "cell"], negatives, False, block, most_asked)
    # able keeps the first ranks, so window w belongs to the positive of rank w + 1.
    chosen = found.select("anchor", (F.col("rank") - 1).alias("w"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    out = best.join(chosen, ["anchor", "w"])
    return out.select(F.col("anchor").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
