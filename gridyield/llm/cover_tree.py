"""Cover trees for the largest inner products inside windows.

A candidate x gets one more component sqrt(M^2 - |x|^2), M being the largest norm, so all candidates lie on one sphere. A
query q is scaled to norm M and gets a zero there. Then q.x falls as the distance d(q, x) grows:

    q.x = |q| / M * (M^2 - d^2 / 2)

A node is a centre with a covering radius, the largest distance of its members. By the triangle inequality the distances of a node's
members, and so their inner products, lie within bounds that follow from the distance of the centre. The search goes
down from the node with the highest bound, skips nodes outside a window, and verifies leaves on the integers themselves.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

FAN = 16  # centres of a node at most
LEAF = 128  # members of a leaf
SLACK = 1e-9  # of the squared norm, for rounding


def lifted(values: np.ndarray, norm: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(norm * norm - (values * values).sum(1), 0.0))
    return np.concatenate([values, rest[:, None]], axis=1)


def asked(values: np.ndarray, norm: float) -> tuple[np.ndarray, np.ndarray]:
    """(points, norms) of queries: scaled to the sphere. A zero query has inner product 0 with all."""
    length = np.sqrt((values * values).sum(1))
    scale = np.divide(norm, length, out=np.zeros_like(length), where=length > 0)
    return np.concatenate([values * scale[:, None], np.zeros((len(values), 1))], axis=1), length


def distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    square = (points * points).sum(1)[:, None] + (centres * centres).sum(1)[None] - 2 * points @ centres.T
    return np.sqrt(np.maximum(square, 0.0))


def bounds(points: np.ndarray, length: np.ndarray, centres: np.ndarray, radius: np.ndarray, norm: float) -> tuple[np.ndarray, np.ndarray]:
    """(low, high): what the inner products of each query with the members of each node lie between."""
    d = distances(points, centres)
    near, far = np.maximum(d - radius, 0.0), d + radius
    scale = (length / norm if norm > 0 else np.zeros_like(length))[:, None]
    slack = SLACK * (norm * length + 1.0)[:, None]
    return scale * (norm * norm - far * far / 2) - slack, scale * (norm * norm - near * near / 2) + slack


def farthest_first(points: np.ndarray, most: int, reach: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(centres, of, distance): rows chosen as centres, each the farthest from those before it, until all rows are within
    ``reach`` or there are ``most``; the centre of each row and its distance."""
    chosen = [0]
    d = distances(points, points[:1])[:, 0]
    of = np.zeros(len(points), np.int64)
    while len(chosen) < most and d.max() > reach:
        new = int(d.argmax())
        other = distances(points, points[new:new + 1])[:, 0]
        closer = other < d
        closer[new] = True
        of[closer], d[closer] = len(chosen), other[closer]
        chosen.append(new)
    d[chosen] = 0.0
    return np.array(chosen), of, d


@dataclass
class Tree:
    """Leaves as rows ``order[border[k]:border[k + 1]]``; levels of nodes, each with the range of leaves below it."""

    order: np.ndarray
    border: np.ndarray
    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]  # centres, radius, first leaf, leaf after the last


def build(points: np.ndarray, leaf: int = LEAF, fan: int = FAN) -> Tree:
    """Every level halves the covering radius, or takes ``fan`` centres where that does not do; nodes of ``leaf`` rows stay whole."""
    levels: list[list[tuple]] = []
    parts: list[np.ndarray] = []

    def split(rows: np.ndarray, centre: int, radius: float, level: int) -> None:
        while len(levels) <= level:
            levels.append([])
        at = len(levels[level])
        levels[level].append(None)
        begin = len(parts)
        if len(rows) <= leaf or radius == 0:
            parts.append(rows)
        else:
            rows = np.concatenate([[centre], rows[rows != centre]])  # the centre stays a centre below
            chosen, of, d = farthest_first(points[rows], fan, radius / 2)
            for k, c in enumerate(rows[chosen]):
                mine = of == k
                split(rows[mine], int(c), float(d[mine].max()), level + 1)
        levels[level][at] = (centre, radius, begin, len(parts))

    if len(points):
        split(np.arange(len(points)), 0, float(distances(points, points[:1]).max()), 0)
    arrays = []
    for level in levels:
        centre, radius, begin, end = (np.array(c) for c in zip(*level))
        arrays.append((points[centre], radius + SLACK * (1.0 + radius), begin, end))
    order = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return Tree(order, np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64), arrays)


def dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of integers: in doubles where they hold them, else in Python's integers."""
    reach = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if reach < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    if any(abs(x) >= 2**63 for x in exact.ravel()):
        raise OverflowError("an inner product does not fit 64 bits")
    return exact.astype(np.int64)


def leaf_bounds(tree: Tree, points: np.ndarray, length: np.ndarray, norm: float, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(best, open): for each query and leaf the least upper bound of the nodes above it, and whether all of them meet [low, high]."""
    leaves = len(tree.border) - 1
    best = np.full((len(points), leaves), np.inf)
    open_ = np.ones((len(points), leaves), bool)
    for centres, radius, begin, end in tree.levels:
        nodes_low, nodes_high = bounds(points, length, centres, radius, norm)
        meets = (nodes_high >= low[:, None]) & (nodes_low <= high[:, None])
        for k in range(len(begin)):
            some = slice(begin[k], end[k])
            best[:, some] = np.minimum(best[:, some], nodes_high[:, k:k + 1])
            open_[:, some] &= meets[:, k:k + 1]
    return best, open_
