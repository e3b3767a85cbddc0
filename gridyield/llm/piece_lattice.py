"""Lattices of many words at a time, and the fold that follows the merges of a BPE model through them.

The characters of all words stand in one array. From every character the piece table is met by equality, one character more at
a time, as long as some piece goes on like this; the pieces found are the edges. Places that no edge of two characters or more crosses cut
the words into segments, which do not depend on each other. All segments fold at once, each step joins in every segment the two neighbours whose
union has the highest score, of equal ones the leftmost. Long segments are folded one by one with a heap, in n log n.
"""

from __future__ import annotations

import heapq

import numpy as np

LONG = 128  # characters of a segment that is folded with the others
TOGETHER = 200_000  # characters of the words that are folded together
CODE = 21  # bits of a character


class PieceLattice:
    """encode(words): the piece ids of each word, as bytes of little-endian 32-bit integers."""

    def __init__(self, pieces: list[tuple[str, int, float]], byte_zero: int):
        self.byte_zero, self.longest = byte_zero, max(len(p) for p, _, _ in pieces)
        self.score = np.full(max(i for _, i, _ in pieces) + 1, -np.inf)
        steps: dict[tuple[int, int], int] = {}
        ids = {}
        for piece, i, score in pieces:
            node = 0
            for c in map(ord, piece):
                node = steps.setdefault((node, c), len(steps) + 1)
            ids[node], self.score[i] = i, score
        self.piece_at = np.full(len(steps) + 1, -1, np.int32)
        self.piece_at[list(ids)] = list(ids.values())
        self.first = np.zeros(1 << CODE, np.int32)
        for (node, c), to in steps.items():
            if node == 0:
                self.first[c] = to
        keys = np.array([node << CODE | c for node, c in steps], np.int64)
        order = np.argsort(keys)
        self.keys, self.to = keys[order], np.array(list(steps.values()), np.int32)[order]

    def edges(self, chars: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Piece of l + 1 characters from each character on, -1 if there is none; none goes beyond the ``end`` of its word."""
        found = np.full((len(chars), self.longest), -1, np.int32)
        start, node = np.arange(len(chars)), self.first[chars]
        for length in range(1, self.longest + 1):
            if length > 1:
                open_ = start + length <= end[start]
                start, node = start[open_], node[open_]
                key = node.astype(np.int64) << CODE | chars[start + length - 1]
                place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                node = np.where(self.keys[place] == key, self.to[place], 0)
            start, node = start[node > 0], node[node > 0]
            found[start, length - 1] = self.piece_at[node]
        return found

    def encode(self, words: list[str]) -> list[bytes]:
        out: list[bytes] = []
        some: list[str] = []
        size = 0
        for word in words:
            if some and size + len(word) > TOGETHER:
                out += self._encode(some)
                some, size = [], 0
            some.append(word)
            size += len(word)
        return out + self._encode(some) if some else out

    def _encode(self, words: list[str]) -> list[bytes]:
        text = "".join(words)
        chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        borders = np.concatenate([[0], np.cumsum(sizes)])
        edges = self.edges(chars, np.repeat(borders[1:], sizes))
        start, stop = self._merged(edges)
        ids = edges[start, stop - start - 1]
        # A character without a piece becomes its bytes.
        lacking = np.flatnonzero(ids < 0)
        if len(lacking):
            as_bytes = [np.frombuffer(text[s].encode("utf-8", "surrogatepass"), np.uint8).astype(np.int32) + self.byte_zero for s in start[lacking].tolist()]
            counts = np.ones(len(ids), np.int64)
            counts[lacking] = list(map(len, as_bytes))
            ids, start = np.repeat(ids, counts), np.repeat(start, counts)
            ids[ids < 0] = np.concatenate(as_bytes)
        raw = ids.astype("<i4").tobytes()
        cut = (4 * np.searchsorted(start, borders)).tolist()
        return [raw[a:b] for a, b in zip(cut, cut[1:])]

    def _merged(self, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the parts of all words in ascending order."""
        n = len(edges)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        wide = np.where((edges >= 0).any(1), self.longest - (edges[:, ::-1] >= 0).argmax(1), 1)
        reach = np.maximum.accumulate(np.arange(n) + wide)
        first = np.concatenate([[0], np.flatnonzero(reach[:-1] <= np.arange(1, n)) + 1])  # of the segments
        sizes = np.diff(np.append(first, n))
        done = [self._by_heap(edges, a, a + k) for a, k in zip(first[sizes > LONG].tolist(), sizes[sizes > LONG].tolist())]
        segment = np.repeat(np.arange(len(first)), sizes)
        start = np.flatnonzero(np.repeat(sizes <= LONG, sizes))
        segment, stop = segment[start], start + 1
        going = np.zeros(len(first), bool)
        while len(start):
            left = np.flatnonzero(segment[:-1] == segment[1:])
            s, e = start[left], stop[left + 1]
            width = np.minimum(e - s, self.longest)
            union = np.where(e - s == width, edges[s, width - 1], -1)
            left, union = left[union >= 0], union[union >= 0]
            owner, score = segment[left], self.score[union]
            groups = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else np.zeros(0, np.int64)
            if len(groups):
                highest = np.repeat(np.maximum.reduceat(score, groups), np.diff(np.append(groups, len(owner))))
                best = np.flatnonzero(score == highest)
                best = best[np.concatenate([[True], owner[best[1:]] != owner[best[:-1]]])]
                chosen = left[best]
            else:
                chosen = left
            going[:] = False
            going[segment[chosen]] = True
            rest = ~going[segment]
            done.append((start[rest], stop[rest]))
            stop[chosen] = stop[chosen + 1]
            stay = ~rest
            stay[chosen + 1] = False
            start, stop, segment = start[stay], stop[stay], segment[stay]
        start, stop = (np.concatenate(c) for c in zip(*done))
        order = np.argsort(start)
        return start[order], stop[order]

    def _by_heap(self, edges: np.ndarray, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """The parts of one segment; unions wait in a heap and count if both neighbours are still as they were."""
        n = last - first
        own, score = edges[first:last], self.score
        stop, before, waiting = list(range(1, n + 1)), list(range(-1, n - 1)), []

        def offer(s: int) -> None:
            middle = stop[s]
            if middle < n and stop[middle] - s <= self.longest and (i := own[s, stop[middle] - s - 1]) >= 0:
                heapq.heappush(waiting, (-score[i], s, middle, stop[middle]))

        for s in range(n):
            offer(s)
        while waiting:
            _, s, middle, e = heapq.heappop(waiting)
            if stop[s] == middle and stop[middle] == e:
                stop[s], stop[middle] = e, -1
                if e < n:
                    before[e] = s
                offer(s)
                if before[s] >= 0:
                    offer(before[s])
        starts = np.flatnonzero(np.array(stop) > 0)
        return starts + first, np.array(stop)[starts] + first
