"""Best-two-fit packing of documents into sequences of a fixed length.

A bin is filled greedily with the longest piece that fits. Then its shortest piece makes room for the
two unpacked pieces that fit the gap it leaves most tightly, if they fill it better. Which pieces a bin
gets depends on lengths alone, and equal bins follow each other until a length runs short. So the bins
are planned once on the number of pieces of each length, a table of at most ``context`` numbers whatever the
number of documents, and the pieces find their place by their rank among the pieces of their length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridyield.llm.common import shuffle_partitions, written
from gridyield.llm.tokens import KEPT_WORDS, encoder

PIECES = pa.schema([
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
])


def encode_pieces(
    docs: DataFrame, tokenizer: str, context: int, end_id: int | None = None, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False,
    kept_words: int = KEPT_WORDS,
) -> DataFrame:
    """Pieces of every text: doc_id, piece (from 0), start, length, ids_crc32, and with ``with_ids`` the ids.

    Texts of at most ``context`` ids, end id included, are one piece. Longer ones are cut into pieces of
    ``context`` ids, where the first piece takes what is left over. Null and empty texts hold the end id only;
    without an end id they have no piece. ``kept_words`` bounds the memory of a worker (see ``tokens``).
    """
    schema = PIECES.append(pa.field("ids", pa.list_(pa.int32()))) if with_ids else PIECES

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, end = encoder(tokenizer, kept_words=kept_words), np.array([] if end_id is None else [end_id], "<u4")
        for batch in batches:
            for k in range(0, len(batch), 256):
                some, rows = batch.slice(k, 256), []
                for name, ids in zip(some.column(0).to_pylist(), own.ids(some.column(1).to_pylist())):
                    ids = np.concatenate([ids, end])
                    if not len(ids):
                        continue
                    borders = [0, *range((len(ids) - 1) % context + 1, len(ids) + 1, context)]
                    for i, (a, b) in enumerate(zip(borders, borders[1:])):
                        part = ids[a:b]
                        rows.append((name, i, a, b - a, zlib.crc32(part), *([part.astype(np.int32)] if with_ids else [])))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    kind = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(cut, kind)


def plan_bins(counts: dict[int, int], context: int) -> list[tuple[int, list[int]]]:
    """Bins as (how many equal ones, lengths longest first) that hold ``counts[length]`` pieces of each length."""
    left = {n: c for n, c in counts.items() if c}
    lengths, plan = sorted(left), []
    if lengths and (lengths[0] < 1 or lengths[-1] > context):
        raise ValueError(f"lengths go from 1 to {context}")

    def longest(room: int, used: Counter) -> int | None:
        i = bisect_right(lengths, room) - 1
        while i >= 0 and left[lengths[i]] <= used[lengths[i]]:
            i -= 1
        return lengths[i] if i >= 0 else None

    while lengths:
        used: Counter = Counter()
        room = context
        while room and (n := longest(room, used)):
            used[n] += 1
            room -= n
        smallest = min(used)
        if room:
            used[smallest] -= 1
            pair = _best_two(lengths, left, used, room + smallest)
            if pair and sum(pair) > smallest:
                used.update(pair)
            else:
                used[smallest] += 1
        used = +used
        times = min(left[n] // c for n, c in used.items())
        plan.append((times, sorted(used.elements(), reverse=True)))
        for n, c in used.items():
            left[n] -= c * times
            if not left[n]:
                del left[n]
                lengths.remove(n)
    return plan


def _best_two(lengths: list[int], left: dict[int, int], used: Counter, room: int) -> tuple[int, int] | None:
    """The two unpacked lengths with the largest sum up to ``room``; of equal sums the one with the longer piece."""
    best, found = 0, None
    low, high = 0, bisect_right(lengths, room) - 1
    while low <= high:
        a, b = lengths[low], lengths[high]
        free_a, free_b = left[a] - used[a], left[b] - used[b]
        if free_a < 1:
            low += 1
        elif free_b < 1:
            high -= 1
        elif a + b > room:
            high -= 1
        else:
            if a + b > best and (a != b or free_a > 1):
                best, found = a + b, (a, b)
            low += 1
    return found


def _slots(plan: list[tuple[int, list[int]]]) -> dict[int, np.ndarray]:
    """For each length its runs of ranks: first rank, first sequence, pieces per bin, and the offsets of those pieces."""
    taken: Counter = Counter()
    runs: dict[int, list] = {}
    sequence = 0
    for times, members in plan:
        offsets: dict[int, list[int]] = {}
        at = 0
        for n in members:
            offsets.setdefault(n, []).append(at)
            at += n
        for n, places in offsets.items():
            # Equal pieces stand next to each other, so their offsets follow from the first.
            runs.setdefault(n, []).append((taken[n], sequence, len(places), places[0]))
            taken[n] += times * len(places)
        sequence += times
    return {n: np.array(r, np.int64) for n, r in runs.items()}


def pack_pieces(pieces: DataFrame, context: int) -> DataFrame:
    """All columns of ``pieces`` (with doc_id, piece and length) and sequence_id and offset.

    Sequences are filled from offset 0 without gaps. Pieces of one length are ranked in buckets of a hash of
    their name, so a length that a third of all pieces share is ranked by many tasks; the counts per
    length and bucket give the first rank of each bucket. Repeated rows are pieces of their own. The pieces
    are read twice, so they are written once to the shared folder before.
    """
    spark = pieces.sparkSession
    pieces = written(pieces, "pieces")
    buckets = max(8, 2 * shuffle_partitions(spark))
    pieces = pieces.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).cast("int"))
    sizes = pieces.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = _slots(plan_bins(counts, context))
    # Ranks start per length and bucket from the sum of the buckets before it: at most context x buckets rows.
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.withColumn("_first", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    inside = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece")
    ranked = pieces.withColumn("_rank", F.row_number().over(inside) - 1).join(first, ["length", "_bucket"])
    ranked = ranked.withColumn("_rank", F.col("_rank") + F.col("_first")).select(*pieces.columns[:-1], "_rank")
    names = pieces.columns[:-1]
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.select(*names).schema) + ", sequence_id bigint, offset bigint"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column(names.index("length")).to_numpy()
            rank = batch.column(len(names)).to_numpy()
            sequence, offset = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            for n in np.unique(length):
                rows = np.flatnonzero(length == n)
                runs = slots[int(n)]
                run = runs[np.searchsorted(runs[:, 0], rank[rows], "right") - 1]
                step = rank[rows] - run[:, 0]
                sequence[rows] = run[:, 1] + step // run[:, 2]
                offset[rows] = run[:, 3] + step % run[:, 2] * n
            columns = [*batch.columns[:len(names)], pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "sequence_id", "offset"])

    return ranked.mapInArrow(place, kind)
