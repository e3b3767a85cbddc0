"""Jaccard self-join on word shingles by parity sketches.

A set of shingles is sketched in lanes. Every shingle belongs to one lane, given by its hash, and flips
one of the 64 bits of that lane; a second number of the lane holds the XOR of its shingle hashes. A
shingle that two sets do not share changes one lane at most, so the number of lanes that differ never
exceeds the symmetric difference of the sets, and neither does the Hamming distance of the bits. Sets of
Jaccard similarity t differ in at most (1 - t) / (1 + t) of the sum of their sizes. With one lane more than
that, two linked sets agree in a lane (pigeonhole), and lanes are joined by equality. The number of lanes
depends on sizes, so there is one sketch per band of sizes; a set is sketched for its own band, and for
the bands below in which a smaller partner may lie.

Sets that meet in a lane are compared by 64 min-hashes of eight bits first. Linked sets agree in 80 per cent of
them on average; pairs that agree in fewer than AGREE are dropped, which a linked pair suffers with a probability
below 1e-11. This keeps sets that share a passage only apart. What is left makes candidate clusters. Within a cluster every pair is verified on whole sets, so no link is
lost; what a cluster gives back is one link per set, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridyield.llm.common import shuffle_partitions, small, text_bytes, written
from gridyield.llm.components import connected
from gridyield.llm.shingles import STEP, mix, shingle_sets

BAND = 1.5  # ratio of the sizes at the ends of a band
SEEDS = 40  # sketches of a set at most; in the last one empty lanes are joined as well
BATCH_BYTES = 1 << 20  # text that is hashed at a time
FLUSH = 1 << 20  # lane entries a task holds before it sends them
HASHES = 64
AGREE = 27
CLUSTER = 2048  # sets of a cluster that are verified in one task, and sets of a lane that are compared in one


def band_starts(limit: int) -> np.ndarray:
    """Smallest sizes of the bands up to ``limit``."""
    starts = [1]
    while starts[-1] <= limit:
        starts.append(max(starts[-1] + 1, int(starts[-1] * BAND)))
    return np.array(starts, np.int64)


def most_different(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Largest symmetric difference of linked sets of sizes a and b.

    100 * shared >= percent * union gives difference * (100 + percent) <= (100 - percent) * (a + b).
    """
    return (100 - percent) * (a + b) // (100 + percent)


def lanes(starts: np.ndarray, percent: int) -> np.ndarray:
    """Lanes of each band: more than the largest symmetric difference of linked sets whose smaller one lies in it, and an eighth to spare."""
    a = starts[1:] - 1
    most = most_different(a, 100 * a // percent, percent)
    return most + 2 + most // 8


def sketch_keys(value: np.ndarray, borders: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, owners): the 64-bit join keys of all lanes of all sketches of the sets, and the set of each key.

    Empty lanes say nothing and are not joined. A set that has more filled lanes than a partner can differ in is
    safe: one of its filled lanes is the same in the partner. A set that is not safe is sketched again with the next
    seed, until it is; both sets of a pair have the sketch in which the first of them is safe.
    """
    size = np.diff(borders)
    if not len(value):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    starts = band_starts(int(size.max()))
    number = lanes(starts, percent)
    own = np.searchsorted(starts, size, "right") - 1
    lowest = np.searchsorted(starts, -(-size * percent // 100), "right") - 1
    bit = np.uint64(1) << (mix(value ^ np.uint64(0xA5A5)) & np.uint64(63))
    owner_of = np.repeat(np.arange(len(size)), size)
    keys, owners = [], []
    for down in range(int((own - lowest)[size > 0].max()) + 1):
        band = own - down
        takes = (size > 0) & (band >= lowest)
        partner = 100 * size // percent if down == 0 else np.minimum(starts[np.maximum(band, 0) + 1] - 1, size)
        differ = most_different(size, partner, percent)
        for seed in range(SEEDS):
            width = np.where(takes, number[np.maximum(band, 0)], 0)
            base = np.concatenate([[0], np.cumsum(width)])
            rows = np.flatnonzero(takes[owner_of])
            of = owner_of[rows]
            spread = mix(value[rows] + np.uint64(seed * int(STEP) % 2**64)) >> np.uint64(32)
            lane = base[of] + ((spread * width[of].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
            parity, check = np.zeros(base[-1], np.uint64), np.zeros(base[-1], np.uint64)
            np.bitwise_xor.at(parity, lane, bit[rows])
            np.bitwise_xor.at(check, lane, value[rows])
            filled = np.bincount(lane, minlength=base[-1]) > 0
            owner = np.repeat(np.arange(len(size)), width)
            unsafe = takes & (np.bincount(owner[filled], minlength=len(size)) <= differ)
            shown = filled | unsafe[owner] if seed == SEEDS - 1 else filled
            place = np.arange(base[-1]) - base[owner] + (band[owner] << 32) + (seed << 48)
            keys.append(mix(mix(mix(place[shown].astype(np.uint64)) + parity[shown]) + check[shown]))
            owners.append(owner[shown])
            takes = unsafe
            if not takes.any():
                break
    return np.concatenate(keys), np.concatenate(owners)


def _grouped(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > BATCH_BYTES:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def _set_name(value: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(value.tobytes())


def _number(name: bytes) -> int:
    """A set's number in the graph: 64 bits of its name."""
    return int.from_bytes(name[:8], "little", signed=True)


def _sets(texts: list[bytes], words: int) -> Iterator[np.ndarray]:
    """The shingle set of each text."""
    for a, b in _grouped(texts):
        value, borders = shingle_sets(texts[a:b], words)
        yield from (value[x:y] for x, y in zip(borders[:-1], borders[1:]))


def shingle_counts(docs: DataFrame, doc_id: str, text: str, words: int) -> DataFrame:
    """doc_id, n_shingles the 128-bit name of the set and its number (null for an empty set), one row per row."""

    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("name", pa.binary()), ("number", pa.int64()), ("signature", pa.binary())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            sizes, names, signs = [], [], []
            texts = [text_bytes(t) for t in batch.column(1).to_pylist()]
            for a, b in _grouped(texts):
                value, borders = shingle_sets(texts[a:b], words)
                sizes += np.diff(borders).tolist()
                names += [_set_name(value[x:y]) if y > x else None for x, y in zip(borders[:-1], borders[1:])]
                signs += min_hashes(value, borders)
            columns = [sizes, names, [n and _number(n) for n in names], signs]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, schema.types[1:]))], schema=schema)

    pairs = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return pairs.mapInArrow(count, "doc_id bigint, n_shingles bigint, name binary, number bigint, signature binary")


def min_hashes(value: np.ndarray, borders: np.ndarray) -> list[bytes | None]:
    """HASHES bytes for each set, null for an empty one."""
    size = np.diff(borders)
    filled = np.flatnonzero(size)
    out = np.zeros((len(filled), HASHES), np.uint8)
    if len(filled):
        factor = mix(np.arange(1, HASHES + 1).astype(np.uint64) * STEP) | np.uint64(1)
        for k in range(HASHES):
            out[:, k] = mix(np.minimum.reduceat(value * factor[k], borders[filled])) >> np.uint64(56)
    rows: list[bytes | None] = [None] * len(size)
    for i, row in zip(filled.tolist(), out):
        rows[i] = row.tobytes()
    return rows


def _met(docs: DataFrame, text: str, words: int, percent: int, slots: int) -> DataFrame:
    """(lane, number): the sets of every lane that holds two different sets or more. Lanes with the same sets are one.

    A set is numbered by 64 bits of its name. Copies are sketched once per task. Entries travel as packed
    arrays of (key, set), one row per slot of the key space and flush; a slot holds about
    1 / slots of all entries, and a key has one entry per set and task at most.
    """

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[tuple[np.ndarray, np.ndarray]] = []
        total = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, total
            key, who = (np.concatenate(c) for c in zip(*held))
            slot = ((key >> np.uint64(40)) % np.uint64(slots)).astype(np.int64)
            order = np.argsort(slot, kind="stable")
            entry = np.stack([key[order], who[order]], 1)
            border = np.searchsorted(slot[order], np.arange(slots + 1))
            used = np.flatnonzero(np.diff(border))
            held, total = [], 0
            return pa.RecordBatch.from_arrays(
                [pa.array(used.astype(np.int32)), pa.array([entry[border[s]:border[s + 1]].tobytes() for s in used], pa.binary())], names=["slot", "entries"]
            )

        for batch in small(batches):
            texts = [text_bytes(t) for t in batch.column(0).to_pylist()]
            for a, b in _grouped(texts):
                value, borders = shingle_sets(texts[a:b], words)
                number = np.array([_number(_set_name(value[x:y])) for x, y in zip(borders[:-1], borders[1:])], np.int64).view(np.uint64)
                new = [i for i in range(b - a) if borders[i + 1] > borders[i] and not (int(number[i]) in seen or seen.add(int(number[i])))]
                if not new:
                    continue
                size = np.diff(borders)
                keep = np.zeros(b - a, bool)
                keep[new] = True
                key, owner = sketch_keys(value[np.repeat(keep, size)], np.concatenate([[0], np.cumsum(size[keep])]), percent)
                held.append((key, number[keep][owner]))
                total += len(key)
                if total >= FLUSH:
                    yield flush()
        if held:
            yield flush()

    def meet(group: pa.Table) -> pa.Table:
        entry = np.frombuffer(b"".join(group.column("entries").to_pylist()), np.uint64).reshape(-1, 2)
        key, who = entry[:, 0], entry[:, 1]
        order = np.lexsort((who, key))
        key, who = key[order], who[order]
        if not len(key):
            return pa.table({"lane": pa.array([], pa.int64()), "number": pa.array([], pa.int64())})
        opens = np.concatenate([[True], key[1:] != key[:-1]])
        new = opens | np.concatenate([[True], who[1:] != who[:-1]])
        key, who = key[new], who[new]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(first, len(key)))
        # The sets of a lane, in ascending order, name it.
        lane = np.repeat(mix(np.add.reduceat(mix(who), first) + size.astype(np.uint64)), size)
        several = np.repeat(size > 1, size)
        pairs = np.unique(np.stack([lane[several], who[several]], 1), axis=0).view(np.int64)
        return pa.table({"lane": pa.array(pairs[:, 0].copy()), "number": pa.array(pairs[:, 1].copy())})

    entries = docs.select(F.col(text).alias("text")).mapInArrow(sketch, "slot int, entries binary")
    return entries.groupBy("slot").applyInArrow(meet, "lane bigint, number bigint").distinct()


def alike(signature: np.ndarray, split: int | None = None) -> list[tuple[int, int]]:
    """Links (i, j) that join all rows reachable by pairs of signatures that agree in AGREE bytes or more.

    The first row not joined yet is compared with all rows, so a lane of alike sets takes one comparison per set.
    With ``split`` only pairs between the first ``split`` rows and the rest count.
    """
    n = len(signature)
    if n == 2 and split is None:
        return [(0, 1)] if (signature[0] == signature[1]).sum() >= AGREE else []
    root, links = np.arange(n), []
    rest = 0 if split is None else split
    for i in range(n if split is None else split):
        if i and (root == root[0]).all():
            break
        if (root[rest:] == root[i]).all():
            continue
        near = rest + np.flatnonzero((signature[rest:] == signature[i]).sum(1) >= AGREE)
        near = near[root[near] != root[i]]
        groups, one = np.unique(root[near], return_index=True)
        links += [(i, int(j)) for j in near[one]]
        root[np.isin(root, groups)] = root[i]
    return links


def _dealt_lanes(met: DataFrame, slots: int, block: int) -> DataFrame:
    """lane, number, own, slot, i, j: lanes of more than ``block`` sets are cut into blocks, block i meets block j in the task (lane, i, j)."""
    sizes = met.groupBy("lane").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block)
    sized = met.join(sizes.select("lane", F.ceil(F.col("n") / F.lit(block)).cast("int").alias("blocks")), "lane", "left")
    own = F.coalesce(F.pmod(F.xxhash64("number"), F.col("blocks")).cast("int"), F.lit(-1))
    slot = F.when(F.col("blocks").isNull(), F.pmod("lane", F.lit(slots))).otherwise(F.col("lane"))
    other = F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(-1))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = sized.select("lane", "number", own.alias("own"), slot.alias("slot"), other.alias("other"))
    return dealt.select("lane", "number", "own", "slot", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))


def _candidates(met: DataFrame, signatures: DataFrame, slots: int, block: int) -> DataFrame:
    """Links (a, b) of sets that share a lane and are alike."""

    def compare(table: pa.Table) -> pa.Table:
        lane, number, own = (table.column(c).to_numpy() for c in ("lane", "number", "own"))
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        sign = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint8).reshape(-1, HASHES)
        order = np.lexsort((number, own != i, lane))
        lane, number, sign = lane[order], number[order], sign[order]
        if i != j:
            found = alike(sign, int((own == i).sum()))
            return pa.table({"a": pa.array(number[np.array([x for x, _ in found], np.int64)], pa.int64()), "b": pa.array(number[np.array([y for _, y in found], np.int64)], pa.int64())})
        first = np.flatnonzero(np.concatenate([[True], lane[1:] != lane[:-1]]))
        size = np.diff(np.append(first, len(lane)))
        two = first[size == 2]
        two = two[(sign[two] == sign[two + 1]).sum(1) >= AGREE]
        a, b = [number[two]], [number[two + 1]]
        for start, n in zip(first[size > 2].tolist(), size[size > 2].tolist()):
            found = alike(sign[start:start + n])
            a.append(number[start + np.array([x for x, _ in found], np.int64)])
            b.append(number[start + np.array([y for _, y in found], np.int64)])
        return pa.table({"a": pa.array(np.concatenate(a)), "b": pa.array(np.concatenate(b))})

    rows = _dealt_lanes(met, slots, block).join(signatures, "number").select("slot", "i", "j", "lane", "number", "own", "signature")
    return rows.groupBy("slot", "i", "j").applyInArrow(compare, "a bigint, b bigint").distinct()


def verify_sets(sets: list[np.ndarray], numbers: np.ndarray, percent: int, split: int | None = None) -> np.ndarray:
    """Links (n, 2) that join all sets reachable from each other by pairs of at least ``percent`` per cent.

    Every pair that is not joined already is judged by its exact intersection, counted over an inverted list.
    With ``split`` only pairs between the first ``split`` sets and the rest are judged.
    """
    size = np.array([len(s) for s in sets], np.int64)
    value = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), size)
    order = np.argsort(value, kind="stable")
    value, owner_by = value[order], owner[order]
    opens = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]])) if len(value) else np.zeros(0, np.int64)
    length = np.diff(np.append(opens, len(value)))
    group = np.empty(len(value), np.int64)
    group[order] = np.repeat(np.arange(len(opens)), length)
    shared = length[group] > 1
    root = np.arange(len(sets))
    links = []
    border = np.concatenate([[0], np.cumsum(size)])
    for i in range(len(sets)):
        if split is not None and i >= split:
            break
        rest = i + 1 if split is None else split
        if (root[rest:] == root[i]).all():
            continue
        mine = group[border[i]:border[i + 1]][shared[border[i]:border[i + 1]]]
        if not len(mine):
            continue
        take = length[mine]
        at = np.repeat(opens[mine] - np.concatenate([[0], np.cumsum(take)[:-1]]), take) + np.arange(take.sum())
        common = np.bincount(owner_by[at], minlength=len(sets))
        common[:rest] = 0
        union = size + size[i] - common
        for j in np.flatnonzero((common > 0) & (100 * common >= percent * union)):
            if root[j] != root[i]:
                links.append((numbers[i], numbers[j]))
                root[root == root[j]] = root[i]
    return np.array(links, np.int64).reshape(-1, 2)


def _verified(members: DataFrame, words: int, percent: int, block: int) -> DataFrame:
    """Links (a, b) of verified pairs; members: cluster, number, n_members, packed text."""
    blocks = F.ceil(F.col("n_members") / F.lit(block)).cast("int")
    spread = members.withColumn("_blocks", blocks).withColumn("_block", F.pmod(F.xxhash64("number"), F.col("_blocks")).cast("int"))
    # Block i meets block j in the task (min, max); a cluster of one block is one task.
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    spread = spread.withColumn("_other", other).select(
        "cluster", F.least("_block", "_other").alias("i"), F.greatest("_block", "_other").alias("j"), "_block", "number", "packed"
    )

    def check(group: pa.Table) -> pa.Table:
        open_ = zstandard.ZstdDecompressor()
        i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
        mine = np.array(group.column("_block").to_pylist())
        order = np.argsort(mine != i, kind="stable")
        packed = group.column("packed").to_pylist()
        numbers = np.array(group.column("number").to_pylist(), np.int64)[order]
        sets = list(_sets([open_.decompress(packed[k]) for k in order], words))
        first = int((mine == i).sum())
        # A doc_id may stand on rows of several texts; only the row of this set counts, and once.
        right, met = [], set()
        for k, (s, number) in enumerate(zip(sets, numbers.tolist())):
            if len(s) and number not in met and _number(_set_name(s)) == number:
                met.add(number)
                right.append(k)
        sets, numbers, first = [sets[k] for k in right], numbers[right], sum(k < first for k in right)
        found = verify_sets(sets, numbers, percent, None if i == j else first)
        return pa.table({"a": pa.array(found[:, 0]), "b": pa.array(found[:, 1])})

    return spread.groupBy("cluster", "i", "j").applyInArrow(check, "a bigint, b bigint")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compressed texts, for the way through the shuffle."""
    squeeze = zstandard.ZstdCompressor(level=1)
    for batch in small(batches):
        packed = [squeeze.compress(text_bytes(t)) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["least", "packed"])


def link_documents(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80, block: int = CLUSTER
) -> DataFrame:
    """doc_id, n_shingles, component_id for every row: the smallest doc_id reachable by links, itself included.

    Two documents link when 100 * shared >= percent * union of their shingle sets. Null, empty and blank texts
    have an empty set and link with nothing. Documents with equal sets are one class from the start, so a group of
    copies costs one row each whatever its size. A row without a doc_id links with copies only: it has their
    component, null if it has none. Repeated rows all come back. Sets are numbered by 64-bit hashes.
    Lanes and clusters of more than ``block`` sets are cut into blocks that meet in pairs, one pair in a task.
    """
    spark = docs.sparkSession
    slots = 2 * shuffle_partitions(spark)
    counts = written(shingle_counts(docs, doc_id, text, words), "shingle-counts")
    met = written(_met(docs.where(F.col(doc_id).isNotNull()), text, words, percent, slots), "lanes-met")
    signatures = counts.where("number is not null").groupBy("number").agg(F.min("signature").alias("signature"))
    met = written(_candidates(met, signatures, slots, block), "candidates")
    classes = counts.where("name is not null").groupBy("name", "number").agg(F.min("doc_id").alias("least"))
    clusters = written(connected(met), "clusters")
    sizes = clusters.groupBy("component").agg(F.count(F.lit(1)).alias("n_members"))
    wanted = clusters.join(sizes, "component").join(classes.withColumnRenamed("number", "node"), "node").where("least is not null")
    wanted = wanted.select(F.col("component").alias("cluster"), F.col("node").alias("number"), "n_members", "least")
    packed = docs.select(F.col(doc_id).cast("bigint").alias("least"), F.col(text).alias("text")).where("least is not null")
    members = wanted.join(packed.mapInArrow(_pack, "least bigint, packed binary"), "least")
    links = written(_verified(members, words, percent, block), "verified")
    joined = connected(links)
    classes = classes.join(joined.withColumnRenamed("node", "number"), "number", "left")
    group = F.coalesce("component", "number")
    least = classes.groupBy(group.alias("g")).agg(F.min("least").alias("component_id"))
    named = classes.select("name", group.alias("g")).join(least, "g").select("name", "component_id")
    return counts.join(named, "name", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
