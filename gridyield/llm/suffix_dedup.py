"""Removal of repeated byte strings by suffix sorting.

A byte goes if it is covered by a string of ``length`` bytes that also starts elsewhere. Two places that
hold the same string hold the same anchor in it: among the grams of ``gram`` bytes that start in a
string's window the one with the smallest hash. So texts are compared only around anchors whose gram
occurs more than once. The stretch around an anchor reaches as far as any such string that has the anchor in it.

* Grams are counted first, by themselves; only places of grams that occur more than once are named and sent.
* Stretches that are equal as a whole are repeated as a whole; they are counted by a 128-bit name.
* The distinct stretches around one gram are sorted as suffixes, in two stages: suffixes smaller than their
  successor directly, the others induced from them bucket by bucket. Neighbours with ``length`` bytes in common
  are repeated strings.
* A gram with more distinct stretches than one task should hold is divided by content: equal strings hold the anchor at the same
  place, so strings with the anchor at ``BLOCK`` neighbouring places go by the hash of the bytes that all of them share. Where a passage of very many
  texts ends, that tells the texts apart. What still shares those bytes goes string by string.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridyield.llm.common import small, text_bytes, written
from gridyield.llm.shingles import mix, prefix_hashes, span_hash
from gridyield.operators.sizing import broadcast_if_small

LENGTH = 400
GRAM = 160
SLICE = 1 << 19  # bytes that are searched for anchors at a time
STRETCHES = 3000  # stretches sorted together
PART = 10_000  # most stretches of one gram or one first text that are sorted together
BLOCKS = (16, 1)  # neighbouring places of the anchor that stay together when a gram is divided, and when one of its blocks is
NO_ID = -(2**63)


# Anchors


def anchors(data: np.ndarray, borders: np.ndarray, length: int, gram: int) -> np.ndarray:
    """Starts of the anchors of all strings of ``length`` bytes inside the texts that end at ``borders``."""
    n = len(data)
    if n < length:
        return np.zeros(0, np.int64)
    start = np.arange(n - gram + 1)
    value = mix(span_hash(prefix_hashes(data), start, start + gram))
    key = (value & np.uint64(0xFFFFFFFF00000000)) | start.astype(np.uint64)
    width, reach = length - gram + 1, 1
    while 2 * reach <= width:  # smallest of a growing run, so the leftmost of equal ones
        key = np.minimum(key[:-reach], key[reach:])
        reach *= 2
    if reach < width:
        key = np.minimum(key[:reach - width], key[width - reach:])
    first = np.arange(len(key))
    owner_end = borders[np.searchsorted(borders, first, "right")]
    place = (key[first + length <= owner_end] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    return place[np.concatenate([[True], place[1:] != place[:-1]])] if len(place) else place


def _text_anchors(texts: list[bytes], length: int, gram: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(text, anchor starts, gram hashes); long texts in slices that overlap by one string."""

    def searched(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = anchors(data, ends, length, gram)
        return at, mix(span_hash(prefix_hashes(data), at, at + gram)) if len(at) else np.zeros(0, np.uint64)

    together: list[int] = []
    size = 0

    def flush() -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        ends = np.cumsum([len(texts[i]) for i in together])
        at, value = searched(np.frombuffer(b"".join(texts[i] for i in together), np.uint8), ends)
        border = np.searchsorted(at, np.concatenate([[0], ends]))
        for k, i in enumerate(together):
            yield i, at[border[k]:border[k + 1]] - (ends[k] - len(texts[i])), value[border[k]:border[k + 1]]

    for i, text in enumerate(texts):
        if len(text) < length:
            continue
        if len(text) > SLICE:
            seen = -1
            for a in range(0, len(text) - length + 1, SLICE):
                data = np.frombuffer(text, np.uint8)[a:a + SLICE + length - 1]
                at, value = searched(data, np.array([len(data)]))
                new = at + a > seen
                seen = max(seen, int((at + a).max(initial=-1)))
                yield i, at[new] + a, value[new]
            continue
        if together and size + len(text) > SLICE:
            yield from flush()
            together, size = [], 0
        together.append(i)
        size += len(text)
    if together:
        yield from flush()


# Suffix sorting


def suffix_order(data: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes in ascending order, by their first ``depth`` bytes at least.

    Suffixes that are smaller than their successor are sorted directly. The others follow from them in one pass
    over the buckets of first bytes: a bucket takes the suffixes whose successor is already placed in the order of
    their successors, then those that repeat its byte, each after the one it precedes in the text.
    """
    n = len(data)
    step = np.sign(np.append(data[1:].astype(np.int16), -1) - data.astype(np.int16))
    known = np.where(step != 0, np.arange(n, dtype=np.int32), np.int32(n))
    follows = np.minimum.accumulate(known[::-1])[::-1]  # the next place where neighbours differ
    smaller = step[np.minimum(follows, n - 1)] > 0
    raw = data.tobytes()
    rank = np.full(n + 1, -1, np.int32)  # the empty suffix comes first
    order, placed = np.empty(n, np.int32), 0
    by_byte = np.argsort(data, kind="stable").astype(np.int32)
    borders = np.searchsorted(data[by_byte], np.arange(257))
    after = np.append(data[1:].astype(np.int16), -1)
    for c in range(256):
        members = by_byte[borders[c]:borders[c + 1]]
        if not len(members):
            continue

        def put(some: np.ndarray) -> None:
            nonlocal placed
            order[placed:placed + len(some)] = some
            rank[some] = np.arange(placed, placed + len(some))
            placed += len(some)

        induced = members[~smaller[members]]
        level = induced[after[induced] < c]
        level = level[np.argsort(rank[level + 1], kind="stable")]
        while len(level):
            put(level)
            level = level[level > 0] - 1
            level = level[data[level] == c]
        direct = members[smaller[members]]
        # By the second byte first, so that few strings are held at a time.
        direct = direct[np.argsort(after[direct], kind="stable")]
        for some in np.split(direct, np.flatnonzero(np.diff(after[direct])) + 1):
            if len(some):
                starts = some.tolist()
                keys = [raw[i:i + depth] for i in starts]
                put(some[sorted(range(len(starts)), key=keys.__getitem__)])
    return order


def common_prefixes(data: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Length of the common prefix of the suffixes at a[i] and b[i], up to ``most``; both have that many bytes."""
    out = np.zeros(len(a), np.int64)
    open_ = np.arange(len(a))
    done = 0
    while done < most and len(open_):
        width = min(16 if done == 0 else 2 * done, most - done)
        view = np.lib.stride_tricks.sliding_window_view(data, width)
        same = np.empty(len(open_), bool)
        for k in range(0, len(open_), 65536):
            some = open_[k:k + 65536]
            differs = view[a[some] + done] != view[b[some] + done]
            same[k:k + 65536] = ~differs.any(1)
            out[some] = done + np.where(same[k:k + 65536], width, differs.argmax(1))
        open_ = open_[same]
        done += width
    return out


def repeated_starts(stretches: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, run): all starts of strings of ``length`` bytes in the concatenation of the stretches, in suffix order,
    and the number of the run of equal strings each belongs to. Strings do not cross the stretches.
    """
    data = np.frombuffer(b"".join(stretches), np.uint8)
    sizes = np.array([len(s) for s in stretches])
    room = np.repeat(np.cumsum(sizes).astype(np.int32), sizes)
    room -= np.arange(len(data), dtype=np.int32)
    order = suffix_order(data, length)
    order = order[room[order] >= length]
    if not len(order):
        return order, order
    prefix = common_prefixes(data, order[:-1], order[1:], length)
    return order, np.cumsum(np.concatenate([[True], prefix < length]), dtype=np.int32) - 1


# Spark


def _key(doc_id: str) -> Column:
    return F.coalesce(F.col(doc_id).cast("bigint"), F.lit(NO_ID))


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(_key(doc_id).alias("id"), F.xxhash64(F.col(text)).alias("h"), F.col(text).alias("text"))


PLACES = "id bigint, h bigint, start bigint, end bigint, at bigint, gram bigint, name binary"
PLACE_SCHEMA = pa.schema([
    ("id", pa.int64()), ("h", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("at", pa.int64()), ("gram", pa.int64()), ("name", pa.binary()),
])


def _anchor_rows(keyed: DataFrame, length: int, gram: int) -> DataFrame:
    """id, h, start and end of the stretch, at, gram, name: a row per anchor."""
    before = length - gram

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            ids, h = (batch.column(k).to_numpy() for k in (0, 1))
            texts = [text_bytes(t) for t in batch.column(2).to_pylist()]
            for i, at, value in _text_anchors(texts, length, gram):
                text = texts[i]
                start, end = np.maximum(at - before, 0), np.minimum(at + length, len(text))
                digest = xxhash.xxh3_128_digest
                # Where the anchor stands in the stretch is part of its name.
                names = [digest(text[a:b], seed=p) for a, b, p in zip(start.tolist(), end.tolist(), (at - start).tolist())]
                n = len(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, ids[i])), pa.array(np.full(n, h[i])), pa.array(start), pa.array(end), pa.array(at), pa.array(value.view(np.int64)), pa.array(names, pa.binary())],
                    schema=PLACE_SCHEMA,
                )

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in find(batches):
            held.append(batch)
            rows += len(batch)
            if rows >= 50_000:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, rows = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return keyed.mapInArrow(joined, PLACES)


def _gram_rows(keyed: DataFrame, length: int, gram: int) -> DataFrame:
    """gram: a row per anchor."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, 2000):
            found = [value for _, _, value in _text_anchors([text_bytes(t) for t in batch.column(2).to_pylist()], length, gram)]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], names=["gram"])

    return keyed.mapInArrow(find, "gram bigint")


def _divided(length: int, block: int):
    """As ``_anchor_rows`` for the stretches ``cuts`` of each text, divided by where the strings hold the anchor.

    The gram is now the hash of the bytes that all strings of a block share, the stretch what they cover.
    """

    def divide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, digest = zstandard.ZstdDecompressor(), xxhash.xxh3_128_digest
        for batch in small(batches, 200):
            rows = []
            for i, h, packed, cuts in zip(*(batch.column(c).to_pylist() for c in ("id", "h", "packed", "cuts"))):
                data = open_.decompress(packed)
                for c in cuts:
                    at, first, last = c["at"], c["start"], c["end"] - length
                    for k in range((at - last) // block, (at - first) // block + 1):
                        a, b = max(at - k * block - block + 1, first), min(at - k * block, last)
                        core = data[at - k * block:at - k * block - block + 1 + length]
                        gram = xxhash.xxh3_64_intdigest(core, seed=k * block)
                        rows.append((i, h, a, b + length, at, gram - 2**64 if gram >= 2**63 else gram, digest(data[a:b + length], seed=at - a)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), PLACE_SCHEMA.types)], schema=PLACE_SCHEMA)

    return divide


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed for the shuffle; further columns as they are."""
    squeeze = zstandard.ZstdCompressor(level=1)
    for batch in small(batches):
        packed = pa.array([squeeze.compress(text_bytes(t)) for t in batch.column(2).to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], packed, *batch.columns[3:]], names=["id", "h", "packed", *batch.schema.names[3:]])


CUTS = "g bigint, id bigint, h bigint, start bigint, sure array<bigint>, stretch binary"
CUT_SCHEMA = pa.schema([("g", pa.int64()), ("id", pa.int64()), ("h", pa.int64()), ("start", pa.int64()), ("sure", pa.list_(pa.int64())), ("stretch", pa.binary())])


def _cut(length: int):
    """Stretches of each text; those of one group that overlap are one.

    ``sure``: pairs of numbers, the starts from and before which strings are known to be repeated.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor()
        for batch in small(batches, 200):
            rows = []
            for i, h, packed, cuts in zip(*(batch.column(c).to_pylist() for c in ("id", "h", "packed", "cuts"))):
                data = open_.decompress(packed)
                runs: list[dict] = []
                for c in sorted(cuts, key=lambda c: (c["g"], c["start"])):
                    sure = [c["start"], c["end"] - length + 1] if c["n"] > 1 else []
                    last = runs[-1] if runs else None
                    if last and last["g"] == c["g"] and c["start"] <= last["end"]:
                        last["end"] = max(last["end"], c["end"])
                        last["sure"] += sure
                    else:
                        runs.append({"g": c["g"], "id": i, "h": h, "start": c["start"], "end": c["end"], "sure": sure})
                rows += [{**r, "stretch": data[r["start"]:r.pop("end")]} for r in runs]
            if rows:
                yield pa.RecordBatch.from_pylist(rows, CUT_SCHEMA)

    return cut


def _sort(length: int):
    schema = pa.schema([("id", pa.int64()), ("h", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])

    def sort(table: pa.Table) -> pa.Table:
        ids, h, start = (table.column(c).to_numpy() for c in ("id", "h", "start"))
        stretches, sure = table.column("stretch").to_pylist(), table.column("sure").to_pylist()
        sizes = np.array([len(s) for s in stretches])
        offset = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        order, run = repeated_starts(stretches, length)
        runs = int(run[-1]) + 1 if len(run) else 0
        marked = np.zeros(int(sizes.sum()), bool)
        for at, pairs, first in zip(offset.tolist(), sure, start.tolist()):
            for a, b in zip(pairs[::2], pairs[1::2]):
                marked[at + a - first:at + b - first] = True
        known = (np.bincount(run, minlength=runs) > 1) | (np.bincount(run, weights=marked[order], minlength=runs) > 0)
        hit = np.sort(order[known[run] & ~marked[order]])
        # Neighbouring starts make one span.
        of = np.searchsorted(offset, hit, "right") - 1
        breaks = np.concatenate([[True], (hit[1:] != hit[:-1] + 1) | (of[1:] != of[:-1])]) if len(hit) else np.zeros(0, bool)
        first = np.flatnonzero(breaks)
        last = np.append(first[1:] - 1, len(hit) - 1)[:len(first)]
        base = start[of[first]] - offset[of[first]]
        columns = (ids[of[first]], h[of[first]], hit[first] + base, hit[last] + base + length)
        return pa.table([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)

    return sort


def repeated_spans(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, stretches: int = STRETCHES, part: int = PART
) -> DataFrame:
    """id, h, spans: for each text with repeated bytes the (start, end) spans to remove, not yet merged.

    ``id`` is the doc_id (the smallest 64-bit number if null) and ``h`` the hash of the text; rows equal in both
    are copies of each other and share their spans.
    """
    if not 0 < gram <= length:
        raise ValueError("the gram is a part of the string")
    keyed = _keyed(docs, doc_id, text)
    # Rows that are equal in id and text count as places above, and are cut once.
    packed = keyed.mapInArrow(_packed, "id bigint, h bigint, packed binary")
    often = written(_gram_rows(keyed, length, gram).groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram"), "repeated-grams")
    found = written(_anchor_rows(keyed, length, gram).join(often, "gram", "left_semi"), "anchors")
    spans: list[DataFrame] = []
    for block in (*BLOCKS, None):
        # Counts combine before they are sent, so a passage that very many texts share is no large group.
        distinct = found.groupBy("gram", "name").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "h", "start", "end", "at")).alias("one"))
        distinct = written(distinct, "stretches")
        # A name that occurs twice stands for a repeated stretch.
        spans.append(found.join(distinct.where("n > 1").select("name"), "name").select("id", "h", "start", "end"))
        if block is None:  # every stretch is one string
            break
        # Grams are sorted together where the first text that has them is the same, because the stretches of near copies
        # around neighbouring anchors overlap. A text that brings together too many is left out of this.
        grams = distinct.groupBy("gram").agg(F.count(F.lit(1)).alias("m"), F.min(F.struct("one.id", "one.h")).alias("hub")).where("m > 1")
        grams = written(grams, "grams")
        few = grams.where(F.col("m") <= part)
        hubs = few.groupBy("hub").agg(F.sum("m").alias("total"))
        total = hubs.agg(F.sum("total")).first()[0] or 0
        groups = max(1, -(-total // stretches))
        near = F.pmod(F.when(F.col("total") > part, F.xxhash64("gram")).otherwise(F.xxhash64("hub.id", "hub.h")), F.lit(groups))
        wanted = distinct.join(few.join(hubs, "hub").select("gram", near.alias("g")), "gram").select("one.*", "n", "g")
        per_text = wanted.groupBy("id", "h").agg(F.collect_list(F.struct("g", "start", "end", "n")).alias("cuts"))
        stretched = packed.dropDuplicates(["id", "h"]).join(per_text, ["id", "h"]).mapInArrow(_cut(length), CUTS)
        spans.append(written(stretched.groupBy("g").applyInArrow(_sort(length), "id bigint, h bigint, start bigint, end bigint"), "sorted"))
        many = grams.where(F.col("m") > part).select("gram")
        if many.isEmpty():
            break
        per_text = distinct.join(many, "gram").select("one.*").groupBy("id", "h").agg(F.collect_list(F.struct("start", "end", "at")).alias("cuts"))
        # Mostly few texts, so the others need not move; the plan knows the size of what is written.
        per_text = broadcast_if_small(written(per_text, "hot-places"))
        hot = packed.join(per_text, ["id", "h"]).dropDuplicates(["id", "h"])
        found = written(hot.mapInArrow(_divided(length, block), PLACES), "divided")
    return reduce(DataFrame.unionByName, spans).groupBy("id", "h").agg(F.collect_set(F.struct("start", "end")).alias("spans"))


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal runs of the spans."""
    out: list[list[int]] = []
    for a, b in sorted((s["start"], s["end"]) for s in spans or []):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def removed_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, part: int = PART, others: list[str] | None = None
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept and the columns ``others``: one row for every row of ``docs``.

    ``kept`` is the text of the bytes that stay, without characters that a removal cuts in two; the hash is that of all
    bytes that stay. Null and empty texts have no bytes. Places in one text count like places in different ones; texts
    of copies and repeated rows go as a whole if they have ``length`` bytes. Other columns of ``docs`` are left out, whatever their names,
    but for ``others``.
    """
    spans = written(repeated_spans(docs, doc_id, text, length, gram, part=part), "spans")
    carried = F.struct(*(F.col(c) for c in others)) if others else F.lit(None).cast("int")
    rows = docs.select(_key(doc_id).alias("id"), F.xxhash64(F.col(text)).alias("h"), F.col(text).alias("text"), carried.alias("others"))
    kind = rows.schema["others"].dataType.simpleString()
    packed = rows.mapInArrow(_packed, f"id bigint, h bigint, packed binary, others {kind}")
    texts = packed.join(spans, ["id", "h"], "left").select("id", "packed", "others", "spans")
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string())])

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor()
        for batch in small(batches):
            out = []
            for i, body, found in zip(*(batch.column(c).to_pylist() for c in ("id", "packed", "spans"))):
                data, at, kept = open_.decompress(body), 0, []
                runs = merged(found)
                for a, b in runs:
                    kept.append(data[at:a])
                    at = b
                rest = b"".join([*kept, data[at:]])
                out.append((None if i == NO_ID else i, len(data), len(data) - len(rest), len(runs), hashlib.sha256(rest).hexdigest(), rest.decode("utf-8", "ignore")))
            columns = [pa.array(c, t) for c, t in zip(zip(*out), schema.types)]
            yield pa.RecordBatch.from_arrays([*columns, batch.column("others")], names=[*schema.names, "others"])

    done = texts.mapInArrow(remove, f"doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept string, others {kind}")
    return done.select(*schema.names, *([F.col("others")[c].alias(c) for c in others] if others else []))
