"""Removal of repeated word windows by super-k-mers.

A window is ``window`` consecutive words of one document. Its minimiser is, of the grams of ``gram`` words in it, the one with
the smallest hash. Consecutive windows with the same minimiser make one super-k-mer: a string of words that holds all of them.
Equal windows have equal minimisers, so they meet in the bucket of that hash, where sorting shows which are equal.

* A bucket with one occurrence holds no repetition. Buckets are counted first, and only super-k-mers of the others go on.
* Equal super-k-mers are one row of a bucket, with the smallest doc_id; a passage of very many documents is no large bucket.
* A bucket with more than ``most`` different super-k-mers sends each of their windows by the hash of the window itself, so
  that it is dealt out evenly however many there are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridyield.llm.common import small, written
from gridyield.llm.shingles import STEP, WHITE, mix, prefix_hashes, span_hash

WINDOW = 13
GRAM = 4
MOST = 20_000  # super-k-mers sorted together
TOGETHER = 1 << 21  # bytes of short texts that are cut at a time
WORDS = 1 << 18  # words of a long text that are cut at a time
LAST_ID = 2**63 - 1  # stands for a null doc_id
KEYS = 1 << 40


def plain(text: bytes | None) -> bytes:
    """The words with one blank between them; bytes.split takes the six white-space bytes."""
    return b" ".join(text.split()) if text else b""


def word_borders(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = ~WHITE[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    return edge[::2], edge[1::2]


def _least(value: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost smallest of each run of ``width`` numbers, by their upper 32 bits."""
    key = (value & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(value), dtype=np.uint64)
    reach = 1
    while 2 * reach <= width:
        key = np.minimum(key[:-reach], key[reach:])
        reach *= 2
    if reach < width:
        key = np.minimum(key[:reach - width], key[width - reach:])
    return (key & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _runs(data: np.ndarray, start: np.ndarray, end: np.ndarray, of: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, windows, bucket) of each super-k-mer; ``of`` is the text of each word."""
    if len(start) < window:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    word = mix(span_hash(prefix_hashes(data), start, end) + (end - start).astype(np.uint64))
    value = np.full(len(word) - gram + 1, gram, np.uint64)
    for k in range(gram):
        value = mix(value * STEP + word[k:k + len(value)])
    first = np.flatnonzero(of[:len(of) - window + 1] == of[window - 1:])
    place = _least(value, window - gram + 1)[first]
    border = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]])) if len(place) else np.zeros(0, np.int64)
    return first[border], np.diff(np.append(border, len(place))), value[place[border]]


def super_kmers(texts: list[bytes], window: int = WINDOW, gram: int = GRAM) -> Iterator[tuple[int, bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(text, bytes, first word, windows, bucket, byte start, byte end) for texts as ``plain`` gives them.

    Short texts are cut together. Long ones in stretches that overlap by the words of a window, so a super-k-mer
    may end where a stretch does; each window is in exactly one.
    """
    together: list[int] = []

    def flush() -> Iterator:
        data = np.frombuffer(b"\n".join(texts[i] for i in together), np.uint8)
        ends = np.cumsum([len(texts[i]) + 1 for i in together])
        start, end = word_borders(data)
        of = np.searchsorted(ends, start, "right")
        base = np.searchsorted(of, np.arange(len(together) + 1))
        first, windows, bucket = _runs(data, start, end, of, window, gram)
        cut = np.searchsorted(of[first], np.arange(len(together) + 1)) if len(first) else np.zeros(len(together) + 1, np.int64)
        for k, i in enumerate(together):
            some, n = first[cut[k]:cut[k + 1]], windows[cut[k]:cut[k + 1]]
            off = ends[k] - len(texts[i]) - 1
            yield i, texts[i], some - base[k], n, bucket[cut[k]:cut[k + 1]], start[some] - off, end[some + n + window - 2] - off

    size = 0
    for i, text in enumerate(texts):
        if len(text) > TOGETHER:
            start, end = word_borders(np.frombuffer(text, np.uint8))
            for a in range(0, len(start), WORDS):
                b = min(a + WORDS + window - 1, len(start))
                off = start[a]
                data = np.frombuffer(text, np.uint8)[off:end[b - 1]]
                first, n, bucket = _runs(data, start[a:b] - off, end[a:b] - off, np.zeros(b - a, np.int8), window, gram)
                yield i, text, first + a, n, bucket, start[first + a], end[first + a + n + window - 2]
            continue
        if size + len(text) > TOGETHER:
            yield from flush()
            together, size = [], 0
        together.append(i)
        size += len(text) + 1
    if together:
        yield from flush()


def _names(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """id, h, body: the doc_id (``LAST_ID`` if null), a hash of the text, the text."""
    return docs.select(F.coalesce(F.col(doc_id).cast("bigint"), F.lit(LAST_ID)).alias("id"), F.xxhash64(F.col(text)).alias("h"), F.col(text).alias("body"))


def _key() -> Column:
    """A number for rows of one doc_id and text. Others may share it: then both look at the buckets of either."""
    return F.pmod(F.xxhash64("id", "h"), F.lit(KEYS))


def _bodies(batch: pa.RecordBatch, name: str = "body") -> list[bytes]:
    return [plain(t) for t in batch.column(name).cast(pa.binary()).to_pylist()]


def _buckets(window: int, gram: int):
    """bucket, key: the different buckets of each row."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, 2000):
            key, held = batch.column("key").to_numpy(), {}
            for i, _, _, _, bucket, _, _ in super_kmers(_bodies(batch), window, gram):
                held.setdefault(i, []).append(bucket)
            found = [(i, np.unique(np.concatenate(b))) for i, b in held.items()]
            if found:
                keys = np.repeat(key[[i for i, _ in found]], [len(b) for _, b in found])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([b for _, b in found]).view(np.int64)), pa.array(keys)], names=["bucket", "key"])

    return find


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bodies as compressed words for the shuffle; further columns as they are."""
    squeeze = zstandard.ZstdCompressor(level=3)
    for batch in small(batches):
        packed = pa.array([squeeze.compress(t) for t in _bodies(batch)], pa.binary())
        others = [n for n in batch.schema.names if n != "body"]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in others), packed], names=[*others, "packed"])


def _opened(batch: pa.RecordBatch) -> list[bytes]:
    unpack = zstandard.ZstdDecompressor()
    return [unpack.decompress(p) for p in batch.column("packed").to_pylist()]


PLACES = "bucket bigint, name bigint, id bigint, h bigint, start int, n int"


def _places(window: int, gram: int):
    """Super-k-mers in the buckets of each row, by a hash of their words."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, 500):
            ids, h = batch.column("id").to_numpy(), batch.column("h").to_numpy()
            wanted = [np.asarray(b, np.int64) for b in batch.column("buckets").to_pylist()]
            out: list[tuple] = []
            for i, text, first, n, bucket, a, b in super_kmers(_opened(batch), window, gram):
                bucket = bucket.view(np.int64)
                keep = np.isin(bucket, wanted[i])
                names = np.array([xxhash.xxh3_64_intdigest(text[x:y]) for x, y in zip(a[keep].tolist(), b[keep].tolist())], np.uint64).view(np.int64)
                m = len(names)
                out.append((bucket[keep], names, np.full(m, ids[i]), np.full(m, h[i]), first[keep].astype(np.int32), n[keep].astype(np.int32)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["bucket", "name", "id", "h", "start", "n"])

    return find


STRINGS = "g bigint, bucket bigint, name bigint, id bigint, k int, words binary"


def _strings(window: int, groups: int):
    """The words of each wanted super-k-mer in the group of its bucket; those of a hot bucket window by window."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, 200):
            out = []
            for i, text, wanted in zip(batch.column("id").to_pylist(), _opened(batch), batch.column("wanted").to_pylist()):
                start, end = word_borders(np.frombuffer(text, np.uint8))
                for w in wanted:
                    s, n = w["start"], w["n"]
                    if w["hot"]:
                        for k in range(n):
                            words = text[start[s + k]:end[s + k + window - 1]]
                            out.append((xxhash.xxh3_64_intdigest(words) % groups, w["bucket"], w["name"], i, k, words))
                    else:
                        out.append((w["bucket"] % groups, w["bucket"], w["name"], i, 0, text[start[s]:end[s + n + window - 2]]))
            if out:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["g", "bucket", "name", "id", "k", "words"])

    return cut


def least_ids(strings: list[bytes], ids: np.ndarray, window: int = WINDOW) -> list[np.ndarray]:
    """For each string the smallest id of all strings that hold its first, second, ... window."""
    raw = b"\n".join(strings)
    data = np.frombuffer(raw, np.uint8)
    start, end = word_borders(data)
    of = np.searchsorted(np.cumsum([len(s) + 1 for s in strings]), start, "right")
    first = np.flatnonzero(of[:len(of) - window + 1] == of[window - 1:])
    a, b = start[first].tolist(), end[first + window - 1].tolist()
    windows = [raw[x:y] for x, y in zip(a, b)]
    order = sorted(range(len(windows)), key=windows.__getitem__)
    owner = of[first]
    least = np.empty(len(windows), np.int64)
    new = np.array([True] + [windows[x] != windows[y] for x, y in zip(order[1:], order[:-1])])
    place = np.array(order, np.int64)
    least[place] = np.minimum.reduceat(ids[owner[place]], np.flatnonzero(new))[np.cumsum(new) - 1]
    return np.split(least, np.cumsum(np.bincount(owner, minlength=len(strings)))[:-1])


def _sort(window: int):
    def sort(table: pa.Table) -> pa.Table:
        least = least_ids(table.column("words").to_pylist(), table.column("id").to_numpy(), window)
        return pa.table({"bucket": table.column("bucket"), "name": table.column("name"), "k": table.column("k"), "least": pa.array(least, pa.list_(pa.int64()))})

    return sort


def repeated_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM, most: int = MOST) -> DataFrame:
    """id, h, starts: for each document the first words of windows that also start in a document with a smaller doc_id, as a set of lists."""
    if not 0 < gram <= window:
        raise ValueError("the gram is a part of the window")
    rows = _names(docs, doc_id, text).withColumn("key", _key())
    found = rows.mapInArrow(_buckets(window, gram), "bucket bigint, key bigint")
    repeated = written(found.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("bucket"), "buckets")
    per_row = found.join(repeated, "bucket", "left_semi").groupBy("key").agg(F.collect_list("bucket").alias("buckets"))
    packed = rows.select("id", "h", "key", "body").mapInArrow(_pack, "id bigint, h bigint, key bigint, packed binary")
    met = written(packed.join(per_row, "key").drop("key"), "candidates")

    places = written(met.mapInArrow(_places(window, gram), PLACES), "places")
    one = written(places.groupBy("bucket", "name").agg(F.min(F.struct("id", "h", "start", "n")).alias("one")), "super-k-mers")
    sizes = one.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    total = sizes.agg(F.sum("size")).first()[0] or 0
    groups = max(1, -(-total // most))
    wanted = one.join(sizes, "bucket").select("one.id", "one.h", F.struct("bucket", "name", "one.start", "one.n", (F.col("size") > most).alias("hot")).alias("w"))
    texts = met.select("id", "h", "packed").dropDuplicates(["id", "h"])
    cut = texts.join(wanted.groupBy("id", "h").agg(F.collect_list("w").alias("wanted")), ["id", "h"]).mapInArrow(_strings(window, groups), STRINGS)
    least = written(cut.groupBy("g").applyInArrow(_sort(window), "bucket bigint, name bigint, k int, least array<bigint>"), "least")
    # A super-k-mer that is alone in its bucket holds for all its windows.
    alone = one.join(sizes.select("bucket"), "bucket", "left_anti")
    alone = alone.select("bucket", "name", F.lit(0).alias("k"), F.array_repeat("one.id", F.col("one.n")).alias("least"))

    def starts(least: DataFrame) -> DataFrame:
        late = F.transform("least", lambda d, j: F.when(d < F.col("id"), F.col("start") + F.col("k") + j))
        return places.join(least, ["bucket", "name"]).select("id", "h", F.filter(late, lambda x: x.isNotNull()).alias("s")).where(F.size("s") > 0)

    return starts(least.unionByName(alone)).groupBy("id", "h").agg(F.collect_set("s").alias("starts"))


def removed_windows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM, most: int = MOST) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept: one row for every row of ``docs``.

    Words end at the six ASCII white-space bytes. A word goes if a window that covers it also starts in a document with a smaller
    doc_id. ``kept`` holds the other words with a blank between them. Null and empty texts have no words; texts with
    fewer words than a window keep them. Rows with the same doc_id are no smaller than each other, a null doc_id comes after all
    others. Further columns are left out, whatever their names.
    """
    starts = written(repeated_words(docs, doc_id, text, window, gram, most), "repeated-words")
    packed = _names(docs, doc_id, text).mapInArrow(_pack, "id bigint, h bigint, packed binary")
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string())])

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            out = []
            for i, body, found in zip(batch.column("id").to_pylist(), _opened(batch), batch.column("starts").to_pylist()):
                words = body.split(b" ") if body else []
                kept = words
                if found:
                    at = np.concatenate([np.asarray(f, np.int64) for f in found])
                    depth = np.zeros(len(words) + 1, np.int64)
                    np.add.at(depth, at, 1)
                    np.add.at(depth, at + window, -1)
                    kept = [words[k] for k in np.flatnonzero(np.cumsum(depth[:-1]) == 0)]
                rest = b" ".join(kept)
                out.append((None if i == LAST_ID else i, len(words), len(words) - len(kept), hashlib.sha256(rest).hexdigest(), rest.decode("utf-8", "replace")))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)

    done = packed.join(starts, ["id", "h"], "left").select("id", "packed", "starts")
    return done.mapInArrow(remove, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept string")
