"""Token files: ids packed at the fewest bits that hold the vocabulary, in blocks with offsets.

Layout, all numbers little-endian: the eight bytes of ``MAGIC``; four unsigned 64-bit numbers (bits per
id, ids per block, documents, ids); then the document ids (64-bit), one byte per document that is 0 for a
null id, the document starts (documents + 1), the block starts in bytes (blocks + 1), and the blocks. Each
block starts on a whole byte, so any document or range of ids is read from its blocks alone.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridyield.llm.common import shared_path, shuffle_partitions, written
from gridyield.llm.tokens import encoder

MAGIC = b"TOKBITS1"
BLOCK = 4096  # ids in a block, a multiple of eight
FILE_IDS = 1 << 23  # a file is closed when it holds so many ids
MANIFEST = "part int, seq int, path string, n_docs bigint, n_ids bigint"


def id_bits(vocabulary: int) -> int:
    """Fewest bits that hold the ids 0 to vocabulary - 1."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Fixed-width packing, lowest bit first."""
    if bits % 8 == 0:
        return np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :bits // 8]).tobytes()
    places = (ids.astype("<u4")[:, None] >> np.arange(bits, dtype="<u4")) & 1
    return np.packbits(places.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(raw: bytes, bits: int, n: int) -> np.ndarray:
    """The first n ids of packed bytes."""
    if bits % 8 == 0:
        out = np.zeros((n, 4), np.uint8)
        out[:, :bits // 8] = np.frombuffer(raw, np.uint8, n * bits // 8).reshape(n, bits // 8)
        return out.view("<u4").ravel()
    places = np.unpackbits(np.frombuffer(raw, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    return (places.astype("<u4") << np.arange(bits, dtype="<u4")).sum(1, dtype="<u4")


def _place(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")


def file_bytes(doc_ids: list[int | None], parts: list[np.ndarray], bits: int) -> bytes:
    """A whole token file."""
    starts = np.zeros(len(parts) + 1, "<u8")
    np.cumsum([len(p) for p in parts], out=starts[1:])
    ids = np.concatenate(parts) if parts else np.zeros(0, "<u4")
    blocks = [pack(ids[i:i + BLOCK], bits) for i in range(0, len(ids), BLOCK)]
    offsets = np.zeros(len(blocks) + 1, "<u8")
    np.cumsum([len(b) for b in blocks], out=offsets[1:])
    known = np.array([d is not None for d in doc_ids], np.uint8)
    numbers = np.array([d or 0 for d in doc_ids], "<i8")
    head = MAGIC + struct.pack("<4Q", bits, BLOCK, len(parts), len(ids))
    return b"".join([head, numbers.tobytes(), known.tobytes(), starts.tobytes(), offsets.tobytes(), *blocks])


class TokenFile:
    """Random access to a token file."""

    def __init__(self, path: str):
        system, name = _place(path)
        self.file = system.open_input_file(name)
        head = self.file.read_at(40, 0)
        if head[:8] != MAGIC:
            raise ValueError(f"{path} is no token file")
        self.bits, self.block, self.n_docs, self.n_ids = struct.unpack("<4Q", head[8:])
        blocks = -(-self.n_ids // self.block)
        raw, n = self.file.read_at(17 * self.n_docs + 8 + 8 * (blocks + 1), 40), self.n_docs
        numbers, known = np.frombuffer(raw, "<i8", n), np.frombuffer(raw, np.uint8, n, 8 * n)
        self.doc_ids = [int(d) if k else None for d, k in zip(numbers, known)]
        self.starts = np.frombuffer(raw[9 * n:], "<u8", n + 1).astype(np.int64)
        self.offsets = np.frombuffer(raw[17 * n + 8:], "<u8", blocks + 1).astype(np.int64)
        self.payload = 40 + len(raw)

    def ids(self, a: int, b: int) -> np.ndarray:
        """ids a to b - 1 of the file; only their blocks are read."""
        if a >= b:
            return np.zeros(0, "<u4")
        first, last = a // self.block, -(-b // self.block)
        at = self.offsets[first]
        raw = self.file.read_at(int(self.offsets[last] - at), int(self.payload + at))
        count = min(last * self.block, self.n_ids) - first * self.block
        if self.block * self.bits % 8 == 0:
            got = unpack(raw, self.bits, count)
        else:
            got = np.concatenate([
                unpack(raw[self.offsets[i] - at:self.offsets[i + 1] - at], self.bits, min(self.block, self.n_ids - i * self.block))
                for i in range(first, last)
            ])
        return got[a - first * self.block:b - first * self.block]

    def doc(self, k: int) -> np.ndarray:
        return self.ids(int(self.starts[k]), int(self.starts[k + 1]))

    def runs(self, size: int = 1 << 20) -> Iterator[tuple[int, np.ndarray]]:
        """(document, ids) for all documents, reading about ``size`` ids at a time."""
        k = 0
        while k < self.n_docs:
            end = int(np.searchsorted(self.starts, self.starts[k] + size, "right")) - 1
            end = min(max(end, k + 1), self.n_docs)
            base, got = int(self.starts[k]), self.ids(int(self.starts[k]), int(self.starts[end]))
            for i in range(k, end):
                yield i, got[self.starts[i] - base:self.starts[i + 1] - base]
            k = end


def write_tokens(
    docs: DataFrame, tokenizer: str, end_id: int | None = None, doc_id: str = "doc_id", text: str = "text", folder: str | None = None
) -> DataFrame:
    """Write the ids of every text to token files in ascending doc_id order (nulls first) and return the manifest.

    One row per file: part, seq, path, n_docs, n_ids; files in the order of (part, seq) hold the documents in
    order. Null and empty texts have no ids but the end id. Rows that share a doc_id all stay, in the order
    of a hash of their texts. A file has a name of its own until it is complete, and counts only when the manifest
    names it, so repeated and lost tasks do no harm. ``folder`` must be seen by all executors.
    """
    spark = docs.sparkSession
    folder = folder or shared_path(spark, "token-files")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, own, seq = TaskContext.get().partitionId(), encoder(tokenizer), 0
        end = np.array([] if end_id is None else [end_id], "<u4")
        bits = id_bits(max(own.size(), (end_id or 0) + 1))
        names: list = []
        parts: list = []
        total = 0

        def close() -> pa.RecordBatch:
            nonlocal names, parts, total, seq
            system, top = _place(folder)
            system.create_dir(top, recursive=True)
            name = f"{part:06d}-{seq:04d}-{uuid.uuid4().hex}.tok"
            with system.open_output_stream(f"{top}/_{name}") as out:
                out.write(file_bytes(names, parts, bits))
            system.move(f"{top}/_{name}", f"{top}/{name}")
            row = pa.RecordBatch.from_pylist(
                [{"part": part, "seq": seq, "path": f"{folder}/{name}", "n_docs": len(parts), "n_ids": total}],
                pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]),
            )
            names, parts, total, seq = [], [], 0, seq + 1
            return row

        for batch in batches:
            for k in range(0, len(batch), 256):
                some = batch.slice(k, 256)
                for name, ids in zip(some.column(0).to_pylist(), own.ids(some.column(1).to_pylist())):
                    names.append(name)
                    parts.append(np.concatenate([ids, end]))
                    total += len(parts[-1])
                    if total >= FILE_IDS:
                        yield close()
        if parts:
            yield close()

    pairs = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("h"))
    ordered = pairs.repartitionByRange(shuffle_partitions(spark), "doc_id", "h").sortWithinPartitions("doc_id", "h")
    return written(ordered.select("doc_id", "text").mapInArrow(write, MANIFEST), "token-manifest")


def _located(manifest: DataFrame) -> DataFrame:
    """The files with the ids before them; a row per file, not per document, passes the one window."""
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.select("path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("before"))


def read_tokens(manifest: DataFrame, digest: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, and ids or, with ``digest``, their crc32."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = ("ids_crc32", pa.int64()) if digest else ("ids", pa.list_(pa.int32()))
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), last])
        for batch in batches:
            for path, before in zip(*(c.to_pylist() for c in batch.columns)):
                file, rows = TokenFile(path), []
                for i, ids in file.runs():
                    value = zlib.crc32(np.ascontiguousarray(ids, "<u4")) if digest else ids.astype(np.int32)
                    rows.append((file.doc_ids[i], before + int(file.starts[i]), len(ids), value))
                    if len(rows) == 5000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    files = manifest.count()
    kind = "ids_crc32 bigint" if digest else "ids array<int>"
    spread = _located(manifest).repartition(max(1, min(files, 4 * shuffle_partitions(manifest.sparkSession))), "path")
    return spread.mapInArrow(read, f"doc_id bigint, start bigint, n_tokens bigint, {kind}")
