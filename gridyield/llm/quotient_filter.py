"""Counting quotient filters over packed n-grams of word ids, as arrays.

An n-gram is n ids of ``bits`` bits. An invertible permutation adds a hash of the other ids to its first id, modulo 2**bits, so
that number is spread evenly. Its upper bits are the quotient: those of the part (where filters of many
shards meet) and of the slot within the part. The rest of it and the other ids, which are kept in full, are the remainder. So a filter gives back
every n-gram and its count exactly.
"""

from __future__ import annotations

import struct

import numpy as np

from gridyield.llm.shingles import STEP, mix

HEAD = struct.Struct("<IBBBBI")  # entries, n, bits, part bits, slot bits, counts that do not fit a byte
MANY = 255


def _shift(ids: np.ndarray, bits: int) -> np.ndarray:
    """What the first id is moved by: a hash of the others."""
    x = np.zeros(ids.shape[1], np.uint64)
    for row in ids[:0:-1]:
        x = mix(x * STEP + row + np.uint64(1))
    return x >> np.uint64(64 - bits) if bits < 64 else x


def permuted(ids: np.ndarray, bits: int) -> np.ndarray:
    """``ids``: n rows of uint64 below 2**bits, one column per n-gram. Only the first row changes."""
    out = ids.copy()
    out[0] = (ids[0] + _shift(ids, bits)) & np.uint64(2**bits - 1)
    return out


def restored(keys: np.ndarray, bits: int) -> np.ndarray:
    out = keys.copy()
    out[0] = (keys[0] - _shift(keys, bits)) & np.uint64(2**bits - 1)
    return out


def counted(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Different columns in ascending order and the sums of their counts (ones if None)."""
    if not keys.shape[1]:
        return keys, np.zeros(0, np.int64)
    order = np.lexsort(keys[::-1])
    keys = keys[:, order]
    first = np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(0)]))
    if counts is None:
        return keys[:, first], np.diff(np.append(first, len(order)))
    return keys[:, first], np.add.reduceat(counts[order], first)


def _bytes_of(column: np.ndarray, width: int) -> bytes:
    return column.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _column(raw: bytes, at: int, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8, n * width, at).reshape(n, width)
    return out.reshape(-1).view("<u8").astype(np.uint64)


def parts_of(keys: np.ndarray, bits: int, part_bits: int) -> np.ndarray:
    return (keys[0] >> np.uint64(bits - part_bits)).astype(np.int64) if part_bits else np.zeros(keys.shape[1], np.int64)


def pack(keys: np.ndarray, counts: np.ndarray, bits: int, part_bits: int) -> bytes:
    """One part's sorted keys and counts: per slot how many keys it has, then remainders, then counters."""
    n, m = keys.shape
    slot_bits = min(max(m - 1, 1).bit_length(), bits - part_bits, 31)
    rest_bits = bits - part_bits - slot_bits
    slot = ((keys[0] >> np.uint64(rest_bits)) & np.uint64(2**slot_bits - 1)).astype(np.int64)
    used = np.bincount(slot, minlength=2**slot_bits)
    full = np.flatnonzero(used >= MANY)
    rest = keys[0] & np.uint64(2**rest_bits - 1)
    large = np.flatnonzero(counts >= MANY)
    return b"".join([
        HEAD.pack(m, n, bits, part_bits, slot_bits, len(large)),
        np.minimum(used, MANY).astype(np.uint8).tobytes(), used[full].astype("<u4").tobytes(),
        _bytes_of(rest, -(-rest_bits // 8)), *(_bytes_of(row, -(-bits // 8)) for row in keys[1:]),
        np.minimum(counts, MANY).astype(np.uint8).tobytes(), counts[large].astype("<i8").tobytes(),
    ])


def unpack(raw: bytes, part: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and counts of a packed part."""
    m, n, bits, part_bits, slot_bits, large = HEAD.unpack_from(raw)
    rest_bits, at = bits - part_bits - slot_bits, HEAD.size
    used = np.frombuffer(raw, np.uint8, 2**slot_bits, at).astype(np.int64)
    at += 2**slot_bits
    full = np.flatnonzero(used == MANY)
    used[full] = np.frombuffer(raw, "<u4", len(full), at)
    at += 4 * len(full)
    slot = np.repeat(np.arange(2**slot_bits, dtype=np.uint64), used)
    keys = np.empty((n, m), np.uint64)
    width = -(-rest_bits // 8)
    high = (np.uint64(part) << np.uint64(slot_bits)) + slot
    keys[0] = (high << np.uint64(rest_bits)) + _column(raw, at, m, width)
    at += m * width
    width = -(-bits // 8)
    for k in range(1, n):
        keys[k] = _column(raw, at, m, width)
        at += m * width
    counts = np.frombuffer(raw, np.uint8, m, at).astype(np.int64)
    at += m
    counts[np.flatnonzero(counts == MANY)] = np.frombuffer(raw, "<i8", large, at)
    return keys, counts


def merged(filters: list[bytes], part: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts of several filters of one part together."""
    opened = [unpack(raw, part) for raw in filters]
    return counted(np.concatenate([k for k, _ in opened], axis=1), np.concatenate([c for _, c in opened]))
