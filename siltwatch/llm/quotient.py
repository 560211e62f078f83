"""Counting quotient filters over packed n-grams.

An n-gram of ``n`` word ids is a number of ``64 * n`` bits. An invertible permutation
spreads such numbers evenly; its upper bits choose a block, the next ones are the
quotient, and *all* others are stored as the remainder. So a filter is lossless: every
n-gram is read back exactly. (With ``cut`` the lowest bits are left out, which makes a
smaller filter of sums over n-grams alike; such sums can only be too high.) A filter keeps one bit per quotient that occurs, one bit
per slot that ends a run, the sorted remainders, and counters as wide as the largest
needs. Sorted filters of the same block merge by adding up equal entries.
"""

from __future__ import annotations

import struct

import numpy as np

from siltwatch.llm.words import mix

_HEAD = struct.Struct("<BBBBBQ")
_KEYS = np.random.default_rng(11).integers(1, 2**63, (3, 8), dtype=np.uint64)


def permute(grams: np.ndarray) -> np.ndarray:
    """Spread packed n-grams (rows of 64-bit words), each word stirred by the one before it."""
    out = grams.astype(np.uint64, copy=True)
    n = out.shape[1]
    for r in range(len(_KEYS) if n > 1 else 0):
        for i in range(n):
            out[:, i] ^= mix(out[:, i - 1] + _KEYS[r, i])
    return out


def restore(spread: np.ndarray) -> np.ndarray:
    """The n-grams that ``permute`` spread: its steps undone from last to first."""
    out = spread.copy()
    n = out.shape[1]
    for r in range(len(_KEYS) - 1 if n > 1 else -1, -1, -1):
        for i in range(n - 1, -1, -1):
            out[:, i] ^= mix(out[:, i - 1] + _KEYS[r, i])
    return out


def summed(spread: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct entries in order, with the sums of their counts."""
    if not len(spread):
        return spread, counts
    order = np.argsort(spread[:, 0], kind="stable")
    rows = spread[order]
    same_first = rows[1:, 0] == rows[:-1, 0]
    new = np.append(True, (rows[1:] != rows[:-1]).any(axis=1))
    if spread.shape[1] > 1 and (new[1:] & same_first).any():  # two n-grams share their first word
        order = np.lexsort(spread.T[::-1])
        rows = spread[order]
        new = np.append(True, (rows[1:] != rows[:-1]).any(axis=1))
    starts = np.flatnonzero(new)
    return rows[starts], np.add.reduceat(counts[order], starts)


def _narrow(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of 64-bit values."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _widen(data: bytes, count: int, width: int) -> np.ndarray:
    out = np.zeros((count, 8), dtype=np.uint8)
    out[:, :width] = np.frombuffer(data, dtype=np.uint8).reshape(count, width)
    return out.view("<u8").ravel().astype(np.uint64)


def pack(spread: np.ndarray, counts: np.ndarray, block_bits: int, cut: int = 0) -> bytes:
    """The filter of sorted distinct entries that share their upper ``block_bits`` bits; ``cut`` low bits are zero."""
    m, n = spread.shape
    bits = max(1, min(int(m - 1).bit_length(), 63 - block_bits - cut))
    low = 64 - block_bits - bits - cut
    first = spread[:, 0] >> np.uint64(cut)
    quotient = ((first >> np.uint64(low)) & np.uint64((1 << bits) - 1)).astype(np.int64)
    occupied = np.zeros(1 << bits, dtype=bool)
    occupied[quotient] = True
    run_end = np.append(quotient[1:] != quotient[:-1], True)
    width, wide = (low + 7) // 8, max(1, (int(counts.max()).bit_length() + 7) // 8)
    remainder = first & np.uint64((1 << low) - 1)
    parts = [_HEAD.pack(n, block_bits, bits, wide, cut, m), np.packbits(occupied).tobytes(), np.packbits(run_end).tobytes(), _narrow(remainder, width)]
    parts += [np.ascontiguousarray(spread[:, i]).astype("<u8").tobytes() for i in range(1, n)]
    return b"".join([*parts, _narrow(counts.astype(np.uint64), wide)])


def unpack(data: bytes, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Entries of a filter and their counts, in order."""
    n, block_bits, bits, wide, cut, m = _HEAD.unpack_from(data)
    low = 64 - block_bits - bits - cut
    width, at = (low + 7) // 8, _HEAD.size

    def take(size: int) -> bytes:
        nonlocal at
        at += size
        return data[at - size : at]

    occupied = np.flatnonzero(np.unpackbits(np.frombuffer(take(max(1, (1 << bits) // 8)), np.uint8), count=1 << bits))
    run_end = np.unpackbits(np.frombuffer(take((m + 7) // 8), np.uint8), count=m)
    run = np.cumsum(run_end) - run_end
    spread = np.empty((m, n), dtype=np.uint64)
    upper = np.uint64(block << (64 - block_bits)) if block_bits else np.uint64(0)
    lower = (occupied[run].astype(np.uint64) << np.uint64(low)) | _widen(take(m * width), m, width)
    spread[:, 0] = upper | (lower << np.uint64(cut))
    for i in range(1, n):
        spread[:, i] = np.frombuffer(take(8 * m), dtype="<u8")
    return spread, _widen(take(m * wide), m, wide).astype(np.int64)


def blocks_of(spread: np.ndarray, counts: np.ndarray, block_bits: int, cut: int = 0) -> list[tuple[int, bytes]]:
    """Filters of sorted distinct entries, one per block that occurs."""
    if not len(spread):
        return []
    block = (spread[:, 0] >> np.uint64(64 - block_bits)).astype(np.int64) if block_bits else np.zeros(len(spread), np.int64)
    cuts = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), len(block)]
    return [(int(block[a]), pack(spread[a:b], counts[a:b], block_bits, cut)) for a, b in zip(cuts, cuts[1:], strict=False)]


def merged(filters: list[bytes], block: int) -> tuple[np.ndarray, np.ndarray]:
    """Entries of several filters of one block, equal ones added up."""
    parts = [unpack(f, block) for f in filters]
    return summed(np.concatenate([s for s, _ in parts]), np.concatenate([c for _, c in parts]))
