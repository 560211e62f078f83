"""Words of whole Arrow batches as 64-bit hashes, without a Python step per word.

A word is ``[^\\x20\\x09-\\x0D]+`` with A-Z lowered. Its hash is a polynomial over
random byte values, taken as a difference of running sums, so the cost is a few
passes over the bytes of a batch. Hashes stand for words: among a billion
different words the chance of any collision is about 3 %.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
"""Text bytes handled at once inside a task; a longer text is a slice of its own."""

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, *range(9, 14)]] = True
_BASE = 0x9E3779B97F4A7C15
_EXACT_VALUES = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64)
_BYTE_VALUES = _EXACT_VALUES[_LOWER]
_cache: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_cache.get("up", ())) < n:
        size = max(n, SLICE_BYTES + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            row = np.full(size, base, dtype=np.uint64)
            row[0] = 1
            _cache[name] = np.cumprod(row, dtype=np.uint64)
    return _cache["up"][:n], _cache["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@dataclass
class Texts:
    """Rows of one slice: all bytes, and where each row begins and ends."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


@dataclass
class Words:
    """Words of one slice in text order; ``first[i]:first[i + 1]`` are those of row i."""

    hash: np.ndarray
    row: np.ndarray
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray


def texts_of(column: pa.Array) -> Texts:
    """Bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return Texts(raw[offsets[0] : offsets[-1]], offsets - offsets[0])


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that no slice holds more than ``limit`` text bytes, single rows aside."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        start = total = 0
        for i, size in enumerate(sizes.tolist()):
            if total and total + size > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if start < batch.num_rows:
            yield batch.slice(start)


def words_of(texts: Texts, exact: bool = False) -> Words:
    """Words of a slice; ``exact`` hashes tell A-Z from a-z."""
    data, offsets = texts.data, texts.offsets
    n = len(data)
    if not n:
        none = np.zeros(0, dtype=np.int64)
        return Words(np.zeros(0, np.uint64), none, np.zeros(len(texts) + 1, np.int64), none, none)
    inside = ~SPACE[data]
    opens = np.ones(n, dtype=bool)
    opens[1:] = ~inside[:-1]
    edges = offsets[offsets < n]
    opens[edges] = True
    opens &= inside
    closes = np.ones(n, dtype=bool)
    closes[:-1] = ~inside[1:]
    closes[edges[edges > 0] - 1] = True
    closes &= inside
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    up, down = _powers(n)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((_EXACT_VALUES if exact else _BYTE_VALUES)[data] * up, out=sums[1:])
    hashes = mix((sums[end] - sums[start]) * down[start])
    first = np.searchsorted(start, offsets)
    row = np.repeat(np.arange(len(texts)), np.diff(first))
    return Words(hashes, row, first, start, end)


def shingles_of(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of ``n`` words, and offsets per row.

    A row of fewer words (but at least one) has its whole sequence as one shingle.
    """
    counts = np.diff(words.first)
    ranks = np.random.default_rng(21).integers(1, 2**62, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    have = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    first = np.concatenate([[0], np.cumsum(have)])
    at = np.arange(first[-1]) + np.repeat(words.first[:-1] - first[:-1], have)
    last = np.repeat(words.first[1:], have)
    total = np.zeros(len(at), dtype=np.uint64)
    padded = np.append(words.hash, np.zeros(n, np.uint64))
    for j in range(n):
        part = padded[at + j] * ranks[j]
        total += np.where(at + j < last, part, np.uint64(j))
    return mix(total), first


def sets_of(values: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct values of each row."""
    out = []
    for begin, end in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        own = np.sort(values[begin:end])
        if len(own) > 1:
            own = own[np.append(True, own[1:] != own[:-1])]
        out.append(own)
    return out
