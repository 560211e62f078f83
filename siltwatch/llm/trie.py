"""Bigram level of an n-gram trie in Elias-Fano form, kept in a memory-mapped file.

Contexts are numbered in order. Pointers to their successor lists are a monotone
sequence; so is the level itself, because each successor is stored as
``context number * universe + successor``. Both are Elias-Fano coded: low bits as they
are, high bits as a unary bit row. Probabilities are quantised beside the level.
"""

from __future__ import annotations

import mmap
import tempfile

import numpy as np

STEP = 1 / 256
"""Quantum of stored log10 probabilities and back-off weights."""


def quantised(log10: np.ndarray) -> np.ndarray:
    return np.minimum(np.rint(-log10 / STEP), 65535).astype(np.uint16)


def restored(code: np.ndarray) -> np.ndarray:
    return code.astype(np.float64) * -STEP


class MappedFile:
    """Arrays written one after another to an unnamed file of the task, and mapped."""

    def __init__(self, arrays: dict[str, np.ndarray]) -> None:
        self._file = tempfile.TemporaryFile()
        places, size = {}, 0
        for name, array in arrays.items():
            pad = -size % 8
            self._file.write(b"\0" * pad)
            places[name] = size + pad, array.dtype, len(array)
            self._file.write(array.tobytes())
            size += pad + array.nbytes
        self._file.write(b"\0" * 8)
        self._file.flush()
        self._map = mmap.mmap(self._file.fileno(), 0, access=mmap.ACCESS_READ)
        self.arrays = {n: np.frombuffer(self._map, d, c, at) for n, (at, d, c) in places.items()}


def elias_fano(values: np.ndarray, universe: int) -> dict[str, np.ndarray]:
    """Low parts (1, 2 or 4 bytes, the nearest above the best width) and the unary row of the high parts."""
    best = max(0, int(universe // max(1, len(values))).bit_length() - 1)
    kind = np.uint8 if best <= 8 else np.uint16 if best <= 16 else np.uint32
    width = 8 * kind().itemsize
    high = (values >> np.uint64(width)).astype(np.int64)
    bits = np.zeros(len(values) + (int(universe) >> width) + 2, np.uint8)
    bits[high + np.arange(len(values))] = 1
    return {"low": values.astype(kind), "bits": np.packbits(bits), "shape": np.array([len(values), len(bits)], np.int64)}


class EliasFano:
    def __init__(self, low: np.ndarray, bits: np.ndarray, shape: np.ndarray) -> None:
        self.low, self.count = low, int(shape[0])
        self.width = np.uint64(8 * low.dtype.itemsize)
        row = np.unpackbits(bits, count=int(shape[1]))
        zeros = np.flatnonzero(row == 0)
        #: Where the values of each high part begin: the zeros' places less the zeros before (select0).
        self.begin = np.concatenate([[0], zeros - np.arange(len(zeros))]).astype(np.int64)
        self.ones = np.flatnonzero(row)

    def get(self, index: np.ndarray) -> np.ndarray:
        """Values at places of the sequence (select1)."""
        high = (self.ones[index] - index).astype(np.uint64)
        return (high << self.width) | self.low[index].astype(np.uint64)

    def successor(self, keys: np.ndarray) -> np.ndarray:
        """Place of the first value not below each key, among those of the key's high part."""
        high = np.minimum((keys >> self.width).astype(np.int64), len(self.begin) - 2)
        lo, hi = self.begin[high].copy(), self.begin[high + 1].copy()
        part = keys & ((np.uint64(1) << self.width) - np.uint64(1))
        while (open_ := lo < hi).any():
            middle = (lo + hi) >> 1
            below = open_ & (self.low[np.minimum(middle, self.count - 1)] < part)
            lo, hi = np.where(below, middle + 1, lo), np.where(open_ & ~below, middle, hi)
        return lo

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key, or -1."""
        if not self.count:
            return np.full(len(keys), -1)
        at = self.successor(keys)
        near = np.minimum(at, self.count - 1)
        return np.where((at < self.count) & (self.get(near) == keys), near, -1)


class BigramTrie:
    """Successors of each context with log10 probabilities, and back-off weights of contexts."""

    def __init__(self, contexts: np.ndarray, backoff: np.ndarray, context_of: np.ndarray, successors: np.ndarray, log10: np.ndarray) -> None:
        """``contexts`` sorted; ``successors`` sorted within ascending ``context_of`` (numbers of contexts)."""
        self.universe = int(successors.max(initial=0)) + 1
        firsts = np.searchsorted(context_of, np.arange(len(contexts) + 1)).astype(np.uint64)
        level = context_of.astype(np.uint64) * np.uint64(self.universe) + successors.astype(np.uint64)
        parts = {f"ptr_{k}": v for k, v in elias_fano(firsts, len(successors) + 1).items()}
        parts |= {f"suc_{k}": v for k, v in elias_fano(level, max(1, len(contexts)) * self.universe).items()}
        parts |= {"contexts": contexts, "backoff": quantised(backoff), "log10": quantised(log10)}
        self.file = MappedFile(parts)
        got = self.file.arrays
        self.contexts, self.backoff, self.log10 = got["contexts"], got["backoff"], got["log10"]
        self.pointers = EliasFano(got["ptr_low"], got["ptr_bits"], got["ptr_shape"])
        self.level = EliasFano(got["suc_low"], got["suc_bits"], got["suc_shape"])

    def score(self, context: np.ndarray, word: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """log10 chance of each word after its context; ``lower`` is that of the word alone."""
        number = np.minimum(np.searchsorted(self.contexts, context), max(0, len(self.contexts) - 1))
        met = self.contexts[number] == context if len(self.contexts) else np.zeros(len(context), bool)
        inside = met & (word < self.universe)
        key = number.astype(np.uint64) * np.uint64(self.universe) + np.where(inside, word, 0).astype(np.uint64)
        place = np.where(inside, self.level.find(key), -1)
        out = lower + np.where(met, restored(self.backoff[number]) if len(self.contexts) else 0.0, 0.0)
        hit = place >= 0
        out[hit] = restored(self.log10[place[hit]])
        return out

    def successors(self, context: int) -> np.ndarray:
        """Words met after a context, in order."""
        number = int(np.searchsorted(self.contexts, context))
        lo, hi = self.pointers.get(np.array([number, number + 1])).astype(np.int64)
        return self.level.get(np.arange(lo, hi)) - np.uint64(number * self.universe)
