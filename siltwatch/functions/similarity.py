"""Pairwise similarity of subdomain strings.

Spark has edit distance but none of these measures, so they run in Arrow batches. The
distinct pairs of a batch are compared together: matching uses bit sets, one machine
word a text, for thousands of pairs at once.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# Metric order a model is trained on, and the prefix boost.
METRICS = (
    "levenshtein", "jaro", "jaro_reversed", "jaro_winkler", "jaro_winkler_reversed", "lcs_sequence", "lcs_string",
)
PREFIX_WEIGHT = 0.2
PREFIX_LENGTH = 4
BOOST_ABOVE = 0.7


def _places(text: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(text):
        out[c] = out.get(c, 0) | (1 << i)
    return out


def jaro(a: str, b: str) -> float:
    if not a or not b:
        return 1.0 if a == b else 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    places, free, hits, left = _places(b), (1 << len(b)) - 1, 0, []
    for i, c in enumerate(a):
        low = max(i - reach, 0)
        near = places.get(c, 0) & free & ((1 << (i + reach + 1)) - 1) & -(1 << low)
        if near:
            first = near & -near
            free ^= first
            hits |= first
            left.append(c)
    m = len(left)
    if m == 0:
        return 0.0
    right = [c for j, c in enumerate(b) if hits >> j & 1]
    moved = sum(x != y for x, y in zip(left, right, strict=True)) // 2
    return (m / len(a) + m / len(b) + (m - moved) / m) / 3


def jaro_winkler(a: str, b: str, base: float) -> float:
    """Jaro with a boost for a shared start; ``base`` is the Jaro value."""
    if base <= BOOST_ABOVE:
        return base
    shared = 0
    for x, y in zip(a[:PREFIX_LENGTH], b[:PREFIX_LENGTH], strict=False):
        if x != y:
            break
        shared += 1
    return base + shared * PREFIX_WEIGHT * (1 - base)


def lcs_sequence(a: str, b: str) -> int:
    """Length of the longest common subsequence."""
    ones = (1 << len(a)) - 1
    places, row = _places(a), ones
    for c in b:
        u = row & places.get(c, 0)
        row = ((row + u) | (row - u)) & ones
    return len(a) - row.bit_count()


def lcs_string(a: str, b: str) -> int:
    """Length of the longest common substring, by bisection on its length."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        known = {a[i : i + mid] for i in range(len(a) - mid + 1)}
        if any(b[j : j + mid] in known for j in range(len(b) - mid + 1)):
            low = mid
        else:
            high = mid - 1
    return low


@lru_cache(maxsize=1 << 16)
def pair_metrics(a: str, b: str) -> tuple[float, ...]:
    """The seven metrics of one pair; trailing windows ask for the same pairs again."""
    if a == b:
        return (1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0) if a else (1.0, 1.0, 1.0, 1.0, 1.0, 0.0, 0.0)
    plain, back = jaro(a, b), jaro(a[::-1], b[::-1])
    size = len(a) + len(b)
    seq = 2 * lcs_sequence(a, b) / size if a and b else 0.0
    run = 2 * lcs_string(a, b) / size if a and b else 0.0
    indel = 1.0 if size == 0 else seq
    return (indel, plain, back, jaro_winkler(a, b, plain), jaro_winkler(a[::-1], b[::-1], back), seq, run)


def _letters(texts: list[str], width: int) -> np.ndarray:
    """Code points of texts, one row each, padded with zeros."""
    return np.array(texts, dtype=f"U{width}").view(np.uint32).reshape(len(texts), width)


def _masks(a: np.ndarray, b: np.ndarray, sizes_b: np.ndarray) -> np.ndarray:
    """For each place in ``a`` the places of the same letter in ``b`` as bits."""
    out = np.zeros(a.shape, dtype=np.uint64)
    for j in range(b.shape[1]):
        here = (a == b[:, j : j + 1]) & (j < sizes_b)[:, None]
        out |= here.astype(np.uint64) << np.uint64(j)
    return out


def _jaro_many(a: np.ndarray, b: np.ndarray, m: np.ndarray, n: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """Jaro of many pairs, place by place of ``a`` for all pairs at once."""
    rows, one = np.arange(len(a)), np.uint64(1)
    reach = np.maximum(np.maximum(m, n) // 2 - 1, 0)
    free, left, found = np.full(len(a), ~np.uint64(0)), np.zeros_like(a), np.zeros(len(a), dtype=np.int64)
    hits = np.zeros(len(a), dtype=np.uint64)
    for i in range(a.shape[1]):
        low, high = np.maximum(i - reach, 0), np.minimum(i + reach, 63)
        span = (~np.uint64(0) >> (63 - high).astype(np.uint64)) & (~np.uint64(0) << np.minimum(low, 63).astype(np.uint64))
        near = np.where((i < m) & (low <= 63), masks[:, i] & free & span, np.uint64(0))
        first = near & (~near + one)
        free &= ~first
        hits |= first
        hit = first != 0
        left[rows[hit], found[hit]] = a[hit, i]
        found += hit
    right, seen = np.zeros_like(b), np.zeros(len(b), dtype=np.int64)
    for j in range(b.shape[1]):
        hit = (hits >> np.uint64(j)) & one == 1
        right[rows[hit], seen[hit]] = b[hit, j]
        seen += hit
    wide = min(left.shape[1], right.shape[1])
    inside = np.arange(wide)[None, :] < found[:, None]
    moved = ((left[:, :wide] != right[:, :wide]) & inside).sum(axis=1) // 2
    some = np.maximum(found, 1)
    return np.where(found > 0, (found / np.maximum(m, 1) + found / np.maximum(n, 1) + (found - moved) / some) / 3, 0.0)


def _boosted(base: np.ndarray, a: np.ndarray, b: np.ndarray, shortest: np.ndarray) -> np.ndarray:
    shared, going = np.zeros(len(a), dtype=np.int64), np.ones(len(a), dtype=bool)
    for k in range(min(PREFIX_LENGTH, a.shape[1], b.shape[1])):
        going &= (a[:, k] == b[:, k]) & (k < shortest)
        shared += going
    return np.where(base > BOOST_ABOVE, base + shared * PREFIX_WEIGHT * (1 - base), base)


def _backwards(letters: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    at = sizes[:, None] - 1 - np.arange(letters.shape[1])[None, :]
    return np.where(at >= 0, np.take_along_axis(letters, np.maximum(at, 0), axis=1), 0)


def _lcs_sequence_many(masks: np.ndarray, m: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Longest common subsequences; ``masks`` are of the places of the first texts in the second."""
    ones = ~np.uint64(0) >> (64 - np.maximum(n, 1)).astype(np.uint64)
    row = ones.copy()
    for i in range(masks.shape[1]):
        u = row & masks[:, i]
        row = np.where(i < m, ((row + u) | (row - u)) & ones, row)
    return n - np.bitwise_count(row & ones).astype(np.int64)


def _lcs_string_many(a: np.ndarray, b: np.ndarray, m: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Longest common substrings by diagonals, a row of ``a`` at a time."""
    wide = b.shape[1]
    runs, best = np.zeros((len(a), wide + 1), dtype=np.int16), np.zeros(len(a), dtype=np.int16)
    valid = np.arange(wide)[None, :] < n[:, None]
    for i in range(a.shape[1]):
        same = (a[:, i : i + 1] == b) & valid & (i < m)[:, None]
        runs[:, 1:] = np.where(same, runs[:, :-1] + 1, 0)
        np.maximum(best, runs.max(axis=1), out=best)
    return best.astype(np.int64)


BIT_SET = 64
"""Longest text whose places fit one word; longer ones are compared one pair at a time."""


def many_pair_metrics(a: list[str], b: list[str]) -> np.ndarray:
    """The seven metrics of many pairs, a row each: the values of ``pair_metrics``.

    Pairs are taken in the order of their lengths, some thousands at once.
    """
    out = np.empty((len(a), len(METRICS)))
    sizes = np.array([max(len(x), len(y)) for x, y in zip(a, b, strict=True)], dtype=np.int64)
    plain = (sizes <= BIT_SET) & np.array(["\0" not in x and "\0" not in y for x, y in zip(a, b, strict=True)], dtype=bool)
    for i in np.flatnonzero(~plain).tolist():
        out[i] = pair_metrics(a[i], b[i])
    order = np.flatnonzero(plain)
    order = order[np.argsort(sizes[order], kind="stable")]
    for at in range(0, len(order), 4096):
        rows = order[at : at + 4096]
        wide = max(1, int(sizes[rows].max()))
        some_a, some_b = [a[i] for i in rows], [b[i] for i in rows]
        m, n = (np.array([len(t) for t in some], dtype=np.int64) for some in (some_a, some_b))
        x, y = _letters(some_a, wide), _letters(some_b, wide)
        back_x, back_y = _backwards(x, m), _backwards(y, n)
        masks, shortest = _masks(x, y, n), np.minimum(m, n)
        forth = _jaro_many(x, y, m, n, masks)
        back = _jaro_many(back_x, back_y, m, n, _masks(back_x, back_y, n))
        both, total = shortest > 0, np.maximum(m + n, 1)
        seq = np.where(both, 2 * _lcs_sequence_many(masks, m, n) / total, 0.0)
        run = np.where(both, 2 * _lcs_string_many(x, y, m, n) / total, 0.0)
        empty = m + n == 0
        forth, back = np.where(empty, 1.0, forth), np.where(empty, 1.0, back)
        out[rows] = np.stack(
            [np.where(empty, 1.0, seq), forth, back, _boosted(forth, x, y, shortest), _boosted(back, back_x, back_y, shortest), seq, run], axis=1
        )
    return out


def window_metrics(texts) -> tuple[float, ...]:
    """Mean of each metric over all pairs of a window."""
    pairs = [pair_metrics(a, b) for a, b in combinations(texts, 2)]
    return tuple(sum(column) / len(pairs) for column in zip(*pairs, strict=True))


PAIRS_AT_ONCE = 1 << 15
"""Pairs of windows that are held at once; a longer window is a piece of its own."""


def _pieces(windows: pa.Array) -> list[tuple[int, int]]:
    """Runs of windows (start, length) whose pairs are held together."""
    sizes = pc.fill_null(pc.list_value_length(windows), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    upto = np.concatenate([[0], np.cumsum(sizes * (sizes - 1) // 2)])
    out, at = [], 0
    while at < len(sizes):
        end = max(at + 1, int(np.searchsorted(upto, upto[at] + PAIRS_AT_ONCE, side="right")) - 1)
        out.append((at, end - at))
        at = end
    return out


def _metrics_of_windows(windows: pa.Array) -> pa.Array:
    """Means of all windows of a batch, some at a time, whatever the size of the batch."""
    found = [_metrics_of_piece(windows.slice(at, n)) for at, n in _pieces(windows)]
    return pa.concat_arrays(found) if found else _metrics_of_piece(windows)


def _metrics_of_piece(windows: pa.Array) -> pa.Array:
    """Means of some windows: each distinct pair is compared once, then windows add up."""
    sizes = pc.fill_null(pc.list_value_length(windows), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    words = pc.list_flatten(windows).dictionary_encode()
    codes, known = words.indices.to_numpy(zero_copy_only=False).astype(np.int64), words.dictionary.to_pylist()
    starts = np.cumsum(sizes) - sizes
    owners, pairs = [], []
    for later in range(1, int(sizes.max(initial=0))):
        rows = np.flatnonzero(sizes > later)
        for earlier in range(later):
            owners.append(rows)
            pairs.append(codes[starts[rows] + earlier] * len(known) + codes[starts[rows] + later])
    total = np.zeros((len(sizes), len(METRICS)))
    if pairs:
        which, distinct = pd.factorize(np.concatenate(pairs))
        scores = many_pair_metrics([known[p // len(known)] for p in distinct.tolist()], [known[p % len(known)] for p in distinct.tolist()])
        owner = np.concatenate(owners)
        for k in range(len(METRICS)):
            total[:, k] = np.bincount(owner, weights=scores[which, k], minlength=len(sizes))
    count = sizes * (sizes - 1) // 2
    none = count == 0
    means = total / np.maximum(count, 1)[:, None]
    return pa.StructArray.from_arrays([pa.array(means[:, k], mask=none) for k in range(len(METRICS))], list(METRICS))


def window_similarity(windows: Column) -> Column:
    """Struct of the seven metrics of each window; null below two strings.

    Marked as not deterministic, so that a filter on a metric is not moved before it: the
    optimizer would compute the metrics twice, in two Python workers a task.
    """
    schema = ", ".join(f"{m} double" for m in METRICS)
    return F.arrow_udf(_metrics_of_windows, schema).asNondeterministic()(windows)
