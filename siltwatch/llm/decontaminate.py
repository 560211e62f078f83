"""Benchmark leaks by latent semantic retrieval.

Passages of documents and benchmark items are TF-IDF vectors, reduced by a randomised
SVD whose products are formed where the passages lie. Item vectors are compared with
every passage by cosine; each candidate is then checked on its words: the longest common
subsequence with the item, and for looser matches also with the item's answer (its
last sentence or line). So inserted, dropped or replaced words do not hide a leak.

The dimensions may hold little of long or many items. So passages that share enough of
a piece's rarest words are candidates as well, whatever their cosine: a common
subsequence long enough for a leak cannot do without these words, so none is missed.

Fixed sizes: the term buckets and dimensions. Document frequencies, the SVD and the
search cover all rows and whole texts; nothing but sums of fixed size is gathered, and
items are searched in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltwatch.llm.common import staged
from siltwatch.llm.words import Texts, Words, mix, slices, texts_of, words_of

TERMS_LOG = 14
TERMS = 1 << TERMS_LOG
BLOCK = 8
WINDOWS = (16, 32, 64)
SUMS = "part int, sums binary"
PART_TERMS = 512
RUN = 32
"""Words of a row of the matrix that the SVD is fitted on."""
RUNS_AT_ONCE = 12
"""Rows that are one dense matrix."""
ROWS_AT_ONCE = 16 * RUNS_AT_ONCE
PARTS_AT_ONCE = 32
PRODUCTS = 2
"""Products by the matrix that the SVD takes, after its start."""
PAIRS = 1 << 20
"""Pairs of a word and a piece that has it, counted at once."""
BLOCKS_AT_ONCE = 512
STARTS_AT_ONCE = 4096
MARKS_LOG = 18
"""Bits of a hash that tell most words from those of a list."""
PLACES_LOG = 12
"""Bits of a hash that words of a passage and of a piece are told by at first."""
PLACES = 1 << PLACES_LOG
PASSAGES_AT_ONCE = 128
SEARCHED_BYTES = 1 << 19


@dataclass(frozen=True)
class LeakSpec:
    dimensions: int = 128
    item_weight: float = 20.0
    """Weight of an item's rows in the SVD, so that its words keep their place among the dimensions."""
    cosine: float = 0.35
    """Of the item and a passage, the passage measured with all its words."""
    share: float = 0.8
    share_with_answer: float = 0.6
    least_words: int = 5
    """Items of fewer words name nothing and are not searched."""
    items_at_once: int = 250
    """Items that share one SVD; recall does not rest on how much of them its dimensions hold."""


def _places(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - PLACES_LOG)).astype(np.int64)


def _terms(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - TERMS_LOG)).astype(np.int64)


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Terms of each slice of texts, two bytes each, where its rows of the matrix open, and what its documents hold."""
    for part in slices(batches, limit=1 << 18):
        words = words_of(texts_of(part.column("text")))
        terms = _terms(words.hash)
        keys = words.row * TERMS + terms
        keys = np.sort(keys.astype(np.int32) if part.num_rows * TERMS < 1 << 31 else keys)
        keys = keys[np.append(True, keys[1:] != keys[:-1])] % TERMS if len(keys) else keys
        counts = np.diff(words.first)
        have = -(-counts // RUN)
        row = np.repeat(np.arange(len(counts)), have)
        opens = words.first[row] + (np.arange(len(row)) - np.repeat(np.cumsum(have) - have, have)) * RUN
        yield pa.record_batch(
            {
                "terms": pa.array([terms.astype(np.uint16).tobytes()], pa.binary()),
                "opens": pa.array([opens.astype(np.int32).tobytes()], pa.binary()),
                "held": pa.array([keys.astype(np.uint16).tobytes()], pa.binary()),
                "n": pa.array([part.num_rows], pa.int64()),
            }
        )


def coded(docs: DataFrame) -> DataFrame:
    """All texts as terms, written once; every pass of the fit reads them."""
    return staged(docs.select("text").mapInArrow(_coded, "terms binary, opens binary, held binary, n long"), "latent-terms")


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, rows = np.zeros(TERMS, dtype=np.int64), 0
    for batch in batches:
        for held, n in zip(batch.column("held"), batch.column("n").to_pylist(), strict=True):
            total += np.bincount(np.frombuffer(held.as_buffer(), np.uint16), minlength=TERMS)
            rows += n
    if rows:
        yield pa.record_batch({"counts": pa.array([np.append(total, rows).tobytes()], pa.binary())})


def _inverse_frequencies(codes: DataFrame) -> np.ndarray:
    sums = codes.select("held", "n").mapInArrow(_document_counts, "counts binary").groupBy(F.lit(0).alias("part")).applyInArrow(_sum_counts, "counts binary")
    found = [np.frombuffer(r["counts"], np.int64) for r in sums.toArrow().to_pylist()]
    counts = found[0] if found else np.zeros(TERMS + 1)
    return np.log((counts[-1] + 1) / (counts[:-1] + 1)).astype(np.float32) + np.float32(0.01)


def _sum_counts(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(TERMS + 1, np.int64)
    for batch in parts:
        for one in batch.column("counts"):
            total += np.frombuffer(one.as_buffer(), np.int64)
    yield pa.record_batch({"counts": pa.array([total.tobytes()], pa.binary())})


def _sum_parts(key: tuple, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in parts:
        for one in batch.column("sums"):
            own = np.frombuffer(one.as_buffer(), np.float32)
            total = own.astype(np.float64) if total is None else total + own
    yield pa.record_batch({"part": pa.array([key[0].as_py()], pa.int32()), "sums": pa.array([total.astype(np.float32).tobytes()], pa.binary())})


def _row_of(terms: np.ndarray, opens: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(opens)), np.diff(np.append(opens, len(terms))))


def _entries(terms: np.ndarray, row: np.ndarray, weight: float, idf: np.ndarray) -> np.ndarray:
    """Entries of rows of A, one for each word: its idf, by the length of its row and times the weight."""
    size = idf[terms]
    return size * (weight / np.sqrt(np.maximum(np.bincount(row, weights=size**2), 1e-6))).astype(np.float32)[row]


def add_signed(total: np.ndarray, terms: np.ndarray, opens: np.ndarray, weight: float, idf: np.ndarray) -> None:
    """Add AᵀS for rows of A that open at ``opens``; S has a 1 or -1 for each row, in a column, both by a hash of its terms."""
    if not len(opens):
        return
    row = _row_of(terms, opens)
    hashes = mix(np.add.reduceat(mix(terms.astype(np.uint64) + np.uint64(1)), opens))
    column = (hashes % np.uint64(total.shape[1])).astype(np.int64)
    sign = np.where(hashes >> np.uint64(63), np.float32(1), np.float32(-1))
    signed = (_entries(terms, row, weight, idf) * sign[row]).astype(total.dtype)  # the type of a sent array is a copy, with which add.at is slow
    np.add.at(total.reshape(-1), terms.astype(np.int64) * total.shape[1] + column[row], signed)


def add_gram(total: np.ndarray, terms: np.ndarray, opens: np.ndarray, weight: float, idf: np.ndarray, basis: np.ndarray) -> None:
    """Add AᵀA·basis for rows of A that open at ``opens``; a few rows at once are a small dense matrix over their terms."""
    ends = np.append(opens, len(terms))
    for at in range(0, len(opens), ROWS_AT_ONCE):
        some = ends[at : at + ROWS_AT_ONCE + 1]
        own = terms[some[0] : some[-1]].astype(np.int64)
        row = _row_of(own, some[:-1] - some[0])
        group = row // RUNS_AT_ONCE
        lines = np.bincount(np.arange(len(some) - 1) // RUNS_AT_ONCE)
        keys = group * TERMS + own
        seen = np.zeros(len(lines) * TERMS, bool)
        seen[keys] = True
        used = np.flatnonzero(seen)
        bound = np.searchsorted(used, np.arange(len(lines) + 1) * TERMS)
        place = np.empty(len(seen), np.int32)
        place[used] = np.arange(len(used), dtype=np.int32)
        wide = np.diff(bound)
        begin = np.concatenate([[0], np.cumsum(lines * wide)])
        cell = (begin[:-1] - bound[:-1])[group] + (row % RUNS_AT_ONCE) * wide[group] + place[keys]
        cells = np.bincount(cell, weights=_entries(own, row, weight, idf), minlength=begin[-1]).astype(np.float32)
        used %= TERMS
        for k in range(len(lines)):
            held = used[bound[k] : bound[k + 1]]
            dense = cells[begin[k] : begin[k + 1]].reshape(lines[k], wide[k])
            product = dense.T @ (dense @ basis.take(held, axis=0))
            product += total.take(held, axis=0)
            total[held] = product


def _summed(passages: DataFrame, width: int, add: Callable, idf: np.ndarray, *more: np.ndarray) -> np.ndarray:
    """What ``add`` adds up over all rows of ``passages`` (terms, opens, weight), for each term ``width`` numbers.

    Each task adds up its own rows and sends a matrix of fixed size. So there are about as
    many tasks as cores, whatever the number of partitions, and one for every
    PARTS_AT_ONCE partitions of larger inputs.
    """
    context = passages.sparkSession.sparkContext
    sent = context.broadcast((idf, *more))
    tasks = max(context.defaultParallelism, passages.rdd.getNumPartitions() // PARTS_AT_ONCE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = sent.value
        total = np.zeros((TERMS, width), np.float32)
        for batch in batches:
            for terms, opens, weight in zip(batch.column("terms"), batch.column("opens"), batch.column("weight").to_pylist(), strict=True):
                add(total, np.frombuffer(terms.as_buffer(), np.uint16), np.frombuffer(opens.as_buffer(), np.int32), weight, *given)
        for k in range(0, TERMS, PART_TERMS):
            if (part := total[k : k + PART_TERMS]).any():
                yield pa.record_batch({"part": pa.array([k], pa.int32()), "sums": pa.array([part.tobytes()], pa.binary())})

    sums = passages.coalesce(tasks).mapInArrow(run, SUMS).groupBy("part").applyInArrow(_sum_parts, SUMS)
    out = np.zeros((TERMS, width), np.float32)
    for row in sums.toArrow().to_pylist():
        out[row["part"] : row["part"] + PART_TERMS] = np.frombuffer(row["sums"], np.float32).reshape(PART_TERMS, -1)
    sent.unpersist()
    return out


def latent_basis(codes: DataFrame, items: DataFrame, idf: np.ndarray, spec: LeakSpec) -> np.ndarray:
    """Term vectors (idf times right singular vectors) of a randomised SVD of all texts and the items.

    The space starts with AᵀS, random sums of the rows, and takes in its product by AᵀA
    (block Krylov). The products serve twice, for the space and, by Nyström, for the
    singular vectors in it.
    """
    own = coded(items)
    rows = codes.select("terms", "opens", F.lit(1.0).alias("weight")).union(own.select("terms", "opens", F.lit(spec.item_weight)))
    width = spec.dimensions + 8
    spaces, images = [], []
    more = _summed(rows, width, add_signed, idf)
    for _ in range(PRODUCTS):
        for _ in range(2):  # once more for what rounding left
            for one in spaces:
                more = more - one @ (one.T @ more)
            more = np.linalg.qr(more)[0]
        spaces.append(more)
        more = _summed(rows, width, add_gram, idf, more)
        images.append(more)
    return _singular_vectors(spaces, images, spec.dimensions) * idf[:, None]


def _singular_vectors(spaces: list[np.ndarray], images: list[np.ndarray], dimensions: int) -> np.ndarray:
    """First eigenvectors of the Nyström matrix of a space and its image, with double sums over a few terms at once."""
    size = sum(s.shape[1] for s in spaces)
    blocks = [slice(k, k + PART_TERMS) for k in range(0, TERMS, PART_TERMS)]
    part = lambda of, some: np.hstack([one[some] for one in of]).astype(np.float64)
    inner, square = np.zeros((size, size)), np.zeros((size, size))
    for some in blocks:
        image = part(images, some)
        inner += part(spaces, some).T @ image
        square += image.T @ image
    values, turn = np.linalg.eigh((inner + inner.T) / 2)
    kept = values > max(values[-1], 0) * 1e-6
    turn = turn[:, kept] / np.sqrt(values[kept])
    values, own = np.linalg.eigh(turn.T @ square @ turn)
    first = [k for k in np.argsort(-values)[:dimensions] if values[k] > values[-1] * 1e-12]
    turn = turn @ (own[:, first] / np.sqrt(values[first]))
    found = np.zeros((TERMS, dimensions), np.float32)
    for some in blocks:
        found[some, : len(first)] = part(images, some) @ turn
    return found


@dataclass
class Piece:
    """Up to 64 words of an item, as bit masks for the subsequence check."""

    item: int
    words: np.ndarray
    answer: np.ndarray

    def __post_init__(self) -> None:
        self.masks, self.answer_masks = ({}, {})
        for masks, words in ((self.masks, self.words), (self.answer_masks, self.answer)):
            for i, w in enumerate(words.tolist()):
                masks[w] = masks.get(w, 0) | 1 << i


def common_subsequence(masks: dict[int, int], length: int, words: list[int]) -> int:
    """Length of the longest common subsequence, a bit per word of the shorter side."""
    rest = (1 << length) - 1
    full = rest
    for w in words:
        if m := masks.get(w):
            hit = rest & m
            rest = ((rest + hit) | (rest - hit)) & full
    return length - rest.bit_count()


def _plain(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    return words_of(Texts(raw, np.array([0, len(raw)]))).hash


def pieces_of(item: int, text: str, spec: LeakSpec) -> list[Piece]:
    words = _plain(text)
    parts = [p for p in regex.split(r"(?<=[.!?])\s+|\n+", text.strip()) if p.strip()]
    answer = _plain(parts[-1])[-WINDOWS[-1] :] if len(parts) > 1 else words[:0]
    if len(words) < spec.least_words:
        return []
    largest = WINDOWS[-1]
    begins = range(0, max(1, len(words) - largest // 2), largest // 2) if len(words) > largest else [0]
    return [Piece(item, words[b : b + largest], answer) for b in begins]


class RareWords:
    """Words that a passage needs to hold at least some of, for each of some pieces.

    A common subsequence of r of a piece's n words leaves out n - r of them, so it has
    at least k of any n - r + k. The rarest are taken, with k about a third of r.
    """

    def __init__(self, idf: np.ndarray, pieces: list[Piece], share: float) -> None:
        hashes, owners, self.least = [], [], np.empty(len(pieces), np.int64)
        for i, p in enumerate(pieces):
            n = len(p.words)
            r = next(x for x in range(n + 1) if x / n >= share)
            k = self.least[i] = max(1, r // 3)
            own = np.unique(p.words[np.argsort(-idf[_terms(p.words)], kind="stable")[: n - r + k]])
            hashes.append(own)
            owners.append(np.full(len(own), i))
        words, owner = np.concatenate(hashes), np.concatenate(owners)
        order = np.argsort(words, kind="stable")
        self.owner = owner[order]
        self.words, begin = np.unique(words[order], return_index=True)
        self.begin = np.append(begin, len(words))

    def passages(self, words: Words, known: np.ndarray, step: int, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(passage, piece) with enough of the words, all of them among the ``known``.

        Passage c of a row spans the steps c - 1 to c + 2, ``first`` is each row's first.
        """
        at = np.minimum(np.searchsorted(self.words, words.hash[known]), len(self.words) - 1)
        same = self.words[at] == words.hash[known]
        known, at = known[same], at[same]
        row = words.row[known]
        chunk = first[row] + (known - words.first[row]) // step
        many = self.begin[at + 1] - self.begin[at]
        ends = np.cumsum(many)
        keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        low = 0
        while low < len(at):
            high = max(low + 1, int(np.searchsorted(ends, ends[low] - many[low] + PAIRS, side="right")))
            n = many[low:high]
            place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.begin[at[low:high]], n)
            key, count = np.unique(self.owner[place] * first[-1] + np.repeat(chunk[low:high], n), return_counts=True)
            keys.append(key)
            counts.append(count)
            low = high
        key, back = np.unique(np.concatenate(keys), return_inverse=True)
        count = np.bincount(back, weights=np.concatenate(counts), minlength=len(key))
        piece, chunk = np.divmod(key, first[-1]) if len(key) else (key, key)
        row = np.searchsorted(first, chunk, side="right") - 1
        total, spots = [], []
        for shift in (-2, -1, 0, 1):
            inside = (chunk + shift >= first[row]) & (chunk + shift < first[row + 1])
            spots.append((key + shift)[inside])
            total.append(count[inside])
        key, back = np.unique(np.concatenate(spots), return_inverse=True)
        count = np.bincount(back, weights=np.concatenate(total), minlength=len(key))
        piece, chunk = np.divmod(key, first[-1]) if len(key) else (key, key)
        enough = count >= self.least[piece]
        order = np.argsort(chunk[enough], kind="stable")
        return chunk[enough][order], piece[enough][order]


class HeldWords:
    """How many of each piece's words have their place among a passage's: no common subsequence is longer.

    Words are told by a few bits of their hashes, so the number may be too high, never too low.
    """

    def __init__(self, pieces: list[Piece], window: int) -> None:
        self.window = window
        self.sizes = np.array([len(p.words) for p in pieces])
        self.places = np.full((len(pieces), window), PLACES + 1, np.uint16)  # a place that no passage has
        for i, p in enumerate(pieces):
            self.places[i, : len(p.words)] = _places(p.words)

    def share(self, places: np.ndarray, lo: np.ndarray, hi: np.ndarray, passage: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """The number as a part of the piece, for pairs in the order of their passages; those have the ``places`` from ``lo`` to ``hi``."""
        out = np.empty(len(passage), np.int64)
        for k in range(0, len(lo), PASSAGES_AT_ONCE):
            at = lo[k : k + PASSAGES_AT_ONCE, None] + np.arange(2 * self.window)
            near = np.where(at < hi[k : k + PASSAGES_AT_ONCE, None], places.take(at, mode="clip"), PLACES)
            has = np.zeros((len(near), PLACES + 2), bool)
            has[np.arange(len(near))[:, None], near] = True
            own = slice(*np.searchsorted(passage, [k, k + PASSAGES_AT_ONCE]))
            where = self.places[piece[own]] + ((passage[own] - k) * (PLACES + 2))[:, None]
            out[own] = np.count_nonzero(has.reshape(-1).take(where), axis=1)
        return out / self.sizes[piece]


def _paired(sums: np.ndarray, weights: np.ndarray, begin: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sums, weights, first words and offsets by row, of every two neighbours in a row together; an odd last one stays alone."""
    have = np.diff(first)
    many = -(-have // 2)
    ends = np.concatenate([[0], np.cumsum(many)])
    left = np.arange(ends[-1]) * 2 - np.repeat(2 * ends[:-1] - first[:-1], many)
    alone = ends[1:][have % 2 == 1] - 1
    right = left + 1
    right[alone] = left[alone]
    total, size = sums.take(left, axis=0), weights[left]
    total += sums.take(right, axis=0)
    size += weights[right]
    total[alone], size[alone] = sums[left[alone]], weights[left[alone]]
    return total, size, begin[left], ends


class Searcher:
    """Items of one block, with the term vectors; finds them in slices of documents."""

    def __init__(self, basis: np.ndarray, idf: np.ndarray, pieces: list[Piece], spec: LeakSpec) -> None:
        self.weight = np.append(idf**2, np.float32(0))
        self.basis, self.spec = np.vstack([basis, np.zeros((1, basis.shape[1]), np.float32)]), spec
        self.by_window: dict[int, tuple[list[Piece], np.ndarray, RareWords, HeldWords]] = {}
        self.marks = np.zeros(1 << MARKS_LOG, np.uint8)  # a bit for each window that has rare words there
        for window in WINDOWS:
            own = [p for p in pieces if next(w for w in WINDOWS if len(p.words) <= w) == window]
            if own:
                vectors = np.stack([basis[_terms(p.words)].sum(axis=0) for p in own])
                vectors = (vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)).T
                rare = RareWords(idf, own, min(spec.share, spec.share_with_answer))
                self.marks[rare.words >> np.uint64(64 - MARKS_LOG)] |= window
                self.by_window[window] = own, vectors, rare, HeldWords(own, window)

    def find(self, column: pa.Array) -> dict[tuple[int, int], tuple[float, float, bool]]:
        """(row, item) of each leak, with its common share, cosine and whether the answer is there."""
        words = words_of(texts_of(column))
        found: dict[tuple[int, int], tuple[float, float, bool]] = {}
        have = -(-np.diff(words.first) // BLOCK)
        first = np.concatenate([[0], np.cumsum(have)])
        if not first[-1]:
            return found
        row = np.repeat(np.arange(len(have)), have)
        begin = words.first[row] + (np.arange(first[-1]) - first[row]) * BLOCK
        end = np.minimum(begin + BLOCK, words.first[row + 1])
        terms = np.append(_terms(words.hash), TERMS)
        sums = np.empty((len(begin), self.basis.shape[1]), np.float32)
        for at in range(0, len(begin), BLOCKS_AT_ONCE):
            own = begin[at : at + BLOCKS_AT_ONCE, None] + np.arange(BLOCK)
            own = np.where(own < end[at : at + BLOCKS_AT_ONCE, None], terms.take(own, mode="clip"), TERMS)
            total, one = sums[at : at + len(own)], np.empty((len(own), sums.shape[1]), np.float32)
            self.basis.take(own[:, 0], axis=0, out=total, mode="clip")
            for j in range(1, BLOCK):
                total += self.basis.take(own[:, j], axis=0, out=one, mode="clip")
        weights = np.add.reduceat(self.weight[terms[:-1]], begin)
        marks, places = self.marks[words.hash >> np.uint64(64 - MARKS_LOG)], _places(words.hash)
        least = min(self.spec.share, self.spec.share_with_answer)
        for window in WINDOWS:
            # ``sums`` and ``weights`` are of half a window each; a passage is two that follow each other in a row.
            if window > WINDOWS[0]:
                sums, weights, begin, first = _paired(sums, weights, begin, first)
                row = np.repeat(np.arange(len(have)), np.diff(first))
            if window not in self.by_window:
                continue
            pieces, vectors, rare, held = self.by_window[window]
            alike, whose = rare.passages(words, np.flatnonzero(marks & window), window // 2, first)
            alone = np.zeros(len(begin), bool)
            alone[first[1:][np.diff(first) > 0] - 1] = True
            for at in range(0, len(begin), STARTS_AT_ONCE):
                some = slice(at, at + STARTS_AT_ONCE)
                passages, lengths = sums[some].copy(), weights[some].copy()
                last = alone[some]
                after, more = sums[at + 1 : at + 1 + len(last)], weights[at + 1 : at + 1 + len(last)]
                passages[: len(after)] += after
                lengths[: len(after)] += more
                passages[last], lengths[last] = sums[some][last], weights[some][last]
                cosines = (passages @ vectors) / np.sqrt(lengths)[:, None]
                chosen = cosines >= self.spec.cosine
                own = slice(*np.searchsorted(alike, [at, at + len(last)]))
                chosen[alike[own] - at, whose[own]] = True
                passage, piece = np.divmod(np.flatnonzero(chosen), len(pieces))
                listed, passage = np.unique(passage, return_inverse=True)
                own, opens = row[some][listed], begin[some][listed]
                lo, hi = np.maximum(words.first[own], opens - window // 2), np.minimum(words.first[own + 1], opens + window * 3 // 2)
                likely = np.flatnonzero(held.share(places, lo, hi, passage, piece) >= least)
                for s, p in zip(passage[likely].tolist(), piece[likely].tolist(), strict=True):
                    self._check(words.hash[lo[s] : hi[s]].tolist(), int(own[s]), pieces[p], float(cosines[listed[s], p]), found)
        return found

    def _check(self, near: list[int], row: int, piece: Piece, cosine: float, found: dict) -> None:
        share = common_subsequence(piece.masks, len(piece.words), near) / len(piece.words)
        if share < self.spec.share_with_answer:
            return
        asked = len(piece.answer)
        answered = asked > 0 and common_subsequence(piece.answer_masks, asked, near) >= self.spec.share * asked
        if share >= self.spec.share or answered:
            old = found.get((row, piece.item))
            best = (share, cosine, answered)
            found[row, piece.item] = max(old, best) if old else best


def searchers(docs: DataFrame, benchmark: DataFrame, spec: LeakSpec) -> list:
    """Broadcast searchers, one for each block of benchmark items."""
    items = staged(benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", "text").distinct(), "items")
    if not (n := items.count()):
        return []
    codes = coded(docs)
    idf = _inverse_frequencies(codes)
    blocks = -(-n // spec.items_at_once)
    out = []
    for k in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k)
        basis = latent_basis(codes, own, idf, spec)
        pieces = [p for r in own.toArrow().to_pylist() for p in pieces_of(r["item_id"], r["text"], spec)]
        out.append(docs.sparkSession.sparkContext.broadcast(Searcher(basis, idf, pieces, spec)))
    return out


def leaks(docs: DataFrame, benchmark: DataFrame, spec: LeakSpec = LeakSpec()) -> DataFrame:
    """One row per leaked item in a document: doc_id, item_id, share, cosine, answer_found.

    ``share`` is the longest common subsequence (of a piece of at most 64 words of the
    item, in the best passage) as a part of the piece; an item leaks at ``spec.share``,
    or at ``spec.share_with_answer`` if its answer is there too. Null or blank texts leak
    nothing, null or very short items are not searched, an empty benchmark gives no rows.
    Rows that repeat a doc_id are searched each; a row without a doc_id shows its leaks
    with a null doc_id. Other columns are ignored.
    """
    sent = searchers(docs, benchmark, spec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, limit=SEARCHED_BYTES):
            ids = part.column("doc_id")
            for one in sent:
                found = one.value.find(part.column("text"))
                keys, facts = list(found), list(found.values())
                yield pa.record_batch(
                    {
                        "doc_id": ids.take(pa.array([r for r, _ in keys], pa.int64())).cast(pa.int64()),
                        "item_id": pa.array([i for _, i in keys], pa.int64()),
                        "share": pa.array([f[0] for f in facts], pa.float64()),
                        "cosine": pa.array([f[1] for f in facts], pa.float64()),
                        "answer_found": pa.array([f[2] for f in facts], pa.bool_()),
                    }
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, item_id long, share double, cosine double, answer_found boolean")


def without_leaks(docs: DataFrame, benchmark: DataFrame, spec: LeakSpec = LeakSpec()) -> DataFrame:
    """Rows of ``docs`` in which no item leaks, filtered where they are read."""
    sent = searchers(docs, benchmark, spec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, limit=SEARCHED_BYTES):
            keep = np.ones(part.num_rows, dtype=bool)
            for one in sent:
                keep[[r for r, _ in one.value.find(part.column("text"))]] = False
            yield part.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
