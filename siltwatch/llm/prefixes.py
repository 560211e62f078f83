"""Exact prefix join of shingle sets, rarest shingles first.

Shingles have one order for all sets: by how often their cell is used, then by value.
Two sets that reach the threshold share a shingle among the first ``n - need + 1`` of
each, where ``need`` is the least overlap. How late that shingle stands bounds the
overlap that is left, and with it the sizes a partner may have; so a row carries a
class of its own size and a class of its partner's, and only rows that agree in
shingle and both classes meet. A text that differs in many rare shingles from the
others meets nobody: what rows would meet on is compared first, packed, and only rows
that meet one of another component are made.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltwatch.llm.common import staged
from siltwatch.llm.words import mix

CELL_BITS = 21
"""Most bits of the number of counters for the order of shingles: 8 MB. Shared cells only change the order."""
KEY_BITS = 26
"""Most bits for what rows may meet on: 8 MB."""
KEYS_AT_ONCE = 1 << 20
STEP = math.log(1.1)
"""A class of sizes spans ten percent."""


def _cells(shingles: np.ndarray, size: int) -> np.ndarray:
    return (shingles >> np.uint64(65 - size.bit_length())).astype(np.int64)


def _own(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(s.as_buffer(), dtype=np.uint64) for s in batch.column("own")]


def _used(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for own in _own(batch):
                np.add.at(total, _cells(own, size), 1)
        cells = np.flatnonzero(total)
        yield pa.record_batch({"cell": cells, "c": total[cells]})

    return run


def cell_counts(sets: DataFrame) -> Broadcast:
    """How many shingles of all sets (id, own; a written table) fall in each cell."""
    size = 1 << min(CELL_BITS, max(14, (512 * sets.count()).bit_length()))
    rows = sets.mapInArrow(_used(size), "cell long, c long").groupBy("cell").agg(F.sum("c").alias("c")).where("c > 1")
    found = rows.toArrow()  # 2 ** CELL_BITS rows at most
    out = np.ones(size, dtype=np.int32)
    out[found.column("cell").to_numpy()] = np.minimum(found.column("c").to_numpy(), 2**31 - 1)
    return sets.sparkSession.sparkContext.broadcast(out)


def typical(sets: DataFrame, counts: Broadcast) -> DataFrame:
    """(id, typical): the mean count of a set's shingles; the middle of a group of copies has the most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used = counts.value
        for batch in batches:
            means = [float(used[_cells(own, len(used))].mean()) if len(own) else 0.0 for own in _own(batch)]
            yield pa.record_batch({"id": batch.column("id"), "typical": pa.array(means, pa.float64())})

    return sets.mapInArrow(run, "id long, typical double")


def size_class(n: np.ndarray) -> np.ndarray:
    return np.floor(np.log(n) / STEP + 1e-9).astype(np.int64)


def prefix(own: np.ndarray, counts: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a sorted set: shingles of the prefix that others may share, what is left at each, and the classes of partners.

    The classes run from the smallest size that reaches the threshold to the largest
    that the shingle's place allows; where that is less, the shingle is left out.
    """
    n, used = len(own), counts[_cells(own, len(counts))]
    order = np.lexsort((own, used))
    need = -(-percent * n // 100)
    order = order[: n - need + 1]
    left = n - np.arange(len(order))
    least = need
    most = np.minimum((100 + percent) * left // percent - n, 100 * n // percent)
    keep = (used[order] > 1) & (most >= least)
    low, high = size_class(np.full(keep.sum(), least)), size_class(most[keep])
    return own[order[keep]], left[keep], low, high


def _meeting(s: np.ndarray, cx: np.ndarray, cy: np.ndarray) -> np.ndarray:
    """One number for what two rows agree in."""
    return mix(s ^ (cx.astype(np.uint64) << np.uint64(32) | cy.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15))


def _prefix_rows(own: np.ndarray, counts: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, int, np.ndarray]:
    """(shingle, left, own class, class of partners) of one set, a row for each class."""
    shingles, left, low, high = prefix(own, counts, percent)
    times = high - low + 1
    within = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    return np.repeat(shingles, times), np.repeat(left, times), int(size_class(np.array([len(own)]))[0]), np.repeat(low, times) + within


def _merged(keys: np.ndarray, low: np.ndarray, high: np.ndarray, sides: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each key once: its smallest and largest component, and the sides it is on."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else order
    if not len(keys):
        return keys, low, high, sides
    return (
        keys[starts], np.minimum.reduceat(low[order], starts), np.maximum.reduceat(high[order], starts), np.bitwise_or.reduceat(sides[order], starts)
    )


_PACKED = (("keys", np.uint64), ("low", np.int64), ("high", np.int64), ("sides", np.uint8))


def _keys(counts: Broadcast, percent: int, parts_log: int):
    """Packed keys of the rows to be, cut by their upper bits."""

    def cut(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        columns = _merged(*(np.concatenate(c) for c in zip(*held, strict=True)))
        edges = np.searchsorted(columns[0], np.arange(1, 1 << parts_log, dtype=np.uint64) << np.uint64(64 - parts_log))
        edges = np.concatenate([[0], edges, [len(columns[0])]])
        for p in np.flatnonzero(np.diff(edges)).tolist():
            own = {name: pa.array([c[edges[p] : edges[p + 1]].tobytes()], pa.binary()) for (name, _), c in zip(_PACKED, columns, strict=True)}
            yield pa.record_batch({"part": pa.array([p], pa.int32()), **own})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for own, component, odd in zip(_own(batch), batch.column("component").to_pylist(), batch.column("odd").to_pylist(), strict=True):
                if len(own):
                    shingles, _, mine, other = _prefix_rows(own, counts.value, percent)
                    mine = np.full(len(shingles), mine)
                    for key, side in ((_meeting(shingles, mine, other), 1), (_meeting(shingles, other, mine), 2))[0 if odd else 1 :]:
                        who = np.full(len(key), component, np.int64)
                        held.append((key, who, who, np.full(len(key), side, np.uint8)))
                        size += len(key)
                if size > KEYS_AT_ONCE:
                    yield from cut(held)
                    held, size = [], 0
        if size:
            yield from cut(held)

    return run


def _shared(parts_log: int, bits: int):
    """The bits of a part's keys that a probe and an index row of different components have."""

    def run(key: tuple, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = tuple(np.zeros(0, t) for _, t in _PACKED)
        for batch in parts:
            for i in range(batch.num_rows):
                more = (np.frombuffer(batch.column(name)[i].as_buffer(), t) for name, t in _PACKED)
                state = _merged(*(np.concatenate(c) for c in zip(state, more, strict=True)))
        keys, low, high, sides = state
        keys = keys[(low != high) & (sides == 3)]
        places = (keys >> np.uint64(64 - bits)).astype(np.int64) - (key[0].as_py() << (bits - parts_log))
        marks = np.zeros(1 << (bits - parts_log), bool)
        marks[places] = True
        yield pa.record_batch({"part": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([np.packbits(marks, bitorder="little").tobytes()], pa.binary())})

    return run


def shared_keys(members: DataFrame, counts: Broadcast, percent: int) -> Broadcast:
    """Bits of what rows of different components would meet on, of ``members`` (id, own, component, odd; a written table).

    Keys are packed, merged beside the scan and compared part by part, so no row of the
    join is made for it. The bits miss none; beyond their fixed size they let more through.
    """
    total = members.agg(F.sum(F.length("own") / 8)).first()[0] or 0
    bits = min(KEY_BITS, max(16, int(32 * total).bit_length()))
    parts_log = min(10, max(2, int(total / KEYS_AT_ONCE).bit_length()))
    packed = members.select("own", "component", "odd").mapInArrow(
        _keys(counts, percent, parts_log), "part int, keys binary, low binary, high binary, sides binary"
    )
    found = packed.groupBy("part").applyInArrow(_shared(parts_log, bits), "part int, bits binary")
    out = np.zeros((1 << bits) // 8, np.uint8)
    size = len(out) >> parts_log
    for row in found.toArrow().to_pylist():  # 2 ** KEY_BITS bits at most
        out[row["part"] * size : (row["part"] + 1) * size] = np.frombuffer(row["bits"], np.uint8)
    return members.sparkSession.sparkContext.broadcast(out)


def _rows(counts: Broadcast, shared: Broadcast, percent: int, probe: bool):
    own_class, other_class = ("cx", "cy") if probe else ("cy", "cx")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = shared.value
        shift = np.uint64(64 - (8 * len(some)).bit_length() + 1)
        for batch in batches:
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            parts = []
            for i, own in enumerate(_own(batch)):
                if len(own):
                    s, left, mine, other = _prefix_rows(own, counts.value, percent)
                    mine = np.full(len(s), mine)
                    at = (_meeting(s, mine, other) if probe else _meeting(s, other, mine)) >> shift
                    keep = (some[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
                    n = int(keep.sum())
                    parts.append((s[keep], mine[keep], other[keep], np.full(n, ids[i]), np.full(n, len(own)), left[keep]))
            if parts:
                s, own_c, other_c, who, n, left = (np.concatenate(c) for c in zip(*parts, strict=True))
                yield pa.record_batch({"s": s.view(np.int64), own_class: own_c, other_class: other_c, "id": who, "n": n, "left": left})

    return run


def near_pairs(sets: DataFrame, sides: DataFrame, counts: Broadcast, percent: int) -> DataFrame:
    """Pairs (a, b), a < b, of different components that may reach the threshold, one of them odd.

    ``sides`` has id, component and odd. No pair that reaches it is missed.
    """
    members = staged(sets.join(sides, "id"), "prefix-members")
    shared = shared_keys(members, counts, percent)
    columns = "s long, {} long, {} long, id long, n long, left long"
    probes = members.where("odd").select("id", "own").mapInArrow(_rows(counts, shared, percent, True), columns.format("cx", "cy"))
    index = members.select("id", "own").mapInArrow(_rows(counts, shared, percent, False), columns.format("cy", "cx"))
    named = lambda df, t: df.join(sides.select("id", "component"), "id").select(
        "s", "cx", "cy", *[F.col(c).alias(f"{c}_{t}") for c in ("id", "n", "left", "component")]
    )
    enough = (100 + percent) * F.least("left_x", "left_y") >= percent * (F.col("n_x") + F.col("n_y"))
    sized = F.least("n_x", "n_y") * 100 >= F.greatest("n_x", "n_y") * percent
    apart = F.col("component_x") != F.col("component_y")
    x, y = named(probes, "x").alias("x"), named(index, "y").alias("y")
    same = (F.col("x.s") == F.col("y.s")) & (F.col("x.cx") == F.col("y.cx")) & (F.col("x.cy") == F.col("y.cy"))
    met = x.join(y, same & enough & sized & apart)
    return met.select(F.least("id_x", "id_y").alias("a"), F.greatest("id_x", "id_y").alias("b")).distinct()
