"""Near-duplicates by circulant MinHash and exact Jaccard checks.

A signature needs two permutations only: one scatters the shingles, the other is
read with a circular shift of 0, 1, 2 ... for the coordinates. Bands of coordinates
propose pairs; every link is confirmed on the full shingle sets.

How skew is handled: equal shingle sets collapse to one representative before
banding; a bucket compares its members with its smallest one only, then, where it still
holds several components, with its most typical one (links of a star suffice for
components). What stays apart of a bucket's largest component goes through an exact
prefix join (``prefixes``), which meets only texts that share a rare shingle early
enough to reach the threshold. No step lists the pairs of a bucket.

Texts and signatures are not shuffled: rows that a step needs are picked beside the
scan by a bitmap of fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltwatch.llm.bitmaps import bitmap, has, id_place
from siltwatch.llm.common import staged
from siltwatch.llm.components import components
from siltwatch.llm.prefixes import cell_counts, near_pairs, typical
from siltwatch.llm.words import mix, sets_of, shingles_of, slices, texts_of, words_of

PLACES_LOG = 20
BANDS, ROWS = 25, 5
COORDINATES = BANDS * ROWS
ID_BITS = 26
"""Most bits of the number of places of a bitmap of ids: 8 MB."""
SLACK = 0.16
"""Pairs are confirmed if their signatures agree to the threshold less this much,
over four standard errors of 125 coordinates at 0.8."""


@lru_cache(1)
def _permutations() -> tuple[np.ndarray, np.ndarray]:
    """The scattering permutation, and windows that hold every circular shift."""
    size = 1 << PLACES_LOG
    rng = np.random.default_rng(10)
    scatter, values = rng.permutation(size), rng.permutation(size).astype(np.int32)
    return scatter, sliding_window_view(np.concatenate([values, values[: COORDINATES - 1]]), COORDINATES)


def signature(shingles: np.ndarray) -> np.ndarray:
    """All coordinates for a set of 64-bit shingles, in bounded pieces."""
    scatter, shifted = _permutations()
    out = np.full(COORDINATES, np.iinfo(np.int32).max, dtype=np.int32)
    for at in range(0, len(shingles), 4096):
        places = scatter[(shingles[at : at + 4096] >> np.uint64(64 - PLACES_LOG)).astype(np.int64)]
        np.minimum(out, shifted[places].min(axis=0), out=out)
    return out


def _band_keys(signatures: np.ndarray) -> np.ndarray:
    rows = signatures.reshape(-1, BANDS, ROWS).astype(np.uint64)
    key = np.arange(BANDS, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15)
    for j in range(ROWS):
        key = mix(key ^ (rows[:, :, j] + np.uint64(j + 1)))
    return key.view(np.int64)


def _sketch(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            sets = sets_of(*shingles_of(words_of(texts_of(part.column("text"))), n))
            sizes = np.array([len(s) for s in sets], dtype=np.int64)
            ids = np.zeros((len(sets), 2), dtype=np.uint64)
            marks = np.empty((len(sets), COORDINATES), dtype=np.int32)
            for i, own in enumerate(sets):
                mixed = mix(own ^ np.uint64(0xD6E8FEB86659FD93))
                ids[i] = own.sum(dtype=np.uint64), mixed.sum(dtype=np.uint64)
                marks[i] = signature(own)
            some = sizes > 0
            ids = ids.view(np.int64)
            yield pa.record_batch(
                {
                    "doc_id": part.column("doc_id"),
                    "n_shingles": pa.array(sizes),
                    "set_a": pa.array(ids[:, 0], mask=~some),
                    "set_b": pa.array(ids[:, 1], mask=~some),
                    "marks": pa.array([m.tobytes() for m in marks], pa.binary()),
                }
            )

    return run


def _shingle_sets(n: int, wanted: np.ndarray):
    """Shingle sets of the rows whose place is in a bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen = batch.filter(pa.array(has(wanted, batch.column("place").to_numpy(zero_copy_only=False))))
            for part in slices(iter([chosen])):
                sets = sets_of(*shingles_of(words_of(texts_of(part.column("text"))), n))
                yield pa.record_batch({"id": part.column("doc_id"), "own": pa.array([s.tobytes() for s in sets], pa.binary())})

    return run


def _picked(wanted: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = pa.array(has(wanted, batch.column("place").to_numpy(zero_copy_only=False)))
            yield batch.select(["id", "marks"]).filter(near)

    return run


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            marks = np.frombuffer(b"".join(batch.column("marks").to_pylist()), dtype=np.int32).reshape(-1, COORDINATES)
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            sizes = batch.column("n_shingles").to_numpy(zero_copy_only=False)
            yield pa.record_batch(
                {"bucket": _band_keys(marks).ravel(), "id": np.repeat(ids, BANDS), "n": np.repeat(sizes, BANDS)}
            )


def _agreeing(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                one, two = (
                    np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.int32).reshape(-1, COORDINATES)
                    for c in ("marks_a", "marks_b")
                )
                near = pa.array((one == two).mean(axis=1) >= least)
                yield batch.select(["a", "b"]).filter(near)

    return run


def _confirmed(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, two in zip(batch.column("own_a"), batch.column("own_b"), strict=True):
                x, y = (np.frombuffer(s.as_buffer(), dtype=np.uint64) for s in (one, two))
                both = np.sort(np.concatenate([x, y]))
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _sets(docs: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    """(id, own) for the documents with the given ids; a few others may be among them."""
    wanted = bitmap(ids, id_place("id"), ID_BITS)
    placed = docs.where("doc_id IS NOT NULL").select("doc_id", "text", id_place("doc_id").alias("place"))
    return staged(placed.mapInArrow(_shingle_sets(n, wanted), "id long, own binary").dropDuplicates(["id"]), "shingle-sets")


def _ends(pairs: DataFrame) -> DataFrame:
    """Ids in pairs, some of them repeated."""
    return pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))


def _links(pairs: DataFrame, marks: DataFrame, docs: DataFrame, n: int, percent: int, sets: DataFrame | None = None) -> DataFrame:
    """Pairs (a, b) confirmed on the full shingle sets; only documents in a likely pair are read for it."""
    pairs = staged(pairs, "pairs")
    wanted = bitmap(_ends(pairs), id_place("id"), ID_BITS)
    placed = marks.select("id", "marks", id_place("id").alias("place"))
    picked = staged(placed.mapInArrow(_picked(wanted), "id long, marks binary"), "pair-marks")
    side = lambda s: picked.select(F.col("id").alias(s), F.col("marks").alias(f"marks_{s}"))
    likely = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "marks_a", "marks_b")
    likely = staged(likely.mapInArrow(_agreeing(percent / 100 - SLACK), "a long, b long"), "likely-pairs")
    sets = _sets(docs, _ends(likely), n) if sets is None else sets
    own = lambda s: sets.select(F.col("id").alias(s), F.col("own").alias(f"own_{s}"))
    return likely.join(own("a"), "a").join(own("b"), "b").select("a", "b", "own_a", "own_b").mapInArrow(_confirmed(percent), "a long, b long")


def _mixed(shared: DataFrame, near: DataFrame) -> DataFrame:
    """Members (bucket, id, n, component, main) of buckets that hold several components; main is the largest."""
    apart = shared.select("bucket", "id", "n").join(near, "id", "left").withColumn("component", F.coalesce("component", "id"))
    counts = apart.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("c"))
    mixed = counts.groupBy("bucket").agg(F.max_by("component", F.struct("c", "component")).alias("main"), F.count(F.lit(1)).alias("k"))
    return staged(apart.join(mixed.where("k > 1").select("bucket", "main"), "bucket"), "mixed")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Linked are documents whose sets of ``words``-word shingles have
    ``100 * intersection >= percent * union``. ``component_id`` is the smallest doc_id
    reachable by links; kept is ``doc_id = component_id``. Texts that are null or have
    no words have an empty set and are linked with nothing; fewer words than a shingle
    count as one shingle. Rows that repeat a doc_id are one document. Rows without a
    doc_id are linked with nothing: component_id is null and kept is true. Other
    columns are ignored; an empty table gives no rows.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketches = staged(
        base.mapInArrow(_sketch(words), "doc_id long, n_shingles long, set_a long, set_b long, marks binary"), "sketches"
    )
    named = sketches.where("doc_id IS NOT NULL AND n_shingles > 0")
    sets = named.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("id"))
    alone = named.join(sets.withColumnRenamed("id", "doc_id"), ["set_a", "set_b", "doc_id"], "left_semi")
    marks = staged(
        alone.select(F.col("doc_id").alias("id"), "n_shingles", "marks", "set_a", "set_b").dropDuplicates(["id"]), "marks"
    )
    buckets = marks.select("id", "n_shingles", "marks").mapInArrow(_bands, "bucket long, id long, n long")
    heads = buckets.groupBy("bucket").agg(F.min(F.struct("id", "n")).alias("head"), F.count(F.lit(1)).alias("size"))
    heads = staged(heads.where("size > 1").select("bucket", "head"), "bucket-heads")
    shared = staged(buckets.join(heads, "bucket"), "shared-buckets")
    close = lambda x, y: F.least(x, y) * 100 >= F.greatest(x, y) * percent
    pair = lambda x, y: (F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
    star = shared.where(F.col("id") != F.col("head.id")).where(close(F.col("n"), F.col("head.n")))
    links = staged(_links(star.select(*pair("head.id", "id")).distinct(), marks, base, words, percent), "confirmed")
    near = staged(components(links), "components")

    mixed = _mixed(shared, near)
    if not mixed.isEmpty():
        sets = _sets(base, mixed.select("id"), words)
        counts = cell_counts(sets)
        middle = mixed.join(typical(sets, counts), "id").groupBy("bucket").agg(F.max_by(F.struct("id", "n", "component"), F.struct("typical", "id")).alias("m"))
        star = mixed.join(middle, "bucket").where(F.col("component") != F.col("m.component")).where(close(F.col("n"), F.col("m.n")))
        links = staged(links.union(_links(star.select(*pair("m.id", "id")).distinct(), marks, base, words, percent, sets)), "confirmed")
        near = staged(components(links), "components")
        apart = _mixed(mixed.select("bucket", "id", "n"), near)
        sides = apart.groupBy("id", "component").agg(F.max(F.col("component") != F.col("main")).alias("odd"))
        late = near_pairs(sets, staged(sides, "sides"), counts, percent)
        late = staged(_links(late, marks, base, words, percent, sets), "late-links")
        if not late.isEmpty():
            near = staged(components(links.union(late)), "components")

    kinds = marks.select("set_a", "set_b", "id").join(near, "id", "left")
    kinds = kinds.select("set_a", "set_b", F.coalesce("component", "id").alias("component"))
    out = sketches.drop("marks").join(kinds, ["set_a", "set_b"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id")
    out = out.select("doc_id", "n_shingles", component)
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
