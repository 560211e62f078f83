"""Exact per-key order over keys of any size.

A plain ``row_number`` over a key puts the whole key in one task. Here the key
is cut into time slots: rows are numbered inside (key, slot), and the slot's
starting number comes from a prefix sum over slot counts. Only the counts, one
row per slot, ever meet in one task per key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def time_slot(ts: Column, seconds: int) -> Column:
    """Number of the fixed-width slot a timestamp falls in."""
    return F.floor(F.unix_micros(ts) / F.lit(seconds * 1_000_000)).cast("bigint")


def _slot_starts(
    slotted: DataFrame, keys: Sequence[str], value: Column, total: str | None = None
) -> DataFrame:
    """Sum of ``value`` before each (key, slot), from one pre-aggregated row per slot."""
    sums = slotted.groupBy(*keys, "_slot").agg(F.sum(value).alias("_in_slot"))
    before = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(
        *keys,
        "_slot",
        F.coalesce(F.sum("_in_slot").over(before), F.lit(0)).alias("_slot_start"),
        *([F.sum("_in_slot").over(Window.partitionBy(*keys)).alias(total)] if total else []),
    )


def keyed_rank(
    df: DataFrame,
    keys: Sequence[str],
    slot: Column,
    order: Sequence[Column],
    name: str = "rank",
    total: str | None = None,
) -> DataFrame:
    """Add the 1-based position of each row within its key, and its key's row count.

    ``slot`` must never decrease along ``order``; keys must not be null. ``df``
    is read twice (once for the counts) and so must be deterministic.
    """
    slotted = df.withColumn("_slot", slot)
    starts = _slot_starts(slotted, keys, F.lit(1), total)
    local = Window.partitionBy(*keys, "_slot").orderBy(*order)
    return (
        slotted.withColumn("_slot_local", F.row_number().over(local))
        .join(starts, [*keys, "_slot"])
        .withColumn(name, F.col("_slot_start") + F.col("_slot_local"))
        .drop("_slot", "_slot_local", "_slot_start")
    )


def keyed_offset(
    df: DataFrame, keys: Sequence[str], slot: Column, order: Sequence[Column], value: str, name: str
) -> DataFrame:
    """Add the sum of ``value`` over the earlier rows of each row's key."""
    slotted = df.withColumn("_slot", slot)
    starts = _slot_starts(slotted, keys, F.col(value))
    local = Window.partitionBy(*keys, "_slot").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        slotted.withColumn("_slot_local", F.coalesce(F.sum(value).over(local), F.lit(0)))
        .join(starts, [*keys, "_slot"])
        .withColumn(name, F.col("_slot_start") + F.col("_slot_local"))
        .drop("_slot", "_slot_local", "_slot_start")
    )


def with_halo(df: DataFrame, rank: str, before: int, chunk: int = 20_000) -> DataFrame:
    """Cut ranked keys into chunks that carry the ``before`` rows ahead of them.

    Adds ``chunk`` and ``is_halo``. Trailing frames over (key, chunk) are then
    exact for every non-halo row, and no task holds more than one chunk.
    """
    if chunk < before:
        raise ValueError("a chunk must be at least as long as its halo")
    own = F.floor((F.col(rank) - 1) / chunk).cast("bigint")
    copies = F.when(
        F.col(rank) > (own + 1) * chunk - before, F.array(own, own + 1)
    ).otherwise(F.array(own))
    return df.withColumn("chunk", F.explode(copies)).withColumn("is_halo", F.col("chunk") != own)


def trailing_frames(
    df: DataFrame,
    keys: Sequence[str],
    rank: str,
    columns: Callable[[Callable[[Column], Column]], dict[str, Column]],
    size: int,
    chunk: int = 20_000,
) -> DataFrame:
    """Add columns over the last ``size`` rows of each ranked key.

    ``columns`` gets ``over``, which evaluates an aggregate over the frame, and
    returns the named columns to add.
    """
    frame = Window.partitionBy(*keys, "chunk").orderBy(rank).rowsBetween(-(size - 1), 0)
    out = with_halo(df, rank, size - 1, max(chunk, size))
    made = columns(lambda aggregate: aggregate.over(frame))
    return out.select("*", *[c.alias(n) for n, c in made.items()]).filter(~F.col("is_halo")).drop("chunk", "is_halo")
