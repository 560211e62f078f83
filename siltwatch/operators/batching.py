"""Batches of log lines per subnet, with carry-over of the previous batch.

A batch is cut when it reaches ``size`` lines or when its time window ends,
whichever comes first. The next batch of the subnet is sent together with the
lines of the one before (the buffer), unless a flush found the subnet without
new lines in between; then the buffer has expired.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltwatch.operators.ranking import keyed_rank, time_slot

# Settings used where a collector configures none.
DEFAULTS = {
    "batch_size": 2000,
    "batch_timeout": 30.0,
    "subnet_id": {"ipv4_prefix_length": 24, "ipv6_prefix_length": 64},
}


def merge_settings(defaults: Mapping, override: Mapping | None) -> dict:
    """Collector settings: an override replaces whole top-level entries."""
    return {**defaults, **(override or {})}


@dataclass(frozen=True)
class BatchSpec:
    size: int = 2000
    seconds: int = 30
    key: str = "subnet_id"
    order: Sequence[str] = ("ts", "logline_id")
    slot_seconds: int = 300

    @classmethod
    def from_settings(cls, settings: Mapping) -> "BatchSpec":
        return cls(size=int(settings["batch_size"]), seconds=max(1, int(settings["batch_timeout"])))


def batch_key(key: str, window: Column, part: Column) -> Column:
    """Readable, replay-stable batch id."""
    return F.concat_ws("#", F.col(key), window.cast("string"), part.cast("string"))


def size_batches(df: DataFrame, size: int, key: str = "subnet_id", slot_seconds: int = 60) -> DataFrame:
    """Size trigger only: every ``size`` lines of a key, in time order."""
    ranked = keyed_rank(df, [key], time_slot(F.col("ts"), slot_seconds), [F.col("ts"), F.col("logline_id")])
    return ranked.withColumn("batch_no", F.floor((F.col("rank") - 1) / size).cast("bigint"))


def time_batches(df: DataFrame, seconds: int, key: str = "subnet_id") -> DataFrame:
    """Time trigger only: lines, first and last time per key and tumbling window."""
    return df.groupBy(key, F.window("ts", f"{seconds} seconds").alias("w")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.min("ts").alias("begin_ts"), F.max("ts").alias("end_ts")
    ).select(key, F.col("w.start").alias("window_start"), "n_lines", "begin_ts", "end_ts")


def assign_batches(df: DataFrame, spec: BatchSpec) -> DataFrame:
    """Add ``flush_no``, ``part``, ``batch_id`` and whether the part ends its window.

    Size and window triggers together. A window is numbered slot by slot, so a
    busy subnet's window is never in one task as a whole.
    """
    return assign_flush(df, spec, time_slot(F.col("ts"), spec.seconds))


def assign_flush(df: DataFrame, spec: BatchSpec, flush: Column) -> DataFrame:
    """As :func:`assign_batches`, with any number that tells which flush sends a line."""
    group = [spec.key, "flush_no"]
    order = [F.col(c) for c in spec.order]
    df = df.withColumn("flush_no", flush)
    slot = time_slot(F.col("ts"), min(spec.slot_seconds, max(1, spec.seconds // 8)))
    ranked = keyed_rank(df, group, slot, order, name="_rn", total="_cnt")
    return (
        ranked.withColumn("part", F.floor((F.col("_rn") - 1) / spec.size).cast("bigint"))
        .withColumn("ends_window", F.col("part") == F.floor((F.col("_cnt") - 1) / spec.size))
        # A full last batch was sent on size; the flush then drops its buffer.
        .withColumn("expires", F.col("ends_window") & (F.col("_cnt") % spec.size == 0))
        .drop("_rn", "_cnt")
        .withColumn("batch_id", batch_key(spec.key, F.col("flush_no"), F.col("part")))
    )


def _successor() -> Column:
    """Struct (flush_no, part) of the batch that would take this one as buffer."""
    return F.when(
        ~F.col("ends_window"), F.struct(F.col("flush_no").alias("f"), (F.col("part") + 1).alias("p"))
    ).when(~F.col("expires"), F.struct((F.col("flush_no") + 1).alias("f"), F.lit(0).cast("bigint").alias("p")))


def carry_over(assigned: DataFrame, spec: BatchSpec) -> DataFrame:
    """Rows of every sent batch: its buffer rows, then its own rows.

    Adds ``is_buffer``, ``position`` (1-based, buffer first, each part in time
    order) and the batch's ``begin_ts`` and ``end_ts``. A group holds at most
    two batches, and one shuffle serves all of it.
    """
    own = F.struct(F.col("flush_no").alias("f"), F.col("part").alias("p"), F.lit(False).alias("b"))
    succ = _successor()
    nxt = F.when(succ.isNotNull(), F.struct(succ["f"].alias("f"), succ["p"].alias("p"), F.lit(True).alias("b")))
    copies = assigned.withColumn("_to", F.explode(F.array_compact(F.array(own, nxt))))
    rows = copies.select(
        *[c for c in assigned.columns if c not in ("flush_no", "part", "batch_id", "ends_window", "expires")],
        F.col("_to.f").alias("flush_no"),
        F.col("_to.p").alias("part"),
        F.col("_to.b").alias("is_buffer"),
    )
    group = Window.partitionBy(spec.key, "flush_no", "part")
    ordered = group.orderBy("is_buffer_last", *spec.order)
    return (
        rows.withColumn("_new", F.max(~F.col("is_buffer")).over(group))
        .filter("_new")
        .withColumn("is_buffer_last", ~F.col("is_buffer"))
        .withColumn(
            "begin_ts",
            F.coalesce(F.min(F.when(F.col("is_buffer"), F.col("ts"))).over(group), F.min("ts").over(group)),
        )
        .withColumn("end_ts", F.max(F.when(~F.col("is_buffer"), F.col("ts"))).over(group))
        .withColumn("position", F.row_number().over(ordered))
        .withColumn("batch_id", batch_key(spec.key, F.col("flush_no"), F.col("part")))
        .drop("_new", "is_buffer_last")
    )


def batch_bounds(assigned: DataFrame, spec: BatchSpec) -> DataFrame:
    """Begin, end and row counts of every sent batch, without copying rows.

    Batches are summarised first; only their summaries travel to the successor.
    """
    summary = assigned.groupBy(spec.key, "flush_no", "part", "ends_window", "expires").agg(
        F.min("ts").alias("lo"), F.max("ts").alias("hi"), F.count(F.lit(1)).alias("n")
    )
    succ = _successor()
    own = F.struct(F.col("flush_no").alias("f"), F.col("part").alias("p"), F.lit(False).alias("b"))
    nxt = F.when(succ.isNotNull(), F.struct(succ["f"].alias("f"), succ["p"].alias("p"), F.lit(True).alias("b")))
    spread = summary.withColumn("to", F.explode(F.array_compact(F.array(own, nxt))))
    is_own, is_buf = ~F.col("to.b"), F.col("to.b")
    return (
        spread.groupBy(spec.key, F.col("to.f").alias("flush_no"), F.col("to.p").alias("part"))
        .agg(
            F.coalesce(F.min(F.when(is_buf, F.col("lo"))), F.min(F.when(is_own, F.col("lo")))).alias("begin_ts"),
            F.max(F.when(is_own, F.col("hi"))).alias("end_ts"),
            F.coalesce(F.sum(F.when(is_buf, F.col("n"))), F.lit(0)).cast("bigint").alias("n_buffer"),
            F.sum(F.when(is_own, F.col("n"))).cast("bigint").alias("n_new"),
        )
        .filter(F.col("n_new").isNotNull())
        .withColumn("batch_id", batch_key(spec.key, F.col("flush_no"), F.col("part")))
    )


def line_to_batch(assigned: DataFrame) -> DataFrame:
    """Lineage edges log line -> batch it was first put in."""
    return assigned.select("logline_id", "batch_id", F.col("ts").alias("timestamp"))


def batch_envelopes(sent: DataFrame, fields: Sequence[str]) -> DataFrame:
    """One nested row per sent batch, for a sink; at most two batches of rows each."""
    entry = F.struct("position", F.struct(*fields).alias("row"))
    return sent.groupBy("batch_id").agg(
        F.coalesce(F.min(F.when(F.col("is_buffer"), F.col("ts"))), F.min("ts")).alias("begin_timestamp"),
        F.max(F.when(~F.col("is_buffer"), F.col("ts"))).alias("end_timestamp"),
        F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["row"]).alias("data"),
    )


def fill_levels(df: DataFrame, stage: str, entry_type: str, at: Column) -> DataFrame:
    """Current number of lines held by a stage."""
    return df.agg(F.count(F.lit(1)).alias("entry_count")).select(
        at.alias("timestamp"), F.lit(stage).alias("stage"), F.lit(entry_type).alias("entry_type"), "entry_count"
    )
