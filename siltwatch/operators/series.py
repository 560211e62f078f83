"""Time series of a batch: messages and mean size per time step."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Step units a configuration may name, in microseconds.
UNITS = {"us": 1, "ms": 1_000, "s": 1_000_000, "m": 60_000_000, "h": 3_600_000_000, "D": 86_400_000_000}
MODES = ("sum", "compat")


@dataclass(frozen=True)
class StepSpec:
    """Step width, and how messages of one step are counted.

    ``sum`` counts every message. ``compat`` counts per distinct timestamp and
    keeps only the latest timestamp of each step.
    """

    range: int = 20
    unit: str = "ms"
    mode: str = "sum"

    def __post_init__(self):
        if self.unit not in UNITS or self.range < 1:
            raise ValueError(f"bad step {self.range} {self.unit}")
        if self.mode not in MODES:
            raise ValueError(f"unknown series mode {self.mode!r}")

    @property
    def micros(self) -> int:
        return self.range * UNITS[self.unit]


def step_index(spec: StepSpec, ts: str = "ts", begin: str = "begin_ts") -> Column:
    """Step of a message, truncated toward zero.

    A message less than one step before begin lands in step 0.
    """
    delta = F.unix_micros(ts) - F.unix_micros(begin)
    return (delta / F.lit(spec.micros)).cast("bigint")


def step_count(spec: StepSpec, begin: str = "begin_ts", end: str = "end_ts") -> Column:
    """Steps from begin to end, both included."""
    delta = F.unix_micros(end) - F.unix_micros(begin)
    return (F.ceil(delta / F.lit(spec.micros)) + 1).cast("bigint")


def size_value(col: Column) -> Column:
    """Number of a size text; the letter ``b`` is ignored."""
    return F.replace(col, F.lit("b"), F.lit("")).try_cast("bigint")


def dense_axis(bounds: DataFrame, spec: StepSpec, piece: int = 4096) -> DataFrame:
    """One row per batch and step, built in pieces: no array holds a whole axis."""
    last = step_count(spec) - 1
    pieces = bounds.select("batch_id", last.alias("last"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(last / piece))).alias("k"))
    inside = F.sequence(F.col("k") * piece, F.least(F.col("last"), F.col("k") * piece + (piece - 1)))
    return pieces.select("batch_id", F.explode(inside).alias("step"))


def step_totals(messages: DataFrame, spec: StepSpec) -> DataFrame:
    """Count and size sum per (batch, step) that has messages.

    ``messages`` carries ``batch_id, ts, begin_ts, end_ts, size``.
    """
    placed = messages.withColumn("step", step_index(spec)).filter(
        (F.col("step") >= 0) & (F.col("step") < step_count(spec))
    )
    size = size_value(F.col("size"))
    totals = [F.count(F.lit(1)).alias("n"), F.sum(size).alias("bytes")]
    if spec.mode == "sum":
        return placed.groupBy("batch_id", "step").agg(*totals)
    by_time = placed.groupBy("batch_id", "step", "ts").agg(*totals)
    last = F.max_by(F.struct("n", "bytes"), "ts")
    return by_time.groupBy("batch_id", "step").agg(last.alias("v")).select("batch_id", "step", "v.n", "v.bytes")


def batch_series(messages: DataFrame, bounds: DataFrame, spec: StepSpec) -> DataFrame:
    """Dense series: ``batch_id, step, n, mean_size`` with 0 in empty steps.

    Axis and totals are stacked and summed, which takes one shuffle and needs no
    join.
    """
    zero = F.lit(0).cast("bigint")
    axis = dense_axis(bounds, spec).select("batch_id", "step", zero.alias("n"), zero.alias("bytes"))
    stacked = axis.unionByName(step_totals(messages, spec))
    return (
        stacked.groupBy("batch_id", "step")
        .agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
        .select(
            "batch_id",
            "step",
            F.col("n").cast("double").alias("n"),
            F.when(F.col("n") > 0, F.col("bytes") / F.col("n")).otherwise(F.lit(0.0)).alias("mean_size"),
        )
    )
