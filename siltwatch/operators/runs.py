"""Scores of a sparse series: runs of steps whose trailing windows hold the same values.

Only steps with messages are rows. A window changes where such a step enters it, stops
being the newest one, or leaves it; between these borders every step has the same
score, so a gap of any length is one row. All rows of a batch are bounded by its
messages (and those of the ``window`` steps before it), never by the time it spans.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltwatch.operators.ranking import keyed_offset
from siltwatch.operators.scorers import Frame, score_columns, steps_apart

TAIL = "array<struct<position:bigint,n:double,mean_size:double>>"


def expanded(df: DataFrame, count: str, name: str, piece: int = 4096) -> DataFrame:
    """One row per number from 0 to ``count`` - 1, without an array longer than a piece or the number of pieces."""
    last = F.col(count) - 1
    pieces = df.withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(last / piece))))
    inside = F.sequence(F.lit(0).cast("bigint"), F.least(last - F.col("_piece") * piece, F.lit(piece - 1)))
    return pieces.withColumn("_at", F.explode(inside)).withColumn(name, F.col("_piece") * piece + F.col("_at")).drop("_piece", "_at")


def spans(bounds: DataFrame, keys: Sequence[str], order: Sequence[str], slot, before: DataFrame | None = None) -> DataFrame:
    """First and last position of every batch in the whole series of its key.

    A key's batches are laid end to end, after the steps that ``before`` (keys, steps,
    tail) says have passed. Only batches are ordered, slot by slot.
    """
    out = keyed_offset(bounds, keys, slot, [F.col(c) for c in order], "n_steps", "_start")
    start = F.col("_start")
    if before is not None:
        out = out.join(before.select(*keys, F.col("steps").alias("_passed")), list(keys), "left")
        start = start + F.coalesce("_passed", F.lit(0))
    return out.select(*keys, "batch_id", (start + 1).alias("first"), (start + F.col("n_steps")).alias("last"))


def placed_points(totals: DataFrame, span: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Steps with messages (batch_id, step, n, bytes) at their positions."""
    joined = totals.join(span, "batch_id")
    return joined.select(
        *keys, "batch_id", "first", "last", (F.col("first") + F.col("step")).alias("position"),
        F.col("n").cast("double").alias("n"), F.coalesce(F.col("bytes") / F.col("n"), F.lit(0.0)).alias("mean_size"),
    )


def _earlier(points: DataFrame, span: DataFrame, keys: Sequence[str], window: int) -> DataFrame:
    """For every batch the points before it that its first windows still hold.

    Points and batches meet in slots as wide as a window; a slot has at most
    ``window`` of either.
    """
    position = F.col("position")
    slots = F.array_distinct(F.array(F.floor(position / window), F.floor((position + window - 1) / window)))
    reach = points.select(*keys, "position", "n", "mean_size", F.explode(slots).alias("_slot"))
    later = span.withColumn("_slot", F.floor(F.col("first") / window))
    met = reach.join(later, [*keys, "_slot"])
    return met.where((position < F.col("first")) & (F.col("first") < position + window)).drop("_slot")


def scored_runs(
    points: DataFrame,
    span: DataFrame,
    keys: Sequence[str],
    mode: str = "univariate",
    models: Sequence[str] = ("ZScoreDetector",),
    ensemble_model: str | None = None,
    window: int = 50,
    before: DataFrame | None = None,
    **ensemble_args,
) -> DataFrame:
    """Runs of every batch: keys, batch_id, position, length, step, n, mean_size, score.

    ``points`` and ``span`` come from :func:`placed_points` and :func:`spans`;
    ``before`` carries the last points of earlier micro-batches.
    """
    columns = [*keys, "batch_id", "first", "last", "position", "n", "mean_size"]
    held = points.select(*keys, "position", "n", "mean_size")
    if before is not None:
        old = before.select(*keys, F.explode("tail").alias("p")).select(*keys, "p.position", "p.n", "p.mean_size")
        held = held.unionByName(old)
    rows = points.select(*columns).unionByName(_earlier(held, span, keys, window).select(*columns))

    position, own = F.col("position"), F.col("position") >= F.col("first")
    leaves = position + window
    if any(steps_apart(m) for m in models):
        borders = F.sequence(F.greatest(position, F.col("first")), F.least(leaves, F.col("last") + 1))
    else:
        borders = F.array_compact(F.array(F.when(own, position + 1), leaves))
    nothing = F.lit(None).cast("double")
    inside = (F.col("border") >= F.col("first")) & (F.col("border") <= F.col("last"))
    edges = rows.select(*columns, F.explode(borders).alias("border")).where(inside).select(
        *keys, "batch_id", "first", "last", F.col("border").alias("position"), nothing.alias("n"), nothing.alias("mean_size")
    )
    starts = F.array_distinct(F.array(F.col("first"), F.greatest(F.col("first"), F.least(F.col("last"), F.lit(window)))))
    opens = span.select(*keys, "batch_id", "first", "last", F.explode(starts).alias("position")).withColumns(
        {"n": nothing, "mean_size": nothing}
    )
    stacked = rows.unionByName(edges).unionByName(opens).repartition("batch_id")
    at = stacked.groupBy("batch_id", *keys, "first", "last", "position").agg(F.max("n").alias("n"), F.max("mean_size").alias("mean_size"))

    batch = Window.partitionBy("batch_id").orderBy("position")
    frame = Frame(window, batch.rangeBetween(-(window - 1), 0))
    score = score_columns(frame, mode, models, ensemble_model, **ensemble_args)
    until = F.coalesce(F.lead("position").over(batch), F.col("last") + 1)
    out = at.select("*", (until - position).alias("length"), *frame.columns())
    return out.where(own).select(
        *keys, "batch_id", "position", "length", (position - F.col("first")).alias("step"),
        F.coalesce("n", F.lit(0.0)).alias("n"), F.coalesce("mean_size", F.lit(0.0)).alias("mean_size"), score.alias("score"),
    )


def per_step(runs: DataFrame) -> DataFrame:
    """Every step of every run."""
    return expanded(runs, "length", "_k").withColumns(
        {"step": F.col("step") + F.col("_k"), "position": F.col("position") + F.col("_k")}
    ).drop("_k", "length")


def resumed_state(points: DataFrame, span: DataFrame, keys: Sequence[str], window: int, before: DataFrame | None = None) -> DataFrame:
    """State (keys, steps, tail) after these batches, for the keys they touch.

    ``tail`` holds the points of the last ``window`` - 1 steps, so a key's state never
    outgrows a window.
    """
    keep = window - 1
    ends = span.groupBy(*keys).agg(F.max("last").alias("steps"))
    held = points.select(*keys, "position", "n", "mean_size")
    if before is not None:
        old = before.select(*keys, F.explode("tail").alias("p")).select(*keys, "p.position", "p.n", "p.mean_size")
        held = held.unionByName(old)
    near = held.join(ends, list(keys)).where(F.col("position") > F.col("steps") - keep)
    tails = near.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("position", "n", "mean_size"))).alias("tail"))
    none = F.array().cast(TAIL)
    return ends.join(tails, list(keys), "left").withColumn("tail", F.coalesce("tail", none))
