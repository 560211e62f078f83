"""Exact quantiles of groups of any size.

Equal values are counted first. A group with few distinct values is read off one small
buffer. A larger one is cut into slots by a sketch of its values; counts per slot tell
which slot holds a wanted rank, and only that slot is ordered. So no task holds a
group, and the sketch decides where to look, never what is found.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltwatch.sources.staging import staged

LIMIT = 20_000
"""Distinct values of a group that one buffer may hold."""
SLOTS = 256


def value_counts(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, v, f): how often each value occurs; nulls leave."""
    return rows.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("f"))


def borders(points: DataFrame, keys: Sequence[str], slots: int) -> DataFrame:
    """(keys, cuts): about equally full slots of the distinct values of each group."""
    shares = F.array(*[F.lit(k / slots) for k in range(1, slots)])
    return points.groupBy(*keys).agg(F.array_distinct(F.percentile_approx("v", shares, 10_000)).alias("cuts"))


def slot_of(value: Column, cuts: Column) -> Column:
    """Number of borders that a value has passed, by halving the list."""
    low, high = F.lit(0), F.size(cuts)
    state = F.struct(low.alias("low"), high.alias("high"))

    def halve(s: Column, _: Column) -> Column:
        middle = F.floor((s["low"] + s["high"]) / 2).cast("int")
        passed = F.get(cuts, middle) < value
        go = s["low"] < s["high"]
        return F.struct(
            F.when(go & passed, middle + 1).otherwise(s["low"]).alias("low"),
            F.when(go & ~passed, middle).otherwise(s["high"]).alias("high"),
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(9)), state, halve, lambda s: s["low"])


def _selected(points: DataFrame, sizes: DataFrame, keys: Sequence[str], qs: Sequence[float]) -> DataFrame:
    """(keys, q): quantiles of large groups by selection."""
    keys = list(keys)
    own = points.join(sizes.select(*keys), keys)
    slotted = own.join(borders(own, keys, SLOTS), keys).select(*keys, "v", "f", slot_of(F.col("v"), F.col("cuts")).alias("_slot"))
    slotted = staged(slotted, "slotted-values")
    before = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = slotted.groupBy(*keys, "_slot").agg(F.sum("f").alias("_held"))
    starts = starts.withColumn("_start", F.coalesce(F.sum("_held").over(before), F.lit(0)))
    place = lambda q: F.lit(float(q)) * (F.col("n") - 1)
    wanted = [
        F.struct(F.lit(k).alias("_k"), F.lit(up).alias("_up"), place(q).alias("_at"), (F.ceil(place(q)) if up else F.floor(place(q))).alias("_rank"))
        for k, q in enumerate(qs)
        for up in (False, True)
    ]
    wanted = sizes.select(*keys, F.explode(F.array(*wanted)).alias("w")).select(*keys, "w.*")
    inside = (F.col("_rank") >= F.col("_start")) & (F.col("_rank") < F.col("_start") + F.col("_held"))
    wanted = staged(wanted.join(starts, keys).where(inside).select(*keys, "_slot", "_start", "_k", "_up", "_at", "_rank"), "wanted-ranks")
    held = slotted.join(wanted.select(*keys, "_slot").distinct(), [*keys, "_slot"])
    upto = F.sum("f").over(Window.partitionBy(*keys, "_slot").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    ranked = held.withColumn("_upto", upto)
    rank = F.col("_rank") - F.col("_start")
    found = wanted.join(ranked, [*keys, "_slot"]).where((rank < F.col("_upto")) & (rank >= F.col("_upto") - F.col("f")))
    ends = found.groupBy(*keys, "_k", "_at").agg(
        F.max(F.when(~F.col("_up"), F.col("v"))).alias("_low"), F.max(F.when(F.col("_up"), F.col("v"))).alias("_high")
    )
    low, high, at = F.col("_low"), F.col("_high"), F.col("_at")
    between = F.when(low == high, low).otherwise((F.ceil(at) - at) * low + (at - F.floor(at)) * high)
    listed = ends.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_k", between.alias("v")))).alias("q"))
    return listed.select(*keys, F.transform("q", lambda e: e["v"]).alias("q"))


def described(rows: DataFrame, keys: Sequence[str], value: str, qs: Sequence[float], limit: int = LIMIT) -> DataFrame:
    """(keys, n, low, mean, high, q): counts, extremes, mean and exact quantiles of each group.

    Quantiles between two values are interpolated. Groups without a value leave; a null
    in a key is a group like others.
    """
    own = rows.select(F.struct(*keys).alias("_key"), value)  # one column, in which nulls are equal
    points = staged(value_counts(own, ["_key"], value), "value-counts")
    sizes = staged(
        points.groupBy("_key").agg(
            F.sum("f").alias("n"), F.count(F.lit(1)).alias("m"), F.min("v").alias("low"), F.max("v").alias("high"),
            (F.sum(F.col("v") * F.col("f")) / F.sum("f")).alias("mean"),
        ),
        "group-sizes",
    )
    cuts = F.array(*[F.lit(float(q)) for q in qs])
    large = sizes.where(F.col("m") > limit)
    small = points
    some = not large.isEmpty()
    if some:
        small = points.join(large.select("_key"), "_key", "left_anti")
    found = small.groupBy("_key").agg(F.percentile("v", cuts, F.col("f")).alias("q"))
    if some:
        found = found.unionByName(_selected(points, large, ["_key"], qs))
    return sizes.join(found, "_key").select("_key.*", "n", "low", "mean", "high", "q")
