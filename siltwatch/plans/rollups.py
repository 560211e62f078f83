"""Roll-ups of alerts and fill levels, and their tiered history."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltwatch.plans.quantiles import described


@dataclass(frozen=True)
class Tier:
    """A resolution and the age range (days) it answers for."""

    name: str
    minutes: int
    from_days: int
    to_days: int

    @property
    def kept(self) -> dt.timedelta:
        return dt.timedelta(days=self.to_days)


# Resolutions and days kept; ranges do not overlap.
TIERS = (Tier("1m", 1, 0, 7), Tier("15m", 15, 7, 30), Tier("1h", 60, 30, 90))


def bucket(ts: str | Column, minutes: int) -> Column:
    """Start of the fixed interval a time falls in; needs no shuffle by itself."""
    width = minutes * 60
    col = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_seconds(F.floor(F.unix_seconds(col) / width) * width)


def alert_rollup(alerts: DataFrame, minutes: int) -> DataFrame:
    """Alerts per bucket and client."""
    return alerts.groupBy(bucket("alert_timestamp", minutes).alias("time_bucket"), "src_ip").agg(
        F.count(F.lit(1)).alias("alert_count")
    )


def coarser_alerts(rollup: DataFrame, minutes: int) -> DataFrame:
    """A coarser roll-up from a finer one; counts add up."""
    return rollup.groupBy(bucket("time_bucket", minutes).alias("time_bucket"), "src_ip").agg(
        F.sum("alert_count").alias("alert_count")
    )


FILL_KEYS = ("time_bucket", "stage", "entry_type")


def fill_state(levels: DataFrame, minutes: int) -> DataFrame:
    """Mergeable state per bucket: min, max, sum, count and a quantile sketch."""
    c = F.col("entry_count")
    return levels.groupBy(bucket("timestamp", minutes).alias("time_bucket"), "stage", "entry_type").agg(
        F.min(c).alias("min_count"),
        F.max(c).alias("max_count"),
        F.sum(c).alias("sum_count"),
        F.count(c).alias("n"),
        F.expr("kll_sketch_agg_double(cast(entry_count AS double))").alias("sketch"),
    )


def merge_fill_states(states: DataFrame, minutes: int | None = None) -> DataFrame:
    """Merge states, into coarser buckets if ``minutes`` is given."""
    time = bucket("time_bucket", minutes).alias("time_bucket") if minutes else F.col("time_bucket")
    return states.groupBy(time, "stage", "entry_type").agg(
        F.min("min_count").alias("min_count"),
        F.max("max_count").alias("max_count"),
        F.sum("sum_count").alias("sum_count"),
        F.sum("n").alias("n"),
        F.expr("kll_merge_agg_double(sketch)").alias("sketch"),
    )


def finish_fill_states(states: DataFrame) -> DataFrame:
    """Readable columns of a state; the median is the sketch's."""
    return states.select(
        *FILL_KEYS,
        "min_count",
        (F.col("sum_count") / F.col("n")).alias("avg_count"),
        "max_count",
        F.expr("kll_sketch_get_quantile_double(sketch, 0.5D)").alias("median_count"),
    )


def fill_rollup(levels: DataFrame, minutes: int) -> DataFrame:
    """Exact min, average, max and median per bucket, stage and entry type."""
    return _fill_statistics(levels.withColumn("time_bucket", bucket("timestamp", minutes)), FILL_KEYS)


def _fill_statistics(levels: DataFrame, keys: Sequence[str]) -> DataFrame:
    kind = levels.schema["entry_count"].dataType
    return described(levels, keys, "entry_count", [0.5]).select(
        *keys,
        F.col("low").cast(kind).alias("min_count"),
        F.col("mean").alias("avg_count"),
        F.col("high").cast(kind).alias("max_count"),
        F.col("q")[0].alias("median_count"),
    )


def age_between(time: str, as_of: dt.datetime, from_days: int, to_days: int) -> Column:
    """Older than or exactly ``from_days`` (0: no limit), younger than ``to_days``."""
    low = F.col(time) >= F.lit(as_of - dt.timedelta(days=to_days))
    return low & (F.col(time) < F.lit(as_of - dt.timedelta(days=from_days))) if from_days else low


def tiered(tables: dict[str, DataFrame], as_of: dt.datetime, tiers: Sequence[Tier] = TIERS, time: str = "time_bucket") -> DataFrame:
    """Each tier's rows for its own age range, stacked."""
    parts = [tables[t.name].filter(age_between(time, as_of, t.from_days, t.to_days)) for t in tiers]
    return reduce(lambda a, b: a.unionByName(b), parts)


def with_tier_buckets(rows: DataFrame, time: str, as_of: dt.datetime, tiers: Sequence[Tier] = TIERS) -> DataFrame:
    """Raw rows with ``tier`` and ``time_bucket``, for a history straight from raw rows.

    A row counts in the tier whose age range holds its bucket; near a border
    that can be two tiers or none. One pass serves all tiers, and the oldest
    age still reaches the scan as a filter.
    """
    low = F.lit(as_of - dt.timedelta(days=max(t.to_days for t in tiers)))
    places = []
    for t in tiers:
        start = bucket(time, t.minutes)
        inside = (start >= F.lit(as_of - dt.timedelta(days=t.to_days)))
        if t.from_days:
            inside = inside & (start < F.lit(as_of - dt.timedelta(days=t.from_days)))
        places.append(F.when(inside, F.struct(F.lit(t.name).alias("tier"), start.alias("time_bucket"))))
    placed = rows.filter(F.col(time) >= low).withColumn("_t", F.explode(F.array_compact(F.array(*places))))
    return placed.select(*rows.columns, "_t.tier", "_t.time_bucket")


def alerts_history(alerts: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Tiered history of alerts, straight from raw alerts."""
    placed = with_tier_buckets(alerts.select("src_ip", "alert_timestamp"), "alert_timestamp", as_of)
    counted = placed.groupBy("tier", "time_bucket", "src_ip").agg(F.count(F.lit(1)).alias("alert_count"))
    return counted.drop("tier")


def fill_levels_history(levels: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Tiered history of fill levels with exact medians, straight from raw rows."""
    placed = with_tier_buckets(levels, "timestamp", as_of)
    return _fill_statistics(placed, ("tier", *FILL_KEYS)).drop("tier")


def fill_history_of_states(states: dict[str, DataFrame], as_of: dt.datetime) -> DataFrame:
    """Tiered history from stored states; a state may come in several parts, as increments leave it."""
    return tiered({name: finish_fill_states(merge_fill_states(rows)) for name, rows in states.items()}, as_of)


def backfill_rows(raw: DataFrame, target: DataFrame | None, time: str, as_of: dt.datetime, days: int) -> DataFrame | None:
    """Raw rows to fill an empty target with; none if it has rows already."""
    if target is not None and not target.isEmpty():
        return None
    return raw.filter(F.col(time) >= F.lit(as_of - dt.timedelta(days=days)))
