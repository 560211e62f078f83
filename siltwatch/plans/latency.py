"""Latency of the pipeline's own stages: states, values, snapshots and views."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltwatch.plans.quantiles import described
from siltwatch.plans.rollups import TIERS, Tier, age_between, bucket, tiered, with_tier_buckets

# Statuses that end a stage, per kind of entity.
LINE_ENDS = ("finished", "batched", "filtered_out", "detected")
BATCH_ENDS = ("finished", "completed", "batched", "filtered_out")
SUSPICIOUS_ENDS = ("finished", "completed", "filtered_out", "detected")

# Hops between stages: name, parent (stage, status), child (stage, status).
HOPS = (
    ("transport.batch_handler_to_prefilter", "log_collection.batch_handler", "completed", "log_filtering.prefilter", "in_process"),
    ("transport.prefilter_to_inspector", "log_filtering.prefilter", "finished", "data_inspection.inspector", "in_process"),
    ("transport.inspector_to_detector", "data_inspection.inspector", "finished", "data_analysis.detector", "in_process"),
)
# Id and instance of rows that stand for a whole bucket.
NIL_ID = "00000000-0000-0000-0000-000000000000"
ROLLED_UP = "historical_rollup"

# Look-back of a snapshot per resolution, in hours.
LOOK_BACK = {"1m": 2, "15m": 6, "1h": 12}
# The finest tier leaves the last day to exact values.
LATENCY_TIERS = (Tier("1m", 1, 1, 7), *TIERS[1:])


def micros_between(start: str | Column, end: str | Column) -> Column:
    return F.unix_micros(end) - F.unix_micros(start)


def stage_states(events: DataFrame, keys: Sequence[str], ends: Sequence[str], inactive_ends: bool) -> DataFrame:
    """Start and end per day and entity: mergeable, null where not seen yet."""
    is_end = F.col("status").isin(*ends)
    if inactive_ends:
        is_end = is_end | ~F.col("is_active")
    ts = F.col("timestamp")
    return events.groupBy(F.to_date(ts).alias("event_date"), *keys).agg(
        F.min(F.when(F.col("status") == "in_process", ts)).alias("start_timestamp"),
        F.max(F.when(is_end, ts)).alias("end_timestamp"),
    )


def logline_states(events: DataFrame) -> DataFrame:
    return stage_states(events, ("stage", "logline_id"), LINE_ENDS, False)


def batch_states(events: DataFrame) -> DataFrame:
    return stage_states(events, ("stage", "instance_name", "batch_id"), BATCH_ENDS, True)


def suspicious_states(events: DataFrame) -> DataFrame:
    return stage_states(events, ("stage", "instance_name", "suspicious_batch_id"), SUSPICIOUS_ENDS, True)


def server_log_states(logs: DataFrame, log_times: DataFrame) -> DataFrame:
    """Start and end per day and message from the two sides of a server log.

    The side that knows no start or end leaves it null, so that it never wins
    the merge.
    """
    no_time = F.lit(None).cast("timestamp")
    starts = logs.select(F.to_date("timestamp_in").alias("event_date"), "message_id", F.col("timestamp_in").alias("s"), no_time.alias("e"))
    out = F.when(F.col("event") == "timestamp_out", F.col("event_timestamp"))
    ends = log_times.select(F.to_date("event_timestamp").alias("event_date"), "message_id", no_time.alias("s"), out.alias("e"))
    return starts.unionByName(ends).groupBy("event_date", "message_id").agg(
        F.min("s").alias("start_timestamp"), F.max("e").alias("end_timestamp")
    )


def stage_latencies(states: DataFrame) -> DataFrame:
    """Completed entities: states of all days merged, end after start.

    Aggregating before subtracting lets start and end come from different days
    or writes.
    """
    keys = [c for c in states.columns if c not in ("event_date", "start_timestamp", "end_timestamp")]
    merged = states.groupBy(*keys).agg(
        F.min("event_date").alias("event_date"),
        F.min("start_timestamp").alias("start_timestamp"),
        F.max("end_timestamp").alias("end_timestamp"),
    )
    return merged.filter(
        (F.col("start_timestamp") > F.timestamp_seconds(F.lit(0))) & (F.col("end_timestamp") > F.col("start_timestamp"))
    ).withColumn("latency_us", micros_between("start_timestamp", "end_timestamp"))


def server_log_latencies(logs: DataFrame, log_times: DataFrame) -> DataFrame:
    """In and out of the log server per message."""
    outs = log_times.filter("event = 'timestamp_out'").select("message_id", F.col("event_timestamp").alias("end_timestamp"))
    starts = logs.select("message_id", F.col("timestamp_in").alias("start_timestamp"))
    return (
        starts.join(outs, "message_id")
        .filter(F.col("end_timestamp") > F.col("start_timestamp"))
        .select(
            "message_id",
            F.to_date("end_timestamp").alias("event_date"),
            "start_timestamp",
            "end_timestamp",
            micros_between("start_timestamp", "end_timestamp").alias("latency_us"),
        )
    )


def roundtrip_latencies(logs: DataFrame, mapping: DataFrame, line_events: DataFrame, terminal: DataFrame) -> DataFrame:
    """First arrival to last terminal event per message.

    Line events are reduced to one row per line before they meet the mapping.
    """
    last_of_line = line_events.filter(~F.col("is_active")).groupBy("logline_id").agg(F.max("timestamp").alias("t"))
    mapped = mapping.select("message_id", "logline_id").join(last_of_line, "logline_id").select("message_id", "t")
    ends = (
        mapped.unionByName(terminal.select("message_id", F.col("timestamp").alias("t")))
        .groupBy("message_id")
        .agg(F.max("t").alias("end_timestamp"))
    )
    starts = logs.groupBy("message_id").agg(F.min("timestamp_in").alias("start_timestamp"))
    return (
        starts.join(ends, "message_id")
        .filter(F.col("end_timestamp") > F.col("start_timestamp"))
        .select(
            "message_id",
            F.to_date("end_timestamp").alias("event_date"),
            "start_timestamp",
            "end_timestamp",
            micros_between("start_timestamp", "end_timestamp").alias("latency_us"),
        )
    )


def transport_latencies(tree: DataFrame) -> DataFrame:
    """Time between a parent row and its child, for the three hops.

    Both sides are labelled with their hop first, so one equi-join on (row, hop)
    serves all three.
    """

    def hop(stage: int, status: int) -> Column:
        cases = [F.when((F.col("stage") == h[stage]) & (F.col("status") == h[status]), F.lit(h[0])) for h in HOPS]
        return F.coalesce(*cases)

    parents = tree.select(F.col("batch_row_id").alias("row"), hop(1, 2).alias("stage"), F.col("timestamp").alias("t1")).filter(
        F.col("stage").isNotNull()
    )
    children = tree.select(
        F.col("parent_batch_row_id").alias("row"), hop(3, 4).alias("stage"), F.col("timestamp").alias("t2")
    ).filter(F.col("stage").isNotNull())
    return (
        parents.join(children, ["row", "stage"])
        .filter(F.col("t2") > F.col("t1"))
        .select("stage", F.col("t2").alias("end_timestamp"), micros_between("t1", "t2").alias("latency_us"))
    )


def latency_values(parts: Mapping[str, DataFrame]) -> DataFrame:
    """All families as (family, stage, end_timestamp, latency_us)."""
    fixed = {"server_log": "log_storage.logserver", "roundtrip": "pipeline.roundtrip"}

    def one(family: str, df: DataFrame) -> DataFrame:
        stage = F.lit(fixed[family]) if family in fixed else F.col("stage")
        return df.select(
            F.lit(family).alias("family"), stage.alias("stage"), "end_timestamp", F.col("latency_us").cast("double").alias("latency_us")
        )

    return reduce(lambda a, b: a.unionByName(b), [one(f, df) for f, df in parts.items()])


def _statistics(values: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts, extremes, mean and exact quantiles; one hot stage's values never sit in one task."""
    found = described(values, keys, "latency_us", (0.5, 0.95, 0.99))
    return found.select(
        *[k for k in keys if k != "tier"],
        F.col("n").alias("sample_count"),
        F.col("low").alias("min_latency_us"),
        F.col("mean").alias("avg_latency_us"),
        F.col("q")[0].alias("p50_latency_us"),
        F.col("q")[1].alias("p95_latency_us"),
        F.col("q")[2].alias("p99_latency_us"),
        F.col("high").alias("max_latency_us"),
    )


def latency_snapshot(values: DataFrame, resolution: str, as_of: dt.datetime, look_back: dt.timedelta | None = None) -> DataFrame:
    """Statistics of the closed buckets of a resolution.

    ``look_back`` limits a regular refresh; without it the whole history is
    computed.
    """
    minutes = next(t.minutes for t in TIERS if t.name == resolution)
    closed = values.filter(F.col("end_timestamp") < bucket(F.lit(as_of), minutes))
    if look_back is not None:
        closed = closed.filter(F.col("end_timestamp") >= F.lit(as_of - look_back))
    placed = closed.withColumn("time_bucket", bucket("end_timestamp", minutes))
    return _statistics(placed, ("time_bucket", "family", "stage")).withColumn("snapshot_version", F.lit(as_of))


def newest_version(snapshots: DataFrame) -> DataFrame:
    """Newest snapshot of each bucket, family and stage."""
    keys = ("family", "stage", "time_bucket")
    rest = [c for c in snapshots.columns if c not in keys]
    best = F.max_by(F.struct(*rest), "snapshot_version").alias("_v")
    return snapshots.groupBy(*keys).agg(best).select(*keys, "_v.*").select(*snapshots.columns)


def latency_history(snapshots: Mapping[str, DataFrame], as_of: dt.datetime) -> DataFrame:
    """Tiered snapshots without their version."""
    return tiered({n: newest_version(df) for n, df in snapshots.items()}, as_of, LATENCY_TIERS).drop("snapshot_version")


def latency_history_from_values(values: DataFrame, as_of: dt.datetime) -> DataFrame:
    """The tiered history straight from values, for a first fill without snapshots."""
    placed = with_tier_buckets(values, "end_timestamp", as_of, LATENCY_TIERS)
    return _statistics(placed, ("tier", "time_bucket", "family", "stage"))


def recent_and_typical(values: DataFrame, history: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Exact values of the last day, then each older bucket's median."""
    recent = values.filter(age_between("end_timestamp", as_of, 0, 1))
    older = history.select("family", "stage", F.col("time_bucket").alias("end_timestamp"), F.col("p50_latency_us").alias("latency_us"))
    return recent.unionByName(older)


def family_view(family: str, recent: DataFrame, history: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Per-entity rows of the last day, then one stand-in row per older bucket.

    ``recent`` decides the columns; stand-in rows fill them with the nil id, the
    roll-up instance and the bucket's times.
    """
    stand_in = {
        "event_date": F.to_date("time_bucket"),
        "start_timestamp": F.col("time_bucket"),
        "end_timestamp": F.col("time_bucket"),
        "latency_us": F.col("p50_latency_us"),
        "stage": F.col("stage"),
        "instance_name": F.lit(ROLLED_UP),
    }
    recent = recent.withColumn("latency_us", F.col("latency_us").cast("double"))
    for c in recent.columns:
        if c.endswith("_id"):
            recent = recent.withColumn(c, F.col(c).cast("string"))
    older = history.filter(F.col("family") == family).select(
        *[stand_in.get(c, F.lit(NIL_ID)).alias(c) for c in recent.columns]
    )
    return recent.filter(age_between("end_timestamp", as_of, 0, 1)).unionByName(older)

