"""Rule filter of batched lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltwatch.functions.rules import LogFormat, relevance_predicate


def keep_relevant(df: DataFrame, method: str, fmt: LogFormat) -> DataFrame:
    """Rows that pass the named relevance method; empty batches vanish."""
    return df.filter(relevance_predicate(method, fmt))


def filtered_out_events(df: DataFrame, method: str, fmt: LogFormat, at: Column) -> DataFrame:
    """One ``filtered_out`` event per dropped line."""
    return df.filter(~relevance_predicate(method, fmt)).select(
        F.col("logline_id").cast("string").alias("logline_id"),
        F.lit("log_filtering.prefilter").alias("stage"),
        F.lit("filtered_out").alias("status"),
        at.alias("timestamp"),
        F.lit(False).alias("is_active"),
    )


def batch_status_events(df: DataFrame, predicate: Column, instance: str, keys: Sequence[str] = ("batch_id",)) -> DataFrame:
    """``in_process`` count per batch, and ``finished`` count if anything was kept."""
    counts = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_in"), F.count_if(predicate).alias("n_out")
    )
    started = F.struct(F.lit("in_process").alias("status"), F.col("n_in").alias("message_count"))
    sent = F.struct(F.lit("finished").alias("status"), F.col("n_out").alias("message_count"))
    events = F.array_compact(F.array(started, F.when(F.col("n_out") > 0, sent)))
    return counts.select(
        *keys,
        F.lit(instance).alias("instance_name"),
        F.lit("log_filtering.prefilter").alias("stage"),
        F.explode(events).alias("e"),
    ).select(*keys, "instance_name", "stage", "e.status", "e.message_count", F.lit(True).alias("is_active"))
