"""Suspicious batches and their split per client."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STAGE = "data_inspection.inspector"

# Inspector plugins: (messages, bounds, settings) -> batch_id + is_suspicious.
INSPECTORS: dict[str, Callable[..., DataFrame]] = {}


def inspector(name: str):
    def add(fn):
        INSPECTORS[name] = fn
        return fn

    return add


def batch_verdicts(scored: DataFrame, score_threshold: float = 0.5, anomaly_threshold: float = 0.1) -> DataFrame:
    """``is_suspicious`` per batch: share of anomalous steps above the threshold.

    Rows are steps, or runs of steps if they have a ``length``.
    """
    steps = F.col("length") if "length" in scored.columns else F.lit(1).cast("bigint")
    anomalous = F.when(F.coalesce("score", F.lit(0.0)) >= score_threshold, steps).otherwise(F.lit(0))
    return scored.groupBy("batch_id").agg(
        F.sum(steps).alias("n_steps"), F.sum(anomalous).cast("bigint").alias("n_anomalies")
    ).withColumn("is_suspicious", F.col("n_anomalies") / F.col("n_steps") > anomaly_threshold)


@inspector("NoInspector")
def all_suspicious(messages: DataFrame, bounds: DataFrame, **_) -> DataFrame:
    """Every batch goes on."""
    return bounds.select("batch_id", F.lit(True).alias("is_suspicious"))


def client_batch_id() -> Column:
    """Id of a client's part of a batch, stable across replays."""
    return F.sha2(F.concat_ws("|", "batch_id", "src_ip"), 256)


def suspicious_lines(messages: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Messages of suspicious batches with the id of their client batch."""
    keep = verdicts.filter("is_suspicious").select("batch_id")
    return messages.join(keep, "batch_id", "left_semi").withColumn("suspicious_batch_id", client_batch_id())


def client_batches(lines: DataFrame) -> DataFrame:
    """One row per suspicious batch and client; begin and end are the batch's."""
    return lines.groupBy("batch_id", "src_ip", "suspicious_batch_id").agg(
        F.count(F.lit(1)).alias("message_count"),
        F.first("begin_ts").alias("begin_ts"),
        F.first("end_ts").alias("end_ts"),
    )


def batch_links(lines: DataFrame) -> DataFrame:
    """Lineage edges suspicious batch -> batch."""
    return lines.select("suspicious_batch_id", "batch_id").distinct()


def dropped_batch_events(verdicts: DataFrame) -> DataFrame:
    """``filtered_out`` event of each batch that was not suspicious."""
    return verdicts.filter(~F.col("is_suspicious")).select(
        "batch_id", F.lit(STAGE).alias("stage"), F.lit("filtered_out").alias("status"), F.lit(False).alias("is_active")
    )


def dropped_line_events(messages: DataFrame, verdicts: DataFrame) -> DataFrame:
    """One ``filtered_out`` event per distinct line and dropped batch."""
    gone = verdicts.filter(~F.col("is_suspicious")).select("batch_id")
    return messages.join(gone, "batch_id", "left_semi").select("batch_id", "logline_id").distinct().select(
        F.col("logline_id").cast("string").alias("logline_id"),
        "batch_id",
        F.lit(STAGE).alias("stage"),
        F.lit("filtered_out").alias("status"),
        F.lit(False).alias("is_active"),
    )
