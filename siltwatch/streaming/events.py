"""Rows of the monitoring tables that each stage of a micro-batch leaves.

Every function takes the written tables of the micro-batch and the times its stages
noted, and returns (table, rows) pairs for one write. Ids of batch rows are digests, so
a replay gives the same tree. A batch row's parent is the row that sent it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltwatch.operators.alerts import processed_events, stored_alerts
from siltwatch.operators.detection import detector_events
from siltwatch.operators.inspection import batch_links
from siltwatch.operators.validation import failed_lines, failed_terminal_events
from siltwatch.sources.event_log import Part
from siltwatch.streaming.sources import uuid_of

COLLECTOR = "log_collection.collector"
BATCHER = "log_collection.batch_handler"
PREFILTER = "log_filtering.prefilter"
INSPECTOR = "data_inspection.inspector"
DETECTOR = "data_analysis.detector"
Time = dt.datetime


def _row(owner: str | Column, stage: str, side: str) -> Column:
    return uuid_of(F.concat_ws("|", owner, F.lit(stage), F.lit(side)))


def _line_events(lines: DataFrame, stage: str, status: str, at: Time | Column, active: bool) -> Part:
    rows = lines.select(
        F.col("logline_id").cast("string").alias("logline_id"), F.lit(stage).alias("stage"), F.lit(status).alias("status"),
        (at if isinstance(at, Column) else F.lit(at)).alias("timestamp"), F.lit(active).alias("is_active"),
    )
    return "logline_timestamps", rows


def _batch_events(counts: DataFrame, instance: str, stage: str, status: str, at: Time, active: bool) -> Part:
    rows = counts.select(
        "batch_id", F.lit(instance).alias("instance_name"), F.lit(stage).alias("stage"), F.lit(status).alias("status"),
        F.lit(at).alias("timestamp"), "message_count", F.lit(active).alias("is_active"),
    )
    return "batch_timestamps", rows


def _tree(batches: DataFrame, row: Column, parent: Column, instance: str, stage: str, status: str, at: Time, key: str = "batch_id") -> Part:
    rows = batches.select(
        row.alias("batch_row_id"), F.col(key).alias("batch_id"), parent.alias("parent_batch_row_id"),
        F.lit(instance).alias("instance_name"), F.lit(stage).alias("stage"), F.lit(status).alias("status"), F.lit(at).alias("timestamp"),
    )
    return "batch_tree", rows


def _fill(df: DataFrame, stage: str, kind: str, at: Time, count: Column | None = None) -> Part:
    counted = df.agg((F.count(F.lit(1)) if count is None else F.coalesce(F.sum(count), F.lit(0))).alias("entry_count"))
    rows = counted.select(F.lit(at).alias("timestamp"), F.lit(stage).alias("stage"), F.lit(kind).alias("entry_type"), "entry_count")
    return "fill_levels", rows


def collected(parsed: DataFrame, valid: DataFrame, at: Time) -> list[Part]:
    """Arrival, validation and naming of lines."""
    failed = failed_lines(parsed)
    dead = failed.select("message_text", "timestamp_in", F.lit(at).alias("timestamp_failed"), "reason_for_failure")
    logs = parsed.select("message_id", "timestamp_in", F.col("raw").alias("message_text"))
    outs = parsed.select("message_id", F.lit("timestamp_out").alias("event"), F.lit(at).alias("event_timestamp"))
    named = valid.select("logline_id", F.col("ts").alias("timestamp"), "subnet_id", "src_ip", "additional_fields")
    return [
        ("server_logs", logs),
        ("server_logs_timestamps", outs),
        ("failed_loglines", dead),
        ("server_log_terminal_events", failed_terminal_events(failed, "message_id", F.lit(at))),
        ("loglines", named),
        ("server_log_to_logline", valid.select("message_id", "logline_id", F.lit(at).alias("timestamp"))),
        _line_events(valid, COLLECTOR, "in_process", F.col("timestamp_in"), True),
        _line_events(valid, COLLECTOR, "finished", at, True),
    ]


def batched(sent: DataFrame, counts: DataFrame, instance: str, begin: Time, at: Time) -> list[Part]:
    """Batches as they are opened and sent; ``counts`` has batch_id, n_new, n_all and n_kept."""
    own = counts.withColumn("message_count", F.col("n_new"))
    lines = sent.where(~F.col("is_buffer"))
    return [
        ("logline_to_batches", lines.select(F.lit(begin).alias("timestamp"), F.col("logline_id").cast("string").alias("logline_id"), "batch_id")),
        _batch_events(own, instance, BATCHER, "waiting", begin, True),
        _batch_events(own, instance, BATCHER, "completed", at, True),
        _tree(counts, _row("batch_id", BATCHER, "out"), F.lit(""), instance, BATCHER, "completed", at),
        _fill(counts, BATCHER, "total_loglines_in_batches", begin, F.col("n_new")),
        _fill(counts, BATCHER, "total_loglines_in_buffer", begin, F.col("n_all") - F.col("n_new")),
        _fill(counts.limit(0), BATCHER, "total_loglines_in_batches", at),
    ]


def filtered(sent: DataFrame, dropped: DataFrame, counts: DataFrame, instance: str, begin: Time, at: Time) -> list[Part]:
    """Batches in and out of the rule filter, and the lines it dropped."""
    entered = counts.withColumn("message_count", F.col("n_all"))
    left = counts.where("n_kept > 0").withColumn("message_count", F.col("n_kept"))
    parent = _row("batch_id", BATCHER, "out")
    return [
        _batch_events(entered, instance, PREFILTER, "in_process", begin, True),
        _batch_events(left, instance, PREFILTER, "finished", at, True),
        _tree(counts, _row("batch_id", PREFILTER, "in"), parent, instance, PREFILTER, "in_process", begin),
        _tree(left, _row("batch_id", PREFILTER, "out"), parent, instance, PREFILTER, "finished", at),
        _line_events(dropped, PREFILTER, "filtered_out", at, False),
        _fill(counts, PREFILTER, "total_loglines", begin, F.col("n_all")),
        _fill(counts, PREFILTER, "total_loglines", at, F.col("n_kept")),
    ]


def inspected(
    messages: DataFrame, verdicts: DataFrame, clients: DataFrame, lines: DataFrame, counts: DataFrame, instance: str, begin: Time, at: Time
) -> list[Part]:
    """Verdicts: client batches that go on, batches and lines that do not."""
    came = counts.where("n_kept > 0").withColumn("message_count", F.col("n_kept"))
    fine = came.join(verdicts.where(~F.col("is_suspicious")).select("batch_id"), "batch_id", "left_semi")
    gone = messages.join(fine.select("batch_id"), "batch_id", "left_semi").select("batch_id", "logline_id").distinct()
    parent, row = _row("batch_id", PREFILTER, "out"), _row("batch_id", INSPECTOR, "out")
    links = batch_links(lines).select(F.lit(at).alias("timestamp"), "suspicious_batch_id", "batch_id")
    return [
        _batch_events(came, instance, INSPECTOR, "in_process", begin, True),
        _tree(came, _row("batch_id", INSPECTOR, "in"), parent, instance, INSPECTOR, "in_process", begin),
        _batch_events(fine, instance, INSPECTOR, "filtered_out", at, False),
        _line_events(gone, INSPECTOR, "filtered_out", at, False),
        _tree(fine, row, parent, instance, INSPECTOR, "finished", at),
        ("suspicious_batches_to_batch", links),
        _client_events(clients, instance, INSPECTOR, "finished", at, True),
        _tree(clients, row, parent, instance, INSPECTOR, "finished", at, "suspicious_batch_id"),
        _fill(came, INSPECTOR, "total_loglines", begin, F.col("message_count")),
        _fill(came.limit(0), INSPECTOR, "total_loglines", at),
    ]


def _client_events(clients: DataFrame, instance: str, stage: str, status: str, at: Time, active: bool) -> Part:
    rows = clients.select(
        "suspicious_batch_id", "src_ip", F.lit(instance).alias("instance_name"), F.lit(stage).alias("stage"), F.lit(status).alias("status"),
        F.lit(at).alias("timestamp"), "message_count", F.lit(active).alias("is_active"),
    )
    return "suspicious_batch_timestamps", rows


def detected(lines: DataFrame, clients: DataFrame, warnings: DataFrame, name: str, begin: Time, at: Time) -> list[Part]:
    """What a detector that reads client batches makes of them."""
    of_lines, of_batches = detector_events(lines, warnings, name)
    owner = F.concat_ws("|", "suspicious_batch_id", F.lit(name))
    parent = _row("batch_id", INSPECTOR, "out")
    key = "suspicious_batch_id"
    return [
        _client_events(clients, name, DETECTOR, "in_process", begin, True),
        _tree(clients, _row(owner, DETECTOR, "in"), parent, name, DETECTOR, "in_process", begin, key),
        ("suspicious_batch_timestamps", of_batches.withColumn("timestamp", F.lit(at))),
        ("logline_timestamps", of_lines.drop(key).withColumn("timestamp", F.lit(at))),
        _tree(clients, _row(owner, DETECTOR, "out"), parent, name, DETECTOR, "finished", at, key),
        _fill(clients, DETECTOR, "total_loglines", begin, F.col("message_count")),
        _fill(clients.limit(0), DETECTOR, "total_loglines", at),
    ]


def chained(upstream: DataFrame, source: str, name: str, begin: Time, at: Time) -> list[Part]:
    """What a detector that reads another one's windows makes of them."""
    batches = upstream.groupBy("suspicious_batch_id", "src_ip").agg(F.sum(F.size("request")).alias("message_count"))
    parent = _row(F.concat_ws("|", "suspicious_batch_id", F.lit(source)), DETECTOR, "out")
    owner, key = F.concat_ws("|", "suspicious_batch_id", F.lit(source), F.lit(name)), "suspicious_batch_id"
    return [
        _client_events(batches, name, DETECTOR, "in_process", begin, True),
        _tree(batches, _row(owner, DETECTOR, "in"), parent, name, DETECTOR, "in_process", begin, key),
        _client_events(batches, name, DETECTOR, "finished", at, False),
        _tree(batches, _row(owner, DETECTOR, "out"), parent, name, DETECTOR, "finished", at, key),
    ]


def alerted(alerts: DataFrame, at: Time) -> list[Part]:
    """Alerts, and the messages they go back to."""
    stored = stored_alerts(alerts).withColumn("overall_score", F.col("overall_score").cast("float"))
    return [("alerts", stored), ("server_log_terminal_events", processed_events(alerts, F.lit(at)).distinct())]
