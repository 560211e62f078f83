"""Alerts: building, shaping, enrichment and originating messages."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltwatch.operators.validation import uuid_or_null

STAGE = "alerting.alerter"

# Most entries of a compact warning.
MAX_DOMAINS = 50
MAX_LOGLINE_IDS = 100
MAX_SERVER_IDS = 100

# Alerter plugins: alerts -> alerts.
ALERTERS: dict[str, Callable[[DataFrame], DataFrame]] = {}


def alerter(name: str):
    def add(fn):
        ALERTERS[name] = fn
        return fn

    return add


@alerter("generic")
def unchanged(alerts: DataFrame) -> DataFrame:
    return alerts


def process_alerts(alerts: DataFrame, hooks: Sequence[str]) -> DataFrame:
    """Run the named hooks in order."""
    unknown = [h for h in hooks if h not in ALERTERS]
    if unknown:
        raise ValueError(f"alerters {unknown} are not registered")
    return reduce(lambda df, h: df.transform(ALERTERS[h]), hooks, alerts)


def _sorted_values(request: Column, name: str) -> Column:
    return F.array_sort(F.array_distinct(F.array_compact(F.transform(request, lambda m: m[name]))))


def warning_domains(request: Column) -> Column:
    """Sorted distinct domain names of a window."""
    return _sorted_values(request, "domain_name")


def flat_messages(nested: Column) -> Column:
    """Windows of windows as one list."""
    return F.flatten(nested)


def persisted_warning(name: str) -> Column:
    """Stored form of a warning, names and scores under every key readers use."""
    request = F.col("request")
    domains = warning_domains(request)
    detector_name = F.coalesce(F.nullif(F.col("name"), F.lit("")), F.lit(name))
    return F.struct(
        detector_name.alias("detector_name"),
        detector_name.alias("name"),
        F.col("probability").alias("score"),
        F.col("probability"),
        F.coalesce("predicted_class", F.lit("")).alias("predicted_class"),
        F.coalesce("attributes", F.array().cast("array<struct<attribute:string,probability:double>>")).alias("attributes"),
        domains.alias("domains"),
        domains.alias("domain_names"),
        _sorted_values(request, "logline_id").alias("logline_ids"),
        _sorted_values(request, "server_message_id").alias("server_message_ids"),
        F.size(request).cast("bigint").alias("request_count"),
        F.struct("name", "sha256", "probability", "predicted_class", "attributes").alias("raw_detector_output"),
        request,
        F.col("sha256"),
    )


def compact_warning() -> Column:
    """Forwarded form of a warning: no request, short lists, sorted before the cut."""
    request = F.col("request")
    return F.struct(
        "name",
        "sha256",
        "probability",
        "predicted_class",
        "attributes",
        F.size(request).cast("bigint").alias("request_count"),
        F.slice(_sorted_values(request, "domain_name"), 1, MAX_DOMAINS).alias("domain_names"),
        F.slice(_sorted_values(request, "logline_id"), 1, MAX_LOGLINE_IDS).alias("logline_ids"),
        F.slice(_sorted_values(request, "server_message_id"), 1, MAX_SERVER_IDS).alias("server_message_ids"),
    )


def build_alerts(warnings: DataFrame, detector_name: str, at: Column, warning: Column) -> DataFrame:
    """One alert per client batch that warned.

    Groups stay small: a client batch holds at most two batches of lines.
    """
    return warnings.withColumn("_w", warning).groupBy("suspicious_batch_id", "src_ip").agg(
        F.median("probability").alias("overall_score"),
        F.count(F.lit(1)).alias("n_warnings"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(warning_domains(F.col("request")))))).alias("domain_names"),
        F.array_distinct(F.flatten(F.collect_list(_sorted_values(F.col("request"), "server_message_id")))).alias(
            "server_message_ids"
        ),
        F.collect_list("_w").alias("result"),
    ).withColumns({"alert_timestamp": at, "detector_name": F.lit(detector_name)})


def stored_alerts(alerts: DataFrame) -> DataFrame:
    """Row form of the alerts table: lists as JSON text."""
    return alerts.select(
        "src_ip",
        "alert_timestamp",
        "suspicious_batch_id",
        "overall_score",
        F.to_json("domain_names").alias("domain_names"),
        F.to_json("result").alias("result"),
    )


def originating_ids(alerts: DataFrame, ids: str = "server_message_ids") -> DataFrame:
    """Distinct valid message ids an alert goes back to; other ids are ignored."""
    valid = F.array_distinct(F.array_compact(F.transform(ids, uuid_or_null)))
    return alerts.withColumn("originating_ids", valid)


def processed_events(alerts: DataFrame, at: Column) -> DataFrame:
    """Terminal event ``processed`` per originating message of each alert."""
    return originating_ids(alerts).select(
        F.explode("originating_ids").alias("message_id"),
        F.lit(STAGE).alias("stage"),
        F.lit("processed").alias("status"),
        at.alias("timestamp"),
    )
