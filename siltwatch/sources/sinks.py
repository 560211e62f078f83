"""Sinks: monitoring tables, alert files and topics, batch envelopes."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwatch.plans.retention import drop_partitions, expired_partitions
from siltwatch.sources.schemas import RETENTION_DAYS, TABLES, conform, event_time

# Days of alert files kept when the setting cannot be read, and the fewest.
FALLBACK_DAYS = 7
FEWEST_DAYS = 1


def write_once(df: DataFrame, path: str, batch_id: int, partition_by: tuple[str, ...] = (), fmt: str = "parquet") -> None:
    """Write one micro-batch under its number; a replay replaces it.

    With a checkpointed query this gives each input offset exactly one result.
    """
    writer = df.write.mode("overwrite").format(fmt)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(f"{path}/stream_batch={batch_id}")


def append_events(df: DataFrame, table: str, root: str, batch_id: int, writer: str = "stream") -> None:
    """Append events to a monitoring table, laid out by month, writing stage and micro-batch.

    Only the stage's own partitions of the micro-batch are replaced: a replay
    writes the same rows again, and several stages can fill one table.
    """
    month = F.date_format(event_time(table), "yyyy-MM")
    rows = conform(df, table).withColumns({"month": month, "writer": F.lit(writer), "stream_batch": F.lit(batch_id)})
    out = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    out.partitionBy("month", "writer", "stream_batch").parquet(f"{root}/{table}")


def read_events(spark: SparkSession, table: str, root: str) -> DataFrame:
    return spark.read.schema(f"{TABLES[table]}, month string, writer string, stream_batch bigint").parquet(f"{root}/{table}")


def expire_table(spark: SparkSession, root: str, table: str, as_of: dt.datetime) -> int:
    """Drop months that ended before the table's time to live; returns how many.

    A month that is only partly expired stays; readers cut it with
    ``retention.kept_table_rows``.
    """
    before = (as_of - dt.timedelta(days=RETENTION_DAYS[table])).date()
    return drop_partitions(spark, expired_partitions(spark, f"{root}/{table}", "month", before))


def retention_days(setting) -> int | None:
    """Configured days: none keeps all, unreadable means a week, at least one day."""
    if setting is None:
        return None
    try:
        days = int(setting)
    except (TypeError, ValueError):
        return FALLBACK_DAYS
    return max(days, FEWEST_DAYS)


def write_alert_files(alerts: DataFrame, path: str, batch_id: int | None = None) -> None:
    """JSON lines, one folder per day of the alert.

    A stream names its micro-batch: the day then has a folder for it, which a
    replay replaces. Without one the files are added to the day.
    """
    rows = alerts.withColumn("alert_date", F.to_date("alert_timestamp"))
    if batch_id is None:
        rows.write.partitionBy("alert_date").mode("append").json(path)
    else:
        out = rows.withColumn("stream_batch", F.lit(batch_id)).write.mode("overwrite")
        out.option("partitionOverwriteMode", "dynamic").partitionBy("alert_date", "stream_batch").json(path)


def expire_alert_files(spark: SparkSession, path: str, setting, today: dt.date) -> int:
    """Drop alert days before ``today - (days - 1)``; returns how many."""
    days = retention_days(setting)
    if days is None:
        return 0
    return drop_partitions(spark, expired_partitions(spark, path, "alert_date", today - dt.timedelta(days=days - 1)))


def topic_rows(alerts: DataFrame, key: str = "src_ip") -> DataFrame:
    """Key and JSON value of each alert for a topic."""
    return alerts.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*alerts.columns)).alias("value"))


def topic_options(brokers: list[str], topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": ",".join(brokers), "topic": topic}


def write_topic(alerts: DataFrame, options: Mapping[str, str]) -> None:
    """Send alerts to a topic; needs the Kafka connector on the class path."""
    topic_rows(alerts).write.format("kafka").options(**options).save()


ENVELOPE = "batch_tree_row_id string, batch_id string, begin_timestamp timestamp, end_timestamp timestamp, data array<string>"


def to_envelope(batches: DataFrame) -> DataFrame:
    """One JSON text per batch row with a nested ``data`` list."""
    names = ["batch_tree_row_id", "batch_id", "begin_timestamp", "end_timestamp", "data"]
    return batches.select(F.to_json(F.struct(*names), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}).alias("value"))


def from_envelope(df: DataFrame, element_schema: str, value: str = "value") -> DataFrame:
    """One row per element of each batch; a list element is a window of messages.

    ``messages`` holds the element's messages; it is null, and ``is_broken``
    set, where an element is neither an object, such an object as text, nor a
    list of objects.
    """
    batch = df.select(F.from_json(value, ENVELOPE, {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}).alias("b"))
    rows = batch.select(
        "b.batch_tree_row_id", "b.batch_id", "b.begin_timestamp", "b.end_timestamp", F.posexplode("b.data").alias("place", "e")
    )
    return rows.select(
        "*",
        F.ltrim("e").startswith("[").alias("is_window"),
        _messages(F.col("e"), element_schema).alias("messages"),
    ).withColumn("is_broken", F.col("messages").isNull()).drop("e")


def _messages(element: Column, schema: str) -> Column:
    text = F.ltrim(element)
    one = F.when(text.startswith("{"), F.array(F.from_json(element, schema)))
    return F.when(text.startswith("["), F.from_json(element, f"array<struct<{_struct_fields(schema)}>>")).otherwise(one)


def _struct_fields(schema: str) -> str:
    return ", ".join(f"{n}: {t}" for n, t in (f.strip().split(" ", 1) for f in schema.split(",")))
