"""Streams of raw log lines and their ingest stamp."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltwatch.sources.staging import staged


def topic_source(brokers: list[str], topics: list[str], per_trigger: int | None = None) -> dict[str, str]:
    """Options of a committed-only topic source that starts at the earliest offset."""
    options = {
        "kafka.bootstrap.servers": ",".join(brokers),
        "subscribe": ",".join(topics),
        "startingOffsets": "earliest",
        "kafka.isolation.level": "read_committed",
    }
    return {**options, "maxOffsetsPerTrigger": str(per_trigger)} if per_trigger else options


def topic_stream(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Records of the topics; needs the Kafka connector on the class path."""
    raw = spark.readStream.format("kafka").options(**options).load()
    return raw.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), "topic", "partition", "offset", "timestamp"
    )


def file_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Lines of text files as they come; :func:`file_lines` gives them their places, micro-batch by micro-batch."""
    reader = spark.readStream.format("text")
    reader = reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader
    return reader.load(path).select(
        "value",
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_modification_time").alias("timestamp"),
    )


def file_lines(batch: DataFrame, topic: str) -> DataFrame:
    """Records like a topic's from the files of a micro-batch; a line's number is its offset.

    A file comes whole in one micro-batch. Its blocks are read by several tasks: each
    line knows its place in its block, and the line counts of the blocks before it are
    added. So the number does not depend on how a file was cut, and equal lines differ.
    """
    rows = staged(batch.withColumn("_row", F.monotonically_increasing_id()), "file-lines")
    blocks = rows.groupBy("path", "block").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_count"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("path", "block", "_first", F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_before"))
    return rows.join(blocks, ["path", "block"]).select(
        F.lit(None).cast("string").alias("key"),
        "value",
        F.lit(topic).alias("topic"),
        F.xxhash64("path").alias("partition"),
        (F.col("_before") + F.col("_row") - F.col("_first")).alias("offset"),
        "timestamp",
    )


def reading_files(job: Callable[[DataFrame, int], None], topic: str) -> Callable[[DataFrame, int], None]:
    """A job that gets the stamped lines of a file stream's micro-batches."""
    return lambda batch, number: job(stamped(file_lines(batch, topic)), number)


def uuid_of(text: Column) -> Column:
    """A digest of a text, shaped as a UUID."""
    digest = F.sha2(text, 256)
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digest, a, n) for a, n in cuts])


def stamped(lines: DataFrame, replay: bool = True) -> DataFrame:
    """Add ``message_id`` and ``timestamp_in``.

    In replay mode the id is a digest of the source position, shaped as a UUID,
    so a retried micro-batch writes the same ids; otherwise it is random.
    """
    if not replay:
        return lines.withColumns({"message_id": F.expr("uuid()"), "timestamp_in": F.current_timestamp()})
    position = F.concat_ws("/", "topic", F.col("partition").cast("string"), F.col("offset").cast("string"))
    return lines.withColumns({"message_id": uuid_of(position), "timestamp_in": F.col("timestamp")})


def server_log_rows(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(server_logs rows, ``timestamp_out`` events) of stamped lines."""
    logs = lines.select("message_id", "timestamp_in", F.col("value").alias("message_text"))
    outs = lines.select("message_id", F.lit("timestamp_out").alias("event"), F.current_timestamp().alias("event_timestamp"))
    return logs, outs
