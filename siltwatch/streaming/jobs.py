"""Micro-batch jobs: batching with carry-over, late lines, roll-ups, detection.

Every job is a ``foreachBatch`` function whose writes are keyed by the
micro-batch number: a replay overwrites what the first try wrote.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siltwatch.functions.network import subnet_id
from siltwatch.functions.rules import LogFormat, relevance_predicate
from siltwatch.operators import alerts as A
from siltwatch.operators.batching import BatchSpec, assign_flush, carry_over
from siltwatch.operators.filtering import keep_relevant
from siltwatch.operators.inspection import client_batches, suspicious_lines
from siltwatch.operators.routing import detector_edges, reads_from_detector
from siltwatch.operators.tunnel import KEYS as TUNNEL_KEYS
from siltwatch.operators.validation import additional_fields, parse_lines, parsed_valid_lines
from siltwatch.plans import flow
from siltwatch.plans.rollups import alert_rollup
from siltwatch.sources.event_log import EventLog, Part, StageClock
from siltwatch.sources.folders import forget_before
from siltwatch.sources.sinks import write_once
from siltwatch.sources.staging import staged
from siltwatch.streaming import events
from siltwatch.streaming.sources import uuid_of
from siltwatch.streaming.state import KeyedState

Sink = Callable[[DataFrame, int], None]


def run(stream: DataFrame, job: Sink, checkpoint: str, seconds: int | None = None) -> StreamingQuery:
    """Start a job; without an interval it drains what is there and stops."""
    writer = stream.writeStream.foreachBatch(job).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": f"{seconds} seconds"} if seconds else {"availableNow": True}
    return writer.trigger(**trigger).start()


def _read_if_there(spark, path: str) -> DataFrame | None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return spark.read.parquet(path) if fs.exists(where) else None


@dataclass
class BatchingJob:
    """Batches per subnet; the end of a micro-batch is the flush.

    The last, not full batch of each subnet is kept as a table for the next
    micro-batch. Subnets without new lines then lose theirs. A busy subnet is
    numbered slot by slot, so it never sits in one task.
    """

    spec: BatchSpec
    root: str
    out: Sink | None = None

    def __call__(self, lines: DataFrame, batch_id: int) -> None:
        write_once(self.sent(lines, batch_id), f"{self.root}/sent", batch_id)
        if self.out:
            self.out(lines.sparkSession.read.parquet(f"{self.root}/sent/stream_batch={batch_id}"), batch_id)

    def sent(self, lines: DataFrame, batch_id: int) -> DataFrame:
        spark = lines.sparkSession
        fine = replace(self.spec, slot_seconds=max(1, min(self.spec.slot_seconds, self.spec.seconds // 10)))
        write_once(assign_flush(lines, fine, F.lit(batch_id).cast("bigint")), f"{self.root}/assigned", batch_id)
        current = spark.read.parquet(f"{self.root}/assigned/stream_batch={batch_id}")
        before = _read_if_there(spark, f"{self.root}/assigned/stream_batch={batch_id - 1}")
        rows = current
        if before is not None:
            rows = rows.unionByName(before.filter(F.col("ends_window") & ~F.col("expires")))
        return carry_over(rows, self.spec).filter(F.col("flush_no") == batch_id)


@dataclass
class LateLines:
    """Split each micro-batch at the watermark reached by earlier ones."""

    delay_seconds: int
    root: str
    on_time: Sink
    late: Sink

    def __call__(self, lines: DataFrame, batch_id: int) -> None:
        spark = lines.sparkSession
        before = _read_if_there(spark, f"{self.root}/high/stream_batch={batch_id - 1}")
        high = before.first()[0] if before is not None else None
        reached = F.greatest(F.max("ts"), F.lit(high).cast("timestamp"))
        write_once(lines.agg(reached.alias("high")), f"{self.root}/high", batch_id)
        if high is None:
            return self.on_time(lines, batch_id)
        limit = F.lit(high) - F.make_dt_interval(secs=F.lit(self.delay_seconds))
        self.on_time(lines.filter(F.col("ts") >= limit), batch_id)
        return self.late(lines.filter(F.col("ts") < limit), batch_id)


def alert_rollup_stream(alerts: DataFrame, minutes: int, delay: str) -> DataFrame:
    """Closed buckets of a stream of alerts, once the watermark has passed them."""
    return (
        alerts.withWatermark("alert_timestamp", delay)
        .groupBy(F.window("alert_timestamp", f"{minutes} minutes"), "src_ip")
        .agg(F.count(F.lit(1)).alias("alert_count"))
        .select(F.col("window.start").alias("time_bucket"), "src_ip", "alert_count")
    )


def rollup_job(root: str, minutes: int) -> Sink:
    """Partial counts per micro-batch; readers add them up."""
    return lambda alerts, batch_id: write_once(alert_rollup(alerts, minutes), f"{root}/alerts_{minutes}m", batch_id)


@dataclass
class DetectionJob:
    """Raw lines to alerts for one collector, with the rows of all monitoring tables.

    Scorers and windows go on where the last micro-batch ended. All rows of a
    micro-batch are committed at once; one that is committed is not done again.
    ``detectors`` configures several detectors, chained if they name each other;
    without it ``detector`` and ``settings`` are the only one.
    """

    fmt: LogFormat
    root: str
    batch: BatchSpec = field(default_factory=BatchSpec)
    method: str = "check_dga_relevance"
    inspection: flow.InspectSpec = field(default_factory=flow.InspectSpec)
    detector: str = "DGADetector"
    settings: dict = field(default_factory=dict)
    hooks: tuple[str, ...] = ("generic",)
    alert_sinks: tuple[Sink, ...] = ()
    detectors: tuple[Mapping, ...] = ()
    name: str = "collector"

    @property
    def log(self) -> EventLog:
        """The monitoring tables."""
        return EventLog(f"{self.root}/tables")

    def entries(self) -> tuple[Mapping, ...]:
        settings = {k: v for k, v in self.settings.items() if k != "name"}
        only = {"name": self.settings.get("name", self.detector), "detector": self.detector, "inspector_name": self.name, "settings": settings}
        return self.detectors or (only,)

    def __call__(self, lines: DataFrame, batch_id: int) -> None:
        spark = lines.sparkSession
        if self.log.committed(spark, batch_id):
            return
        parts, alerts = self.process(lines, batch_id)
        self.log.write(spark, parts, batch_id)
        for sink in self.alert_sinks:
            sink(alerts, batch_id)
        self.log.commit(spark, batch_id)
        for path in ("parsed", "valid", "batches/assigned", "batches/sent", "messages", "verdicts", "suspicious", "warnings", "alerts", "clock"):
            forget_before(spark, f"{self.root}/{path}", batch_id)

    def process(self, lines: DataFrame, batch_id: int) -> tuple[list[Part], DataFrame]:
        """Rows of the monitoring tables, and the alerts, of a micro-batch."""
        spark, clock = lines.sparkSession, StageClock(self.root)
        now = lambda mark: clock.at(spark, batch_id, mark)

        def kept(df: DataFrame, name: str) -> DataFrame:
            path = f"{self.root}/{name}"
            write_once(df, path, batch_id)
            return spark.read.schema(df.schema).parquet(f"{path}/stream_batch={batch_id}")

        raw = lines.select("message_id", "timestamp_in", F.col("value").alias("raw"))
        parsed = kept(parse_lines(raw, self.fmt), "parsed")
        named = parsed_valid_lines(parsed.withColumn("additional_fields", additional_fields(F.col("raw"))), self.fmt)
        valid = kept(
            named.withColumns(
                {"logline_id": uuid_of(F.concat_ws("/", "message_id", F.lit("line"))), "server_message_id": F.col("message_id"),
                 "subnet_id": subnet_id(F.col("src_ip"))}
            ),
            "valid",
        )
        parts = events.collected(parsed, valid, now("collected"))

        begin = now("batching")
        BatchingJob(self.batch, f"{self.root}/batches")(valid.drop("raw", "message_id", "timestamp_in", "additional_fields"), batch_id)
        sent = spark.read.parquet(f"{self.root}/batches/sent/stream_batch={batch_id}")
        keeps = F.coalesce(relevance_predicate(self.method, self.fmt), F.lit(False))
        counts = sent.groupBy("batch_id").agg(
            F.count_if(~F.col("is_buffer")).alias("n_new"), F.count(F.lit(1)).alias("n_all"), F.count_if(keeps).alias("n_kept")
        )
        counts = staged(counts, "batch-counts")
        parts += events.batched(sent, counts, self.name, begin, now("batched"))

        begin = now("filtering")
        messages = kept(keep_relevant(sent, self.method, self.fmt), "messages")
        dropped = sent.filter(~keeps).select("logline_id")
        parts += events.filtered(sent, dropped, counts, self.name, begin, now("filtered"))

        begin, scorers = now("inspecting"), KeyedState(f"{self.root}/state/scorers", flow.KEYS)
        before = scorers.before(spark, batch_id) if flow.resumes(self.inspection) else None
        verdicts = kept(flow.inspect(messages, self.inspection, before), "verdicts")
        if flow.resumes(self.inspection):
            scorers.put(flow.scorer_state(messages, self.inspection, before), batch_id)
        lines = kept(suspicious_lines(messages, verdicts), "suspicious")
        clients = staged(client_batches(lines), "client-batches")
        parts += events.inspected(messages, verdicts, clients, lines, counts, self.name, begin, now("inspected"))

        begin, entries = now("detecting"), self.entries()

        def queue(name: str):
            state = KeyedState(f"{self.root}/state/queues-{name}", TUNNEL_KEYS)
            return state.before(spark, batch_id), lambda rows: state.put(rows, batch_id)

        found = flow.run_detectors(lines, entries, staged, queue)
        at = now("detected")
        listening = {e["name"] for e in entries if reads_from_detector(e)}
        for name, warnings in found.items():
            if name not in listening:
                parts += events.detected(lines, clients, warnings, name, begin, at)
        for source, name in detector_edges(entries):
            parts += events.chained(found[source], source, name, begin, at)

        alerting = [e["name"] for e in entries if e.get("send_to_alerter") is not False]
        at = now("alerted")
        made = [A.build_alerts(found[n], n, F.lit(at), A.persisted_warning(n)) for n in alerting]
        none = A.build_alerts(next(iter(found.values())).limit(0), "", F.lit(at), A.persisted_warning(""))
        alerts = kept(A.process_alerts(reduce(DataFrame.unionByName, made, none), self.hooks), "alerts")
        return parts + events.alerted(alerts, at), alerts
