"""Queries over what the engine's own micro-batches leave behind."""

from __future__ import annotations

import re
import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltwatch.catalog.detection import AT, CLASSES, WINDOWS
from siltwatch.catalog.ingest import SPEC
from siltwatch.catalog.inspection import INSPECT
from siltwatch.catalog.registry import query
from siltwatch.catalog.views import DNS, TUNNEL, TUNNEL_LOG, batches, domains, entropy, series, verdicts, with_
from siltwatch.operators import alerts as A
from siltwatch.operators.batching import BatchSpec
from siltwatch.operators.inspection import suspicious_lines
from siltwatch.plans import flow
from siltwatch.session import checkpoint_root
from siltwatch.sources import testbed as tb
from siltwatch.sources.schemas import TABLES
from siltwatch.sources.staging import staged
from siltwatch.streaming.jobs import DetectionJob

# A micro-batch of the test stream: fifteen days.
PIECE = 15 * 86_400
PIECES = (
    with_(DNS, batches(40, PIECE), series("sum", "s.status_code = 'NXDOMAIN'"), verdicts("z", 1.5, 0.1))
    + f""",
line_sets AS (
  SELECT DISTINCT s.suspicious_batch_id, s.src_ip, s.batch_id, s.logline_id,
    bool_or(NOT is_buffer AND least(1.0, {entropy("domain_name")} / 4.0) > 0.8) OVER (PARTITION BY s.suspicious_batch_id) AS warned
  FROM suspicious s
),
clients AS (SELECT DISTINCT suspicious_batch_id, warned FROM line_sets),
batch_counts AS (
  SELECT batch_id, count(*) FILTER (WHERE status_code = 'NXDOMAIN') AS n_kept FROM sent_lines GROUP BY batch_id
),
kept_batches AS (SELECT batch_id FROM batch_counts WHERE n_kept > 0),
fine AS (SELECT batch_id FROM verdicts WHERE NOT is_suspicious),
failed AS (
  SELECT * FROM checked
  WHERE NOT (ok_ts AND ok_status_code AND ok_src_ip AND ok_dns_server_ip AND ok_domain_name AND ok_record_type AND ok_size)
),
pieces AS (SELECT count(DISTINCT floor(epoch_us(ts) / {PIECE}000000.0)) AS n FROM dns_log),
levels AS (SELECT * FROM (VALUES
  ('log_collection.batch_handler', 'total_loglines_in_batches', 2), ('log_collection.batch_handler', 'total_loglines_in_buffer', 1),
  ('log_filtering.prefilter', 'total_loglines', 2), ('data_inspection.inspector', 'total_loglines', 2),
  ('data_analysis.detector', 'total_loglines', 2)) v(stage, status, k))"""
)
_EVENTS = (
    ("server_logs", "", "", "dns_log"),
    ("server_logs_timestamps", "", "timestamp_out", "dns_log"),
    ("failed_loglines", "", "", "failed"),
    ("server_log_terminal_events", "log_collection.collector", "failed", "failed"),
    ("loglines", "", "", "valid_log"),
    ("server_log_to_logline", "", "", "valid_log"),
    ("logline_timestamps", "log_collection.collector", "in_process", "valid_log"),
    ("logline_timestamps", "log_collection.collector", "finished", "valid_log"),
    ("logline_to_batches", "", "", "valid_log"),
    ("batch_timestamps", "log_collection.batch_handler", "waiting", "batch_counts"),
    ("batch_timestamps", "log_collection.batch_handler", "completed", "batch_counts"),
    ("batch_tree", "log_collection.batch_handler", "completed", "batch_counts"),
    ("batch_timestamps", "log_filtering.prefilter", "in_process", "batch_counts"),
    ("batch_timestamps", "log_filtering.prefilter", "finished", "kept_batches"),
    ("batch_tree", "log_filtering.prefilter", "in_process", "batch_counts"),
    ("batch_tree", "log_filtering.prefilter", "finished", "kept_batches"),
    ("logline_timestamps", "log_filtering.prefilter", "filtered_out", "sent_lines WHERE status_code <> 'NXDOMAIN'"),
    ("batch_timestamps", "data_inspection.inspector", "in_process", "kept_batches"),
    ("batch_tree", "data_inspection.inspector", "in_process", "kept_batches"),
    ("batch_timestamps", "data_inspection.inspector", "filtered_out", "fine"),
    (
        "logline_timestamps", "data_inspection.inspector", "filtered_out",
        "(SELECT DISTINCT m.batch_id, m.logline_id FROM messages m JOIN fine f ON m.batch_id = f.batch_id)",
    ),
    ("batch_tree", "data_inspection.inspector", "finished", "(SELECT batch_id FROM fine UNION ALL SELECT suspicious_batch_id FROM clients)"),
    ("suspicious_batches_to_batch", "", "", "clients"),
    ("suspicious_batch_timestamps", "data_inspection.inspector", "finished", "clients"),
    ("suspicious_batch_timestamps", "data_analysis.detector", "in_process", "clients"),
    ("suspicious_batch_timestamps", "data_analysis.detector", "finished", "clients WHERE warned"),
    ("suspicious_batch_timestamps", "data_analysis.detector", "filtered_out", "clients WHERE NOT warned"),
    ("batch_tree", "data_analysis.detector", "in_process", "clients"),
    ("batch_tree", "data_analysis.detector", "finished", "clients"),
    ("logline_timestamps", "data_analysis.detector", "detected", "line_sets WHERE warned"),
    ("logline_timestamps", "data_analysis.detector", "filtered_out", "line_sets WHERE NOT warned"),
    ("alerts", "", "", "clients WHERE warned"),
    (
        "server_log_terminal_events", "alerting.alerter", "processed",
        f"(SELECT DISTINCT logline_id FROM suspicious WHERE NOT is_buffer AND least(1.0, {entropy('domain_name')} / 4.0) > 0.8)",
    ),
)
_COUNTS = " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, '{stage}' AS stage, '{status}' AS status, count(*) AS n FROM {source}"
    for table, stage, status, source in _EVENTS
)


def run_stream(spark, sf) -> DetectionJob:
    """All raw lines through the detection job, fifteen days a micro-batch."""
    root = f"{checkpoint_root(spark)}/monitored-{uuid.uuid4().hex}"
    lines = tb.dns_log(spark, sf).select(
        F.concat(F.lit("00000000-0000-4000-8000-"), F.lpad(F.col("logline_id").cast("string"), 12, "0")).alias("message_id"),
        F.col("ts").alias("timestamp_in"), F.col("raw").alias("value"), F.floor(F.unix_micros("ts") / (PIECE * 1_000_000)).alias("piece"),
    )
    lines = staged(lines, "stream-lines")
    job = DetectionJob(
        tb.DNS_FORMAT, root, BatchSpec(size=40, seconds=86_400, slot_seconds=3600), inspection=INSPECT, settings={"name": "dga", "threshold": 0.8}
    )
    first, last = lines.agg(F.min("piece"), F.max("piece")).first()
    for k in range(last - first + 1 if first is not None else 0):
        job(lines.where(F.col("piece") == first + k).drop("piece"), k)
    return job


@query(
    "a11_monitoring_events",
    PIECES + f" SELECT * FROM ({_COUNTS}) WHERE n > 0 UNION ALL SELECT 'fill_levels', stage, status, k * n FROM levels, pieces",
)
def monitoring_events(spark, sf):
    """Rows by table, stage and status that the job's stages leave in the monitoring tables."""
    job, parts = run_stream(spark, sf), []
    for table in TABLES:
        rows = job.log.read(spark, table)
        stage = F.col("stage") if "stage" in rows.columns else F.lit("")
        state = next((c for c in ("status", "event", "entry_type") if c in rows.columns), None)
        state = F.col(state) if state else F.lit("")
        counted = rows.groupBy(stage.alias("stage"), state.alias("status")).agg(F.count(F.lit(1)).alias("n"))
        parts.append(counted.select(F.lit(table).alias("table_name"), "stage", "status", "n"))
    return reduce(DataFrame.unionByName, parts)


@query(
    "c10_batch_tree",
    PIECES + """, edges AS (
  SELECT '' AS parent_stage, 'log_collection.batch_handler' AS stage, 'completed' AS status, (SELECT count(*) FROM batch_counts) AS n
  UNION ALL SELECT 'log_collection.batch_handler', 'log_filtering.prefilter', 'in_process', (SELECT count(*) FROM batch_counts)
  UNION ALL SELECT 'log_collection.batch_handler', 'log_filtering.prefilter', 'finished', (SELECT count(*) FROM kept_batches)
  UNION ALL SELECT 'log_filtering.prefilter', 'data_inspection.inspector', 'in_process', (SELECT count(*) FROM kept_batches)
  UNION ALL SELECT 'log_filtering.prefilter', 'data_inspection.inspector', 'finished', (SELECT count(*) FROM fine) + (SELECT count(*) FROM clients)
  UNION ALL SELECT 'data_inspection.inspector', 'data_analysis.detector', 'in_process', (SELECT count(*) FROM clients)
  UNION ALL SELECT 'data_inspection.inspector', 'data_analysis.detector', 'finished', (SELECT count(*) FROM clients))
SELECT * FROM edges WHERE n > 0""",
)
def batch_tree_edges(spark, sf):
    """Edges of the batch tree by the stages they join; a row without its parent would be lost here."""
    tree = run_stream(spark, sf).log.read(spark, "batch_tree")
    parents = tree.select(F.col("batch_row_id").alias("parent_batch_row_id"), F.col("stage").alias("parent_stage")).distinct()
    roots = tree.where("parent_batch_row_id = ''").withColumn("parent_stage", F.lit(""))
    edges = tree.join(parents, "parent_batch_row_id").unionByName(roots)
    return edges.groupBy("parent_stage", "stage", "status").agg(F.count(F.lit(1)).alias("n"))


def _probabilities(windows: DataFrame) -> DataFrame:
    j, r = F.col("jaro"), F.col("jaro_reversed")
    total = 1 + r / 2
    return windows.withColumn("probabilities", F.array(j / total, (1 - j) / total, r / 2 / total))


_SECOND = re.sub(r"\b(windows|window_pairs|pair_jaro|window_jaro|window_scores)\b", r"second_\1", TUNNEL[TUNNEL.index("window_pairs AS") :])
_PROBS = "jaro / (1 + jaro_reversed / 2), (1 - jaro) / (1 + jaro_reversed / 2), jaro_reversed / 2 / (1 + jaro_reversed / 2)"


@query(
    "f21_detector_chain",
    WINDOWS + f""",
warned AS (SELECT logline_id AS trigger, ts AS arrived_at, ids, window_names FROM window_scores WHERE 1 - jaro > 0.5),
passed AS (SELECT CAST(trigger AS VARCHAR) AS trigger, arrived_at, unnest(range(len(ids))) AS place, unnest(ids) AS logline_id, unnest(window_names) AS domain_name FROM warned),
labelled AS (
  SELECT *, CASE WHEN len(l) > 2 THEN array_to_string(l[1:len(l) - 2], '.') ELSE '' END AS sub FROM (SELECT *, string_split(domain_name, '.') AS l FROM passed)
),
second_windows AS (
  SELECT * FROM (
    SELECT trigger || '/' || place AS logline_id, list(sub) OVER w AS subs, list(logline_id) OVER w AS ids FROM labelled
    WINDOW w AS (PARTITION BY l[-2] ORDER BY arrived_at, trigger, place ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)
  ) WHERE len(subs) >= 3
),
{_SECOND},
rated AS (SELECT ids, [{_PROBS}] AS ps FROM second_window_scores),
topped AS (SELECT *, list_aggregate(ps, 'max') AS top FROM rated)
SELECT array_to_string(ids, ',') AS window_ids, ['benign', 'dnscat2', 'iodine'][list_position(ps, top)] AS predicted_class, round(top, 10) AS probability
FROM topped WHERE list_position(ps, top) > 1 AND top >= 0.3""",
)
def detector_chain(spark, sf):
    """Two levels: windows of a tunnel detector go on to one that names the tool."""
    lines = tb.tunnel_log(spark, sf).withColumn("suspicious_batch_id", F.col("subnet_id"))
    entries = (
        {"name": "tunnel", "detector": "TunnelDetector", "inspector_name": "none", "next_detectors": ["attributor"]},
        {"name": "attributor", "detector": "AttributionDetector", "consume_from": "detector",
         "settings": {"labels": CLASSES, "threshold": 0.3, "score": _probabilities}},
    )
    named = flow.run_detectors(lines, entries)["attributor"]
    ids = F.array_join(F.transform("request", lambda m: m["logline_id"]), ",")
    return named.select(ids.alias("window_ids"), "predicted_class", F.round("probability", 10).alias("probability"))


@query(
    "f16_tunnel_flow",
    with_(
        DNS, TUNNEL_LOG, batches(40, 86_400).replace("FROM valid_log", "FROM tunnel_log"), series(), verdicts("z", 1.5, 0.1),
        "fresh AS (SELECT * FROM suspicious WHERE NOT is_buffer)", domains("fresh"), TUNNEL,
    )
    + """ SELECT suspicious_batch_id, src_ip, count(*) AS n_warnings, round(median(1 - jaro), 8) AS overall_score
FROM window_scores WHERE 1 - jaro > 0.5 GROUP BY 1, 2""",
)
def tunnel_flow(spark, sf):
    """Batches, inspection, windows of suspicious lines, and one alert per client batch."""
    messages = flow.sent_messages(tb.tunnel_log(spark, sf), SPEC, "no_relevance_check", tb.DNS_FORMAT)
    lines = staged(suspicious_lines(messages, flow.inspect(messages, INSPECT)), "suspicious")
    entries = ({"name": "tunnel", "detector": "TunnelDetector", "inspector_name": "dga"},)
    alerts = A.build_alerts(flow.run_detectors(lines, entries)["tunnel"], "tunnel", F.lit(AT), A.compact_warning())
    return alerts.select("suspicious_batch_id", "src_ip", "n_warnings", F.round("overall_score", 8).alias("overall_score"))
