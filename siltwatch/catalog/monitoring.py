"""Queries: roll-ups, latencies, retention and dashboards."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltwatch.catalog.registry import query
from siltwatch.catalog.views import DNS, with_
from siltwatch.plans import dashboards as P
from siltwatch.plans import latency as L
from siltwatch.plans import retention, rollups
from siltwatch.plans.quantiles import described
from siltwatch.session import checkpoint_root
from siltwatch.sources import testbed as tb
from siltwatch.sources.staging import staged
from siltwatch.streaming.increments import state_tables


def last_event(spark, sf, **plus):
    return tb.table(spark, sf, "events").agg(F.max("ts")).first()[0] + dt.timedelta(**plus)


def last_ship(spark, sf, **plus):
    return tb.table(spark, sf, "lineitem").agg(F.max("l_shipdate")).first()[0] + dt.timedelta(**plus)


# Five days after the last event, all three tiers hold rows.
AS_OF = "(SELECT max(ts) + INTERVAL 5 DAY FROM events)"
SHIP = "(SELECT max(l_shipdate) + INTERVAL 12 HOUR FROM lineitem)"

ALERTS = """
alerts AS (
  SELECT '192.168.' || CAST(user_id % 4 AS VARCHAR) || '.' || CAST(1 + user_id % 254 AS VARCHAR) AS src_ip, ts AS alert_timestamp
  FROM events WHERE event_type = 'error'
)"""
ALERT_HISTORY = ALERTS + f""",
rolled AS (
  SELECT t.m, time_bucket(to_minutes(t.m), alert_timestamp) AS time_bucket, src_ip, CAST(count(*) AS BIGINT) AS alert_count
  FROM alerts, (VALUES (1), (15), (60)) t(m) GROUP BY 1, 2, 3
),
history AS (
  SELECT time_bucket, src_ip, alert_count FROM rolled, (SELECT {AS_OF} AS as_of)
  WHERE (m = 1 AND time_bucket >= as_of - INTERVAL 7 DAY)
     OR (m = 15 AND time_bucket >= as_of - INTERVAL 30 DAY AND time_bucket < as_of - INTERVAL 7 DAY)
     OR (m = 60 AND time_bucket >= as_of - INTERVAL 90 DAY AND time_bucket < as_of - INTERVAL 30 DAY)
)"""


def _rollup(minutes, name):
    @query(
        f"h1_alerts_{name}",
        with_(ALERTS) + f" SELECT time_bucket(INTERVAL {minutes} MINUTE, alert_timestamp) AS time_bucket, src_ip, count(*) AS alert_count FROM alerts GROUP BY 1, 2",
    )
    def alerts(spark, sf):
        return rollups.alert_rollup(tb.alert_rows(spark, sf, with_text=False), minutes)

    @query(
        f"h2_fill_levels_{name}",
        f"""SELECT time_bucket(INTERVAL {minutes} MINUTE, ts) AS time_bucket, event_type AS stage, 'total_loglines' AS entry_type,
  min(CAST(floor(value) AS BIGINT)) AS min_count, round(avg(floor(value)), 9) AS avg_count, max(CAST(floor(value) AS BIGINT)) AS max_count, median(floor(value)) AS median_count
FROM events GROUP BY 1, 2""",
    )
    def fill(spark, sf):
        return rollups.fill_rollup(tb.fill_level_rows(spark, sf), minutes).withColumn("avg_count", F.round("avg_count", 9))


for _m, _n in ((1, "1m"), (15, "15m"), (60, "1h")):
    _rollup(_m, _n)


@query(
    "h2_merged_states",
    """SELECT time_bucket(INTERVAL 60 MINUTE, ts) AS time_bucket, event_type AS stage, 'total_loglines' AS entry_type,
  min(CAST(floor(value) AS BIGINT)) AS min_count, round(avg(floor(value)), 9) AS avg_count, max(CAST(floor(value) AS BIGINT)) AS max_count
FROM events GROUP BY 1, 2""",
)
def merged_states(spark, sf):
    """Minute states merged to hours."""
    fine = rollups.fill_state(tb.fill_level_rows(spark, sf), 1)
    merged = rollups.finish_fill_states(rollups.merge_fill_states(fine, 60))
    return merged.withColumn("avg_count", F.round("avg_count", 9)).drop("median_count")


@query(
    "h5_stored_states",
    f"""WITH rolled AS (
  SELECT t.m, time_bucket(to_minutes(t.m), ts) AS time_bucket, event_type AS stage, 'total_loglines' AS entry_type,
    min(CAST(floor(value) AS BIGINT)) AS min_count, round(avg(floor(value)), 9) AS avg_count, max(CAST(floor(value) AS BIGINT)) AS max_count, TRUE AS median_in_bound
  FROM events, (VALUES (1), (15), (60)) t(m) GROUP BY 1, 2, 3)
SELECT time_bucket, stage, entry_type, min_count, avg_count, max_count, median_in_bound FROM rolled, (SELECT {AS_OF} AS as_of)
WHERE (m = 1 AND time_bucket >= as_of - INTERVAL 7 DAY)
   OR (m = 15 AND time_bucket >= as_of - INTERVAL 30 DAY AND time_bucket < as_of - INTERVAL 7 DAY)
   OR (m = 60 AND time_bucket >= as_of - INTERVAL 90 DAY AND time_bucket < as_of - INTERVAL 30 DAY)""",
)
def history_of_states(spark, sf):
    """The tiers from stored states that came in three increments; the sketch's median lies within two percent of the ranks."""
    as_of, levels = last_event(spark, sf, days=5), staged(tb.fill_level_rows(spark, sf), "fill-levels")
    part = F.pmod(F.xxhash64("timestamp", "entry_count"), F.lit(3))
    states = {}
    for t in rollups.TIERS:
        increments = [rollups.fill_state(levels.where(part == k), t.minutes) for k in range(3)]
        states[t.name] = staged(reduce(DataFrame.unionByName, increments), f"states-{t.name}")
    found = rollups.fill_history_of_states(states, as_of)
    placed = rollups.with_tier_buckets(levels, "timestamp", as_of)
    ranks = described(placed, ("tier", *rollups.FILL_KEYS), "entry_count", [0.48, 0.52])
    ranks = ranks.select(*rollups.FILL_KEYS, F.floor(F.col("q")[0]).alias("lo"), F.ceil(F.col("q")[1]).alias("hi"), "low", "high", "n")
    joined = found.join(ranks, list(rollups.FILL_KEYS))
    few = F.col("n") < 25  # so few values that two percent is less than one of them
    median = F.col("median_count")
    inside = F.when(few, median.between(F.col("low"), F.col("high"))).otherwise(median.between(F.col("lo"), F.col("hi")))
    return joined.select(*rollups.FILL_KEYS, "min_count", F.round("avg_count", 9).alias("avg_count"), "max_count", inside.alias("median_in_bound"))


@query(
    "h3_backfill",
    with_(ALERTS) + f""" SELECT time_bucket(INTERVAL 15 MINUTE, alert_timestamp) AS time_bucket, src_ip, count(*) AS alert_count
FROM alerts WHERE alert_timestamp >= {AS_OF} - INTERVAL 30 DAY GROUP BY 1, 2""",
)
def backfill(spark, sf):
    rows = tb.alert_rows(spark, sf, with_text=False)
    raw = rollups.backfill_rows(rows, rows.limit(0), "alert_timestamp", last_event(spark, sf, days=5), 30)
    return rollups.alert_rollup(raw, 15)


@query("h4_alerts_history", with_(ALERT_HISTORY) + " SELECT time_bucket, src_ip, alert_count FROM history")
def alerts_history(spark, sf):
    return rollups.alerts_history(tb.alert_rows(spark, sf, with_text=False), last_event(spark, sf, days=5))


@query(
    "h5_fill_levels_history",
    f"""WITH rolled AS (
  SELECT t.m, time_bucket(to_minutes(t.m), ts) AS time_bucket, event_type AS stage, 'total_loglines' AS entry_type,
    min(CAST(floor(value) AS BIGINT)) AS min_count, round(avg(floor(value)), 9) AS avg_count, max(CAST(floor(value) AS BIGINT)) AS max_count, median(floor(value)) AS median_count
  FROM events, (VALUES (1), (15), (60)) t(m) GROUP BY 1, 2, 3)
SELECT time_bucket, stage, entry_type, min_count, avg_count, max_count, median_count FROM rolled, (SELECT {AS_OF} AS as_of)
WHERE (m = 1 AND time_bucket >= as_of - INTERVAL 7 DAY)
   OR (m = 15 AND time_bucket >= as_of - INTERVAL 30 DAY AND time_bucket < as_of - INTERVAL 7 DAY)
   OR (m = 60 AND time_bucket >= as_of - INTERVAL 90 DAY AND time_bucket < as_of - INTERVAL 30 DAY)""",
)
def fill_history(spark, sf):
    out = rollups.fill_levels_history(tb.fill_level_rows(spark, sf), last_event(spark, sf, days=5))
    return out.withColumn("avg_count", F.round("avg_count", 9))


# Monitoring events as the adapters derive them.
_STAGE = "CASE WHEN l_linestatus = 'O' THEN 'log_collection.batch_handler' ELSE 'log_filtering.prefilter' END AS stage"
_STATUS = "CASE l_returnflag WHEN 'A' THEN 'in_process' WHEN 'N' THEN 'finished' ELSE 'filtered_out' END AS status"
EVENTS = f"""
server_logs AS (SELECT o_orderkey AS message_id, o_orderdate AS timestamp_in FROM orders),
log_times AS (SELECT l_orderkey AS message_id, CASE WHEN l_linenumber % 2 = 1 THEN 'timestamp_out' ELSE 'other' END AS event, l_shipdate AS event_timestamp FROM lineitem),
line_events AS (SELECT l_orderkey AS logline_id, {_STAGE}, {_STATUS}, l_shipdate AS timestamp, l_returnflag <> 'R' AS is_active FROM lineitem),
batch_events AS (SELECT l_orderkey AS batch_id, CAST(l_suppkey AS VARCHAR) AS instance_name, {_STAGE}, {_STATUS}, l_shipdate AS timestamp, l_returnflag <> 'R' AS is_active FROM lineitem),
terminal AS (SELECT o_orderkey AS message_id, o_orderdate + INTERVAL 1 DAY AS timestamp FROM orders WHERE o_orderstatus = 'F'),
batch_tree AS (
  SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS batch_row_id,
    CASE WHEN turn = 0 THEN '' ELSE CAST(conv_id AS VARCHAR) || '-' || CAST(turn - 1 AS VARCHAR) END AS parent_batch_row_id,
    CASE WHEN turn = 0 THEN 'log_collection.batch_handler' WHEN turn IN (1, 2) THEN 'log_filtering.prefilter'
         WHEN turn IN (3, 4) THEN 'data_inspection.inspector' ELSE 'data_analysis.detector' END AS stage,
    CASE WHEN turn = 0 THEN 'completed' WHEN turn % 2 = 1 THEN 'in_process' ELSE 'finished' END AS status,
    TIMESTAMP '2024-01-01' + to_seconds(conv_id * 60 + turn * turn) AS timestamp
  FROM conversations
)"""


def _state_sql(source, keys, ends, inactive):
    end = f"status IN {ends}" + (" OR NOT is_active" if inactive else "")
    return f"""SELECT CAST(timestamp AS DATE) AS event_date, {keys}, min(timestamp) FILTER (WHERE status = 'in_process') AS start_timestamp,
  max(timestamp) FILTER (WHERE {end}) AS end_timestamp FROM {source} GROUP BY ALL"""


_STATES = {
    "logline": _state_sql("line_events", "stage, logline_id", L.LINE_ENDS, False),
    "batch": _state_sql("batch_events", "stage, instance_name, batch_id", L.BATCH_ENDS, True),
    "suspicious_batch": _state_sql("batch_events", "stage, instance_name, batch_id AS suspicious_batch_id", L.SUSPICIOUS_ENDS, True),
}


def _merged_sql(family, keys):
    return f"""SELECT {keys}, min(event_date) AS event_date, min(start_timestamp) AS start_timestamp, max(end_timestamp) AS end_timestamp,
  epoch_us(max(end_timestamp)) - epoch_us(min(start_timestamp)) AS latency_us FROM ({_STATES[family]}) GROUP BY {keys}
  HAVING min(start_timestamp) > TIMESTAMP '1970-01-01' AND max(end_timestamp) > min(start_timestamp)"""


LATENCIES = EVENTS + f""",
server_log_l AS (
  SELECT s.message_id, CAST(t.event_timestamp AS DATE) AS event_date, s.timestamp_in AS start_timestamp, t.event_timestamp AS end_timestamp,
    epoch_us(t.event_timestamp) - epoch_us(s.timestamp_in) AS latency_us
  FROM server_logs s JOIN log_times t ON s.message_id = t.message_id WHERE t.event = 'timestamp_out' AND t.event_timestamp > s.timestamp_in
),
logline_l AS ({_merged_sql("logline", "stage, logline_id")}),
batch_l AS ({_merged_sql("batch", "stage, instance_name, batch_id")}),
suspicious_l AS ({_merged_sql("suspicious_batch", "stage, instance_name, suspicious_batch_id")}),
roundtrip_l AS (
  SELECT message_id, CAST(e AS DATE) AS event_date, s AS start_timestamp, e AS end_timestamp, epoch_us(e) - epoch_us(s) AS latency_us
  FROM (
    SELECT l.message_id, min(l.timestamp_in) AS s, max(t.e) AS e FROM server_logs l JOIN (
      SELECT o.o_orderkey AS message_id, max(x.timestamp) AS e FROM orders o JOIN line_events x ON o.o_orderkey = x.logline_id WHERE NOT x.is_active GROUP BY 1
      UNION ALL SELECT message_id, max(timestamp) FROM terminal GROUP BY 1) t ON l.message_id = t.message_id GROUP BY 1)
  WHERE e > s
),
transport_l AS (
  SELECT h.name AS stage, b.timestamp AS end_timestamp, epoch_us(b.timestamp) - epoch_us(a.timestamp) AS latency_us
  FROM batch_tree a JOIN batch_tree b ON a.batch_row_id = b.parent_batch_row_id
  JOIN (VALUES {", ".join(str(h) for h in L.HOPS)}) h(name, s1, x1, s2, x2)
    ON a.stage = h.s1 AND a.status = h.x1 AND b.stage = h.s2 AND b.status = h.x2
  WHERE b.timestamp > a.timestamp
),
all_values AS (
  SELECT 'server_log' AS family, 'log_storage.logserver' AS stage, end_timestamp, CAST(latency_us AS DOUBLE) AS latency_us FROM server_log_l
  UNION ALL SELECT 'logline', stage, end_timestamp, CAST(latency_us AS DOUBLE) FROM logline_l
  UNION ALL SELECT 'batch', stage, end_timestamp, CAST(latency_us AS DOUBLE) FROM batch_l
  UNION ALL SELECT 'suspicious_batch', stage, end_timestamp, CAST(latency_us AS DOUBLE) FROM suspicious_l
  UNION ALL SELECT 'roundtrip', 'pipeline.roundtrip', end_timestamp, CAST(latency_us AS DOUBLE) FROM roundtrip_l
  UNION ALL SELECT 'transport', stage, end_timestamp, CAST(latency_us AS DOUBLE) FROM transport_l
)"""


def parts(spark, sf):
    return {
        "server_log": L.server_log_latencies(tb.server_logs(spark, sf), tb.server_logs_timestamps(spark, sf)),
        "logline": L.stage_latencies(L.logline_states(tb.logline_timestamps(spark, sf))),
        "batch": L.stage_latencies(L.batch_states(tb.batch_timestamps(spark, sf))),
        "suspicious_batch": L.stage_latencies(L.suspicious_states(tb.suspicious_batch_timestamps(spark, sf))),
        "roundtrip": L.roundtrip_latencies(
            tb.server_logs(spark, sf), tb.server_log_to_logline(spark, sf), tb.logline_timestamps(spark, sf), tb.terminal_events(spark, sf)
        ),
        "transport": L.transport_latencies(tb.batch_tree(spark, sf)),
    }


@query(
    "h6_server_log_states",
    with_(EVENTS) + """ SELECT event_date, message_id, min(s) AS start_timestamp, max(e) AS end_timestamp FROM (
  SELECT CAST(timestamp_in AS DATE) AS event_date, message_id, timestamp_in AS s, CAST(NULL AS TIMESTAMP) AS e FROM server_logs
  UNION ALL SELECT CAST(event_timestamp AS DATE), message_id, NULL, CASE WHEN event = 'timestamp_out' THEN event_timestamp END FROM log_times)
GROUP BY 1, 2""",
)
def server_log_states(spark, sf):
    return L.server_log_states(tb.server_logs(spark, sf), tb.server_logs_timestamps(spark, sf))


@query("h7_logline_states", with_(EVENTS) + " " + _STATES["logline"])
def logline_states(spark, sf):
    return L.logline_states(tb.logline_timestamps(spark, sf))


@query("h7_incremental_states", with_(EVENTS) + " SELECT * REPLACE (CAST(logline_id AS VARCHAR) AS logline_id) FROM (" + _STATES["logline"] + ")")
def incremental_states(spark, sf):
    """States that came in increments, some of them merged on the way, are those of one run."""
    table = state_tables(f"{checkpoint_root(spark)}/states-{uuid.uuid4().hex}")["logline"]
    events = staged(tb.logline_timestamps(spark, sf).withColumn("logline_id", F.col("logline_id").cast("string")), "line-events")
    low, high = events.agg(F.min(F.unix_date(F.to_date("timestamp"))), F.max(F.unix_date(F.to_date("timestamp")))).first()
    place = F.floor((F.unix_date(F.to_date("timestamp")) - (low or 0)) * 3 / ((high or 0) - (low or 0) + 1))
    for k in range(3):  # an increment touches some days only
        table.add(spark, L.logline_states(events.where(place == k)), k)
    again = events.where((place == 1) & (F.dayofmonth("timestamp") == 1))
    table.add(spark, L.logline_states(again), 3)  # seen again: nothing changes
    table.compact(spark, 2)
    return table.read(spark)


@query("h8_batch_states", with_(EVENTS) + " " + _STATES["batch"])
def batch_states(spark, sf):
    return L.batch_states(tb.batch_timestamps(spark, sf))


@query("h9_suspicious_states", with_(EVENTS) + " " + _STATES["suspicious_batch"])
def suspicious_states(spark, sf):
    return L.suspicious_states(tb.suspicious_batch_timestamps(spark, sf))


def _part(key, name, source):
    @query(name, with_(LATENCIES) + f" SELECT * FROM {source}")
    def values(spark, sf):
        return parts(spark, sf)[key]


_part("server_log", "h10_server_log_latency", "server_log_l")
_part("logline", "h11_logline_latency", "logline_l")
_part("batch", "h11_batch_latency", "batch_l")
_part("suspicious_batch", "h11_suspicious_latency", "suspicious_l")
_part("roundtrip", "h12_roundtrip_latency", "roundtrip_l")
_part("transport", "h13_transport_latency", "transport_l")


def all_values(spark, sf):
    return L.latency_values(parts(spark, sf))


@query("h14_latency_values", with_(LATENCIES) + " SELECT family, stage, end_timestamp, latency_us FROM all_values")
def latency_values(spark, sf):
    return all_values(spark, sf)


LATER = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)
_Q = "round(quantile_cont(latency_us, {}), 0)"
_STATS = f"""count(*) AS sample_count, min(latency_us) AS min_latency_us, round(avg(latency_us), 0) AS avg_latency_us,
  {_Q.format(0.5)} AS p50_latency_us, {_Q.format(0.95)} AS p95_latency_us, {_Q.format(0.99)} AS p99_latency_us, max(latency_us) AS max_latency_us"""
_ROUNDED = ("avg_latency_us", "p50_latency_us", "p95_latency_us", "p99_latency_us")


def _rounded(df):
    return df.withColumns({c: F.round(c, 0) for c in _ROUNDED if c in df.columns})


def _snapshot(resolution, minutes):
    @query(
        f"h15_latency_{resolution}",
        with_(LATENCIES) + f""" SELECT time_bucket(INTERVAL {minutes} MINUTE, end_timestamp) AS time_bucket, family, stage, {_STATS}, TIMESTAMP '2024-02-01' AS snapshot_version
FROM all_values WHERE end_timestamp < TIMESTAMP '2024-02-01' GROUP BY 1, 2, 3""",
    )
    def snapshot(spark, sf):
        return _rounded(L.latency_snapshot(all_values(spark, sf), resolution, LATER))


for _m, _n in ((1, "1m"), (15, "15m"), (60, "1h")):
    _snapshot(_n, _m)


@query(
    "h15_refresh_look_back",
    with_(LATENCIES) + f""" SELECT time_bucket(INTERVAL 60 MINUTE, end_timestamp) AS time_bucket, family, stage, {_STATS}, {SHIP} AS snapshot_version
FROM all_values WHERE end_timestamp < date_trunc('hour', {SHIP}) AND end_timestamp >= {SHIP} - INTERVAL 12 HOUR GROUP BY 1, 2, 3""",
)
def refresh(spark, sf):
    """One scheduled refresh of the hourly tier."""
    as_of = last_ship(spark, sf, hours=12)
    hours = dt.timedelta(hours=L.LOOK_BACK["1h"])
    return _rounded(L.latency_snapshot(all_values(spark, sf), "1h", as_of, hours))


@query(
    "h16_newest_version",
    with_(LATENCIES) + f""", versions AS (
  SELECT time_bucket(INTERVAL 15 MINUTE, end_timestamp) AS time_bucket, family, stage, {_STATS}, {SHIP} - INTERVAL 30 DAY AS snapshot_version
  FROM all_values WHERE end_timestamp < {SHIP} - INTERVAL 30 DAY GROUP BY 1, 2, 3
  UNION ALL
  SELECT time_bucket(INTERVAL 15 MINUTE, end_timestamp), family, stage, {_STATS}, {SHIP}
  FROM all_values WHERE end_timestamp < {SHIP} AND family <> 'logline' GROUP BY 1, 2, 3)
SELECT * FROM versions QUALIFY row_number() OVER (PARTITION BY family, stage, time_bucket ORDER BY snapshot_version DESC) = 1""",
)
def newest(spark, sf):
    """Two overlapping versions; the newer leaves one family out."""
    as_of = last_ship(spark, sf, hours=12)
    values = staged(all_values(spark, sf), "latency-values")
    first = L.latency_snapshot(values, "15m", as_of - dt.timedelta(days=30))
    second = L.latency_snapshot(values.filter("family <> 'logline'"), "15m", as_of)
    return _rounded(L.newest_version(first.unionByName(second)))


_TIERS = f""",
tiers AS (
  SELECT t.m, time_bucket(to_minutes(t.m), end_timestamp) AS time_bucket, family, stage, {_STATS}
  FROM all_values, (VALUES (1), (15), (60)) t(m) WHERE time_bucket(to_minutes(t.m), end_timestamp) < time_bucket(to_minutes(t.m), {SHIP}) GROUP BY 1, 2, 3, 4
),
latency_history AS (
  SELECT time_bucket, family, stage, sample_count, min_latency_us, avg_latency_us, p50_latency_us, p95_latency_us, p99_latency_us, max_latency_us
  FROM tiers, (SELECT {SHIP} AS as_of)
  WHERE (m = 1 AND time_bucket >= as_of - INTERVAL 7 DAY AND time_bucket < as_of - INTERVAL 1 DAY)
     OR (m = 15 AND time_bucket >= as_of - INTERVAL 30 DAY AND time_bucket < as_of - INTERVAL 7 DAY)
     OR (m = 60 AND time_bucket >= as_of - INTERVAL 90 DAY AND time_bucket < as_of - INTERVAL 30 DAY)
)"""


def history(spark, sf, values=None):
    values = values if values is not None else all_values(spark, sf)
    return L.latency_history_from_values(values, last_ship(spark, sf, hours=12))


@query("h17_stored_snapshots", with_(LATENCIES + _TIERS) + " SELECT * FROM latency_history")
def stored_snapshots(spark, sf):
    """The same history, read from stored snapshots of the three resolutions."""
    as_of = last_ship(spark, sf, hours=12)
    values = staged(all_values(spark, sf), "latency-values")
    tables = {t.name: L.latency_snapshot(values, t.name, as_of) for t in L.LATENCY_TIERS}
    return _rounded(L.latency_history(tables, as_of))


@query("h17_latency_history", with_(LATENCIES + _TIERS) + " SELECT * FROM latency_history")
def latency_history(spark, sf):
    return _rounded(history(spark, sf))


@query(
    "h18_recent_and_typical",
    with_(LATENCIES + _TIERS) + f""" SELECT family, stage, end_timestamp, latency_us FROM all_values WHERE end_timestamp >= {SHIP} - INTERVAL 1 DAY
UNION ALL SELECT family, stage, time_bucket, p50_latency_us FROM latency_history""",
)
def recent_and_typical(spark, sf):
    values = staged(all_values(spark, sf), "latency-values")
    out = L.recent_and_typical(values, history(spark, sf, values), last_ship(spark, sf, hours=12))
    return out.withColumn("latency_us", F.round("latency_us", 0))


def _view(family, name, source, ids, has_stage):
    nil, rolled = f"'{L.NIL_ID}'", f"'{L.ROLLED_UP}'"
    columns, stand = [], []
    if has_stage:
        columns.append("stage")
        stand.append("stage")
    for c in ids:
        columns.append(c if c == "instance_name" else f"CAST({c} AS VARCHAR) AS {c}")
        stand.append(rolled if c == "instance_name" else nil)
    if family != "transport":
        columns += ["event_date", "start_timestamp"]
        stand += ["CAST(time_bucket AS DATE)", "time_bucket"]
    columns += ["end_timestamp", "CAST(latency_us AS DOUBLE) AS latency_us"]
    stand += ["time_bucket", "p50_latency_us"]

    @query(
        name,
        with_(LATENCIES + _TIERS) + f" SELECT {', '.join(columns)} FROM {source} WHERE end_timestamp >= {SHIP} - INTERVAL 1 DAY "
        f"UNION ALL SELECT {', '.join(stand)} FROM latency_history WHERE family = '{family}'",
    )
    def view(spark, sf):
        values = staged(parts(spark, sf)[family], "family-latencies")
        # Only this family's history is needed.
        own = L.latency_values({family: values})
        out = L.family_view(family, values, history(spark, sf, own), last_ship(spark, sf, hours=12))
        return out.withColumn("latency_us", F.round("latency_us", 0))


_view("server_log", "h19_server_log_view", "server_log_l", ["message_id"], False)
_view("logline", "h19_logline_view", "logline_l", ["logline_id"], True)
_view("batch", "h19_batch_view", "batch_l", ["instance_name", "batch_id"], True)
_view("suspicious_batch", "h19_suspicious_view", "suspicious_l", ["instance_name", "suspicious_batch_id"], True)
_view("transport", "h19_transport_view", "transport_l", [], True)
_view("roundtrip", "h19_roundtrip_view", "roundtrip_l", ["message_id"], False)


@query(
    "h20_kept_alerts",
    with_(ALERTS) + " SELECT src_ip, alert_timestamp FROM alerts WHERE alert_timestamp >= (SELECT max(ts) + INTERVAL 45 DAY FROM events) - INTERVAL 60 DAY",
)
def kept_alerts(spark, sf):
    return retention.kept_table_rows(tb.alert_rows(spark, sf, with_text=False), "alerts", last_event(spark, sf, days=45))


_TIER_ROWS = " UNION ALL ".join(
    f"SELECT '{t.name}' AS tier, time_bucket(INTERVAL {t.minutes} MINUTE, alert_timestamp) AS time_bucket, src_ip, count(*) AS alert_count "
    f"FROM alerts GROUP BY 1, 2, 3 HAVING time_bucket >= {AS_OF} - INTERVAL {t.to_days} DAY"
    for t in rollups.TIERS
)


@query("h20_kept_tiers", with_(ALERTS) + " " + _TIER_ROWS)
def kept_tiers(spark, sf):
    """What three resolutions still hold once their days have expired."""
    tables = state_tables(f"{checkpoint_root(spark)}/tiers-{uuid.uuid4().hex}")
    alerts = staged(tb.alert_rows(spark, sf, with_text=False).select("src_ip", "alert_timestamp"), "alerts")
    for k in range(2):
        part = alerts.where(F.pmod(F.xxhash64("src_ip", "alert_timestamp"), F.lit(2)) == k)
        for t in rollups.TIERS:
            tables[f"alerts_{t.name}"].add(spark, rollups.alert_rollup(part, t.minutes), k)
    as_of, kept = last_event(spark, sf, days=5), []
    for t in rollups.TIERS:
        tables[f"alerts_{t.name}"].expire(spark, as_of, t.kept)
        kept.append(tables[f"alerts_{t.name}"].read(spark).select(F.lit(t.name).alias("tier"), "time_bucket", "src_ip", "alert_count"))
    return reduce(DataFrame.unionByName, kept)


@query(
    "h20_kept_loglines",
    with_(DNS) + " SELECT CAST(logline_id AS VARCHAR) AS logline_id, ts AS timestamp FROM dns_log WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 1 DAY",
)
def kept_loglines(spark, sf):
    rows = tb.logline_rows(spark, sf).select("logline_id", "timestamp")
    return retention.kept_table_rows(rows, "loglines", last_event(spark, sf))


START, END = dt.datetime(2024, 1, 3, 4, 30, tzinfo=dt.timezone.utc), dt.datetime(2024, 1, 20, 17, 45, tzinfo=dt.timezone.utc)
START_SQL, END_SQL = "TIMESTAMP '2024-01-03 04:30:00'", "TIMESTAMP '2024-01-20 17:45:00'"


def _over_time(name, g, start, end, start_sql, end_sql):
    @query(
        name,
        with_(ALERT_HISTORY) + f""", counted AS (
  SELECT date_trunc('{g}', time_bucket) AS time_bucket, sum(alert_count) AS n FROM history
  WHERE time_bucket >= date_trunc('{g}', {start_sql}) AND time_bucket <= date_trunc('{g}', {end_sql}) GROUP BY 1),
axis AS (SELECT unnest(range(date_trunc('{g}', {start_sql}), date_trunc('{g}', {end_sql}), INTERVAL 1 {g})) AS time_bucket)
SELECT coalesce(a.time_bucket, c.time_bucket) AS time_bucket, CAST(coalesce(c.n, 0) AS BIGINT) AS count FROM axis a FULL JOIN counted c ON a.time_bucket = c.time_bucket""",
    )
    def over_time(spark, sf):
        rows = rollups.alerts_history(tb.alert_rows(spark, sf, with_text=False), last_event(spark, sf, days=5))
        return P.alerts_over_time(rows, start, end)


_over_time("h21_alerts_per_day", "day", START, END, START_SQL, END_SQL)
_over_time(
    "h21_alerts_per_hour", "hour", START, START + dt.timedelta(hours=60), START_SQL, f"({START_SQL} + INTERVAL 60 HOUR)"
)


@query(
    "h22_alerting_clients",
    with_(ALERTS) + f" SELECT count(DISTINCT src_ip) AS clients FROM alerts WHERE alert_timestamp BETWEEN {START_SQL} AND {END_SQL}",
)
def alerting_clients(spark, sf):
    return P.alerting_clients(tb.alert_rows(spark, sf, with_text=False), START, END)


def _cells(cells, test):
    return ", ".join(f"CAST(coalesce(sum(alert_count) FILTER (WHERE {test} = {k}), 0) AS BIGINT) AS \"{v}\"" for k, v in cells.items())


def _heat(name, g, cells, test, low, high, upper, fn, plus):
    @query(
        name,
        with_(ALERT_HISTORY if plus else ALERT_HISTORY.replace("INTERVAL 5 DAY", "INTERVAL 0 DAY")) + f""",
axis AS (SELECT unnest(range({low}, {high}, INTERVAL 1 {g})) AS time),
cells AS (SELECT time_bucket, alert_count FROM history WHERE time_bucket >= {low} AND {upper})
SELECT coalesce(a.time, date_trunc('{g}', c.time_bucket)) AS time, {_cells(cells, test)}
FROM axis a FULL JOIN cells c ON a.time = date_trunc('{g}', c.time_bucket) GROUP BY 1""",
    )
    def heat(spark, sf):
        as_of = last_event(spark, sf, days=plus)
        return fn(rollups.alerts_history(tb.alert_rows(spark, sf, with_text=False), as_of), as_of)


_NOW0 = "(SELECT max(ts) FROM events)"
_heat("h23_month_by_day", "month", {d: d for d in range(1, 32)}, "day(time_bucket)", f"date_trunc('month', {AS_OF} - INTERVAL 90 DAY)",
      f"date_trunc('month', {AS_OF})", f"time_bucket < date_trunc('month', {AS_OF})", P.month_by_day, 5)
_heat("h24_day_by_hour", "day", {h: h for h in range(24)}, "hour(time_bucket)", f"date_trunc('month', {AS_OF} - INTERVAL 1 MONTH)::TIMESTAMP",
      f"date_trunc('month', {AS_OF})::TIMESTAMP", f"time_bucket < date_trunc('month', {AS_OF})", P.day_by_hour, 5)
_heat("h25_hour_by_quarter", "hour", {0: 0, 1: 15, 2: 30, 3: 45}, "minute(time_bucket) // 15", f"date_trunc('hour', {_NOW0} - INTERVAL 1 DAY)",
      f"date_trunc('hour', {_NOW0})", f"time_bucket <= {_NOW0}", P.hour_by_quarter, 0)


ALERT_ROWS = DNS + r""",
failed AS (SELECT *, '"' || domain_name || '"' AS q FROM dns_log WHERE status_code = 'NXDOMAIN'),
alert_rows AS (
  SELECT logline_id, src_ip, ts AS alert_timestamp, CAST(logline_id AS VARCHAR) AS suspicious_batch_id,
    least(1.0, CAST(replace(size, 'b', '') AS DOUBLE) / 500) AS overall_score, domain_name,
    CASE logline_id % 3 WHEN 0 THEN [domain_name, 'x.' || domain_name] WHEN 1 THEN [domain_name, 'y.' || domain_name] ELSE [domain_name] END AS domain_list,
    CASE WHEN logline_id % 5 = 0 THEN 'rf, tunnel' ELSE 'rf' END AS detector_names
  FROM failed
)"""


@query(
    "h26_latest_alerts",
    with_(ALERT_ROWS) + " SELECT src_ip, array_to_string(domain_list, ', ') AS domains FROM alert_rows ORDER BY alert_timestamp DESC, suspicious_batch_id LIMIT 20",
)
def latest_alerts(spark, sf):
    return P.latest_alerts(tb.alert_rows(spark, sf), tie=("suspicious_batch_id",))


@query("h26_all_alert_domains", with_(ALERT_ROWS) + " SELECT suspicious_batch_id, array_to_string(domain_list, ', ') AS domains FROM alert_rows")
def all_domains(spark, sf):
    """The domain parser over every alert."""
    rows = tb.alert_rows(spark, sf)
    return rows.select("suspicious_batch_id", F.array_join(P.listed_domains(F.col("domain_names")), ", ").alias("domains"))


@query(
    "h27_top_clients",
    with_(DNS, ALERTS) + f""", counts AS (SELECT src_ip, count(*) AS alert_count FROM alerts WHERE alert_timestamp BETWEEN {START_SQL} AND {END_SQL} GROUP BY 1),
requests AS (SELECT src_ip, count(*) AS n FROM dns_log GROUP BY 1)
SELECT CAST(row_number() OVER (ORDER BY alert_count DESC, c.src_ip) AS VARCHAR) || '.' AS rank, c.src_ip, alert_count, coalesce(r.n, 0) AS total_requests
FROM counts c LEFT JOIN requests r ON c.src_ip = r.src_ip ORDER BY alert_count DESC, c.src_ip LIMIT 5""",
)
def top_clients(spark, sf):
    return P.top_clients(tb.alert_rows(spark, sf, with_text=False), tb.logline_rows(spark, sf), START, END)


@query(
    "h28_alert_search",
    with_(ALERT_ROWS) + f""" SELECT alert_timestamp, src_ip, suspicious_batch_id, round(overall_score, 4) AS score, detector_names, array_to_string(domain_list, ', ') AS domains
FROM alert_rows WHERE alert_timestamp BETWEEN {START_SQL} AND {END_SQL} AND contains(src_ip, '168.1') AND contains(lower(array_to_string(domain_list, ', ')), '.com')
  AND contains(detector_names, 'tunnel') ORDER BY alert_timestamp DESC, suspicious_batch_id LIMIT 500""",
)
def alert_search(spark, sf):
    return P.search_alerts(
        tb.alert_rows(spark, sf), START, END, ip="168.1", domain=".COM", detector="Tunnel", tie=("suspicious_batch_id",)
    )


@query(
    "h29_detector_outputs",
    with_(ALERT_ROWS) + f""", outputs AS (
  SELECT *, CASE WHEN logline_id % 2 = 0 THEN 'dga' ELSE 'rf' END AS detector_name, CAST(logline_id % 100 AS DOUBLE) AS score, 'malicious' AS predicted_class,
    '["' || domain_name || '"]' AS detector_domains, '["' || CAST(logline_id AS VARCHAR) || '"]' AS logline_ids, '"' || domain_name || '"' AS request_raw FROM alert_rows
  UNION ALL SELECT *, 'tunnel', CAST(logline_id % 10 AS DOUBLE), '', '', '', '' FROM alert_rows WHERE logline_id % 5 = 0)
SELECT alert_timestamp, src_ip, suspicious_batch_id, detector_name, score, predicted_class, '' AS class_output, detector_domains, logline_ids, '' AS server_message_ids, request_raw
FROM outputs WHERE alert_timestamp BETWEEN {START_SQL} AND {END_SQL}""",
)
def detector_outputs(spark, sf):
    out = P.detector_outputs(tb.alert_rows(spark, sf), START, END, rows=None)
    return out.drop("raw_detector_output")


@query(
    "h29_detector_search",
    with_(ALERT_ROWS) + f""", outputs AS (SELECT *, 'tunnel' AS detector_name, CAST(logline_id % 10 AS DOUBLE) AS score FROM alert_rows WHERE logline_id % 5 = 0)
SELECT alert_timestamp, src_ip, suspicious_batch_id, detector_name, score FROM outputs WHERE alert_timestamp BETWEEN {START_SQL} AND {END_SQL}
  AND contains(array_to_string(domain_list, ', '), '.net') ORDER BY alert_timestamp DESC, score DESC, suspicious_batch_id LIMIT 500""",
)
def detector_search(spark, sf):
    out = P.detector_outputs(tb.alert_rows(spark, sf), START, END, domain=".NET", detector="TUNNEL", tie=("suspicious_batch_id",))
    return out.select("alert_timestamp", "src_ip", "suspicious_batch_id", "detector_name", "score")


@query(
    "h30_confusion",
    """WITH d AS (SELECT replace(regexp_extract(url, '://([^/?#:]+)', 1), '.example.', '.') AS query, min(page_id) AS first_page FROM pages GROUP BY 1)
SELECT CASE WHEN len(string_split(query, '.')) = 2 THEN 'legit' ELSE 'family_' || CAST(first_page % 3 AS VARCHAR) END AS class,
  CASE WHEN length(query) < 14 THEN 'legit' ELSE 'family_' || CAST(length(query) % 3 AS VARCHAR) END AS predicted_class, count(*) AS n FROM d GROUP BY 1, 2""",
)
def confusion(spark, sf):
    truth = tb.labelled_domains(spark, sf)
    size = F.length("query")
    predicted = truth.select(
        "query", F.when(size < 14, "legit").otherwise(F.concat(F.lit("family_"), (size % 3).cast("string"))).alias("predicted_class")
    )
    return P.confusion(truth.select("query", "class"), predicted, "query")
