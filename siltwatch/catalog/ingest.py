"""Queries: ingest, validation, keying and batching."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltwatch.catalog.registry import query
from siltwatch.catalog.views import DNS, batches, with_
from siltwatch.functions.network import is_ipv4, subnet_v4, subnet_v6
from siltwatch.operators import batching as B
from siltwatch.operators import filtering, routing
from siltwatch.operators import validation as V
from siltwatch.sources import testbed as tb

# Sparse test events: small batches over long windows.
SPEC = B.BatchSpec(size=40, seconds=86_400, slot_seconds=3600)
BATCHES = batches(40, 86_400)
COLLECTORS = [("dns", "dga_collector"), ("dns", "tunnel_collector"), ("http", "web_collector")]


def parsed(spark, sf):
    return V.parse_lines(tb.raw_lines(spark, sf), tb.DNS_FORMAT)


def assigned(spark, sf):
    return B.assign_batches(tb.stored_log(spark, sf), SPEC)


@query(
    "subnet_minute_health",
    with_(DNS) + """
SELECT split_part(src_ip, '.', 1) || '.' || split_part(src_ip, '.', 2) || '.' || split_part(src_ip, '.', 3) || '.0_24' AS subnet_id,
  date_trunc('minute', ts) AS minute, count(*) AS n_lines,
  count(*) FILTER (WHERE NOT (ok_ts AND ok_status_code AND ok_src_ip AND ok_dns_server_ip AND ok_domain_name AND ok_record_type AND ok_size)) AS n_failed,
  count(*) FILTER (WHERE status_code = 'NXDOMAIN') AS n_nxdomain
FROM checked GROUP BY 1, 2""",
)
def subnet_minute_health(spark, sf):
    """Lines, failed lines and failed lookups per subnet and minute."""
    lines = V.parse_lines(tb.dns_log(spark, sf).select("ts", "raw"), tb.DNS_FORMAT)
    return lines.groupBy(
        subnet_v4(F.col("fields.src_ip")).alias("subnet_id"), F.date_trunc("minute", "ts").alias("minute")
    ).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(F.size("failed_fields") > 0).alias("n_failed"),
        F.count_if(F.col("fields.status_code") == "NXDOMAIN").alias("n_nxdomain"),
    )


@query(
    "a3_protocol_fanout",
    """
SELECT e.event_id AS logline_id, r.protocol, r.collector
FROM events e JOIN (VALUES ('dns', 'dga_collector'), ('dns', 'tunnel_collector'), ('http', 'web_collector')) r(protocol, collector)
  ON r.protocol = CASE WHEN e.event_type IN ('click', 'view') THEN 'http' ELSE 'dns' END""",
)
def protocol_fanout(spark, sf):
    """Every line to each collector of its protocol."""
    logs = tb.table(spark, sf, "events").select(
        F.col("event_id").alias("logline_id"),
        F.when(F.col("event_type").isin("click", "view"), "http").otherwise("dns").alias("protocol"),
    )
    return routing.fan_out(logs, routing.route_table(spark, COLLECTORS), "protocol", "collector").select(
        "logline_id", "protocol", "collector"
    )


_REASON = " || ".join(
    f"CASE WHEN ok_{f} THEN '' ELSE ',{f}' END"
    for f in ("ts", "status_code", "src_ip", "dns_server_ip", "domain_name", "record_type", "size")
)
_RAW = (
    "'{\"ts\":\"' || ts_text || '\",\"status_code\":\"' || status_code || '\",\"src_ip\":\"' || src_ip || '\",\"dns_server_ip\":\"' "
    "|| dns_server_ip || '\",\"domain_name\":\"' || domain_name || '\",\"record_type\":\"' || record_type || '\",\"size\":\"' || size || '\"}'"
)


@query(
    "a13_dead_letters",
    with_(DNS) + f"""
SELECT logline_id, {_RAW} AS message_text, substr({_REASON}, 2) AS reason_for_failure
FROM checked WHERE length({_REASON}) > 0""",
)
def dead_letters(spark, sf):
    """Invalid lines with the fields that failed."""
    return V.failed_lines(parsed(spark, sf))


@query(
    "a13_failed_terminal_events",
    with_(DNS) + f"""
SELECT CAST(logline_id AS VARCHAR) AS message_id, 'log_collection.collector' AS stage, 'failed' AS status, ts AS timestamp
FROM checked WHERE length({_REASON}) > 0""",
)
def failed_events(spark, sf):
    lines = V.parse_lines(tb.dns_log(spark, sf).select("logline_id", F.col("ts").alias("at"), "raw"), tb.DNS_FORMAT)
    return V.failed_terminal_events(V.failed_lines(lines), "logline_id", F.col("at"))


@query("b2_regex_domain", with_(DNS) + " SELECT logline_id, domain_name, ok_domain_name AS is_valid FROM checked")
def regex_domain(spark, sf):
    test = tb.DNS_FORMAT.rule("domain_name").test(F.col("domain_name"))
    return tb.dns_log(spark, sf).select("logline_id", "domain_name", test.alias("is_valid"))


@query(
    "b3_timestamp",
    with_(DNS) + " SELECT logline_id, try_strptime(ts_text, '%Y-%m-%dT%H:%M:%S.%f') AS parsed_ts, ok_ts AS is_valid FROM checked",
)
def timestamp_format(spark, sf):
    rule = tb.DNS_FORMAT.rule("ts")
    return tb.dns_log(spark, sf).select(
        "logline_id", rule.parse(F.col("ts_text")).alias("parsed_ts"), rule.test(F.col("ts_text")).alias("is_valid")
    )


@query("b4_ipv4", with_(DNS) + " SELECT logline_id, dns_server_ip, ok_dns_server_ip AS is_valid FROM checked")
def ipv4(spark, sf):
    return tb.dns_log(spark, sf).select("logline_id", "dns_server_ip", is_ipv4(F.col("dns_server_ip")).alias("is_valid"))


@query("b5_list_item", with_(DNS) + " SELECT logline_id, record_type, ok_record_type AS is_valid FROM checked")
def list_item(spark, sf):
    test = tb.DNS_FORMAT.rule("record_type").test(F.col("record_type"))
    return tb.dns_log(spark, sf).select("logline_id", "record_type", test.alias("is_valid"))


@query("b6_all_rules", with_(DNS) + f" SELECT logline_id, length({_REASON}) = 0 AS is_valid FROM checked")
def all_rules(spark, sf):
    return parsed(spark, sf).select("logline_id", (F.size("failed_fields") == 0).alias("is_valid"))


@query(
    "b8_additional_fields",
    with_(DNS) + """
SELECT logline_id, '{"status_code":"' || status_code || '","dns_server_ip":"' || dns_server_ip || '","domain_name":"' || domain_name
  || '","record_type":"' || record_type || '","size":"' || size || '"}' AS additional_fields FROM dns_log""",
)
def split_fields(spark, sf):
    """Everything but time and client, as JSON."""
    return tb.raw_lines(spark, sf).select("logline_id", V.additional_fields(F.col("raw")).alias("additional_fields"))


@query("c1_subnet_v4", with_(DNS) + " SELECT logline_id, src_ip, subnet_id FROM valid_log")
def subnet_key(spark, sf):
    return tb.valid_log(spark, sf).select("logline_id", "src_ip", "subnet_id")


@query(
    "c2_subnet_v6",
    """SELECT event_id, printf('2001:db8:%x:0:0:%x::1', event_id % 65535 + 1, user_id % 4095 + 1) AS address,
  printf('2001:db8:%x::_64', event_id % 65535 + 1) AS net_64, printf('2001:db8:%x::%x:0:0_96', event_id % 65535 + 1, user_id % 4095 + 1) AS net_96
FROM events""",
)
def subnet_key_v6(spark, sf):
    """Networks of addresses made from the events' ids."""
    wide = lambda c, n: F.lower(F.hex(F.col(c) % n + 1))
    address = F.concat(F.lit("2001:db8:"), wide("event_id", 65535), F.lit(":0:0:"), wide("user_id", 4095), F.lit("::1"))
    rows = tb.table(spark, sf, "events").select("event_id", address.alias("address"))
    return rows.select("event_id", "address", subnet_v6(F.col("address"), 64).alias("net_64"), subnet_v6(F.col("address"), 96).alias("net_96"))


@query(
    "c1_subnet_v4_prefix18",
    with_(DNS) + """
SELECT logline_id, dns_server_ip,
  '10.10.' || CAST(0 AS VARCHAR) || '.0_18' AS dns_net,
  '192.168.' || CAST(CAST(split_part(src_ip, '.', 3) AS INTEGER) & 254 AS VARCHAR) || '.0_23' AS client_net
FROM valid_log""",
)
def subnet_prefixes(spark, sf):
    """Prefixes that cut through an octet."""
    return tb.valid_log(spark, sf).select(
        "logline_id",
        "dns_server_ip",
        subnet_v4(F.col("dns_server_ip"), 18).alias("dns_net"),
        subnet_v4(F.col("src_ip"), 23).alias("client_net"),
    )


@query(
    "c4_size_batches",
    with_(DNS) + """
SELECT logline_id, subnet_id, CAST((row_number() OVER (PARTITION BY subnet_id ORDER BY ts, logline_id) - 1) // 40 AS BIGINT) AS batch_no
FROM valid_log""",
)
def size_batches(spark, sf):
    return B.size_batches(tb.stored_log(spark, sf), 40, slot_seconds=86_400).select("logline_id", "subnet_id", "batch_no")


@query(
    "c5_time_batches",
    with_(DNS) + """
SELECT subnet_id, time_bucket(INTERVAL '6 hours', ts) AS window_start, count(*) AS n_lines, min(ts) AS begin_ts, max(ts) AS end_ts
FROM valid_log GROUP BY 1, 2""",
)
def time_batches(spark, sf):
    return B.time_batches(tb.valid_log(spark, sf), 6 * 3600)


@query(
    "c6_batch_order",
    with_(DNS, BATCHES) + """
SELECT batch_id, logline_id, row_number() OVER (PARTITION BY batch_id ORDER BY is_buffer DESC, ts, logline_id) AS position FROM sent_lines""",
)
def batch_order(spark, sf):
    """Buffer first, then new lines, each in time order."""
    sent = B.carry_over(assigned(spark, sf), SPEC)
    return sent.select("batch_id", "logline_id", F.col("position").cast("bigint").alias("position"))


@query("c7_carry_over", with_(DNS, BATCHES) + " SELECT batch_id, logline_id, ts, is_buffer FROM sent_lines")
def carry_over(spark, sf):
    return B.carry_over(assigned(spark, sf), SPEC).select("batch_id", "logline_id", "ts", "is_buffer")


@query(
    "c9_batch_bounds",
    with_(DNS, BATCHES) + " SELECT batch_id, subnet_id, begin_ts, end_ts, n_buffer, n_new FROM bounds",
)
def batch_bounds(spark, sf):
    return B.batch_bounds(assigned(spark, sf), SPEC).select(
        "batch_id", "subnet_id", "begin_ts", "end_ts", "n_buffer", "n_new"
    )


@query(
    "c10_line_to_batch",
    with_(DNS, BATCHES) + """
SELECT logline_id, subnet_id || '#' || CAST(flush_no AS VARCHAR) || '#' || CAST(part AS VARCHAR) AS batch_id, ts AS timestamp FROM assigned""",
)
def line_to_batch(spark, sf):
    return B.line_to_batch(assigned(spark, sf))


@query(
    "c11_fill_levels",
    with_(DNS, BATCHES) + """
SELECT e.max_ts AS timestamp, 'log_collection.batch_handler' AS stage, 'total_loglines_in_batches' AS entry_type, count(*) AS entry_count
FROM sent_lines, (SELECT max(ts) AS max_ts FROM events) e GROUP BY 1""",
)
def fill_levels(spark, sf):
    sent = B.carry_over(assigned(spark, sf), SPEC)
    last = tb.table(spark, sf, "events").agg(F.max("ts")).first()[0]
    return B.fill_levels(sent, "log_collection.batch_handler", "total_loglines_in_batches", F.lit(last))


@query("d1_relevance_listed", with_(DNS) + " SELECT logline_id, subnet_id FROM valid_log WHERE status_code = 'NXDOMAIN'")
def relevance_listed(spark, sf):
    return filtering.keep_relevant(tb.valid_log(spark, sf), "check_dga_relevance", tb.DNS_FORMAT).select("logline_id", "subnet_id")


@query("d2_relevance_all", with_(DNS) + " SELECT logline_id, subnet_id FROM valid_log")
def relevance_all(spark, sf):
    return filtering.keep_relevant(tb.valid_log(spark, sf), "no_relevance_check", tb.DNS_FORMAT).select("logline_id", "subnet_id")


@query(
    "d4_filtered_out_events",
    with_(DNS, BATCHES) + """
SELECT CAST(logline_id AS VARCHAR) AS logline_id, 'log_filtering.prefilter' AS stage, 'filtered_out' AS status, ts AS timestamp, FALSE AS is_active
FROM sent_lines WHERE status_code <> 'NXDOMAIN'""",
)
def filtered_out(spark, sf):
    sent = B.carry_over(assigned(spark, sf), SPEC)
    return filtering.filtered_out_events(sent, "check_dga_relevance", tb.DNS_FORMAT, F.col("ts"))


@query(
    "d5_nonempty_batches",
    with_(DNS, BATCHES) + " SELECT batch_id, count(*) AS n_kept FROM sent_lines WHERE status_code = 'NXDOMAIN' GROUP BY batch_id",
)
def nonempty_batches(spark, sf):
    """Batches that still hold lines after the filter."""
    sent = B.carry_over(assigned(spark, sf), SPEC)
    kept = filtering.keep_relevant(sent, "check_dga_relevance", tb.DNS_FORMAT)
    return kept.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n_kept"))


@query(
    "d6_batch_status",
    with_(DNS, BATCHES) + """,
counts AS (SELECT batch_id, count(*) AS n_in, count(*) FILTER (WHERE status_code = 'NXDOMAIN') AS n_out FROM sent_lines GROUP BY 1)
SELECT batch_id, 'dga_filter' AS instance_name, 'log_filtering.prefilter' AS stage, 'in_process' AS status, n_in AS message_count, TRUE AS is_active FROM counts
UNION ALL
SELECT batch_id, 'dga_filter', 'log_filtering.prefilter', 'finished', n_out, TRUE FROM counts WHERE n_out > 0""",
)
def batch_status(spark, sf):
    sent = B.carry_over(assigned(spark, sf), SPEC)
    from siltwatch.functions.rules import relevance_predicate

    return filtering.batch_status_events(sent, relevance_predicate("check_dga_relevance", tb.DNS_FORMAT), "dga_filter")
