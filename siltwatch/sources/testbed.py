"""DNS logs and monitoring tables derived from the given test tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwatch.functions.network import subnet_v4
from siltwatch.functions.rules import LogFormat
from siltwatch.operators.validation import additional_fields, valid_lines
from siltwatch.session import prepare
from siltwatch.sources.staging import spread, staged

TIME_FORMAT = "%Y-%m-%dT%H:%M:%S.%f"

# The log format of a DNS collector.
DNS_FORMAT = LogFormat.parse(
    [
        ["ts", "Timestamp", TIME_FORMAT],
        ["status_code", "ListItem", ["NOERROR", "NXDOMAIN"], ["NXDOMAIN"]],
        ["src_ip", "IpAddress"],
        ["dns_server_ip", "IpAddress"],
        ["domain_name", "RegEx", r"^(?=.{1,253}$)((?!-)[A-Za-z0-9-]{1,63}(?<!-)\.)+[A-Za-z]{2,63}$"],
        ["record_type", "ListItem", ["A", "AAAA"]],
        ["size", "RegEx", r"^\d+$"],
    ]
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def host(url: Column) -> Column:
    return F.replace(F.regexp_extract(url, r"://([^/?#:]+)", 1), F.lit(".example."), F.lit("."))


def text(col: Column) -> Column:
    return col.cast("string")


def client_ip(user: Column) -> Column:
    return F.concat(F.lit("192.168."), text(user % 4), F.lit("."), text(user % 254 + 1))


def dns_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DNS log lines, some broken on purpose, with their JSON text in ``raw``.

    Events are joined to pages by number; the page count is read from the file
    footers.
    """
    events = table(spark, sf_dir, "events")
    pages = table(spark, sf_dir, "pages")
    n_pages = pages.count()
    hosts = pages.select("page_id", host(F.col("url")).alias("host"))
    eid = F.col("event_id")
    ts_text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    spaced = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    joined = events.withColumn("page_id", eid % n_pages).join(hosts, "page_id")
    lines = joined.select(
        eid.alias("logline_id"),
        "ts",
        F.when(eid % 13 == 0, spaced).otherwise(ts_text).alias("ts_text"),
        F.when(F.col("event_type") == "error", "NXDOMAIN")
        .when(F.col("event_type") == "signup", "SERVFAIL")
        .otherwise("NOERROR")
        .alias("status_code"),
        client_ip(F.col("user_id")).alias("src_ip"),
        F.concat(F.lit("10.10.0."), F.when(eid % 17 == 0, "300").otherwise(text(eid % 10 + 1))).alias("dns_server_ip"),
        F.concat(F.when(eid % 19 == 0, "-").otherwise(""), F.col("host")).alias("domain_name"),
        F.when(eid % 7 == 0, "CNAME").when(eid % 2 == 0, "A").otherwise("AAAA").alias("record_type"),
        F.concat(text(F.floor("value").cast("bigint")), F.when(eid % 11 == 0, "b").otherwise("")).alias("size"),
    )
    fields = [F.col("ts_text").alias("ts"), "status_code", "src_ip", "dns_server_ip", "domain_name", "record_type", "size"]
    return spread(lines, events, "logline_id").withColumn("raw", F.to_json(F.struct(*fields)))


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines as they arrive: id and JSON text."""
    return dns_log(spark, sf_dir).select("logline_id", "raw")


def valid_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid lines with their subnet, parsed back from the JSON text."""
    lines = valid_lines(raw_lines(spark, sf_dir), DNS_FORMAT)
    return lines.withColumn("subnet_id", subnet_v4(F.col("src_ip"))).drop("raw")


def stored_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid lines as a written table, for plans that read them more than once."""
    return staged(valid_log(spark, sf_dir), "loglines")


def tunnel_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored lines, every third with a hashed label in front, as a tunnel sends."""
    lid = F.col("logline_id")
    hashed = F.substring(F.md5(text(lid)), F.lit(1), (lid % 9 + 4).cast("int"))
    name = F.when(lid % 3 == 0, F.concat(hashed, F.lit("."), F.col("domain_name"))).otherwise(F.col("domain_name"))
    return stored_log(spark, sf_dir).withColumn("domain_name", name)


def server_logs(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("message_id"), F.col("o_orderdate").alias("timestamp_in")
    )


def server_logs_timestamps(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("message_id"),
        F.when(F.col("l_linenumber") % 2 == 1, "timestamp_out").otherwise("other").alias("event"),
        F.col("l_shipdate").alias("event_timestamp"),
    )


def _stage() -> Column:
    return (
        F.when(F.col("l_linestatus") == "O", "log_collection.batch_handler")
        .otherwise("log_filtering.prefilter")
        .alias("stage")
    )


def _status() -> Column:
    return (
        F.when(F.col("l_returnflag") == "A", "in_process")
        .when(F.col("l_returnflag") == "N", "finished")
        .otherwise("filtered_out")
        .alias("status")
    )


def logline_timestamps(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("logline_id"),
        _stage(),
        _status(),
        F.col("l_shipdate").alias("timestamp"),
        (F.col("l_returnflag") != "R").alias("is_active"),
    )


def server_log_to_logline(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("message_id"),
        F.col("o_orderkey").alias("logline_id"),
        F.col("o_orderdate").alias("timestamp"),
    )


def terminal_events(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(
        F.col("o_orderkey").alias("message_id"),
        F.lit("alerting.alerter").alias("stage"),
        F.lit("processed").alias("status"),
        (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("timestamp"),
    )


def batch_timestamps(spark, sf_dir, id_name: str = "batch_id") -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias(id_name),
        text(F.col("l_suppkey")).alias("instance_name"),
        _stage(),
        _status(),
        F.col("l_shipdate").alias("timestamp"),
        F.col("l_linenumber").cast("bigint").alias("message_count"),
        (F.col("l_returnflag") != "R").alias("is_active"),
    )


def suspicious_batch_timestamps(spark, sf_dir) -> DataFrame:
    return batch_timestamps(spark, sf_dir, "suspicious_batch_id")


def batch_tree(spark, sf_dir) -> DataFrame:
    """Lineage rows of conversations: a turn is the child of the turn before."""
    turn = F.col("turn")
    stage = (
        F.when(turn == 0, "log_collection.batch_handler")
        .when(turn == 1, "log_filtering.prefilter")
        .when(turn == 2, "log_filtering.prefilter")
        .when(turn == 3, "data_inspection.inspector")
        .when(turn == 4, "data_inspection.inspector")
        .otherwise("data_analysis.detector")
    )
    status = F.when(turn == 0, "completed").when(turn % 2 == 1, "in_process").otherwise("finished")
    at = F.lit(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc))
    return table(spark, sf_dir, "conversations").select(
        F.concat(text(F.col("conv_id")), F.lit("-"), text(turn)).alias("batch_row_id"),
        text(F.col("conv_id")).alias("batch_id"),
        F.when(turn == 0, "").otherwise(F.concat(text(F.col("conv_id")), F.lit("-"), text(turn - 1))).alias(
            "parent_batch_row_id"
        ),
        stage.alias("stage"),
        status.alias("status"),
        F.timestamp_add("SECOND", F.col("conv_id") * 60 + turn * turn, at).alias("timestamp"),
    )


def fill_level_rows(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("ts").alias("timestamp"),
        F.col("event_type").alias("stage"),
        F.lit("total_loglines").alias("entry_type"),
        F.floor("value").cast("bigint").alias("entry_count"),
    )


def alert_rows(spark, sf_dir, with_text: bool = True) -> DataFrame:
    """Alerts: one per failed lookup; names and results as JSON text.

    Names come in the three shapes readers must accept: text, object, list.
    """
    if not with_text:
        return table(spark, sf_dir, "events").filter("event_type = 'error'").select(
            client_ip(F.col("user_id")).alias("src_ip"), F.col("ts").alias("alert_timestamp")
        )
    log = dns_log(spark, sf_dir).filter("status_code = 'NXDOMAIN'")
    name, lid = F.col("domain_name"), F.col("logline_id")
    q = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    names = F.concat(
        F.lit("["), q(name), F.lit(","),
        F.when(lid % 3 == 0, F.concat(F.lit('{"domain_name":'), q(F.concat(F.lit("x."), name)), F.lit("}")))
        .when(lid % 3 == 1, F.concat(F.lit("["), q(F.concat(F.lit("y."), name)), F.lit(","), q(name), F.lit("]")))
        .otherwise(F.lit('""')),
        F.lit("]"),
    )
    score = F.least(F.lit(1.0), F.regexp_replace("size", "b", "").cast("double") / 500)
    first = F.concat(
        F.lit('{"detector_name":"'), F.when(lid % 2 == 0, "dga").otherwise(""),
        F.lit('","name":"rf","score":'), text(lid % 100), F.lit(',"predicted_class":"malicious","domains":['), q(name),
        F.lit('],"logline_ids":["'), text(lid), F.lit('"],"request":"'), name, F.lit('"}'),
    )
    second = F.concat(F.lit('{"name":"tunnel","probability":'), text(lid % 10), F.lit("}"))
    result = F.concat(F.lit("["), first, F.when(lid % 5 == 0, F.concat(F.lit(","), second)).otherwise(""), F.lit("]"))
    return log.select(
        "src_ip",
        F.col("ts").alias("alert_timestamp"),
        text(lid).alias("suspicious_batch_id"),
        score.alias("overall_score"),
        names.alias("domain_names"),
        result.alias("result"),
    )


def logline_rows(spark, sf_dir) -> DataFrame:
    log = dns_log(spark, sf_dir)
    return log.select(
        text(F.col("logline_id")).alias("logline_id"),
        F.col("ts").alias("timestamp"),
        subnet_v4(F.col("src_ip")).alias("subnet_id"),
        "src_ip",
        additional_fields(F.col("raw")).alias("additional_fields"),
    )


def labelled_domains(spark, sf_dir) -> DataFrame:
    """Distinct hosts with a class: two labels are legit, others one of three families."""
    pages = table(spark, sf_dir, "pages").select("page_id", host(F.col("url")).alias("query"))
    first = pages.groupBy("query").agg(F.min("page_id").alias("first_page"))
    two = F.size(F.split("query", r"\.")) == 2
    family = F.concat(F.lit("family_"), text(F.col("first_page") % 3))
    return first.select("query", F.when(two, "legit").otherwise(family).alias("class"), "first_page")


def evaluation_pairs(spark, sf_dir) -> DataFrame:
    """Truth and prediction: toxicity against low quality."""
    return table(spark, sf_dir, "labels").select(
        "doc_id", F.col("toxic").cast("int").alias("y"), (1 - F.col("quality")).cast("int").alias("y_pred")
    )


def user_domain_lines(spark, sf_dir) -> DataFrame:
    """All lines as (user, query, class) for the training form of tunnel features."""
    log = dns_log(spark, sf_dir)
    two = F.size(F.split("domain_name", r"\.")) == 2
    return log.select(
        "logline_id", "ts", F.col("src_ip").alias("user"), F.col("domain_name").alias("query"),
        F.when(two, "legit").otherwise("malicious").alias("class"),
    )
