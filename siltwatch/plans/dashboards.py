"""Dashboard reports over alerts and their history."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


# Rows a report shows.
LATEST = 20
TOP_CLIENTS = 5
SEARCH_ROWS = 500


def granularity(start: dt.datetime, end: dt.datetime) -> str:
    """Bucket of a time range: second, minute, hour or day."""
    # Differences count crossed boundaries, not elapsed time.
    minutes = int(end.timestamp() // 60 - start.timestamp() // 60)
    hours = int(end.timestamp() // 3600 - start.timestamp() // 3600)
    if minutes <= 5:
        return "second"
    if hours <= 6:
        return "minute"
    return "hour" if hours <= 72 else "day"


def _axis(spark: SparkSession, low: Column, high: Column, step: str, include_end: bool, name: str) -> DataFrame:
    """Every bucket start of a range, built from literals."""
    one = spark.range(1).select(low.alias("lo"), high.alias("hi"))
    out = one.select(F.explode(F.sequence("lo", "hi", F.expr(f"INTERVAL 1 {step}"))).alias(name), "hi")
    return (out if include_end else out.filter(F.col(name) < F.col("hi"))).select(name)


def alerts_over_time(history: DataFrame, start: dt.datetime, end: dt.datetime) -> DataFrame:
    """Alert counts per bucket of an adaptive width, gaps filled with 0.

    The fill stops before the end's bucket; that bucket shows when it has alerts.
    """
    g = granularity(start, end)
    low, high = F.date_trunc(g, F.lit(start)), F.date_trunc(g, F.lit(end))
    counted = (
        history.filter((F.col("time_bucket") >= low) & (F.col("time_bucket") <= high))
        .groupBy(F.date_trunc(g, "time_bucket").alias("time_bucket"))
        .agg(F.sum("alert_count").alias("count"))
    )
    return _fill(history.sparkSession, counted, low, high, g, "time_bucket", ["count"])


def _fill(spark, counted: DataFrame, low: Column, high: Column, step: str, time: str, values: Sequence[str]) -> DataFrame:
    """Add zero rows for missing buckets: a few literal rows stacked and summed."""
    zero = F.lit(0).cast("bigint")
    gaps = _axis(spark, low, high, step, False, time).select(time, *[zero.alias(v) for v in values])
    sums = [F.sum(F.col(f"`{v}`")).alias(v) for v in values]
    return counted.select(time, *[F.col(f"`{v}`") for v in values]).unionByName(gaps).groupBy(time).agg(*sums)


def alerting_clients(alerts: DataFrame, start: dt.datetime, end: dt.datetime, approximate: bool = False) -> DataFrame:
    """Number of distinct clients with alerts in a range, both ends included."""
    rows = alerts.filter(F.col("alert_timestamp").between(F.lit(start), F.lit(end)))
    count = F.approx_count_distinct("src_ip") if approximate else F.count_distinct("src_ip")
    return rows.agg(count.alias("clients"))


def _heat_map(rows: DataFrame, low: Column, fill_to: Column, row: str, cell: Column, cells: dict) -> DataFrame:
    """Alert sums per row bucket and cell; every row bucket up to ``fill_to`` is present."""
    small = rows.groupBy(F.date_trunc(row, "time_bucket").alias("time"), cell.alias("cell")).agg(
        F.sum("alert_count").alias("n")
    )
    zero = F.lit(0).cast("bigint")
    sums = [F.coalesce(F.sum(F.when(F.col("cell") == k, F.col("n"))), zero).alias(v) for k, v in cells.items()]
    wide = small.groupBy("time").agg(*sums)
    return _fill(rows.sparkSession, wide, low, fill_to, row, "time", list(cells.values()))


def _between(history: DataFrame, low: Column, high: Column) -> DataFrame:
    return history.filter((F.col("time_bucket") >= low) & (F.col("time_bucket") < high))


def month_by_day(history: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Months of the last 90 days, the current one left out, by day."""
    low, high = F.date_trunc("month", F.lit(as_of - dt.timedelta(days=90))), F.date_trunc("month", F.lit(as_of))
    days = {d: str(d) for d in range(1, 32)}
    return _heat_map(_between(history, low, high), low, high, "month", F.dayofmonth("time_bucket"), days)


def day_by_hour(history: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Days of the last whole month by hour."""
    low = F.date_trunc("month", F.lit(as_of) - F.expr("INTERVAL 1 MONTH"))
    high = F.date_trunc("month", F.lit(as_of))
    hours = {h: str(h) for h in range(24)}
    return _heat_map(_between(history, low, high), low, high, "day", F.hour("time_bucket"), hours)


def hour_by_quarter(history: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Hours of the last day by quarter; the current hour shows once it has alerts."""
    low, now = F.date_trunc("hour", F.lit(as_of - dt.timedelta(days=1))), F.lit(as_of)
    rows = history.filter((F.col("time_bucket") >= low) & (F.col("time_bucket") <= now))
    quarters = {0: "0", 1: "15", 2: "30", 3: "45"}
    return _heat_map(rows, low, F.date_trunc("hour", now), "hour", F.floor(F.minute("time_bucket") / 15), quarters)


_TEXTS = "array<string>"


def _entry_name(entry: Column) -> Column:
    """Domain of a JSON list entry: quoted text, object with a name, or as it is."""
    return F.when(entry.startswith('"'), F.regexp_replace(entry, '^"|"$', "")).otherwise(
        F.coalesce(F.get_json_object(entry, "$.domain_name"), entry)
    )


def _raw_items(json: Column) -> Column:
    """Raw JSON text of each item of a JSON array."""
    variants = F.try_variant_get(F.try_parse_json(json), "$", "array<variant>")
    return F.transform(variants, lambda v: F.to_json(v))


def listed_domains(json: Column) -> Column:
    """Distinct non-empty domains of a JSON list of texts, objects or lists."""
    items = F.coalesce(_raw_items(json), F.array().cast(_TEXTS))
    nested = F.transform(items, lambda i: F.when(i.startswith("["), _raw_items(i)).otherwise(F.array(i)))
    names = F.transform(F.flatten(nested), _entry_name)
    return F.array_distinct(F.filter(names, lambda n: n != ""))


def listed_names(json: Column) -> Column:
    """Distinct non-empty detector names of a JSON list of warnings."""
    items = F.coalesce(_raw_items(json), F.array().cast(_TEXTS))
    names = F.transform(items, lambda w: F.coalesce(F.get_json_object(w, "$.name"), F.lit("")))
    return F.array_distinct(F.filter(names, lambda n: n != ""))


def latest_alerts(alerts: DataFrame, tie: Sequence[str] = (), rows: int = LATEST) -> DataFrame:
    """Newest alerts and their domains; only the shown rows are parsed."""
    top = alerts.orderBy(F.desc("alert_timestamp"), *tie).limit(rows)
    return top.select("src_ip", F.array_join(listed_domains(F.col("domain_names")), ", ").alias("domains"))


def top_clients(alerts: DataFrame, loglines: DataFrame, start: dt.datetime, end: dt.datetime, rows: int = TOP_CLIENTS) -> DataFrame:
    """Clients with most alerts, with all their requests.

    The top is cut first; the request count then joins against those few rows.
    """
    counts = (
        alerts.filter(F.col("alert_timestamp").between(F.lit(start), F.lit(end)))
        .groupBy("src_ip")
        .agg(F.count(F.lit(1)).alias("alert_count"))
    )
    top = counts.orderBy(F.desc("alert_count"), "src_ip").limit(rows)
    wanted = loglines.select("src_ip").join(top.select("src_ip"), "src_ip", "left_semi")
    requests = wanted.groupBy("src_ip").agg(F.count(F.lit(1)).alias("total_requests"))
    place = F.row_number().over(Window.orderBy(F.desc("alert_count"), "src_ip"))
    return top.join(requests, "src_ip", "left").select(
        F.concat(place.cast("string"), F.lit(".")).alias("rank"),
        "src_ip",
        "alert_count",
        F.coalesce("total_requests", F.lit(0)).alias("total_requests"),
    )


def _has(text: Column, part: str) -> Column:
    """Case-insensitive substring test; an empty part matches all."""
    return F.contains(F.lower(text), F.lit(part.lower())) if part else F.lit(True)


def search_alerts(
    alerts: DataFrame, start: dt.datetime, end: dt.datetime, ip: str = "", domain: str = "", batch: str = "",
    detector: str = "", tie: Sequence[str] = (), rows: int = SEARCH_ROWS,
) -> DataFrame:
    """Alerts that match all filters, newest first.

    Filters on stored columns come before the JSON is parsed.
    """
    found = alerts.filter(F.col("alert_timestamp").between(F.lit(start), F.lit(end)))
    found = found.filter(_has(F.col("src_ip"), ip) & _has(F.col("suspicious_batch_id"), batch))
    parsed = found.withColumn("domains", F.array_join(listed_domains(F.col("domain_names")), ", ")).withColumn(
        "detector_names", F.array_join(listed_names(F.col("result")), ", ")
    )
    return (
        parsed.filter(_has(F.col("domains"), domain) & _has(F.col("detector_names"), detector))
        .orderBy(F.desc("alert_timestamp"), *tie)
        .limit(rows)
        .select("alert_timestamp", "src_ip", "suspicious_batch_id", F.round("overall_score", 4).alias("score"), "detector_names", "domains")
    )


def detector_outputs(
    alerts: DataFrame, start: dt.datetime, end: dt.datetime, ip: str = "", domain: str = "", batch: str = "",
    detector: str = "", tie: Sequence[str] = (), rows: int | None = SEARCH_ROWS,
) -> DataFrame:
    """One row per stored warning, newest and highest score first."""
    w = F.col("warning")

    def text(name: str) -> Column:
        return F.coalesce(F.get_json_object(w, f"$.{name}"), F.lit(""))

    def raw(*names: str) -> Column:
        parsed = F.try_parse_json(w)
        found = [F.to_json(F.try_variant_get(parsed, f"$.{n}", "variant")) for n in names]
        return F.coalesce(*found, F.lit(""))

    def filled(*names: str) -> Column:
        return F.coalesce(*[F.nullif(F.get_json_object(w, f"$.{n}"), F.lit("")) for n in names], F.lit(""))

    found = alerts.filter(F.col("alert_timestamp").between(F.lit(start), F.lit(end)))
    found = found.filter(_has(F.col("src_ip"), ip) & _has(F.col("suspicious_batch_id"), batch))
    each = found.select(
        "alert_timestamp", "src_ip", "suspicious_batch_id",
        F.array_join(listed_domains(F.col("domain_names")), ", ").alias("domains"),
        F.explode(_raw_items(F.col("result"))).alias("warning"),
    )
    named = each.select(
        "*",
        filled("detector_name", "name").alias("detector_name"),
        F.coalesce(
            *[F.get_json_object(w, f"$.{n}").try_cast("double") for n in ("score", "probability")], F.lit(0.0)
        ).alias("score_value"),
        text("predicted_class").alias("predicted_class"),
        raw("attributes", "class_probabilities").alias("class_output"),
        raw("domains", "domain_names").alias("detector_domains"),
        raw("logline_ids").alias("logline_ids"),
        raw("server_message_ids").alias("server_message_ids"),
        raw("request").alias("request_raw"),
        F.coalesce(F.nullif(raw("raw_detector_output"), F.lit("")), w).alias("raw_detector_output"),
    )
    hit = _has(F.concat_ws(" ", "domains", "detector_domains", "request_raw"), domain) & _has(F.col("detector_name"), detector)
    shown = named.filter(hit).orderBy(F.desc("alert_timestamp"), F.desc("score_value"), *tie)
    return (shown.limit(rows) if rows else shown).select(
        "alert_timestamp", "src_ip", "suspicious_batch_id", "detector_name", F.round("score_value", 4).alias("score"),
        "predicted_class", "class_output", "detector_domains", "logline_ids", "server_message_ids", "request_raw", "raw_detector_output",
    )


def confusion(truth: DataFrame, predicted: DataFrame, key: str) -> DataFrame:
    """Counts per true and predicted class."""
    return truth.join(predicted, key).groupBy("class", "predicted_class").agg(F.count(F.lit(1)).alias("n"))
