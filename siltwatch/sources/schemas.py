"""Schemas of the monitoring tables and the row check before a write."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Table name -> columns. '?' marks a column that may be null.
TABLES = {
    "server_logs": "message_id string, timestamp_in timestamp, message_text string",
    "server_logs_timestamps": "message_id string, event string, event_timestamp timestamp",
    "server_log_to_logline": "message_id string, logline_id string, timestamp timestamp",
    "server_log_terminal_events": "message_id string, stage string, status string, timestamp timestamp",
    "failed_loglines": "message_text string, timestamp_in timestamp, timestamp_failed timestamp, reason_for_failure string",
    "loglines": "logline_id string, timestamp timestamp, subnet_id string, src_ip string, additional_fields string",
    "logline_timestamps": "logline_id string, stage string, status string, timestamp timestamp, is_active boolean",
    "logline_to_batches": "timestamp timestamp, logline_id string, batch_id string",
    "batch_timestamps": (
        "batch_id string, instance_name string, stage string, status string, timestamp timestamp, "
        "message_count bigint, is_active boolean"
    ),
    "batch_tree": (
        "batch_row_id string, batch_id string, parent_batch_row_id string, instance_name string, "
        "stage string, status string, timestamp timestamp"
    ),
    "suspicious_batches_to_batch": "timestamp timestamp, suspicious_batch_id string, batch_id string",
    "suspicious_batch_timestamps": (
        "suspicious_batch_id string, src_ip string, instance_name string, stage string, status string, "
        "timestamp timestamp, message_count bigint, is_active boolean"
    ),
    "fill_levels": "timestamp timestamp, stage string, entry_type string, entry_count bigint",
    "alerts": (
        "src_ip string, alert_timestamp timestamp, suspicious_batch_id string, overall_score float, "
        "domain_names string, result string"
    ),
}
# Event time column of a table where it is not `timestamp`.
EVENT_TIME = {
    "server_logs": "timestamp_in",
    "server_logs_timestamps": "event_timestamp",
    "failed_loglines": "timestamp_in",
    "alerts": "alert_timestamp",
}
# Days kept.
RETENTION_DAYS = {**{name: 1 for name in TABLES}, "alerts": 60}


def table_schema(name: str) -> T.StructType:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return T.StructType.fromDDL(TABLES[name])


def event_time(name: str) -> str:
    return EVENT_TIME.get(name, "timestamp")


def conform(df: DataFrame, name: str) -> DataFrame:
    """Columns in table order; wrong count, name or type is an error.

    A missing parent row becomes ''.
    """
    schema = table_schema(name)
    if sorted(df.columns) != sorted(schema.names):
        raise ValueError(f"columns of {name} are {schema.names}, got {df.columns}")
    given = {f.name: f.dataType for f in df.schema}
    numbers = (T.IntegralType, T.FractionalType)
    for f in schema:
        same = given[f.name] == f.dataType or isinstance(given[f.name], T.NullType)
        both = isinstance(f.dataType, numbers) and isinstance(given[f.name], type(f.dataType).__bases__[0])
        if not same and not both:
            raise TypeError(f"{name}.{f.name} is {f.dataType.simpleString()}, got {given[f.name].simpleString()}")
    out = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
    if "parent_batch_row_id" in schema.names:
        out = out.withColumn("parent_batch_row_id", F.coalesce("parent_batch_row_id", F.lit("")))
    return out


def split_typed(texts: DataFrame, name: str, json_column: str = "value") -> tuple[DataFrame, DataFrame]:
    """JSON event rows -> (typed rows, rejected rows).

    A row is rejected when a value does not read as its column's type, or when
    it has other fields than the table.
    """
    schema = table_schema(name)
    as_text = ", ".join(f"`{n}` string" for n in schema.names)
    parsed = texts.withColumn("_t", F.from_json(json_column, as_text)).withColumn(
        "_k", F.json_object_keys(json_column)
    )
    typed = [F.col(f"_t.`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema]
    checked = parsed.select(F.col(json_column).alias("_raw"), "_k", "_t", F.struct(*typed).alias("_v"))
    broken = [F.col(f"_t.`{n}`").isNotNull() & F.col(f"_v.`{n}`").isNull() for n in schema.names]
    known = F.array_sort(F.col("_k")) == F.array(*[F.lit(n) for n in sorted(schema.names)])
    ok = F.coalesce(known, F.lit(False)) & ~reduce(lambda a, b: a | b, broken)
    marked = checked.withColumn("_ok", ok)
    good = conform(marked.filter("_ok").select("_v.*"), name)
    bad = marked.filter(~F.col("_ok")).select(F.lit(name).alias("table_name"), F.col("_raw").alias("value"))
    return good, bad
