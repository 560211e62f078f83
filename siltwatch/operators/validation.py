"""Log line validation, dead letters and field splitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltwatch.functions.rules import REQUIRED_NAMES, LogFormat, Timestamp

UUID_PATTERN = r"^[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$"
_BROKEN = "_broken_line"


def uuid_or_null(col: Column) -> Column:
    """Lower-case text of a UUID, null for anything else."""
    return F.when(col.rlike(UUID_PATTERN), F.lower(col))


def parse_lines(df: DataFrame, fmt: LogFormat, raw: str = "raw") -> DataFrame:
    """Parse JSON text and name the failed fields of each line.

    Adds ``fields`` (struct of the configured names) and ``failed_fields``
    (empty = valid, ``['json']`` = not a JSON object). A missing required field
    counts as invalid, whatever its class.
    """
    parsed = _parsed_once(df, fmt, raw)
    failed = fmt.failed_fields(lambda name: F.col(f"fields.`{name}`"))
    return parsed.withColumn("failed_fields", F.when(_is_broken(), F.array(F.lit("json"))).otherwise(failed))


def _parsed_once(df: DataFrame, fmt: LogFormat, raw: str) -> DataFrame:
    """Parse in a generator: filters on the fields then stay above it.

    As a plain projection the parser would be copied into every predicate and
    into join conditions below, and run once per rule.
    """
    schema = f"{fmt.schema()}, `{_BROKEN}` string"
    fields = F.from_json(raw, schema, {"columnNameOfCorruptRecord": _BROKEN})
    return df.select("*", F.explode(F.array(fields)).alias("fields"))


def _is_broken() -> Column:
    return F.col("fields").isNull() | F.col(f"fields.`{_BROKEN}`").isNotNull()


def valid_lines(df: DataFrame, fmt: LogFormat, raw: str = "raw") -> DataFrame:
    """Valid lines with one column per configured field and a parsed ``ts``."""
    parsed = _parsed_once(df, fmt, raw)
    ts_rule = fmt.rule("ts")
    ts = ts_rule.parse(F.col("fields.ts")) if isinstance(ts_rule, Timestamp) else F.try_to_timestamp("fields.ts")
    keep = [c for c in df.columns if c not in fmt.names]
    return parsed.filter(~_is_broken() & fmt.all_valid(lambda name: F.col(f"fields.`{name}`"))).select(
        *keep,
        ts.alias("ts"),
        *[F.col(f"fields.`{n}`").alias(n) for n in fmt.names if n != "ts"],
    )


def parsed_valid_lines(parsed: DataFrame, fmt: LogFormat) -> DataFrame:
    """As :func:`valid_lines`, from lines that are parsed already; other columns stay."""
    ts_rule = fmt.rule("ts")
    ts = ts_rule.parse(F.col("fields.ts")) if isinstance(ts_rule, Timestamp) else F.try_to_timestamp("fields.ts")
    keep = [c for c in parsed.columns if c not in (*fmt.names, "fields", "failed_fields")]
    named = [F.col(f"fields.`{n}`").alias(n) for n in fmt.names if n != "ts"]
    return parsed.filter(F.size("failed_fields") == 0).select(*keep, ts.alias("ts"), *named)


def failed_lines(parsed: DataFrame, raw: str = "raw") -> DataFrame:
    """Dead letters with the reason the line failed."""
    return parsed.filter(F.size("failed_fields") > 0).select(
        *[c for c in parsed.columns if c not in ("fields", raw, "failed_fields")],
        F.col(raw).alias("message_text"),
        F.array_join("failed_fields", ",").alias("reason_for_failure"),
    )


def failed_terminal_events(failed: DataFrame, id_column: str, at: Column) -> DataFrame:
    """Terminal event ``failed`` of each dead letter that carries a message id."""
    return failed.filter(F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("string").alias("message_id"),
        F.lit("log_collection.collector").alias("stage"),
        F.lit("failed").alias("status"),
        at.alias("timestamp"),
    )


def additional_fields(raw: Column) -> Column:
    """JSON text of everything but the required fields, unknown ones included."""
    fields = F.from_json(raw, "map<string,string>")
    return F.to_json(F.map_filter(fields, lambda k, _: ~k.isin(*REQUIRED_NAMES)))


def with_message_ids(df: DataFrame, key: str = "key") -> DataFrame:
    """Attach ``server_message_id`` (only if the key is a UUID) and a stable ``logline_id``.

    The id is a digest of the source position, so a replay yields the same id.
    """
    position = F.concat_ws("/", F.col("topic"), F.col("partition").cast("string"), F.col("offset").cast("string"))
    return df.withColumn("server_message_id", uuid_or_null(F.col(key))).withColumn(
        "logline_id", F.sha2(position, 256)
    )
