"""Retention: drop what is older than a table keeps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwatch.sources.schemas import RETENTION_DAYS, event_time


def kept_rows(df: DataFrame, time: str, days: int, as_of: dt.datetime) -> DataFrame:
    """Rows younger than the time to live."""
    return df.filter(F.col(time) >= F.lit(as_of - dt.timedelta(days=days)))


def kept_table_rows(df: DataFrame, table: str, as_of: dt.datetime) -> DataFrame:
    return kept_rows(df, event_time(table), RETENTION_DAYS[table], as_of)


def expired_partitions(spark: SparkSession, path: str, column: str, before: dt.date) -> list[str]:
    """Partition folders of a day or a month that ended before a day; others are ignored."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    found = []
    for status in fs.listStatus(root):
        name, _, value = status.getPath().getName().partition("=")
        if name != column:
            continue
        last = _last_day(value)
        if last is not None and last < before:
            found.append(status.getPath().toString())
    return sorted(found)


def _last_day(value: str) -> dt.date | None:
    """The day ``yyyy-MM-dd``, or the last day of the month ``yyyy-MM``."""
    try:
        if len(value) == len("yyyy-MM"):
            first = dt.date.fromisoformat(f"{value}-01")
            return (first + dt.timedelta(days=31)).replace(day=1) - dt.timedelta(days=1)
        return dt.date.fromisoformat(value)
    except ValueError:
        return None


def drop_partitions(spark: SparkSession, paths: list[str]) -> int:
    """Delete partition folders; rows of kept days are never rewritten."""
    jvm = spark.sparkContext._jvm
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return len(paths)
