"""Monitoring tables of a collector, all committed at once, and the times of its stages."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltwatch.sources.file_log import FileLog
from siltwatch.sources.folders import exists, read_text, write_text
from siltwatch.sources.schemas import RETENTION_DAYS, TABLES, conform, event_time, table_schema

Part = tuple[str, DataFrame]


def all_columns() -> T.StructType:
    """Columns of all tables; a name has one type wherever it occurs."""
    found: dict[str, T.DataType] = {}
    for name in TABLES:
        for f in table_schema(name):
            if found.setdefault(f.name, f.dataType) != f.dataType:
                raise TypeError(f"column {f.name} has two types")
    return T.StructType([T.StructField(n, t) for n, t in found.items()])


def _wide(df: DataFrame, table: str) -> DataFrame:
    rows = conform(df, table)
    own = set(rows.columns)
    columns = [F.col(f.name) if f.name in own else F.lit(None).cast(f.dataType).alias(f.name) for f in all_columns()]
    return rows.select(*columns, F.lit(table).alias("table_name"), F.to_date(event_time(table)).alias("day"))


@dataclass
class EventLog(FileLog):
    """The monitoring tables of one collector; partitions are table and day."""

    parts: tuple[str, ...] = ("table_name", "day")

    def write(self, spark: SparkSession, parts: Iterable[Part], batch_id: int) -> None:
        """Write the rows of a micro-batch in one pass over all tables; they show once it is committed."""
        self.put(spark, reduce(DataFrame.unionByName, [_wide(df, table) for table, df in parts]), batch_id)

    def read(self, spark: SparkSession, table: str, first_day: dt.date | None = None, batch_id: int | None = None) -> DataFrame:
        """Committed rows of a table, from a day on or of one micro-batch."""
        since = str(first_day) if first_day else ""
        listed = [x for x in self.files(spark, batch_id) if x.parts[0] == table and x.parts[1] >= since]
        return self.rows(spark, listed, table_schema(table))

    def expire(self, spark: SparkSession, as_of: dt.datetime) -> dict[str, int]:
        """Drop rows past their table's time to live; returns files dropped or replaced per table.

        Days that ended go; the day that is half expired is written anew.
        """
        listed, gone, new = self.files(spark), [], []
        for table in {x.parts[0] for x in listed}:
            limit = as_of - dt.timedelta(days=RETENTION_DAYS[table])
            border = str(limit.date())
            own = [x for x in listed if x.parts[0] == table]
            half = [x for x in own if x.parts[1] == border]
            gone += [x for x in own if x.parts[1] <= border]
            if half:
                kept = self.rows(spark, half, table_schema(table)).where(F.col(event_time(table)) >= F.lit(limit))
                new += self.rewritten(spark, kept.withColumns({"table_name": F.lit(table), "day": F.lit(border)}))
        self.swap(spark, gone, new)
        return {t: sum(x.parts[0] == t for x in gone) for t in {x.parts[0] for x in gone}}


@dataclass
class StageClock:
    """Times at which a micro-batch passed its stages, noted once: a replay reads them."""

    root: str

    def at(self, spark: SparkSession, batch_id: int, mark: str) -> dt.datetime:
        path = f"{self.root}/clock/stream_batch={batch_id}/{mark}"
        if not exists(spark, path):
            write_text(spark, path, str(time.time_ns() // 1000))
        micros = int(read_text(spark, path))
        return dt.datetime.fromtimestamp(micros // 1_000_000, dt.timezone.utc) + dt.timedelta(microseconds=micros % 1_000_000)
