"""Stored states that grow by increments: only days that changed are touched.

A micro-batch adds partial states, laid out by day. Readers merge the parts of a state;
``compact`` merges those of days that have gathered many. Every column has a merge that
does not care how the rows were cut, so n increments give what one run would.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltwatch.plans import latency as L
from siltwatch.plans import rollups as R
from siltwatch.sources.event_log import EventLog
from siltwatch.sources.file_log import FileLog

TIMES = {"start_timestamp": "min", "end_timestamp": "max"}
FILL = {"min_count": "min", "max_count": "max", "sum_count": "sum", "n": "sum", "sketch": "kll_merge_agg_double"}


@dataclass
class StateTable:
    """Mergeable rows per key. ``time`` is a key column: a date, or a bucket whose day is the partition."""

    root: str
    schema: str
    keys: Sequence[str]
    merges: Mapping[str, str]
    time: str

    @property
    def log(self) -> FileLog:
        return FileLog(self.root, ("day",))

    def add(self, spark: SparkSession, rows: DataFrame, batch_id: int) -> None:
        """Add the states of a micro-batch; one that is there is not added again."""
        if self.log.committed(spark, batch_id):
            return
        self.log.put(spark, rows.select(*self._columns(), F.to_date(self.time).alias("day")), batch_id)
        self.log.commit(spark, batch_id)

    def read(self, spark: SparkSession, first_day: dt.date | None = None) -> DataFrame:
        """States of all increments, merged."""
        since = str(first_day) if first_day else ""
        return self._merged(self.log.rows(spark, [x for x in self.log.files(spark) if x.parts[0] >= since], self._schema()))

    def compact(self, spark: SparkSession, fewest: int = 8) -> int:
        """Merge the days that have so many increments, all in one pass; returns how many were."""
        batches: dict[str, set[str]] = {}
        listed = self.log.files(spark)
        for x in listed:
            batches.setdefault(x.parts[0], set()).add(x.batch)
        due = {day for day, own in batches.items() if len(own) >= fewest}
        if due:
            old = [x for x in listed if x.parts[0] in due]
            merged = self._merged(self.log.rows(spark, old, self._schema())).select(*self._columns(), F.to_date(self.time).alias("day"))
            self.log.swap(spark, old, self.log.rewritten(spark, merged))
        return len(due)

    def expire(self, spark: SparkSession, as_of: dt.datetime, kept: dt.timedelta) -> int:
        """Drop what is older than a tier keeps: ended days at once, the border day by writing it anew."""
        limit = as_of - kept
        border = str(limit.date())
        listed = self.log.files(spark)
        gone, half = [x for x in listed if x.parts[0] <= border], [x for x in listed if x.parts[0] == border]
        new = []
        if half:
            rest = self.log.rows(spark, half, self._schema()).where(F.col(self.time) >= F.lit(limit))
            new = self.log.rewritten(spark, rest.withColumn("day", F.to_date(self.time)))
        self.log.swap(spark, gone, new)
        return len(gone)

    def _columns(self) -> list[str]:
        return [*self.keys, *self.merges]

    def _schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.schema)

    def _merged(self, rows: DataFrame) -> DataFrame:
        types = {f.name: f.dataType for f in self._schema()}
        made: list[Column] = [F.expr(f"{how}(`{c}`)").cast(types[c]).alias(c) for c, how in self.merges.items()]
        return rows.groupBy(*self.keys).agg(*made)


SPAN = "start_timestamp timestamp, end_timestamp timestamp"


def state_tables(root: str) -> dict[str, StateTable]:
    """Latency states by day, and roll-ups of alerts and fill levels in three resolutions."""
    day = lambda name, keys: StateTable(f"{root}/{name}", "event_date date, " + ", ".join(f"{k} string" for k in keys) + f", {SPAN}", ("event_date", *keys), TIMES, "event_date")
    out = {
        "server_log": day("server_log", ("message_id",)),
        "logline": day("logline", ("stage", "logline_id")),
        "batch": day("batch", ("stage", "instance_name", "batch_id")),
        "suspicious": day("suspicious", ("stage", "instance_name", "suspicious_batch_id")),
    }
    for t in R.TIERS:
        out[f"alerts_{t.name}"] = StateTable(
            f"{root}/alerts_{t.name}", "time_bucket timestamp, src_ip string, alert_count bigint", ("time_bucket", "src_ip"),
            {"alert_count": "sum"}, "time_bucket",
        )
        out[f"fill_levels_{t.name}"] = StateTable(
            f"{root}/fill_levels_{t.name}",
            "time_bucket timestamp, stage string, entry_type string, min_count bigint, max_count bigint, sum_count bigint, n bigint, sketch binary",
            R.FILL_KEYS, FILL, "time_bucket",
        )
    return out


def states_of(log: EventLog, spark: SparkSession, batch_id: int) -> dict[str, DataFrame]:
    """Partial states of one committed micro-batch."""
    read = lambda table: log.read(spark, table, batch_id=batch_id)
    out = {
        "server_log": L.server_log_states(read("server_logs"), read("server_logs_timestamps")),
        "logline": L.logline_states(read("logline_timestamps")),
        "batch": L.batch_states(read("batch_timestamps")),
        "suspicious": L.suspicious_states(read("suspicious_batch_timestamps")),
    }
    for t in R.TIERS:
        out[f"alerts_{t.name}"] = R.alert_rollup(read("alerts"), t.minutes)
        out[f"fill_levels_{t.name}"] = R.fill_state(read("fill_levels"), t.minutes)
    return out


def refresh(log: EventLog, tables: Mapping[str, StateTable], spark: SparkSession, batch_id: int, fewest: int = 8) -> None:
    """After a micro-batch: add its states everywhere, and merge days that have gathered many."""
    for name, rows in states_of(log, spark, batch_id).items():
        tables[name].add(spark, rows, batch_id)
        tables[name].compact(spark, fewest)


def expire_tiers(tables: Mapping[str, StateTable], spark: SparkSession, as_of: dt.datetime) -> dict[str, int]:
    """Drop what each resolution no longer keeps; returns files dropped or replaced."""
    return {
        f"{kind}_{t.name}": tables[f"{kind}_{t.name}"].expire(spark, as_of, t.kept) for kind in ("alerts", "fill_levels") for t in R.TIERS
    }
