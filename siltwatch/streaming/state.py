"""Keyed state between micro-batches, as versioned tables.

A micro-batch writes the rows of the keys it touched, under its number. Every
``every`` micro-batches the state so far is written as a whole, and older rows go. So
a micro-batch costs what it touches, a replay reads only what came before it, and the
state of a key is one bounded row in no worker's memory.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwatch.sources.folders import exists, forget_before
from siltwatch.sources.sinks import write_once


@dataclass
class KeyedState:
    root: str
    keys: Sequence[str]
    every: int = 16

    def put(self, rows: DataFrame, batch_id: int) -> None:
        """Replace the rows of the keys in ``rows`` (one row per key)."""
        write_once(rows, f"{self.root}/touched", batch_id)

    def before(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        """State after all micro-batches before this one; None if there was none."""
        whole = batch_id // self.every * self.every
        if whole and not exists(spark, f"{self.root}/whole/stream_batch={whole}/_SUCCESS"):
            state = self._newest(spark, whole - self.every, whole)
            if state is not None:
                write_once(state, f"{self.root}/whole", whole)
            forget_before(spark, f"{self.root}/touched", whole - self.every)
            forget_before(spark, f"{self.root}/whole", whole - self.every)
        return self._newest(spark, whole, batch_id)

    def _newest(self, spark: SparkSession, whole: int, batch_id: int) -> DataFrame | None:
        parts = []
        if exists(spark, f"{self.root}/whole/stream_batch={whole}/_SUCCESS"):
            parts.append(spark.read.parquet(f"{self.root}/whole/stream_batch={whole}").withColumn("_version", F.lit(-1)))
        for n in range(whole, batch_id):
            path = f"{self.root}/touched/stream_batch={n}"
            if exists(spark, f"{path}/_SUCCESS"):
                parts.append(spark.read.parquet(path).withColumn("_version", F.lit(n)))
        if not parts:
            return None
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        values = [c for c in rows.columns if c not in (*self.keys, "_version")]
        newest = F.max_by(F.struct(*values), "_version").alias("_row")
        return rows.groupBy(*self.keys).agg(newest).select(*self.keys, "_row.*")
