"""Global row numbers without one task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltwatch.llm.common import staged

_IN_PARTITION = (1 << 33) - 1


def numbered(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Rows of ``df`` with ``name``: their place from 0 in the order of some columns.

    Nulls come first. Rows are sorted by ranges; each then knows its place inside its
    range, and one row per range gives the start. Rows equal in all ``order`` columns
    are dealt over several ranges by where they were read, so a key of any size is
    split; their places are exchangeable.
    """
    rows = staged(df.withColumn("_read", F.monotonically_increasing_id()), f"{name}-rows")
    ranged = rows.repartitionByRange(*order, "_read").sortWithinPartitions(*order, "_read")
    placed = staged(ranged.drop("_read").withColumn("_place", F.monotonically_increasing_id()), f"{name}-places")
    placed = placed.withColumn("_range", F.shiftright("_place", 33))
    counts = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_count"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    starts = counts.select("_range", F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_start"))
    number = F.col("_start") + F.col("_place").bitwiseAND(_IN_PARTITION)
    return placed.join(F.broadcast(starts), "_range").select(*df.columns, number.alias(name))
