"""Connected components of a link table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltwatch.llm.common import staged


def _hook(sides: DataFrame, keep) -> DataFrame:
    """Links (v, least) where ``least`` is the smallest end around each ``u``."""
    least = sides.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("least"))
    return sides.join(least, "u").where(keep).select(F.col("v").alias("a"), F.col("least").alias("b")).where("a <> b")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) for every linked id; a component is named by its smallest id.

    Large-star and small-star steps alternate until the links no longer change, a
    number of steps that grows with the logarithm of the longest chain. Each step is
    written to the shared folder. No table of ids reaches the driver.
    """
    links = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct()
    links = staged(links, "links")
    before = None
    while True:
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return links.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
                links.select(F.col("b"), F.col("b")).distinct()
            )
        before = state
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a"))
        large = staged(_hook(both, F.col("v") > F.col("u")).distinct(), "links")
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("least").alias("b")), F.struct("a", F.col("least").alias("b")))).alias("l"))
        links = staged(small.select("l.*").where("a <> b").distinct(), "links")
