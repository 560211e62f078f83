"""Stage boundaries: a result used several times is written once."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from siltwatch.session import checkpoint_root


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later plans start at the written table, so neither a second use nor a lost
    executor repeats the work before it.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/stages/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, name: str) -> DataFrame:
    """Join side that is usually small, written once.

    The planner sees the written bytes and broadcasts below its own threshold;
    above it the join is a shuffle, where adaptive execution splits hot keys.
    """
    return staged(df, name)


def spread(df: DataFrame, scan: DataFrame, key: str) -> DataFrame:
    """Spread rows over all cores when their scan has fewer partitions than cores.

    Small or unsplittable inputs would leave costly parsing to one task. A large
    scan already has enough partitions and is left alone, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if scan.rdd.getNumPartitions() >= cores else df.repartition(cores, key)
