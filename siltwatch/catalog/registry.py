"""Registry of checkable queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltwatch.session import prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Zone-less times, so results compare equal to the SQL twin's."""
    casts = {f.name: F.col(f"`{f.name}`").cast("timestamp_ntz") for f in df.schema if isinstance(f.dataType, T.TimestampType)}
    return df.withColumns(casts) if casts else df


def query(name: str, sql: str | None = None):
    """Register a query under a name, with its SQL twin if it has one."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(fn(prepare(spark), sf_dir))

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return fn

    return add
