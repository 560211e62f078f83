"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwatch.session import prepare
from siltwatch.sources.staging import staged

__all__ = ["BLANKS", "arrow_ready", "bucket", "documents", "keep_listed", "row_keyed", "lowered", "nonnull_text", "staged", "table", "word_count"]

BLANKS = r"[\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def arrow_ready(spark: SparkSession) -> SparkSession:
    """Small Arrow batches, so that long texts do not fill a worker."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(arrow_ready(spark), sf_dir, "documents")


def nonnull_text(text: str = "text") -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def lowered(text: Column) -> Column:
    """A-Z in lower case; other letters stay."""
    return F.translate(text, _UPPER, _LOWER)


def word_count(text: str = "text") -> Column:
    """Number of blank-separated words; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def bucket(modulus: int, key: str = "doc_id") -> Column:
    """crc32 of the key as text, modulo ``modulus``; a null key counts as ''."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % modulus


def keep_listed(docs: DataFrame, listed: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose key is listed, with the columns of ``docs``."""
    return docs.join(listed.select(F.col(key)), key, "left_semi").select(*docs.columns)


OWN_ID = "_own_id"


def row_keyed(docs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """Rows whose ``doc_id`` tells each from all others, and a function that gives results their own ids back.

    A table of distinct ids is left as it is. Otherwise rows are numbered in the order
    of doc_id, rows without one last, and the number stands in for the id; so the row
    that an operator keeps of a group still has the smallest id.
    """
    from siltwatch.llm.numbering import numbered  # which needs this module

    rows, ids = docs.agg(F.count(F.lit(1)), F.count_distinct("doc_id")).first()
    if rows == ids:
        return docs, lambda out: out
    own = staged(docs.withColumns({OWN_ID: F.col("doc_id"), "_read": F.monotonically_increasing_id()}), "rows")
    ids = own.select(F.col("doc_id").isNull().alias("none"), "doc_id", F.col("_read").alias("row"))
    places = numbered(ids, ("none", "doc_id"), "number").select(F.col("row").alias("_read"), "number")
    keyed = own.join(places, "_read").withColumn("doc_id", F.col("number")).select(*docs.columns, OWN_ID)
    return staged(keyed, "keyed"), lambda out: out.withColumn("doc_id", F.col(OWN_ID)).drop(OWN_ID)
