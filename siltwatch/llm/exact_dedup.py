"""Exact duplicates by content-defined chunk recipes.

Each text is cut where its own content says so, so equal stretches give equal chunks.
Chunks are deduplicated to identifiers: a short hash, verified by a SHA-256 digest of
the chunk, with an ordinal where two digests ever share the hash. A document is then
its ordered list of identifiers, and only those lists and digests are shuffled; texts
stay where they are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltwatch.llm.common import nonnull_text, staged

RECIPE = "array<struct<weak:bigint,ordinal:int>>"
SMALLEST, LARGEST = 512, 4096
CHUNK = rf"(?s).{{{SMALLEST},{LARGEST}}}?[adgnrtyADGNRTY.,] (?=[b-dB-D\x{{80}}-\x{{10FFFF}}])|.{{1,{LARGEST}}}"
"""A chunk ends at a blank between given letters, past a least and within a largest length."""


def normalised(text: str = "text") -> Column:
    """Every run of blanks as one space; a lone space needs no replacement."""
    return F.regexp_replace(nonnull_text(text), r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")


def recipes(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, text_sha256 and the recipe of its normalised text."""
    texts = docs.select("doc_id", F.explode(F.array(normalised())).alias("normal"))
    pieces = F.regexp_extract_all("normal", F.lit(CHUNK), F.lit(0))
    chunk = lambda c: F.struct(F.xxhash64(c).alias("weak"), F.unhex(F.sha2(c.cast("binary"), 256)).alias("digest"))
    cut = texts.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.sha2(F.col("normal").cast("binary"), 256).alias("text_sha256"),
        F.transform(pieces, chunk).alias("chunks"),
    )
    cut = staged(cut, "chunked")
    chunks = cut.select("row", F.posexplode("chunks").alias("at", "c")).select("row", "at", "c.weak", "c.digest")
    known = chunks.groupBy("weak", "digest").agg(F.count(F.lit(1)).alias("uses"))
    order = Window.partitionBy("weak").orderBy("digest")
    known = known.select("weak", "digest", F.row_number().over(order).alias("ordinal"))
    named = chunks.join(known, ["weak", "digest"]).select("row", F.struct("at", "weak", "ordinal").alias("c"))
    lists = named.groupBy("row").agg(F.sort_array(F.collect_list("c")).alias("cs"))
    lists = lists.select("row", F.transform("cs", lambda c: F.struct(c["weak"], c["ordinal"])).alias("recipe"))
    none = F.array().cast(RECIPE)
    out = cut.drop("chunks").join(lists, "row", "left")
    return out.select("doc_id", "text_sha256", F.coalesce(F.col("recipe").cast(RECIPE), none).alias("recipe"))


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical with each run of blanks as one space; null
    counts as empty, and empty texts are equal to each other. The smallest doc_id stays;
    rows that repeat it all stay. Rows without a doc_id count in group_size, stay only
    in a group that has no doc_id at all, and then keep_id is null. Other columns are
    ignored; an empty table gives no rows.
    """
    listed = staged(recipes(docs), "recipes")
    groups = listed.groupBy("recipe", "text_sha256").agg(
        F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    return listed.join(groups, ["recipe", "text_sha256"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


SQL = """
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)
"""
