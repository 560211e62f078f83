"""Queries of the operators, over their whole tables, and SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwatch.llm import decontaminate, exact_dedup, langid, licenses, line_dedup, lm, merkle, minhash, mixing, phrases, pii, quality, sharding
from siltwatch.llm.common import bucket, documents, table

Query = Callable[[SparkSession, str], DataFrame]
QUALITY_FOLDS, QUALITY_HELD, QUALITY_CUT = 4, 2, 0.7


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in every document."""
    return licenses.licences(documents(spark, sf_dir))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: base spans by rule, and those the trees add."""
    return pii.digest(pii.personal_data(documents(spark, sf_dir)))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that stays of its equal texts."""
    return exact_dedup.exact_duplicates(documents(spark, sf_dir))


def op4_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every document under a bigram trie and under unigrams."""
    return lm.lm_scores(documents(spark, sf_dir), bucket(7) != 2)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from the labels outside the held-out fold."""
    docs, held = documents(spark, sf_dir), bucket(QUALITY_FOLDS) == QUALITY_HELD
    model = quality.fit(docs, table(spark, sf_dir, "labels"), ~held)
    score = F.col("quality_score").alias("score")
    scored = quality.quality_scores(docs.select("doc_id", "text"), model).select("doc_id", held.alias("held_out"), score)
    return scored.withColumn("predicted", (F.col("score") >= QUALITY_CUT).cast("int"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from every document."""
    return mixing.mix(documents(spark, sf_dir))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that leak in documents."""
    return decontaminate.leaks(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that spread over many sources."""
    return line_dedup.digest(line_dedup.without_spread_lines(documents(spark, sf_dir)))


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned outside the held-out fold."""
    docs, held = documents(spark, sf_dir), bucket(4) == 2
    found = langid.predict(docs, langid.fit(docs, ~held))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its component of near-duplicates on 4-word shingles."""
    return minhash.near_duplicates(documents(spark, sf_dir), words=4)


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases of every language that keep together."""
    return phrases.collocations(documents(spark, sf_dir))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, path and root of every document, and whether a tampered one is told."""
    return merkle.tampered_proofs(documents(spark, sf_dir))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document in a permuted order."""
    return sharding.sharded(documents(spark, sf_dir))


OPERATORS = (
    op1_licenses, op2_pii, op3_exact_dedup, op4_lm, op5_quality, op6_mixing, op7_decontamination,
    op8_line_dedup, op9_langid, op10_minhash, op11_phrases, op12_merkle, op13_sharding,
)


def llm_queries() -> dict[str, Query]:
    return {fn.__name__: fn for fn in OPERATORS}


def llm_sql() -> dict[str, str]:
    return {
        "op1_licenses": licenses.sql(), "op3_exact_dedup": exact_dedup.SQL, "op8_line_dedup": line_dedup.SQL,
        "op11_phrases": phrases.sql(), "op12_merkle": merkle.SQL, "op13_sharding": sharding.sql(),
    }
