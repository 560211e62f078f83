"""Corpus pipeline: from raw documents to a mix, in five stages.

Each stage works on what the one before kept; its result is written as Parquet and read
again. All but the last return the columns of ``documents``. A stage decides on rows:
rows without a doc_id or with one that repeats are documents of their own, and every
row is kept, dropped or taken once.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwatch.llm import decontaminate, exact_dedup, minhash, mixing, quality
from siltwatch.llm.common import arrow_ready, bucket, keep_listed, row_keyed, table
from siltwatch.llm.queries import QUALITY_CUT, QUALITY_FOLDS, QUALITY_HELD
from siltwatch.session import checkpoint_root


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.

    Null and empty texts are scored like others. Without labels of both kinds there is
    nothing to learn, and all documents stay.
    """
    arrow_ready(spark)
    learn, labels = bucket(QUALITY_FOLDS) != QUALITY_HELD, table(spark, sf_dir, "labels")
    if not quality.learnable(docs, labels, learn):
        return docs
    model = quality.fit(docs, labels, learn)
    return quality.quality_scores(docs, model).where(F.col("quality_score") >= QUALITY_CUT).select(*docs.columns)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts: the smallest doc_id, a row without one only if no other has one.

    Null counts as an empty text, and empty texts are equal. Repeated rows are equal too.
    """
    arrow_ready(spark)
    keyed, own = row_keyed(docs)
    return own(keep_listed(keyed, exact_dedup.exact_duplicates(keyed).where("kept")))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near-duplicates on 5-word shingles, chosen as among equal texts.

    Rows without words are linked with nothing and stay.
    """
    arrow_ready(spark)
    keyed, own = row_keyed(docs)
    return own(keep_listed(keyed, minhash.near_duplicates(keyed, words=5).where("kept")))


def leak_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without benchmark items, whatever their ids; null and empty texts stay."""
    arrow_ready(spark)
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of the mix, each once, with the words taken from it and its source's target.

    Rows of which the mix takes nothing, such as empty texts, go. Columns of ``docs``
    named n_words, target or taken are replaced.
    """
    arrow_ready(spark)
    keyed, own = row_keyed(docs)
    taken = mixing.mix(keyed).where("taken > 0").select("doc_id", F.col("size").alias("n_words"), "target", "taken")
    added = [c for c in taken.columns if c != "doc_id"]
    return own(keyed.drop(*added).join(taken, "doc_id"))


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("decontamination", leak_stage),
    ("mixing", mix_stage),
]

#: Trained scores, sketches and latent search have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = f"{checkpoint_root(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{root}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
