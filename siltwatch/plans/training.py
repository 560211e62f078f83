"""Training data: preprocessing, labels, windows, splits and weights."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltwatch.functions.domains import labels
from siltwatch.functions.similarity import METRICS, window_similarity
from siltwatch.operators.ranking import keyed_rank, time_slot
from siltwatch.sources.staging import small_side

# Seed, split fractions, window length and the rows a window must exceed.
SEED = 108
SAMPLE = 0.25
TRAIN = 0.8
WINDOW = 10
MORE_THAN = 3
LEGIT = "legit"


def preprocess(df: DataFrame, keep_all: bool = False) -> DataFrame:
    """Label columns of a dataset; empty and single-label queries are dropped.

    Duplicates of a query collapse to its smallest class, so the result does not
    depend on the order of rows.
    """
    rows = df.filter(F.length("query") > 0)
    if not keep_all:
        others = [c for c in df.columns if c != "query"]
        first = F.min(F.struct(*others)) if others else F.lit(1)
        rows = rows.groupBy("query").agg(first.alias("_v")).select("query", *[F.col(f"_v.{c}") for c in others])
    parts = rows.withColumn("labels", labels(F.col("query"))).filter(F.size("labels") != 1)
    two = F.size("labels") == 2
    return parts.select(
        "*",
        F.element_at("labels", -1).alias("tld"),
        F.col("query").alias("fqdn"),
        F.when(two, F.col("labels")[0]).otherwise(F.element_at("labels", -2)).alias("secondleveldomain"),
        F.when(two, F.lit("")).otherwise(F.array_join(F.slice("labels", 1, F.size("labels") - 2), ".")).alias("thirdleveldomain"),
    )


def training_windows(df: DataFrame, order: Sequence[str] = ("ts", "logline_id"), slot_seconds: int = 300) -> DataFrame:
    """Disjoint windows of ten queries per user and domain, more than three rows each.

    The class is the domain's smallest class over all users.
    """
    rows = df.withColumn("domain", F.concat_ws(".", "secondleveldomain", "tld"))
    classes = rows.groupBy("domain").agg(F.min("class").alias("class"))
    ranked = keyed_rank(rows.drop("class"), ["user", "domain"], time_slot(F.col(order[0]), slot_seconds), [F.col(c) for c in order])
    entry = F.struct("rank", "thirdleveldomain")
    chunks = ranked.groupBy("user", "domain", F.floor((F.col("rank") - 1) / WINDOW).cast("bigint").alias("window_no")).agg(
        F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["thirdleveldomain"]).alias("subdomains")
    )
    return chunks.filter(F.size("subdomains") > MORE_THAN).join(classes, "domain")


def tunnel_training_features(windows: DataFrame) -> DataFrame:
    """The seven similarities of each training window, with class and domain."""
    scored = windows.withColumn("_m", window_similarity(F.col("subdomains")))
    return scored.select(F.col("domain").alias("query"), "class", "window_no", *[F.col(f"_m.{m}").alias(m) for m in METRICS])


def label_codes(df: DataFrame, column: str = "class") -> DataFrame:
    """Class -> code: legit is 0, the others count from 1 in sorted order.

    One row per class; the classes are counted before they are ordered.
    """
    classes = df.select(F.col(column).alias("class")).distinct()
    rank = F.row_number().over(Window.orderBy("class"))
    others = classes.filter(F.col("class") != LEGIT).select("class", rank.cast("bigint").alias("code"))
    legit = classes.filter(F.col("class") == LEGIT).select("class", F.lit(0).cast("bigint").alias("code"))
    return others.unionByName(legit)


def encode(df: DataFrame, codes: DataFrame, column: str = "class") -> DataFrame:
    return df.join(small_side(codes.withColumnRenamed("class", column), "codes"), column)


def binary_label(cls: Column) -> Column:
    """0 for legit, 1 for any other class."""
    return F.when(cls == LEGIT, 0.0).otherwise(1.0)


def binarise(code: Column) -> Column:
    return F.when(code != 0, 1).otherwise(0).cast("bigint")


def scale_parameters(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and population deviation per feature, as one row each."""
    stats = [F.struct(F.lit(c).alias("feature"), F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")) for c in columns]
    return df.agg(F.array(*stats).alias("s")).select(F.inline("s"))


def standard_scaled(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Features minus mean over population deviation; a constant feature becomes 0."""
    row = df.agg(*[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]).first()
    scaled = {}
    for c in columns:
        mean, std = row[f"m_{c}"], row[f"s_{c}"]
        scaled[c] = (F.col(c) - F.lit(mean)) / F.lit(std if std else 1.0)
    return df.withColumns(scaled)


def draw(key: Column, seed: int = SEED) -> Column:
    """Number in [0, 1) that depends only on the key and the seed."""
    digest = F.conv(F.substring(F.sha2(F.concat(key, F.lit(f"|{seed}")), 256), 1, 12), 16, 10).cast("double")
    return digest / float(1 << 48)


def stratified_rank(df: DataFrame, key: str, label: str, seed: int = SEED, slots: int = 65_536) -> DataFrame:
    """Position of each row within its class in a fixed random order, and the class size.

    The random number itself cuts a class into slots, so a class that holds
    nearly all rows is still numbered in parallel.
    """
    drawn = df.withColumn("_u", draw(F.col(key), seed))
    slot = F.floor(F.col("_u") * slots).cast("bigint")
    return keyed_rank(drawn, [label], slot, [F.col("_u"), F.col(key)], "rank", "class_size").drop("_u")


def stratified_split(df: DataFrame, key: str, label: str, sample: float = SAMPLE, train: float = TRAIN, seed: int = SEED) -> DataFrame:
    """Add ``split``: a stratified sample cut into train, val and test; others drop.

    Per class: the first ``sample`` share is used, of it the first ``train``
    share trains, and the rest is halved.
    """
    ranked = stratified_rank(df, key, label, seed)
    used = F.floor(F.col("class_size") * sample)
    first = F.floor(used * train)
    second = first + F.floor((used - first) / 2)
    return (
        ranked.filter(F.col("rank") <= used)
        .withColumn("split", F.when(F.col("rank") <= first, "train").when(F.col("rank") <= second, "val").otherwise("test"))
        .drop("rank", "class_size")
    )


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Per class: size and total / (2 * size)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))
    return counts.select(label, "n", (total / (2 * F.col("n"))).alias("weight"))


def balanced_weights(df: DataFrame, label: str) -> DataFrame:
    """Rows with the weight of their class."""
    return df.join(small_side(class_weights(df, label).select(label, "weight"), "weights"), label)


def positive_scale(df: DataFrame, label: str) -> DataFrame:
    """Negatives per positive, as one row."""
    pos, neg = F.count_if(F.col(label) != 0), F.count_if(F.col(label) == 0)
    return df.agg(F.when(pos > 0, neg / pos).alias("scale_pos_weight"))


def clean_name(column: str) -> str:
    """Column name a model accepts: underscores for gaps, no other signs, no leading digit."""
    cleaned = re.sub(r"[^A-Za-z0-9_]", "", re.sub(r"[\s\-]+", "_", column))
    return f"f_{cleaned}" if cleaned[:1].isdigit() else cleaned
