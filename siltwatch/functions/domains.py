"""Domain name parts and the 44 lexical features."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters counted, and the feature order a model is trained on.
LETTERS = "abcdefghijklmnopqrstuvwxyz"
LEVELS = ("thirdleveldomain", "secondleveldomain", "fqdn")
ENTROPY_LEVELS = ("fqdn", "thirdleveldomain", "secondleveldomain")
RATIOS = ("full", "alpha", "numeric", "special")
FEATURES = (
    ["label_length", "label_max", "label_average"]
    + [f"freq_{c}" for c in LETTERS]
    + [f"{level}_{ratio}_count" for level in LEVELS for ratio in RATIOS]
    + [f"{level}_entropy" for level in ENTROPY_LEVELS]
)


def strip_dots(col: Column) -> Column:
    return F.regexp_replace(col, r"^\.+|\.+$", "")


def labels(col: Column) -> Column:
    return F.split(col, r"\.", -1)


def second_level(parts: Column) -> Column:
    """Label left of the top level, '' when there is only one label."""
    return F.when(F.size(parts) >= 2, F.element_at(parts, -2)).otherwise(F.lit(""))


def third_level(parts: Column) -> Column:
    """Everything left of the second level, '' when there is nothing."""
    return F.when(
        F.size(parts) > 2, F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - 2, F.lit(0))), ".")
    ).otherwise(F.lit(""))


def with_domain_parts(df, name: str = "domain_name"):
    """Add ``fqdn``, ``labels``, ``secondleveldomain``, ``thirdleveldomain``."""
    return (
        df.withColumn("fqdn", strip_dots(F.col(name)))
        .withColumn("labels", labels(F.col("fqdn")))
        .withColumn("secondleveldomain", second_level(F.col("labels")))
        .withColumn("thirdleveldomain", third_level(F.col("labels")))
    )


def _share(count: Column, text: Column) -> Column:
    """``count / length`` as double, 0 for empty text."""
    return F.when(F.length(text) > 0, count / F.length(text)).otherwise(F.lit(0.0))


def letter_share(text: Column, letter: str) -> Column:
    low = F.lower(text)
    return _share(F.length(low) - F.length(F.replace(low, F.lit(letter), F.lit(""))), text)


def class_ratios(text: Column, variant: str = "serve") -> list[Column]:
    """Ratios of any, letter, digit and special characters.

    ``serve`` counts Unicode letters and digits and takes '_' for special;
    ``train`` counts ASCII ones and takes '_' for a word character.
    """
    if variant == "serve":
        patterns = (r"\p{L}", r"\p{Nd}", r"[^\p{L}\p{N}\s]")
    elif variant == "train":
        patterns = (r"[a-zA-Z]", r"[0-9]", r"[^\p{L}\p{N}\p{M}_\s]")
    else:
        raise ValueError(f"unknown feature variant {variant!r}")
    full = F.when(F.length(text) > 0, F.lit(1.0)).otherwise(F.lit(0.0))
    return [full] + [_share(F.regexp_count(text, F.lit(p)), text) for p in patterns]


def entropy(text: Column) -> Column:
    """Shannon entropy (bits) of the characters, 0 for empty text."""
    n = F.length(text).cast("double")
    shares = F.transform(
        F.array_distinct(F.split(text, "")), lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n
    )
    bits = F.aggregate(shares, F.lit(0.0), lambda acc, p: acc - p * F.log2(p))
    return F.when(F.length(text) > 0, bits).otherwise(F.lit(0.0))


def feature_columns(name: str = "domain_name", variant: str = "serve") -> list[Column]:
    """The 44 features as named doubles; needs :func:`with_domain_parts`.

    The training form counts over the raw query, the serving form over the
    dot-stripped one.
    """
    text = F.col("fqdn") if variant == "serve" else F.col(name)
    parts = F.col("labels") if variant == "serve" else labels(text)
    levels = {level: F.col(level) for level in LEVELS}
    if variant == "train":
        levels["fqdn"] = text
    columns = [F.size(parts), F.length(F.array_max(parts)), F.length(strip_dots(text))]
    columns += [letter_share(text, c) for c in LETTERS]
    columns += reduce(lambda a, b: a + b, [class_ratios(levels[level], variant) for level in LEVELS])
    columns += [entropy(levels[level]) for level in ENTROPY_LEVELS]
    return [c.cast("double").alias(n) for c, n in zip(columns, FEATURES, strict=True)]


def feature_array() -> Column:
    """Features in model order as one array column."""
    return F.array(*[F.col(n) for n in FEATURES])
