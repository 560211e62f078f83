"""Detectors: scored lines -> warnings."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltwatch.functions.domains import entropy

STAGE = "data_analysis.detector"

# Classes that never raise a warning.
LEGITIMATE = ("benign", "legit", "legitimate", "legitimate_legitimate")

REQUEST = "array<struct<logline_id:string,server_message_id:string,domain_name:string,ts:timestamp>>"
ATTRIBUTES = "array<struct<attribute:string,probability:double>>"
WARNING_COLUMNS = (
    "suspicious_batch_id", "src_ip", "name", "sha256", "probability", "predicted_class", "attributes", "request",
)

# Detector plugins: lines -> warnings.
DETECTORS: dict[str, Callable[..., DataFrame]] = {}
# Detectors whose windows go on over micro-batches.
RESUMED: dict[str, object] = {}


def detector(name: str):
    def add(fn):
        DETECTORS[name] = fn
        return fn

    return add


def request_entry(lines: DataFrame) -> Column:
    """The part of a line a warning keeps; not every source has message ids."""
    server_id = F.col("server_message_id") if "server_message_id" in lines.columns else F.lit(None)
    return F.struct(
        F.col("logline_id").cast("string").alias("logline_id"),
        server_id.cast("string").alias("server_message_id"),
        F.col("domain_name"),
        F.col("ts"),
    )


def entropy_probability(text: Column, ceiling: float = 4.0) -> Column:
    """Transparent stand-in for a model: entropy of the name, scaled to 0..1."""
    return F.least(F.lit(1.0), entropy(text) / ceiling)


def _warning(df: DataFrame, name: str, sha256: str, predicted: Column, attributes: Column, request: Column) -> DataFrame:
    made = {
        "name": F.lit(name),
        "sha256": F.lit(sha256),
        "probability": F.col("probability").cast("double"),
        "predicted_class": predicted,
        "attributes": attributes,
        "request": request.cast(REQUEST),
    }
    return df.select(*[made[c].alias(c) if c in made else F.col(c) for c in WARNING_COLUMNS])


def binary_warnings(
    scored: DataFrame,
    name: str,
    threshold: float = 0.5,
    sha256: str = "",
    always: bool = False,
    request: Column | None = None,
) -> DataFrame:
    """Warn where class 1 wins and its probability is above the threshold.

    A tie at one half is not malicious. ``always`` warns on every row.
    """
    wins = F.lit(True) if always else F.col("probability") > max(0.5, threshold)
    one = F.array(request_entry(scored)) if request is None else request
    return _warning(
        scored.filter(wins), name, sha256, F.lit(None).cast("string"), F.lit(None).cast(ATTRIBUTES), one
    )


@detector("DGADetector")
def dga_warnings(
    lines: DataFrame, name: str = "dga", threshold: float = 0.5, score: Callable | None = None, sha256: str = ""
) -> DataFrame:
    """Score every line's domain; ``score`` adds ``probability`` (default: entropy rule)."""
    if score is None:
        scored = lines.withColumn("probability", entropy_probability(F.regexp_replace("domain_name", r"^\.+|\.+$", "")))
    else:
        scored = score(lines)
    return binary_warnings(scored, name, threshold, sha256)


def class_decision(labels: Sequence[str], probabilities: Column, threshold: float) -> dict[str, Column]:
    """Winner, its probability, every class at or above the threshold, and the warn flag."""
    names = F.array(*[F.lit(v) for v in labels])
    top = F.array_max(probabilities)
    winner = F.element_at(names, F.array_position(probabilities, top).cast("int"))
    pairs = F.zip_with(names, probabilities, lambda a, p: F.struct(a.alias("attribute"), p.alias("probability")))
    return {
        "predicted_class": winner,
        "probability": top,
        "attributes": F.filter(pairs, lambda x: x["probability"] >= threshold),
        "warn": ~winner.isin(*LEGITIMATE) & (top >= threshold),
    }


def attribution_warnings(
    scored: DataFrame, labels: Sequence[str], name: str, threshold: float = 0.5, sha256: str = "", request: str = "request"
) -> DataFrame:
    """Warnings of a multi-class detector; ``scored`` carries ``probabilities``."""
    decided = class_decision(labels, F.col("probabilities"), threshold)
    kept = scored.select("*", *[v.alias(f"_{k}") for k, v in decided.items()]).filter("_warn")
    return _warning(
        kept.withColumn("probability", F.col("_probability")),
        name,
        sha256,
        F.col("_predicted_class"),
        F.col("_attributes"),
        F.col(request),
    )


def detector_events(lines: DataFrame, warnings: DataFrame, instance: str) -> tuple[DataFrame, DataFrame]:
    """(line events, batch events): ``detected``/``finished`` where the client batch warned."""
    warned = warnings.select("suspicious_batch_id").distinct().withColumn("warned", F.lit(True))
    marked = lines.join(warned, "suspicious_batch_id", "left").withColumn(
        "warned", F.coalesce("warned", F.lit(False))
    )
    line_events = (
        marked.select("suspicious_batch_id", "logline_id", "warned")
        .distinct()
        .select(
            F.col("logline_id").cast("string").alias("logline_id"),
            F.lit(STAGE).alias("stage"),
            F.when(F.col("warned"), "detected").otherwise("filtered_out").alias("status"),
            F.lit(False).alias("is_active"),
        )
    )
    batch_events = (
        marked.groupBy("suspicious_batch_id", "src_ip", "warned")
        .agg(F.count(F.lit(1)).alias("message_count"))
        .select(
            "suspicious_batch_id",
            "src_ip",
            F.lit(instance).alias("instance_name"),
            F.lit(STAGE).alias("stage"),
            F.when(F.col("warned"), "finished").otherwise("filtered_out").alias("status"),
            "message_count",
            F.lit(False).alias("is_active"),
        )
    )
    return line_events, batch_events
