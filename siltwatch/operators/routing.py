"""Who gets what: stage wiring from configuration."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GENERIC_ALERTER = "generic"
MAX_ROUTES = 10_000


def route_table(spark: SparkSession, routes: Sequence[tuple[str, str]]) -> DataFrame:
    """Configured (source, target) pairs, few enough to be broadcast."""
    if len(routes) > MAX_ROUTES:
        raise ValueError(f"{len(routes)} routes; at most {MAX_ROUTES} are supported")
    return spark.createDataFrame(list(routes), "source string, target string")


def fan_out(df: DataFrame, routes: DataFrame, on: str, target: str = "target") -> DataFrame:
    """One copy of each row per matching target; the route table is configuration-sized."""
    renamed = routes.select(F.col("source").alias(on), F.col("target").alias(target))
    return df.join(F.broadcast(renamed), on)


def consumers(links: Sequence[Mapping], producer_key: str) -> dict[str, list[str]]:
    """Producer name -> names of the stages that consume from it."""
    out: dict[str, list[str]] = {}
    for link in links:
        out.setdefault(link[producer_key], []).append(link["name"])
    return out


# Configuration keys that name downstream or upstream detectors.
DOWNSTREAM_KEYS = ("next_detectors", "produce_detector_topics")
UPSTREAM_KEYS = ("upstream_detector_name", "source_detector_name", "input_detector_name")


def name_list(value) -> list[str]:
    """Names of a setting that may be missing, one text with commas, or a list."""
    if value is None:
        return []
    items = value.split(",") if isinstance(value, str) else value if isinstance(value, (list, tuple, set)) else [value]
    return [text for text in (str(v).strip() for v in items) if text]


def next_detectors(entry: Mapping) -> list[str]:
    """Names from both spellings of the key, in order, without repeats."""
    return list(dict.fromkeys(n for key in DOWNSTREAM_KEYS for n in name_list(entry.get(key))))


def reads_from_detector(entry: Mapping) -> bool:
    """Whether a detector is fed by detectors rather than by an inspector."""
    stated = str(entry.get("consume_from") or "").strip().lower()
    if stated:
        return stated == "detector"
    return any(entry.get(k) for k in UPSTREAM_KEYS) or not entry.get("inspector_name")


def detector_order(detectors: Sequence[Mapping]) -> list[str]:
    """Run order of chained detectors; a cycle or an unknown name is an error."""
    known = {d["name"] for d in detectors}
    graph: dict[str, set] = {name: set() for name in known}
    for d in detectors:
        for child in next_detectors(d):
            if child not in known:
                raise ValueError(f"{d['name']!r} chains to unknown detector {child!r}")
            graph[child].add(d["name"])
    try:
        return list(TopologicalSorter(graph).static_order())
    except CycleError as error:
        raise ValueError(f"detectors form a cycle: {error.args[1]}") from error


def alerter_routes(detectors: Sequence[Mapping]) -> list[tuple[str, str]]:
    """(detector, alerter) pairs; no alerter when switched off, generic when none is named."""
    wanted = [d for d in detectors if d.get("send_to_alerter") is not False]
    return [(d["name"], n) for d in wanted for n in (name_list(d.get("produce_topics")) or [GENERIC_ALERTER])]


def detector_edges(detectors: Sequence[Mapping]) -> list[tuple[str, str]]:
    """(upstream, downstream) pairs whose downstream side listens to detectors."""
    listening = {d["name"] for d in detectors if reads_from_detector(d)}
    return [(d["name"], child) for d in detectors for child in next_detectors(d) if child in listening]


def downstream_messages(warnings: DataFrame, edges: DataFrame) -> DataFrame:
    """Windows of a detector's warnings, addressed to its downstream detectors."""
    return fan_out(
        warnings.select(F.col("name").alias("upstream"), "suspicious_batch_id", "src_ip", "request"),
        edges,
        "upstream",
        "downstream",
    )
