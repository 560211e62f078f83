"""Tunnel detection over the last queries of a domain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltwatch.functions.domains import with_domain_parts
from siltwatch.functions.similarity import METRICS, window_similarity
from siltwatch.operators.detection import REQUEST, RESUMED, attribution_warnings, binary_warnings, detector, request_entry
from siltwatch.operators.ranking import keyed_rank, time_slot, trailing_frames

# Queue length, and the fewest queries that are scored.
WINDOW = 10
FEWEST = 3


KEYS = ("secondleveldomain",)
ORDER = ("ts", "logline_id")


def arrivals(
    lines: DataFrame,
    keys: Sequence[str] = KEYS,
    order: Sequence[str] = ORDER,
    slot_seconds: int = 60,
    before: DataFrame | None = None,
) -> DataFrame:
    """Lines with their ``arrival`` number per key, and the ``entry`` a window keeps of them.

    A popular label is numbered slot by slot. ``before`` (keys, arrived, tail) counts
    what earlier micro-batches brought.
    """
    split = with_domain_parts(lines) if "secondleveldomain" not in lines.columns else lines
    ranked = keyed_rank(split, list(keys), time_slot(F.col(order[0]), slot_seconds), [F.col(c) for c in order], "arrival")
    if before is not None:
        ranked = ranked.join(before.select(*keys, "arrived"), list(keys), "left")
        ranked = ranked.withColumn("arrival", F.col("arrival") + F.coalesce("arrived", F.lit(0))).drop("arrived")
    request = request_entry(lines).cast(REQUEST.removeprefix("array<").removesuffix(">"))
    return ranked.withColumn("entry", F.struct(request.alias("request"), F.col("thirdleveldomain").alias("sub")))


def _with_tail(arrived: DataFrame, keys: Sequence[str], before: DataFrame | None) -> DataFrame:
    """Arrivals and, marked, the last ones of earlier micro-batches."""
    rows = arrived.withColumn("_old", F.lit(False))
    if before is None:
        return rows
    old = before.select(*keys, F.explode("tail").alias("_t")).select(*keys, "_t.arrival", "_t.entry", F.lit(True).alias("_old"))
    return rows.unionByName(old, allowMissingColumns=True)


def windows_of(
    arrived: DataFrame,
    keys: Sequence[str] = KEYS,
    size: int = WINDOW,
    fewest: int = FEWEST,
    chunk: int = 20_000,
    before: DataFrame | None = None,
) -> DataFrame:
    """The last ``size`` queries of the key at every arrival, framed chunk by chunk."""
    rows = _with_tail(arrived, keys, before)
    framed = trailing_frames(rows, list(keys), "arrival", lambda over: {"_frame": over(F.collect_list("entry"))}, size, chunk)
    return (
        framed.filter(~F.col("_old") & (F.size("_frame") >= fewest))
        .withColumn("request", F.transform("_frame", lambda e: e["request"]).cast(REQUEST))
        .withColumn("subdomains", F.transform("_frame", lambda e: e["sub"]))
        .drop("_frame", "_old", "entry")
    )


def tunnel_state(arrived: DataFrame, keys: Sequence[str] = KEYS, size: int = WINDOW, before: DataFrame | None = None) -> DataFrame:
    """State (keys, arrived, tail) for the next micro-batch, of the keys that got lines; a tail has ``size`` - 1 entries."""
    ends = arrived.groupBy(*keys).agg(F.max("arrival").alias("arrived"))
    rows = _with_tail(arrived, keys, before).select(*keys, "arrival", "entry").join(ends, list(keys))
    last = rows.where(F.col("arrival") > F.col("arrived") - (size - 1))
    return last.groupBy(*keys, "arrived").agg(F.array_sort(F.collect_list(F.struct("arrival", "entry"))).alias("tail"))


def tunnel_windows(
    lines: DataFrame,
    keys: Sequence[str] = KEYS,
    size: int = WINDOW,
    fewest: int = FEWEST,
    order: Sequence[str] = ORDER,
    slot_seconds: int = 60,
    chunk: int = 20_000,
) -> DataFrame:
    """The last ``size`` queries of the domain at every arrival.

    The key is the second-level label alone; add ``src_ip`` to keep clients
    apart. A popular label is numbered slot by slot and framed chunk by chunk.
    """
    return windows_of(arrivals(lines, keys, order, slot_seconds), keys, size, fewest, chunk)


def with_similarity(windows: DataFrame, subdomains: str = "subdomains") -> DataFrame:
    """Add the seven mean pairwise similarities of each window."""
    scored = windows.withColumn("_m", window_similarity(F.col(subdomains)))
    return scored.select("*", *[F.col(f"_m.{m}").alias(m) for m in METRICS]).drop("_m")


# Order of messages that come from upstream warnings.
CHAINED_ORDER = ("arrived_at", "trigger", "place")


def from_requests(warnings: DataFrame) -> DataFrame:
    """Messages of upstream warnings, one row each; nested windows become rows.

    The same message can sit in many upstream windows; it arrives once per
    window, as it does from an upstream detector. A window arrives with its
    newest message.
    """
    newest = F.element_at("request", -1)
    return warnings.select(
        "suspicious_batch_id",
        "src_ip",
        newest["ts"].alias("arrived_at"),
        newest["logline_id"].alias("trigger"),
        F.posexplode("request").alias("place", "m"),
    ).select("suspicious_batch_id", "src_ip", *CHAINED_ORDER, "m.*")


def _two_classes(windows: DataFrame) -> DataFrame:
    """Transparent stand-in for a model of two classes."""
    return windows.withColumn("probabilities", F.array("jaro", F.lit(1.0) - F.col("jaro")))


def _warn(windows: DataFrame, name: str, threshold: float = 0.5, score=None, sha256: str = "") -> DataFrame:
    windows = with_similarity(windows)
    scored = score(windows) if score else windows.withColumn("probability", F.lit(1.0) - F.col("jaro"))
    return binary_warnings(scored, name, threshold, sha256, request=F.col("request"))


def _attribute(
    windows: DataFrame, name: str, threshold: float = 0.5, score=None, sha256: str = "", labels: Sequence[str] = ("benign", "tunnel")
) -> DataFrame:
    scored = (score or _two_classes)(with_similarity(windows))
    return attribution_warnings(scored, labels, name, threshold, sha256)


class Windowed:
    """A detector of windows over micro-batches: number the lines, warn, keep the last queries of every label."""

    keys = KEYS
    arrivals = staticmethod(arrivals)
    state = staticmethod(tunnel_state)

    def __init__(self, warn):
        self._warn = warn

    def warnings(self, arrived: DataFrame, before: DataFrame | None = None, **settings) -> DataFrame:
        return self._warn(windows_of(arrived, before=before), **settings)


@detector("TunnelDetector")
def tunnel_warnings(lines: DataFrame, name: str = "tunnel", order: Sequence[str] = ORDER, **settings) -> DataFrame:
    """Warn per window (``threshold``, ``score``, ``sha256``); the warning keeps a snapshot of the whole window."""
    return _warn(tunnel_windows(lines, order=order), name, **settings)


@detector("AttributionDetector")
def attribution_of_windows(lines: DataFrame, name: str = "attribution", order: Sequence[str] = ORDER, **settings) -> DataFrame:
    """Name the tool behind a window: ``labels``, and ``score`` that adds their ``probabilities``."""
    return _attribute(tunnel_windows(lines, order=order), name, **settings)


RESUMED.update({"TunnelDetector": Windowed(_warn), "AttributionDetector": Windowed(_attribute)})
