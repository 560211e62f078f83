"""The detection flow: valid lines -> batches -> suspicious lines -> alerts."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltwatch.functions.rules import LogFormat
from siltwatch.operators import alerts as A
from siltwatch.operators.batching import BatchSpec, assign_batches, carry_over
from siltwatch.operators.detection import DETECTORS, RESUMED
from siltwatch.operators.filtering import keep_relevant
from siltwatch.operators.inspection import INSPECTORS, batch_verdicts, inspector, suspicious_lines
from siltwatch.operators import runs as R
from siltwatch.operators.routing import detector_edges, detector_order, reads_from_detector
from siltwatch.operators.scorers import check_models
from siltwatch.operators.series import StepSpec, step_count, step_totals
from siltwatch.operators.tunnel import CHAINED_ORDER, ORDER, from_requests
from siltwatch.sources.staging import staged


@dataclass(frozen=True)
class InspectSpec:
    """How batches are inspected; a model's state belongs to one subnet."""

    inspector: str = "SeriesInspector"
    mode: str = "univariate"
    models: tuple[str, ...] = ("ZScoreDetector",)
    ensemble: str | None = None
    step: StepSpec = field(default_factory=StepSpec)
    window: int = 50
    score_threshold: float = 0.5
    anomaly_threshold: float = 0.1


def sent_messages(lines: DataFrame, batch: BatchSpec, method: str, fmt: LogFormat) -> DataFrame:
    """Filtered rows of every sent batch, buffer included.

    The filter comes after batching: batches are cut on unfiltered counts.
    Inspection reads the result several times, so it is a stage boundary.
    """
    return staged(keep_relevant(carry_over(assign_batches(lines, batch), batch), method, fmt), "messages")


def message_bounds(messages: DataFrame, step: StepSpec) -> DataFrame:
    """One row per batch that still has messages."""
    return (
        messages.groupBy("subnet_id", "batch_id", "flush_no", "part")
        .agg(F.first("begin_ts").alias("begin_ts"), F.first("end_ts").alias("end_ts"))
        .withColumn("n_steps", step_count(step))
    )


KEYS = ("subnet_id",)


def _placed(messages: DataFrame, bounds: DataFrame, spec: InspectSpec, before: DataFrame | None):
    """(points, spans) of the batches, after what earlier micro-batches left."""
    slot = F.floor(F.col("flush_no") / 100).cast("bigint")
    span = R.spans(bounds, KEYS, ["flush_no", "part"], slot, before)
    return R.placed_points(step_totals(messages, spec.step), span, KEYS), span


def scored_runs(messages: DataFrame, bounds: DataFrame, spec: InspectSpec, before: DataFrame | None = None) -> DataFrame:
    """Runs of steps of every batch with their anomaly score."""
    points, span = _placed(messages, bounds, spec, before)
    return R.scored_runs(points, span, KEYS, spec.mode, spec.models, spec.ensemble, spec.window, before)


def scorer_state(messages: DataFrame, spec: InspectSpec, before: DataFrame | None = None) -> DataFrame:
    """What the scorers of the touched subnets need for the next micro-batch."""
    points, span = _placed(messages, message_bounds(messages, spec.step), spec, before)
    return R.resumed_state(points, span, KEYS, spec.window, before)


@inspector("SeriesInspector")
def inspect_series(messages: DataFrame, bounds: DataFrame, spec: InspectSpec, before: DataFrame | None = None) -> DataFrame:
    check_models(spec.mode, spec.models, spec.ensemble)
    return batch_verdicts(scored_runs(messages, bounds, spec, before), spec.score_threshold, spec.anomaly_threshold)


inspect_series.resumes = True


def resumes(spec: InspectSpec) -> bool:
    """Whether the inspector goes on where the last micro-batch ended."""
    return getattr(INSPECTORS.get(spec.inspector), "resumes", False)


def inspect(messages: DataFrame, spec: InspectSpec, before: DataFrame | None = None) -> DataFrame:
    """Verdict per batch from the configured inspector; ``before`` is the scorers' state so far."""
    if spec.inspector not in INSPECTORS:
        raise NotImplementedError(f"inspector {spec.inspector!r} is not registered")
    state = {"before": before} if before is not None and resumes(spec) else {}
    return INSPECTORS[spec.inspector](messages, message_bounds(messages, spec.step), spec=spec, **state)


def detect(lines: DataFrame, detector: str, include_buffer: bool = False, **settings) -> DataFrame:
    """Warnings of a registered detector.

    Carried-over rows were new rows of the batch before; they are scored again
    only with ``include_buffer``.
    """
    if detector not in DETECTORS:
        raise NotImplementedError(f"detector {detector!r} is not registered")
    return DETECTORS[detector](lines if include_buffer else own_lines(lines), **settings)


def own_lines(lines: DataFrame) -> DataFrame:
    """Lines without those carried over."""
    return lines.filter(~F.col("is_buffer")) if "is_buffer" in lines.columns else lines


def run_detectors(
    lines: DataFrame,
    entries: Sequence[Mapping],
    keep: Callable[[DataFrame, str], DataFrame] = staged,
    queue: Callable[[str], tuple[DataFrame | None, Callable[[DataFrame], None]]] | None = None,
) -> dict[str, DataFrame]:
    """Warnings of every configured detector, upstream ones first.

    A detector reads the suspicious lines, or the windows of its upstream detectors,
    each once. Its warnings are written (``keep``) before others read them. In a
    stream ``queue`` gives the last queries a detector has seen and takes the new ones.
    """
    by_name, upstream, out = {e["name"]: e for e in entries}, {}, {}
    for source, target in detector_edges(entries):
        upstream.setdefault(target, []).append(source)
    for name in detector_order(entries):
        entry = by_name[name]
        kind = entry["detector"]
        if kind not in DETECTORS:
            raise NotImplementedError(f"detector {kind!r} is not registered")
        settings = {**entry.get("settings", {}), "name": name}
        order = ORDER
        if reads_from_detector(entry):
            if name not in upstream:
                raise ValueError(f"detector {name!r} listens to detectors, but none names it")
            rows, order = reduce(DataFrame.unionByName, [from_requests(out[u]) for u in upstream[name]]), CHAINED_ORDER
        else:
            rows = own_lines(lines)
        if kind not in RESUMED:
            found = DETECTORS[kind](rows, **settings)
        elif queue is None:
            found = DETECTORS[kind](rows, order=order, **settings)
        else:
            before, put = queue(name)
            arrived = keep(RESUMED[kind].arrivals(rows, order=order, before=before), f"arrivals-{name}")
            found = RESUMED[kind].warnings(arrived, before, **settings)
            put(RESUMED[kind].state(arrived, before=before))
        out[name] = keep(found, f"warnings-{name}")
    return out


def alerts_of(
    lines: DataFrame,
    batch: BatchSpec,
    fmt: LogFormat,
    method: str,
    inspection: InspectSpec,
    detector: str,
    at: Column,
    include_buffer: bool = False,
    **settings,
) -> DataFrame:
    """The whole flow for one collector, in one plan."""
    messages = sent_messages(lines, batch, method, fmt)
    suspicious = suspicious_lines(messages, inspect(messages, inspection))
    warnings = detect(suspicious, detector, include_buffer, **settings)
    return A.build_alerts(warnings, settings.get("name", detector), at, A.compact_warning())
