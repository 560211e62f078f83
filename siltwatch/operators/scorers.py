"""Anomaly scorers over trailing windows of a series, and their ensembles.

A scorer sees the last points of its key up to and including the current one. Steps
that are no rows count as zero, so a window may be sparse. Until a full window has
arrived a scorer yields null, which later counts as 0.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from siltwatch.operators.ranking import keyed_offset, trailing_frames

VALUES = ("n", "mean_size")


class Frame:
    """Trailing windows of a series as columns; only what a scorer asks for is computed."""

    def __init__(self, w: int, window: WindowSpec | None = None, over: Callable[[Column], Column] | None = None):
        self.w, self._made = w, {}
        self._over = over or (lambda aggregate: aggregate.over(window))
        self.full = F.col("position") >= w

    def _need(self, name: str, aggregate: Column) -> Column:
        self._made.setdefault(name, aggregate)
        return F.col(name)

    def columns(self) -> list[Column]:
        """Window columns to add before the scores are read."""
        return [self._over(aggregate).alias(name) for name, aggregate in self._made.items()]

    def current(self, value: str) -> Column:
        return F.coalesce(value, F.lit(0.0))

    def total(self, value: str) -> Column:
        return F.coalesce(self._need(f"_total_{value}", F.sum(value)), F.lit(0.0))

    def squares(self, value: str) -> Column:
        return F.coalesce(self._need(f"_squares_{value}", F.sum(F.col(value) * F.col(value))), F.lit(0.0))

    def rows(self, value: str) -> Column:
        """Values of the rows in the window, oldest first."""
        return self._need(f"_rows_{value}", F.collect_list(value))

    def places(self) -> Column:
        """Positions of the rows in the window that have values."""
        return self._need("_places", F.collect_list(F.when(F.col("n").isNotNull(), F.col("position"))))

    def values(self, value: str) -> Column:
        """All ``w`` values of the window in ascending order."""
        rows = self.rows(value)
        return F.sort_array(F.concat(rows, F.array_repeat(F.lit(0.0), F.lit(self.w) - F.size(rows))))


# A scorer maps (frame, names of the values) to a score column.
Scorer = Callable[[Frame, Sequence[str]], Column]
UNIVARIATE: dict[str, Scorer] = {}
MULTIVARIATE: dict[str, Scorer] = {}
ENSEMBLES: dict[str, Callable[..., Column]] = {}
MODES = ("univariate", "multivariate", "ensemble")


def univariate(name: str):
    """Register a scorer of one value per step."""

    def add(fn: Scorer) -> Scorer:
        UNIVARIATE[name] = fn
        return fn

    return add


def multivariate(name: str):
    """Register a scorer of several values per step."""

    def add(fn: Scorer) -> Scorer:
        MULTIVARIATE[name] = fn
        return fn

    return add


def ensemble(name: str):
    def add(fn):
        ENSEMBLES[name] = fn
        return fn

    return add


def steps_apart(model: str) -> bool:
    """Whether a score depends on where in the window the values lie."""
    return getattr({**UNIVARIATE, **MULTIVARIATE}.get(model), "ordered", False)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _median(ordered: Column, w: int) -> Column:
    return (F.element_at(ordered, (w + 1) // 2) + F.element_at(ordered, w // 2 + 1)) / 2


def _per_window(score: Callable[..., np.ndarray], frame: Frame, values: Sequence[str]) -> Column:
    """Score whole windows in Arrow batches.

    ``score`` gets one (rows x w) matrix per value and returns a score per row;
    windows that are not full yet stay null.
    """
    w = frame.w

    def run(position: pd.Series, places: pd.Series, *rows: pd.Series) -> pd.Series:
        out = np.full(len(position), np.nan)
        full = position.to_numpy() >= w
        if full.any():
            sizes = places[full].map(len).to_numpy()
            row = np.repeat(np.arange(len(sizes)), sizes)
            ends = np.repeat(position[full].to_numpy(), sizes)
            at = w - 1 - (ends - np.concatenate([*places[full].to_numpy(), np.zeros(0)]).astype(np.int64))
            dense = []
            for lists in rows:
                matrix = np.zeros((len(sizes), w))
                matrix[row, at] = np.concatenate([*lists[full].to_numpy(), np.zeros(0)])
                dense.append(matrix)
            out[full] = score(*dense)
        return pd.Series(out)

    scored = F.pandas_udf(run, "double")
    return scored(F.col("position"), frame.places(), *[frame.rows(v) for v in values])


@univariate("ZScoreDetector")
def z_score(frame: Frame, values: Sequence[str]) -> Column:
    """Distance from the window mean in population standard deviations."""
    (x,) = values
    total, squares, w = frame.total(x), frame.squares(x), frame.w
    spread = squares * w - total * total
    some = spread > squares * (w * 1e-12)
    score = F.when(some, F.abs(frame.current(x) * w - total) / F.sqrt(F.when(some, spread))).otherwise(F.lit(0.0))
    return F.when(frame.full, score)


@univariate("MadDetector")
def mad_score(frame: Frame, values: Sequence[str]) -> Column:
    """Distance from the window median in median absolute deviations."""
    (x,) = values
    w, now = frame.w, frame.current(x)

    def score(ordered: Column) -> Column:
        return _bound(_median(ordered, w), lambda middle: _bound(
            _median(F.sort_array(F.transform(ordered, lambda v: F.abs(v - middle))), w),
            lambda mad: F.when(mad > 0, F.abs(now - middle) / mad).otherwise(F.lit(0.0)),
        ))

    return F.when(frame.full, _bound(frame.values(x), score))


@univariate("KNNDetector")
def knn_score(frame: Frame, values: Sequence[str], k: int = 3) -> Column:
    """Mean distance to the ``k`` nearest earlier points of the window."""
    (x,) = values
    now = frame.current(x)
    off = F.sort_array(F.transform(frame.values(x), lambda v: F.abs(v - now)))
    near = F.slice(off, 2, k)  # the first is the current point itself
    return F.when(frame.full, _bound(near, lambda d: F.aggregate(d, F.lit(0.0), lambda a, v: a + v) / F.size(d)))


@univariate("SRDetector")
def spectral_residual(frame: Frame, values: Sequence[str]) -> Column:
    """Saliency of the newest point in the spectral residual of its window.

    A component that vanishes has no angle; it counts as zero.
    """

    def score(x: np.ndarray) -> np.ndarray:
        spectrum = np.fft.fft(x, axis=1)
        size = np.abs(spectrum)
        log_amp = np.log(np.where(size > 1e-9, size, 0) + 1e-8)
        wide = np.pad(log_amp, ((0, 0), (1, 1)))
        smooth = (wide[:, :-2] + wide[:, 1:-1] + wide[:, 2:]) / 3
        angle = np.where(size > 1e-9, np.angle(spectrum), 0)
        saliency = np.abs(np.fft.ifft(np.exp(log_amp - smooth + 1j * angle), axis=1))
        mean = saliency.mean(axis=1)
        return np.abs(saliency[:, -1] - mean) / (mean + 1e-8)

    return _per_window(score, frame, values)


spectral_residual.ordered = True


def directions(dims: int, count: int, seed: int) -> np.ndarray:
    """Sparse random directions: about sqrt(dims) non-zero weights each."""
    rng = np.random.default_rng(seed)
    used = max(1, round(dims**0.5))
    out = np.zeros((count, dims))
    for row in out:
        row[rng.choice(dims, used, replace=False)] = rng.standard_normal(used)
    return out


@multivariate("LodaDetector")
def loda_score(frame: Frame, values: Sequence[str], count: int = 16, bins: int = 8, seed: int = 108) -> Column:
    """Mean negative log density of the newest point over random 1-d histograms."""
    chosen = directions(len(values), count, seed)

    def score(*dims: np.ndarray) -> np.ndarray:
        total = np.zeros(len(dims[0]))
        for weights in chosen:
            z = sum(weight * d for weight, d in zip(weights, dims, strict=True))
            low = z.min(axis=1, keepdims=True)
            span = z.max(axis=1, keepdims=True) - low
            place = np.divide(z - low, span, out=np.zeros_like(z), where=span > 1e-12)
            cell = np.minimum((place * bins).astype(int), bins - 1)
            total -= np.log((cell == cell[:, -1:]).mean(axis=1))
        return total / count

    return _per_window(score, frame, values)


@ensemble("WeightEnsemble")
def weighted(scores: Sequence[Column], weights: Sequence[float] | None = None, **_) -> Column:
    """Weighted mean of the scores that are not null."""
    weights = weights or [1.0] * len(scores)
    pairs = list(zip(scores, weights, strict=True))
    top = reduce(lambda a, b: a + b, [F.coalesce(s * w, F.lit(0.0)) for s, w in pairs])
    bottom = reduce(lambda a, b: a + b, [F.when(s.isNotNull(), F.lit(float(w))).otherwise(F.lit(0.0)) for s, w in pairs])
    return F.when(bottom > 0, top / bottom)


@ensemble("VoteEnsemble")
def vote(scores: Sequence[Column], threshold: float = 0.8, **_) -> Column:
    """1 when more than half of the scorers reach the threshold, else 0."""
    votes = reduce(lambda a, b: a + b, [F.when(s >= threshold, F.lit(1)).otherwise(F.lit(0)) for s in scores])
    known = reduce(lambda a, b: a | b, [s.isNotNull() for s in scores])
    return F.when(known, (votes > len(scores) / 2).cast("double"))


def check_models(mode: str, models: Sequence[str], ensemble_model: str | None = None) -> None:
    """Reject unknown modes, unknown models for a mode, and empty model lists."""
    if mode not in MODES:
        raise NotImplementedError(f"inspection mode {mode!r}")
    if not models:
        raise NotImplementedError("inspection needs at least one model")
    known = MULTIVARIATE if mode == "multivariate" else UNIVARIATE
    unknown = [m for m in models if m not in known]
    if unknown:
        raise NotImplementedError(f"models {unknown} do not support mode {mode!r}")
    if mode == "ensemble" and ensemble_model not in ENSEMBLES:
        raise NotImplementedError(f"ensemble model {ensemble_model!r}")


def with_positions(
    series: DataFrame, bounds: DataFrame, keys: Sequence[str], order: Sequence[str], slot: Column
) -> DataFrame:
    """Position of each step in the whole series of its key.

    A key's batches are laid end to end: a batch starts after the steps of those
    before it. Only batches are ordered, slot by slot.
    """
    starts = keyed_offset(bounds, keys, slot, [F.col(c) for c in order], "n_steps", "_start")
    return (
        series.join(starts.select(*keys, "batch_id", "_start"), "batch_id")
        .withColumn("position", F.col("_start") + F.col("step") + 1)
        .drop("_start")
    )


def score_columns(
    frame: Frame, mode: str, models: Sequence[str], ensemble_model: str | None = None, **ensemble_args
) -> Column:
    """Score of the configured models; only an ensemble uses more than its first."""
    check_models(mode, models, ensemble_model)
    values = ("mean_size", "n") if mode == "multivariate" else ("n",)
    known = MULTIVARIATE if mode == "multivariate" else UNIVARIATE
    scores = [known[m](frame, values) for m in (models if mode == "ensemble" else models[:1])]
    return ENSEMBLES[ensemble_model](scores, **ensemble_args) if mode == "ensemble" else scores[0]


def score_series(
    positioned: DataFrame,
    keys: Sequence[str],
    mode: str = "univariate",
    models: Sequence[str] = ("ZScoreDetector",),
    ensemble_model: str | None = None,
    window: int = 50,
    chunk: int = 20_000,
    **ensemble_args,
) -> DataFrame:
    """Add ``score`` to every step of a series that has a row for each position."""
    frame = Frame(window, over=lambda aggregate: aggregate)
    score = score_columns(frame, mode, models, ensemble_model, **ensemble_args)
    names = list(frame._made)
    scored = trailing_frames(positioned, keys, "position", lambda over: {k: over(v) for k, v in frame._made.items()}, window, chunk)
    return scored.withColumn("score", score).drop(*names)
