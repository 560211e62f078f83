"""Queries: time series, scorers, verdicts and the split per client."""

from __future__ import annotations

import uuid
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltwatch.catalog.ingest import BATCHES, SPEC
from siltwatch.catalog.registry import query
from siltwatch.catalog.views import DNS, series, verdicts, with_
from siltwatch.operators import inspection as I
from siltwatch.operators.runs import per_step
from siltwatch.operators.scorers import directions
from siltwatch.operators.series import StepSpec, batch_series, dense_axis, step_totals
from siltwatch.plans import flow
from siltwatch.session import checkpoint_root
from siltwatch.sources import testbed as tb
from siltwatch.sources.staging import staged
from siltwatch.streaming.state import KeyedState

STEP = StepSpec(30, "m")
COMPAT = StepSpec(30, "m", "compat")
# Thresholds that split the sparse test batches into both verdicts.
INSPECT = flow.InspectSpec(step=STEP, window=10, score_threshold=1.5, anomaly_threshold=0.1)
ALL = with_(DNS, BATCHES, series())
SUSPECT = with_(DNS, BATCHES, series(), verdicts("z", 1.5, 0.1))


def messages(spark, sf, method="no_relevance_check"):
    return flow.sent_messages(tb.stored_log(spark, sf), SPEC, method, tb.DNS_FORMAT)


def scored(spark, sf, **spec):
    rows = messages(spark, sf)
    merged = flow.InspectSpec(**{**INSPECT.__dict__, **spec})
    return per_step(flow.scored_runs(rows, flow.message_bounds(rows, merged.step), merged))


def _series(spark, sf, step):
    rows = messages(spark, sf)
    return batch_series(rows, flow.message_bounds(rows, step), step)


@query("e1_counts", ALL + " SELECT batch_id, step, n FROM series")
def counts(spark, sf):
    """Messages per step, every message counted."""
    return _series(spark, sf, STEP).select("batch_id", "step", "n")


@query("e1q_counts_compat", with_(DNS, BATCHES, series("compat")) + " SELECT batch_id, step, n FROM series")
def counts_compat(spark, sf):
    """Messages per step, the latest timestamp of a step winning."""
    return _series(spark, sf, COMPAT).select("batch_id", "step", "n")


@query("e1r_steps_in_range", ALL + " SELECT batch_id, step, n, bytes FROM counted")
def in_range(spark, sf):
    return step_totals(messages(spark, sf), STEP).select("batch_id", "step", "n", "bytes")


@query("e2_mean_size", ALL + " SELECT batch_id, step, round(mean_size, 9) AS mean_size FROM series")
def mean_size(spark, sf):
    return _series(spark, sf, STEP).select("batch_id", "step", F.round("mean_size", 9).alias("mean_size"))


@query(
    "e2_mean_size_compat",
    with_(DNS, BATCHES, series("compat")) + " SELECT batch_id, step, round(mean_size, 9) AS mean_size FROM series",
)
def mean_size_compat(spark, sf):
    return _series(spark, sf, COMPAT).select("batch_id", "step", F.round("mean_size", 9).alias("mean_size"))


@query("e3_dense_axis", ALL + " SELECT batch_id, count(*) AS n_steps, max(step) AS last_step FROM axis GROUP BY batch_id")
def axis(spark, sf):
    bounds = flow.message_bounds(messages(spark, sf), STEP)
    return dense_axis(bounds, STEP).groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n_steps"), F.max("step").alias("last_step")
    )


@query("e4a_z_score", ALL + " SELECT batch_id, step, round(z, 6) AS score FROM scored")
def z_score(spark, sf):
    return scored(spark, sf).select("batch_id", "step", F.round("score", 6).alias("score"))


@query("e4b_mad", ALL + " SELECT batch_id, step, round(m, 6) AS score FROM scored")
def mad(spark, sf):
    return scored(spark, sf, models=("MadDetector",)).select("batch_id", "step", F.round("score", 6).alias("score"))


@query(
    "e4c_knn",
    ALL + """ SELECT batch_id, step,
  CASE WHEN c >= 10 THEN round(list_sum(list_sort(list_transform(frame[1:9], lambda v: abs(v - n)))[1:3]) / 3, 6) END AS score FROM scored""",
)
def knn(spark, sf):
    return scored(spark, sf, models=("KNNDetector",)).select("batch_id", "step", F.round("score", 6).alias("score"))


# Discrete Fourier transform of the ten values of a window, its residual, and back.
_SPECTRUM = """,
spectrum AS (
  SELECT batch_id, step,
    list_transform(range(10), lambda k: list_sum(list_transform(range(10), lambda j: frame[j + 1] * cos(2 * pi() * j * k / 10)))) AS re,
    list_transform(range(10), lambda k: -list_sum(list_transform(range(10), lambda j: frame[j + 1] * sin(2 * pi() * j * k / 10)))) AS im
  FROM framed WHERE c >= 10
),
sized AS (
  SELECT *, list_transform(range(1, 11), lambda k: CASE WHEN sqrt(re[k] * re[k] + im[k] * im[k]) > 1e-9 THEN sqrt(re[k] * re[k] + im[k] * im[k]) ELSE 0.0 END) AS size
  FROM spectrum
),
logged AS (
  SELECT *, list_transform(size, lambda s: ln(s + 1e-8)) AS la,
    list_transform(range(1, 11), lambda k: CASE WHEN size[k] > 0 THEN atan2(im[k], re[k]) ELSE 0.0 END) AS angle FROM sized
),
residual AS (
  SELECT *, list_transform(range(1, 11), lambda k: exp(la[k] - (CASE WHEN k > 1 THEN la[k - 1] ELSE 0 END + la[k] + CASE WHEN k < 10 THEN la[k + 1] ELSE 0 END) / 3)) AS amp
  FROM logged
),
salient AS (
  SELECT batch_id, step, list_transform(range(10), lambda j: sqrt(
    pow(list_sum(list_transform(range(10), lambda k: amp[k + 1] * cos(angle[k + 1] + 2 * pi() * j * k / 10))), 2)
    + pow(list_sum(list_transform(range(10), lambda k: amp[k + 1] * sin(angle[k + 1] + 2 * pi() * j * k / 10))), 2)) / 10) AS s FROM residual
)"""


@query(
    "e4d_spectral_residual",
    ALL + _SPECTRUM + """ SELECT f.batch_id, f.step, round(abs(s[10] - list_avg(s)) / (list_avg(s) + 1e-8), 6) AS score
FROM framed f LEFT JOIN salient t ON f.batch_id = t.batch_id AND f.step = t.step""",
)
def spectral(spark, sf):
    return scored(spark, sf, models=("SRDetector",)).select("batch_id", "step", F.round("score", 6).alias("score"))


_DIRECTIONS = ", ".join(
    f"({int(np.flatnonzero(row)[0])}, {float(row[np.flatnonzero(row)[0]])!r}::DOUBLE)" for row in directions(2, 16, 108)
)
# Sixteen projections of the window, each on one of the two values.
_DENSITY = f""",
sized_frames AS (
  SELECT batch_id, step, c, frame, list(mean_size) OVER w AS sizes FROM framed
  WINDOW w AS (PARTITION BY subnet_id ORDER BY flush_no, part, step ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)
),
projected AS (
  SELECT batch_id, step, list_transform(CASE WHEN dim = 0 THEN sizes ELSE frame END, lambda v: weight * v) AS z
  FROM sized_frames, (VALUES {_DIRECTIONS}) d(dim, weight) WHERE c >= 10
),
spanned AS (SELECT *, list_min(z) AS low, list_max(z) - list_min(z) AS span FROM projected),
cells AS (
  SELECT batch_id, step, list_transform(z, lambda v: CASE WHEN span > 1e-12 THEN least(CAST(trunc((v - low) / span * 8) AS INTEGER), 7) ELSE 0 END) AS cell FROM spanned
),
densities AS (SELECT batch_id, step, (0.0 - sum(ln(len(list_filter(cell, lambda x: x = cell[10])) / 10.0))) / 16 AS score FROM cells GROUP BY 1, 2)"""


@query(
    "e5_loda",
    ALL + _DENSITY + """ SELECT f.batch_id, f.step, round(d.score, 6) AS score
FROM framed f LEFT JOIN densities d ON f.batch_id = d.batch_id AND f.step = d.step""",
)
def loda(spark, sf):
    """Two-column series through random projections."""
    out = scored(spark, sf, mode="multivariate", models=("LodaDetector",))
    return out.select("batch_id", "step", F.round("score", 6).alias("score"))


@query(
    "e6_weight_ensemble",
    ALL + " SELECT batch_id, step, round((z + m) / 2, 6) AS score FROM scored",
)
def weight_ensemble(spark, sf):
    out = scored(spark, sf, mode="ensemble", models=("ZScoreDetector", "MadDetector"), ensemble="WeightEnsemble")
    return out.select("batch_id", "step", F.round("score", 6).alias("score"))


@query(
    "e6_vote_ensemble",
    ALL + """ SELECT batch_id, step,
  CASE WHEN z IS NOT NULL THEN CASE WHEN z >= 0.8 AND m >= 0.8 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END END AS score FROM scored""",
)
def vote_ensemble(spark, sf):
    return scored(
        spark, sf, mode="ensemble", models=("ZScoreDetector", "MadDetector"), ensemble="VoteEnsemble"
    ).select("batch_id", "step", "score")


@query("e8_suspicious", SUSPECT + " SELECT batch_id, n_steps, n_anomalies, is_suspicious FROM verdicts")
def suspicious(spark, sf):
    return flow.inspect(messages(spark, sf), INSPECT).select("batch_id", "n_steps", "n_anomalies", "is_suspicious")


PIECES = 5


def in_pieces(rows, number):
    """Rows cut into micro-batches by a number, from low to high."""
    low, high = rows.agg(F.min(number), F.max(number)).first()
    for k in range(PIECES if low is not None else 0):
        place = F.floor((F.col(number) - low) * PIECES / (high - low + 1))
        yield rows.where(place == k)


@query("e12_resumed_scores", ALL + " SELECT batch_id, step, round(z, 6) AS score FROM scored")
def resumed_scores(spark, sf):
    """Scores over micro-batches, each with the scorers' state of those before it, are those of one run."""
    rows = messages(spark, sf)
    state = KeyedState(f"{checkpoint_root(spark)}/scorers-{uuid.uuid4().hex}", flow.KEYS, every=2)
    out = []
    for k, some in enumerate(in_pieces(rows, "flush_no")):
        before = state.before(spark, k)
        out.append(staged(flow.scored_runs(some, flow.message_bounds(some, INSPECT.step), INSPECT, before), "runs"))
        state.put(flow.scorer_state(some, INSPECT, before), k)
    steps = per_step(reduce(DataFrame.unionByName, out))
    return steps.select("batch_id", "step", F.round("score", 6).alias("score"))


@query("e9_no_inspector", ALL + " SELECT DISTINCT batch_id, TRUE AS is_suspicious FROM messages")
def no_inspector(spark, sf):
    return flow.inspect(messages(spark, sf), flow.InspectSpec(inspector="NoInspector", step=STEP))


def suspicious_rows(spark, sf, method="no_relevance_check"):
    rows = messages(spark, sf, method)
    return I.suspicious_lines(rows, flow.inspect(rows, INSPECT))


@query(
    "e10_client_batches",
    SUSPECT + """
SELECT batch_id, src_ip, suspicious_batch_id, count(*) AS message_count, min(begin_ts) AS begin_ts, min(end_ts) AS end_ts
FROM suspicious GROUP BY 1, 2, 3""",
)
def client_batches(spark, sf):
    return I.client_batches(suspicious_rows(spark, sf))


@query("c10_suspicious_links", SUSPECT + " SELECT DISTINCT suspicious_batch_id, batch_id FROM suspicious")
def links(spark, sf):
    return I.batch_links(suspicious_rows(spark, sf))


@query(
    "e11_dropped_batches",
    SUSPECT + """
SELECT batch_id, 'data_inspection.inspector' AS stage, 'filtered_out' AS status, FALSE AS is_active FROM verdicts WHERE NOT is_suspicious""",
)
def dropped_batches(spark, sf):
    return I.dropped_batch_events(flow.inspect(messages(spark, sf), INSPECT))


@query(
    "e11_dropped_lines",
    SUSPECT + """
SELECT DISTINCT CAST(m.logline_id AS VARCHAR) AS logline_id, m.batch_id, 'data_inspection.inspector' AS stage, 'filtered_out' AS status, FALSE AS is_active
FROM messages m JOIN verdicts v ON m.batch_id = v.batch_id WHERE NOT v.is_suspicious""",
)
def dropped_lines(spark, sf):
    rows = messages(spark, sf)
    return I.dropped_line_events(rows, flow.inspect(rows, INSPECT))
